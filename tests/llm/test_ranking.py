import math
import random
from collections import Counter

from gatewatch.llm import ranking
from gatewatch.llm.common import alnum_words

from .helpers import same_rows


def test_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert same_rows(ranking.op13_ranked_search(spark, sf), ranking.OP13_SQL, sf) == 2000


def brute(docs, items, top):
    held = [(i, alnum_words((t or "").encode())) for i, t in docs]
    held = [(i, w) for i, w in held if w]
    n, total = len(held), sum(len(w) for _, w in held)
    df = Counter(t for _, w in held for t in set(w))
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(alnum_words((t or "").encode()))
    out = {}
    for item, terms in wanted.items():
        rows = []
        for i, words in held:
            tf = Counter(words)
            m = 50 + 50 * len(words) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 20 * m))
                    for t in terms if t in tf)
            if s > 0:
                rows.append((-s, i is None, i or 0, i))
        out[item] = [(k + 1, r[3], -r[0]) for k, r in enumerate(sorted(rows)[:top])]
    return {i: r for i, r in out.items() if r}


def ranks(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r.rank):
        out.setdefault(r.item, []).append((r.rank, r.id, r.score))
    return out


def tables(spark, docs, items):
    return (spark.createDataFrame([(i, t, 0, "x") for i, t in docs], "doc_id long, text string, rank int, item string"),
            spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id long"))


def test_equals_brute_force(spark):
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(150)]
    pick = lambda k: " ".join(rng.choices(vocab, [1 / (i + 1) for i in range(150)], k=k))
    docs = [(i, pick(rng.randint(0, 60))) for i in range(600)]
    docs += [(1000 + i, docs[3][1]) for i in range(300)]  # ties of a hot text
    docs += [(None, docs[3][1]), (None, None), (2000, None), (2001, ""), (5, docs[5][1]), (2002, pick(200_000))]
    items = [(i, pick(rng.choice([1, 5, 20, 400]))) for i in range(30)]  # some have more terms than a mask word has bits
    items += [(50, None), (51, "..."), (52, "W1 w1 W2"), (0, pick(3)), (None, "w3 w4"), (53, "nowhere"), (54, docs[3][1])]
    want = brute(docs, items, 50)
    d, i = tables(spark, docs, items)
    assert ranks(ranking.ranked_search(d.repartition(5), i)) == want
    # small blocks of documents and of items change nothing
    assert ranks(ranking.ranked_search(d.repartition(3), i, item_bytes=2000, block_bytes=3000)) == want
    assert ranks(ranking.ranked_search(d, i, top=1)) == brute(docs, items, 1)


def test_masks_are_skipped_only_when_safe():
    import numpy as np

    rng = random.Random(9)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(80)], k=rng.randint(1, 30))).encode() for _ in range(400)]
    raw = np.frombuffer(b"".join(texts), np.uint8)
    at = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    words = sorted({w for t in texts for w in t.split()})
    data = np.frombuffer(b"".join(words), np.uint8)
    end = np.cumsum([len(w) for w in words])
    hashes = ranking.span_hashes(data, end - [len(w) for w in words], end)
    items = ranking.Items.of([hashes.view(np.int64).tolist()])
    post = ranking.Postings(raw, at, 0, len(texts), items.terms, ranking.presence(items.terms))
    weight = np.array([rng.randint(1, 5000) for _ in items.terms], np.int64)
    length = 50 + post.size
    most = np.maximum.reduceat(post.count, post.start[:-1])
    own = items.number[:70]
    every, scores = ranking.candidates(post, own, weight, length, most, len(texts), 1)
    best = sorted(zip((-scores).tolist(), every.tolist(), strict=True))
    for top in (1, 3, 50):
        rows, some = ranking.candidates(post, own, weight, length, most, top, 1)
        assert sorted(zip((-some).tolist(), rows.tolist(), strict=True))[:top] == best[:top]
        assert len(rows) < len(every)


def test_empty_tables(spark):
    d, i = tables(spark, [(1, "a b")], [(1, "a")])
    assert ranking.ranked_search(d.limit(0), i).count() == 0
    assert ranking.ranked_search(d, i.limit(0)).count() == 0
    assert [tuple(r) for r in ranking.ranked_search(d, i).collect()] == [(1, 1, 1, brute([(1, "a b")], [(1, "a")], 50)[1][0][2])]
