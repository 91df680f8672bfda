import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from gatewatch.llm import repeats as rep
from gatewatch.llm.common import table
from gatewatch.llm.suffixes import RangeMinimum, common_prefixes, suffix_array


def test_suffix_array_equals_sorting():
    rng = random.Random(0)
    for size in list(range(12)) * 20 + [50, 200, 400] * 10:
        s = [rng.randint(0, rng.choice([1, 2, 5, 50])) for _ in range(size)]
        order = suffix_array(s)
        assert order == sorted(range(size), key=lambda i: s[i:]), s
        want = [0] * size
        for k in range(1, size):
            a, b = s[order[k - 1]:], s[order[k]:]
            want[k] = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert common_prefixes(s, order) == want
    for s in ([0] * 300, [0, 1] * 150, list(range(200)), list(range(200))[::-1]):
        assert suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def test_range_minimum():
    x = np.random.default_rng(0).integers(0, 9, 100)
    low = RangeMinimum(x)
    lo, hi = np.triu_indices(101, 1)
    assert (low(lo, hi) == [x[a:b].min() for a, b in zip(lo, hi, strict=True)]).all()


def brute(texts, span):
    count = Counter(t[i:i + span] for t in texts for i in range(len(t) - span + 1))
    out = []
    for t in texts:
        dead = bytearray(len(t))
        for i in range(len(t) - span + 1):
            if count[t[i:i + span]] > 1:
                dead[i:i + span] = b"\1" * span
        kept = bytes(c for c, d in zip(t, dead, strict=True) if not d)
        runs = sum(d and not (i and dead[i - 1]) for i, d in enumerate(dead))
        out.append((len(t), sum(dead), runs, hashlib.sha256(kept).hexdigest()))
    return out


def rows(df):
    return sorted((r.id if r.id is not None else -1, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


@pytest.mark.parametrize("span,gram,max_segments", [(12, 4, 4096), (12, 12, 3), (40, 16, 2), (40, 16, 8), (40, 13, 4096)])
def test_equals_brute_force_on_small_texts(spark, span, gram, max_segments):
    rng = random.Random(span + gram)
    word = lambda: "".join(rng.choices("abé", k=rng.randint(1, 6)))
    common = [" ".join(word() for _ in range(30)) for _ in range(4)]
    texts = []
    for _ in range(60):
        t = " ".join(word() for _ in range(rng.randint(0, 25)))
        for _ in range(rng.randint(0, 2)):
            c = rng.choice(common)
            a = rng.randint(0, len(c) - 1)
            t += c[a:a + rng.randint(1, 120)] + word()
        texts.append(t)
    texts += ["a" * 100, "ab" * 60, "b" + "a" * 90, None, "", texts[3], texts[5], "x" * (span - 1), "0123456789" * 30, common[0], common[0]]
    docs = spark.createDataFrame([(i, t, b"k", 7) for i, t in enumerate(texts)] + [(None, common[1], b"k", 7)],
                                 "doc_id long, text string, cid binary, n_bytes int").repartition(3)
    want = brute([(t or "").encode() for t in [*texts, common[1]]], span)
    got = rows(rep.remove_repeats(docs, span=span, gram=gram, max_segments=max_segments))
    assert got == sorted((i if i < len(texts) else -1, *w) for i, w in enumerate(want))


@pytest.mark.parametrize("max_segments", [2, 512, 4096])
def test_equals_hashing_on_documents(spark, sf_small, max_segments):
    docs = table(spark, sf_small, "documents")
    data = docs.collect()
    texts = [(r.text or "").encode() for r in data]
    seen = Counter(hash(t[i:i + 400]) for t in texts for i in range(len(t) - 399))
    want = []
    for r, t in zip(data, texts, strict=True):
        gone = np.zeros(len(t) + 1, int)
        for i in range(len(t) - 399):
            if seen[hash(t[i:i + 400])] > 1:
                gone[i] += 1
                gone[i + 400] -= 1
        dead = np.cumsum(gone[:-1]) > 0
        kept = np.frombuffer(t, np.uint8)[~dead].tobytes()
        want.append((r.doc_id, len(t), int(dead.sum()), int((np.diff(dead.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    assert rows(rep.remove_repeats(docs, max_segments=max_segments)) == sorted(want)


def test_long_and_empty(spark):
    docs = spark.createDataFrame([(1, "z" * 200_000), (2, "y" * 399), (3, "y" * 400)], "doc_id long, text string")
    got = {r.id: (r.n_removed, r.n_spans) for r in rep.remove_repeats(docs).collect()}
    assert got == {1: (200_000, 1), 2: (0, 0), 3: (0, 0)}
    assert rep.remove_repeats(docs.limit(0)).count() == 0


def test_near_copies_take_few_rounds(spark, monkeypatch):
    rng = random.Random(5)
    base = "".join(rng.choices("abcdefghij ", k=1000))
    texts = [base[:i] + "#" + base[i + 1:] for i in range(3, 1000, 12)] + [base]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    written = []
    monkeypatch.setattr(rep, "checkpointed", lambda df, own=rep.checkpointed: written.append(1) or own(df))
    got = rows(rep.remove_repeats(docs, max_segments=2))
    assert got == sorted((i, *w) for i, w in enumerate(brute([t.encode() for t in texts], 400)))
    assert len(written) <= 12
