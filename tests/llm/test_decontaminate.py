import re

import pytest

from gatewatch.llm import decontaminate as d

from .helpers import same_rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))


def brute(text, items, n=10):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        v = words(t)
        m = min(n, len(v))
        wins = {tuple(v[i:i + m]) for i in range(len(v) - m + 1)} if m else set()
        for i in range(len(w) - m + 1):
            if tuple(w[i:i + m]) in wins:
                hit.update(range(i, i + m))
                found |= {str(item)} if item is not None else set()
    return len(w), len(hit), sorted(found)


def test_equals_sql(spark, sf_small):
    assert same_rows(d.op3_benchmark_decontamination(spark, sf_small), d.OP3_SQL, sf_small) == 200


@pytest.mark.parametrize("broadcast_bytes", [64, 32 << 20])
def test_small_cases_equal_brute_force(spark, broadcast_bytes):
    import random
    rng = random.Random(4)
    vocab = ["a", "b", "Cé", "d1"]
    items = [(i, " ".join(rng.choices(vocab, k=rng.randint(0, 16)))) for i in range(12)]
    items += [(2, items[2][1]), (None, "x y z"), (99, None), (98, ""), (97, "solo"), (96, "q " * 30)]
    texts = [" ".join(rng.choices(vocab + ["solo"], k=rng.randint(0, 60))) for _ in range(25)]
    texts += [None, "", "x Y z", items[3][1] + "." + items[4][1], "Q " * 500, "solo", "a" * 30_000, texts[0]]
    docs = spark.createDataFrame([(i, t, "extra") for i, t in enumerate(texts)] + [(None, "solo", "x")],
                                 "doc_id long, text string, spans string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.id: (r.n_words, sum(s.end - s.start for s in r.spans), sorted(r.items))
           for r in d.contamination(docs, bench, broadcast_bytes=broadcast_bytes).collect()}
    assert got == {i: brute(t, items) for i, t in enumerate(texts)} | {None: brute("solo", items)}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert [r.spans for r in d.contamination(docs, bench).collect()] == [[]]
    assert d.contamination(docs.limit(0), bench).count() == 0


def test_drop_keeps_clean_rows_and_columns(spark):
    docs = spark.createDataFrame([(1, "one two three", "k"), (None, "Solo", "k"), (2, None, None), (2, None, None)],
                                 "doc_id long, text string, id string")
    bench = spark.createDataFrame([(7, "solo")], "item_id long, text string")
    kept = d.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.id) for r in kept.collect() if r.id) == [(1, "k")]
    assert kept.count() == 3


def test_repeated_items_count_once(spark):
    text = "one two three four five six seven eight nine ten eleven"
    once = spark.createDataFrame([(1, text), (2, "solo words here")], "item_id long, text string")
    bench = spark.createDataFrame([(1, text)] * 60 + [(2, "solo words here")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "0 " + text), (2, "clean")], "doc_id long, text string")
    for n in (0, 32 << 20):
        got = {r.id: (len(r.spans), r.items) for r in d.contamination(docs, bench, broadcast_bytes=n).collect()}
        assert got == {1: (1, ["1"]), 2: (0, [])}
    size = lambda b: d.benchmark_tables(b, 10, "item_id", "text")[3]
    assert size(bench) == size(once) > 0


def test_joins_equal_the_broadcast_form(spark):
    sf = "/root/testdata/sf0.01"
    docs, bench = d.table(spark, sf, "documents"), d.table(spark, sf, "benchmark")
    rows = lambda n: sorted(d.contamination(docs, bench, broadcast_bytes=n).collect(), key=lambda r: r.id)
    assert rows(0) == rows(32 << 20)
    kept = lambda n: sorted(d.drop_contaminated(docs, bench, broadcast_bytes=n).collect(), key=lambda r: r.doc_id)
    assert kept(0) == kept(32 << 20) and 0 < len(kept(0)) < docs.count()


def test_a_passage_that_all_items_and_documents_share(spark):
    """Set sizes multiply only in the result."""
    shared = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(i, f"intro {i} {shared} end {i}") for i in range(300)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, f"{shared} item {i}") for i in range(50)], "item_id long, text string")
    for n in (0, 32 << 20):
        got = d.contamination(docs, bench, broadcast_bytes=n).collect()
        assert len(got) == 300 and all([(s.start, s.end) for s in r.spans] == [(2, 42)] and len(r.items) == 50 for r in got)
