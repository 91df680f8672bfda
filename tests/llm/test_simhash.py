from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import Row

from gatewatch.llm import simhash
from gatewatch.llm.common import table


def brute_print(text, n=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [words[i:i + n] for i in range(len(words) - n + 1)] or [words]
    count = Counter()
    for g in grams:
        h = xxhash.xxh64_intdigest(" ".join(g).encode(), 42)
        count.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * count[b] > len(grams))


def brute_groups(prints, bits=2):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    values = sorted(set(prints))
    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if bin(a ^ b).count("1") <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in values}


def test_equals_brute_force(spark, sf_small):
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in simhash.op8_simhash_near_dedup(spark, sf_small).collect()}
    docs = table(spark, sf_small, "documents").collect()
    prints = {d.doc_id: brute_print(d.text) for d in docs}
    root = brute_groups(prints.values())
    low = {}
    for d, p in prints.items():
        low[root[p]] = min(low.get(root[p], d), d)
    assert got == {d: (p, low[root[p]]) for d, p in prints.items()}


@pytest.mark.parametrize("max_unit", [3, 40, 50_000])
@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_links_connect_like_brute_force(spark, max_unit, bits):
    rng = np.random.default_rng(bits)
    base = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    values = set(base.tolist())
    for b in base[:6]:  # dense balls: many fingerprints share a block
        for _ in range(25):
            flips = rng.choice(64, rng.integers(1, 5), replace=False)
            values.add(int(b) ^ sum(1 << int(f) for f in flips))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    prints = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = simhash.links(prints, bits, max_unit).collect()
    for r in found:
        assert r.a != r.b
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in found:
        a, b = find(r.a % (1 << 64)), find(r.b % (1 << 64))
        root[max(a, b)] = min(a, b)
    assert {v: find(v) for v in values} == brute_groups(values, bits)


def test_odd_rows(spark):
    rows = [Row(doc_id=1, text=None, component="x", fp=9), Row(doc_id=2, text="", component="x", fp=9),
            Row(doc_id=3, text="one two", component="x", fp=9), Row(doc_id=3, text="one two", component="x", fp=9),
            Row(doc_id=4, text="w " * 70_000, component="x", fp=9), Row(doc_id=None, text="a b c", component=None, fp=None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component string, fp int")
    got = {(r.id, r.component) for r in simhash.simhash_groups(docs).collect()}
    assert {(1, 1), (2, 1), (3, 3), (4, 4), (None, None)} <= got
    assert simhash.simhash_groups(docs).count() == 6
    assert simhash.simhash_groups(docs.limit(0)).count() == 0


def test_fingerprints_equal_brute_force_on_odd_texts(spark):
    texts = ["A\x0bB\x0cC D", "é É ß", "x", "a b", "a a a a a a", "  lead and trail \r\n", " no break space here"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: r.fp % (1 << 64) for r in simhash.fingerprints(docs).collect()}
    assert got == {i: brute_print(t) for i, t in enumerate(texts)}


def test_one_id_on_several_texts_is_judged_row_by_row(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, text, "a"), (2, text, "b"), (2, "a clean text of its own kind", "c"), (3, "x y z one two", "d"), (3, "X y z one two", "e"),
            (3, "X y z one two", "e"), (None, text, "f"), (None, text, "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component string")
    prints = {r.id: r.fp for r in simhash.fingerprints(docs.where("doc_id = 3"), "text").collect()}
    assert len(set(prints.values())) == 1
    got = simhash.keep_one_per_group(docs)
    assert got.schema == docs.schema
    kept = sorted(r.component for r in got.collect())
    assert kept in (["a", "c", "d", "f", "g"], ["a", "c", "e", "f", "g"])
