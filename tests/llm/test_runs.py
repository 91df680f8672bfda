import itertools
import random

import pytest

from gatewatch.llm import runs

from .helpers import same_rows


def lyndon_brute(s):
    out = []
    for i in range(len(s)):
        best = 1
        for j in range(i + 1, len(s) + 1):
            w = s[i:j]
            if all(w < w[k:] for k in range(1, len(w))):
                best = j - i
        out.append(best)
    return out


def runs_brute(w, min_length=6, min_exponent=4):
    out, seen = [], set()
    for q in range(1, len(w) // min_exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_length, min_exponent * q) and (i, j + q) not in seen:
                seen.add((i, j + q))
                out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_lyndon_array_equals_brute_force():
    for n in range(1, 8):
        for s in itertools.product((1, 2, 3), repeat=n):
            assert runs.lyndon_array(list(s)) == lyndon_brute(list(s))
    rng = random.Random(5)
    for _ in range(200):
        s = [rng.randint(0, rng.choice([1, 2, 5])) for _ in range(rng.randint(1, 40))]
        assert runs.lyndon_array(s) == lyndon_brute(s)
        assert runs.lyndon_array([-x for x in s]) == lyndon_brute([-x for x in s])


def made(rng):
    out = []
    while len(out) < rng.randint(5, 90):
        root = [rng.randint(0, rng.choice([0, 1, 2, 6])) for _ in range(rng.randint(1, 5))]
        out += root * rng.randint(1, 7) + root[: rng.randint(0, len(root))]
    return out


@pytest.mark.parametrize("length,exponent", [(6, 4), (2, 2), (9, 3)])
def test_runs_equal_brute_force(length, exponent):
    rng = random.Random(length)
    sequences = [made(rng) for _ in range(400)] + [[], [7], [0] * 50, [0, 1] * 40]
    want = [(k, *r) for k, s in enumerate(sequences) for r in runs_brute(s, length, exponent)]
    got = list(zip(*(x.tolist() for x in runs.runs_of(sequences, length, exponent)), strict=True))
    assert got == want and len(want) > 100


def collapse(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_documents_equal_brute_force(spark):
    rng = random.Random(2)
    texts = ["  ".join(f"é{x}" if x % 2 else f"w{x}" for x in made(rng)) + "\t end" for _ in range(150)]
    texts += [None, "", " \n\x0b ", "one", "a b " * 9, "x" * 100_000, texts[0], "A a " * 8, "\x1f \x1f \x1f \x1f \x1f \x1f"]
    docs = spark.createDataFrame([(i, t, [1], "c") for i, t in enumerate(texts)] + [(None, "b " * 7, [1], "c")],
                                 "doc_id long, text string, runs array<int>, collapsed string")
    got = {r.id: (r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in runs.periodic_runs(docs).collect()}
    want = {}
    for i, t in [*enumerate(texts), (None, "b " * 7)]:
        words = [w.decode() for w in (t or "").encode().split()]
        found = runs_brute(words)
        want[i] = (len(words), found, collapse(words, found))
    assert got == want
    assert runs.periodic_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        runs.periodic_runs(docs, min_exponent=1)


def test_long_texts(spark):
    words = ["p", "q", "r"] * 100_000 + [f"u{i}" for i in range(50_000)] + ["s"] * 200_000
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    (r,) = runs.periodic_runs(docs).collect()
    assert [tuple(x) for x in r.runs] == [(0, 300_000, 3), (350_000, 200_000, 1)]
    assert r.collapsed == " ".join(["p", "q", "r"] + words[300_000:350_001])


def test_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert same_rows(runs.op11_periodic_runs(spark, sf), runs.OP11_SQL, sf) == 1000
