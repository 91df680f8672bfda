import zlib

from gatewatch.llm import toxicity as t
from gatewatch.llm.common import table


def area(pairs):
    pairs = sorted(pairs)
    n1 = sum(y for _, y in pairs)
    ranks = {}
    for i, (s, _) in enumerate(pairs, 1):
        ranks.setdefault(s, []).append(i)
    total = sum(sum(ranks[s]) / len(ranks[s]) for s, y in pairs if y)
    return (total - n1 * (n1 + 1) / 2) / (n1 * (len(pairs) - n1))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"  # 97 toxic rows held out; sf0.01 has six, two of them in languages hardly seen
    got = {r.doc_id: r for r in t.op10_toxicity(spark, sf).collect()}
    assert len(got) == table(spark, sf, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    held = [(got[r.doc_id].score, r.toxic) for r in table(spark, sf, "labels").collect() if got[r.doc_id].held_out]
    assert area(held) > 0.95
    right = sum((s >= 0.5) == (y == 1) for s, y in held) / len(held)
    assert right > 0.98


def test_labels_of_held_out_rows_are_not_read(spark):
    docs = spark.createDataFrame([(i, "calm words here" if i % 2 else f"you dunce {i}") for i in range(200)], "doc_id long, text string")
    rows = [(i, 1 - i % 2) for i in range(200)]
    a = t.fit(docs, spark.createDataFrame(rows, "doc_id long, toxic int"))
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in rows]
    b = t.fit(docs, spark.createDataFrame(flipped, "doc_id long, toxic int"))
    assert a == b and any("dunce" in e or "dunc" in e for e in a.weights)


def test_folding():
    fold = t.folder()
    assert fold("Ïd1οt!! с​lown, l0$er") == " idiot clown loser "
    assert fold("ＣＬＯＷＮ") == " clown "
    assert fold("") == "  "


def test_exception_phrases_and_longest_weight():
    m = t.Model({" trash ": 2.0, " tras": 1.0, " clow": 3.0}, ("trash can",))
    match = t.matcher(m)
    fold = t.folder()
    assert list(match(fold("trash trashy clowns")).values()) == [2.0, 1.0, 3.0]
    assert list(match(fold("a trash can by trash")).values()) == [2.0]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 0.1), (2, "", 0.2), (None, "dunce", 0.3), (3, "dunce " * 30_000, None), (3, "dunce " * 30_000, None)],
                                 "doc_id long, text string, score double")
    m = t.Model({" dunce ": 3.0}, (), (-3.0, 2.0, 1.0))
    got = sorted((r.id or 0, r.score) for r in t.toxicity(docs, m).collect())
    assert len(got) == 5 and got[1][1] == got[2][1] < 0.5 < got[0][1] and got[3] == got[4]
    empty = t.fit(docs.limit(0), spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r.score < 0.5 for r in t.toxicity(docs, empty).collect()] == [True] * 5


def test_drop_keeps_clean_rows(spark):
    rows = [(i, "calm words here" if i % 2 else f"you dunce {i}", "x") for i in range(200)]
    docs = spark.createDataFrame([*rows, (None, "calm", "x"), (None, "dunce", None)], "doc_id long, text string, id string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(200)], "doc_id long, toxic int")
    kept = t.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.text for r in kept.collect()) == ["calm"] + ["calm words here"] * 100


def test_matches_equal_brute_force():
    """The automaton against a search for every entry at every place."""
    import random

    rng = random.Random(3)
    for _ in range(300):
        words = ["".join(rng.choices("ab", k=rng.randint(1, 4))) for _ in range(12)]
        entries = {e: rng.choice([1.0, 2.0, 3.0]) for w in rng.sample(words, 5) for e in rng.sample([f" {w} ", f" {w}"], 1)}
        phrases = tuple({" ".join(rng.choices(words, k=rng.randint(1, 3))) for _ in range(rng.randint(0, 3))})
        text = t.folder()(" ".join(rng.choices(words, k=rng.randint(0, 25))))
        want = {}
        for i in range(len(text)):
            held = [w for e, w in entries.items() if text.startswith(e, i)]
            spared = any(text.startswith(f" {p} ", j) and j <= i < j + len(p) + 1 for p in phrases for j in range(i + 1))
            if held and not spared:
                want[i] = max(held)
        assert t.matcher(t.Model(entries, phrases))(text) == want


def test_long_texts_take_time_in_proportion():
    import time

    match = t.matcher(t.Model({" trash ": 2.0}, ("trash can",)))
    text = t.folder()("trash can trash bag " * 50_000)  # 1 MB
    t0 = time.time()
    assert len(match(text)) == 50_000 and time.time() - t0 < 10


def test_a_null_id_is_not_held_out(spark, tmp_path):
    docs = spark.createDataFrame([(None, "x"), (5, "y")], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(5, 1)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = {r.doc_id: r.held_out for r in t.op10_toxicity(spark, str(tmp_path)).collect()}
    assert got == {None: False, 5: zlib.crc32(b"5") % 5 == 0}
