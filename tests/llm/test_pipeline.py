import zlib

import corpus_pipeline as cp
import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gatewatch.llm import packing, pii, toxicity
from gatewatch.llm.common import table

from .test_decontaminate import brute as brute_windows
from .test_packing import check
from .test_simhash import brute_groups, brute_print

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: (r["doc_id"] is None, r["doc_id"]))


def test_stages_equal_brute_force(spark):
    docs = table(spark, SF, "documents")
    names = docs.columns
    model = toxicity.fit(docs, table(spark, SF, "labels"))
    fold, match = toxicity.folder(), toxicity.matcher(model)
    want = [r for r in rows(docs) if model.score(sum(match(fold(r["text"])).values()), fold(r["text"]).count(" ") - 1) < 0.5]
    got = cp.toxicity(spark, docs, SF)
    assert got.columns == names and rows(got) == want and 0 < len(want) < docs.count()

    docs = spark.createDataFrame(want, docs.schema)
    prints = {r["doc_id"]: brute_print(r["text"]) for r in want}
    root = brute_groups(prints.values())
    first = {}
    for i in sorted(prints):
        first.setdefault(root[prints[i]], i)
    want = [r for r in want if first[root[prints[r["doc_id"]]]] == r["doc_id"]]
    got = cp.near_duplicates(spark, docs, SF)
    assert got.columns == names and rows(got) == want and len(want) < docs.count()

    docs = spark.createDataFrame(want, docs.schema)
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    want = [r for r in want if not brute_windows(r["text"], items)[1]]
    got = cp.decontamination(spark, docs, SF)
    assert got.columns == names and rows(got) == want and len(want) < docs.count()

    docs = spark.createDataFrame(want, docs.schema)
    found = {r.id: r.spans for r in pii.private_spans(docs, pii.fit(docs)).collect()}
    for r in want:
        spans = sorted((s.start, -s.end, s.kind) for s in found[r["doc_id"]])
        out, at = "", 0
        for a, minus_b, k in spans:
            if a >= at:
                out += r["text"][at:a] + f"[{pii.KINDS[k].upper()}]"
            at = max(at, -minus_b)
        if spans:
            r["text"] = out + r["text"][at:]
            r["n_chars"] = len(r["text"])
    got = cp.personal_data(spark, docs, SF)
    assert got.schema == docs.schema and rows(got) == want and any(found.values())

    docs = spark.createDataFrame(want, docs.schema)
    packed = cp.packing(spark, docs, SF)
    n = check(packed.withColumnRenamed("doc_id", "id").collect(), [(r["doc_id"], r["text"]) for r in want],
              Tokenizer.from_file(packing.TOKENIZER), 2048)
    whole = cp.run(spark, SF)
    assert whole.select("doc_id", "piece", "ids_crc32").exceptAll(packed.select("doc_id", "piece", "ids_crc32")).count() == 0
    assert whole.count() == packed.count()
    assert all(len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in whole.collect())
    lengths = np.array([r.length for r in packed.collect()])
    assert n <= packing.lower_bound(lengths, 2048) + 1


def test_stages_on_odd_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (None, "a b c", "en", "s", 5), (3, "x " * 40_000, "en", "s", None),
                                  (3, "x " * 40_000, "en", "s", None)], schema)
    for name, stage in cp.STAGES[:4]:
        out = stage(spark, docs, SF)
        assert out.schema.simpleString() == docs.schema.simpleString(), name
        assert out.count() == (3 if name == "near_duplicates" else 5), name
        assert stage(spark, docs.limit(0), SF).count() == 0, name
        wide = docs.withColumn("id", F.lit("i")).withColumn("fp", F.lit(0)).withColumn("row", F.lit(1)).withColumn("_print", F.lit(2)).withColumns({"a.b": F.lit(3), "my col": F.lit(4), "score": F.lit(5)})
        assert stage(spark, wide, SF).columns == wide.columns and stage(spark, wide, SF).count() == out.count()
    assert cp.packing(spark, docs, SF).count() > 5
