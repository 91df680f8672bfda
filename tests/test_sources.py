"""Ingest contract: identifiers, envelopes, landing, loading, sinks."""

from __future__ import annotations

import tempfile
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from gatewatch.functions.columns import safe_identifier
from gatewatch.sources.contracts import SOURCE_FILES, SOURCE_REQUIRED_COLUMNS
from gatewatch.sources.envelope import decode_envelopes, encode_records, envelope_counts, require_clean
from gatewatch.sources.landing import land
from gatewatch.sources.loader import align, check_source_files, load_source, read_csv_source
from gatewatch.sources.sinks import write_findings


def scratch() -> str:
    return tempfile.mkdtemp(prefix="gw-test-")


def test_safe_identifier(spark):
    rows = spark.createDataFrame([(" run/with spaces ",), ("",), ("x" * 100,), ("__a__",)], "v string")
    got = [r[0] for r in rows.select(safe_identifier("v")).collect()]
    assert got == ["run-with-spaces", "manual", "x" * 63, "a"]


def _one_row_csvs(d: Path) -> None:
    for source, name in SOURCE_FILES.items():
        cols = SOURCE_REQUIRED_COLUMNS[source]
        (d / name).write_text(",".join(cols) + "\n" + ",".join(f"{source}-{c}" for c in cols) + "\n")


def test_contract_check_and_csv_scan(spark):
    d = Path(scratch())
    _one_row_csvs(d)
    assert check_source_files(spark, str(d)).count() == 0
    (d / SOURCE_FILES["okta"]).unlink()
    (d / SOURCE_FILES["ad"]).write_text("event_id,ts\n1,2\n")
    bad = SOURCE_FILES["app_usage"]
    text = (d / bad).read_text()
    (d / bad).write_text(text + "only,three,fields\n")
    kinds = {(r["source"], r["kind"]) for r in check_source_files(spark, str(d)).collect()}
    assert kinds == {("okta", "missing_file"), ("ad", "missing_columns"), ("app_usage", "malformed_row")}
    hr = read_csv_source(spark, str(d / SOURCE_FILES["hrlifecycle"]), "hrlifecycle")
    assert hr.collect()[0]["user"] == "hrlifecycle-user"


def test_envelope_round_trip_and_landing_is_idempotent(spark):
    d = Path(scratch())
    _one_row_csvs(d)
    frames = {s: read_csv_source(spark, str(d / n), s).select(*SOURCE_REQUIRED_COLUMNS[s])
              for s, n in SOURCE_FILES.items()}
    env = encode_records(frames, "dev", "run 1")
    assert {r["source"]: r["messages"] for r in envelope_counts(env).collect()} == {s: 1 for s in SOURCE_FILES}
    assert {r["run_id"] for r in env.collect()} == {"run-1"}
    by_source, rejects = decode_envelopes(env.unionByName(env), "dev")  # delivered twice
    assert rejects.count() == 0
    root = scratch()
    land(by_source, root)
    land(by_source, root)  # replayed batch
    okta = load_source(spark, root, "okta", typed=False)
    assert okta.count() == 1
    row = okta.collect()[0]
    assert row["req_id"] == "okta-req_id" and row["_pipeline_run_id"] == "run-1"


def test_decode_rejects(spark):
    env = spark.createDataFrame(
        [("m1", '{"req_id":"a","user":"u","ts":"2026-01-01 00:00:00"}', "okta", "dev", None),
         ("m2", '{"req_id":"b"}', "nope", "dev", "r"),
         ("m3", '{"req_id":"c"}', "okta", "prod", "r"),
         ("m4", "not json", "okta", None, "r")],
        "message_id string, value string, source string, pipeline_env string, run_id string",
    )
    by_source, rejects = decode_envelopes(env, "dev")
    assert {r["message_id"]: r["reason"] for r in rejects.collect()} == {
        "m2": "unknown_source", "m3": "environment_mismatch", "m4": "bad_json"}
    okta = by_source["okta"].collect()
    assert [(r["req_id"], r["_pipeline_run_id"]) for r in okta] == [("a", "unlabelled")]
    with pytest.raises(ValueError):
        require_clean(rejects)


def test_load_source_missing_path_and_alignment(spark):
    empty = load_source(spark, scratch(), "okta")
    assert empty.count() == 0 and "session_id" in empty.columns
    df = spark.createDataFrame([("1", "x")], "req_id string, extra string")
    out = align(df, load_source(spark, scratch(), "okta", typed=False).schema)
    assert out.columns[:2] == ["req_id", "user"] and "extra" not in out.columns


def test_load_source_dedups_latest_and_types(spark):
    root = scratch()
    rows = [("r1", "u", "2024-01-01 00:00:00", "old", "m1", "2024-01-01T00:00:00"),
            ("r1", "u", "2024-01-02 00:00:00", "new", "m2", "2024-01-02T00:00:00"),
            ("r2", "u", "garbage", "x", "m3", "2024-01-01T00:00:00")]
    df = spark.createDataFrame(rows, "req_id string, user string, ts string, status string, "
                                     "_pubsub_message_id string, _ingested_at string")
    df.withColumn("_pipeline_run_id", F.lit("r")).write.parquet(f"{root}/okta/run_id=r")
    got = {r["req_id"]: (r["status"], r["ts"]) for r in load_source(spark, root, "okta").collect()}
    assert got["r1"][0] == "new" and got["r2"][1] is None


class FakeWriter:
    def __init__(self):
        self.options, self.fmt, self.mode_name, self.parts, self.saved = {}, None, None, [], None

    def format(self, f):
        self.fmt = f
        return self

    def mode(self, m):
        self.mode_name = m
        return self

    def option(self, k, v):
        self.options[k] = v
        return self

    def partitionBy(self, *cols):
        self.parts = list(cols)
        return self

    def save(self, path=None):
        self.saved = path or "table"


def test_write_findings_options():
    w = FakeWriter()
    write_findings(SimpleNamespace(columns=["event_date"], write=w), "/out/t")
    assert (w.fmt, w.mode_name, w.parts, w.saved) == ("parquet", "overwrite", ["event_date"], "/out/t")
    assert w.options["partitionOverwriteMode"] == "static"
    w2 = FakeWriter()
    write_findings(SimpleNamespace(columns=["event_date"], write=w2), "p:d.t", format="bigquery",
                   options={"writeMethod": "direct"})
    assert w2.parts == [] and w2.options == {"writeMethod": "direct", "table": "p:d.t"}


def test_write_findings_replaces(spark):
    out = scratch() + "/t"
    df = spark.createDataFrame([("a", "2024-01-01")], "x string, event_date string")
    write_findings(df, out)
    write_findings(df.withColumn("event_date", F.lit("2024-01-02")), out)
    assert [str(r["event_date"]) for r in spark.read.parquet(out).collect()] == ["2024-01-02"]


def test_csv_binds_by_header_name_and_follows_rfc_4180(spark, tmp_path):
    from gatewatch.sources.loader import csv_path, read_csv_source

    path = csv_path(str(tmp_path), "hrlifecycle")
    Path(path).write_bytes(
        'location,user,extra,_pubsub_message_id,join_date,move_date1,move_date2,termination_date,department,job_role\r\n'
        'Oslo,alice,e,m,2024-01-01,,,,"said ""yes"", ok","two\nlines"\r\n'.encode())
    (r,) = read_csv_source(spark, path, "hrlifecycle").collect()
    assert r["user"] == "alice" and r["location"] == "Oslo" and r["department"] == 'said "yes", ok'
    assert r["job_role"] == "two\nlines" and r["move_date1"] == "" and "extra" not in r.asDict()
    assert "_pubsub_message_id" not in r.asDict()


def _as_multiline(spark, path):
    """Spark's own reading of the file, by one task."""
    return spark.read.csv(path, header=True, quote='"', escape='"', multiLine=True, encoding="UTF-8")


def test_csv_records_equal_a_multiline_read_however_the_file_is_split(spark, tmp_path):
    import random

    from gatewatch.sources.loader import _parsed

    rng = random.Random(8)
    field = lambda: rng.choice([
        "", "plain", "5\" pipe", "a b", "é", '"quoted"', '"say ""yes"", ok"', '"two\nlines"', '"\n\n"', '"crlf\r\nhere"', '""', '"a,b"',
        '"' + "long line, " * 30 + '\n""end"""', '"' + "many\n" * 40 + '"'])
    for k, end in enumerate(("\n", "\r\n")):
        path = str(tmp_path / f"f{k}.csv")
        rows = [",".join([str(i), field(), field(), field()]) for i in range(400)]
        Path(path).write_bytes((end.join(["id,a,b,c", *rows]) + (end if k else "")).encode())
        want = sorted(_as_multiline(spark, path).collect(), key=str)
        assert len(want) == 400
        # splits of 300 bytes: records reach over several of them
        for size in ("134217728", "5000", "300"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
            try:
                got = _parsed(spark, path, ["id", "a", "b", "c"])
                if size == "300":
                    assert spark.read.text(path).rdd.getNumPartitions() > 50
                rows_ = [r if end == "\n" else Row(**{c: v and v.replace("\r\n", "\n") for c, v in r.asDict().items()}) for r in got.collect()]
                assert sorted(rows_, key=str) == want, (end, size)
            finally:
                spark.conf.unset("spark.sql.files.maxPartitionBytes")
                spark.conf.unset("spark.sql.files.openCostInBytes")


def test_csv_records_of_odd_files(spark, tmp_path):
    from gatewatch.sources.csv_records import csv_records, quoted_after

    read = lambda text: sorted((r.first, r.record) for r in csv_records(spark, _put(tmp_path, text)).collect())

    def _put(folder, text):
        import uuid
        path = folder / f"{uuid.uuid4().hex}.csv"
        path.write_bytes(text.encode())
        return str(path)

    assert read("") == [] and read("a,b") == [(True, "a,b")]
    assert read("a,b\n\n1,2\n") == [(False, "1,2"), (True, "a,b")]
    assert read('a\n"never closed\nmore') == [(False, '"never closed\nmore'), (True, "a")]
    assert read('"two\nline header",b\n1,2') == [(False, "1,2"), (True, '"two\nline header",b')]
    assert not quoted_after(b'a,"b"', False) and quoted_after(b'a,"b""', False) and quoted_after(b'x"",y', True) and not quoted_after(b'x",y', True)


def test_blank_csv_values_survive_publish_and_decode(spark, tmp_path):
    from gatewatch.sources.envelope import decode_envelopes, encode_records
    from gatewatch.sources.loader import csv_path, read_csv_source

    path = csv_path(str(tmp_path), "anomaly_key")
    Path(path).write_text('user,anomaly_description\nalice,\n"",x\n')
    rows = read_csv_source(spark, path, "anomaly_key")
    back, rejects = decode_envelopes(encode_records({"anomaly_key": rows}, "dev", "r"), "dev")
    assert sorted(tuple(r)[:2] for r in back["anomaly_key"].collect()) == [("", "x"), ("alice", "")]
    assert rejects.count() == 0


def test_check_finds_invalid_utf8_and_accepts_any_column_order(spark, tmp_path):
    from gatewatch.sources.contracts import SOURCE_FILES, SOURCE_REQUIRED_COLUMNS
    from gatewatch.sources.loader import check_source_files

    for source, name in SOURCE_FILES.items():
        cols = [*reversed(SOURCE_REQUIRED_COLUMNS[source]), "more"]
        (tmp_path / name).write_text(",".join(cols) + "\n" + ",".join("v" for _ in cols) + "\n")
    assert check_source_files(spark, str(tmp_path)).count() == 0
    assert check_source_files(spark, f"file://{tmp_path}/").count() == 0
    with open(tmp_path / SOURCE_FILES["anomaly_key"], "ab") as f:
        f.write(b"bad \xff byte,x,y\n")
    found = check_source_files(spark, str(tmp_path)).collect()
    assert {(r["source"], r["kind"]) for r in found} == {("anomaly_key", "invalid_utf8")}


def test_connector_write_rules():
    import pytest

    from gatewatch.sources.sinks import connector_options

    full = connector_options({"temporaryGcsBucket": "b", "x": "1"}, ["user", "event_date"])
    assert full == {"writeMethod": "indirect", "writeDisposition": "WRITE_TRUNCATE", "partitionField": "event_date", "partitionType": "DAY",
                    "temporaryGcsBucket": "b", "x": "1"}
    undated = connector_options({"temporaryGcsBucket": "b"}, ["user"])
    assert undated == {"writeMethod": "indirect", "writeDisposition": "WRITE_TRUNCATE", "temporaryGcsBucket": "b"}
    assert connector_options({"writeMethod": "direct"}, ["event_date"]) == {"writeMethod": "direct"}
    for bad in ({}, {"writeMethod": "indirect"}, {"writeMethod": "other", "temporaryGcsBucket": "b"}):
        with pytest.raises(ValueError):
            connector_options(bad, ["event_date"])


def test_connector_writes_reach_a_sink_and_commit(spark, tmp_path):
    """Both write rules through a real sink of the data source API, which keeps
    the options it was given and what was committed."""
    import datetime as dt
    import json

    from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

    from gatewatch.sources.sinks import write_findings

    log = str(tmp_path / "log.json")

    class Rows(WriterCommitMessage):
        def __init__(self, n):
            self.n = n

    class Recorder(DataSourceWriter):
        def __init__(self, options, overwrite):
            self.options, self.overwrite = dict(options), overwrite

        def write(self, iterator):
            return Rows(sum(1 for _ in iterator))

        def commit(self, messages):
            with open(log, "w") as f:
                json.dump({"rows": sum(m.n for m in messages), "overwrite": self.overwrite, "options": self.options}, f)

    class Warehouse(DataSource):
        @classmethod
        def name(cls):
            return "recording_warehouse"

        def writer(self, schema, overwrite):
            return Recorder(self.options, overwrite)

    spark.dataSource.register(Warehouse)
    dated = spark.createDataFrame([("a", dt.date(2024, 1, 1)), ("b", None), ("c", dt.date(2024, 1, 2))], "user string, event_date date")

    def written(df, **options):
        write_findings(df, "p.d.risk_scores", format="recording_warehouse", options=options)
        got = json.loads(Path(log).read_text())
        assert got["rows"] == df.count() and got["overwrite"] is True
        given = {k.lower(): v for k, v in got["options"].items() if k.lower() != "path"}
        assert given.pop("table") == "p.d.risk_scores"
        return given

    indirect = {"writemethod": "indirect", "writedisposition": "WRITE_TRUNCATE", "temporarygcsbucket": "bucket"}
    assert written(dated, temporaryGcsBucket="bucket") == {**indirect, "partitionfield": "event_date", "partitiontype": "DAY"}
    assert written(dated.drop("event_date"), temporaryGcsBucket="bucket") == indirect
    assert written(dated, writeMethod="direct") == {"writemethod": "direct"}


def test_landed_text_reaches_the_timeline_and_untimed_uses_are_no_findings(spark, tmp_path):
    from gatewatch.plans import rules as R
    from gatewatch.sources.contracts import SOURCE_SCHEMAS
    from gatewatch.sources.landing import land
    from gatewatch.sources.loader import load_source

    def rows(source, *given):
        names = SOURCE_SCHEMAS[source].names
        full = [{**dict.fromkeys(names), **g, "_pipeline_run_id": "r", "_ingested_at": "2024"} for g in given]
        return spark.createDataFrame([tuple(g[n] for n in names) for g in full], SOURCE_SCHEMAS[source])

    land({
        "app_usage": rows("app_usage",
                          {"usage_id": "U1", "user": "u", "ts": "2024-01-01 08:00:00", "session_id": "S", "data_mb": "12", "app": "A"},
                          {"usage_id": "U2", "user": "u", "ts": "no time", "session_id": "S", "data_mb": "a lot", "app": "A"},
                          {"usage_id": "U3", "user": "u", "ts": None, "session_id": "T", "data_mb": None, "app": "A"}),
        "okta": rows("okta", {"req_id": "L1", "user": "u", "ts": "2024-01-01 07:50:00", "session_id": "S", "status": "success"}),
        "saviynt": rows("saviynt"), "ad": rows("ad"),
    }, str(tmp_path))
    src = {s: load_source(spark, str(tmp_path), s) for s in ("app_usage", "okta", "saviynt", "ad")}
    line = R.identity_timeline(src["okta"], src["saviynt"], src["ad"], src["app_usage"])
    text = {r["source_event_id"]: r["details"] for r in line.collect()}
    assert text["U1"] == "app=A | data_mb=12" and text["U2"] == "app=A | data_mb=a lot" and text["U3"] == "app=A"
    found = {(r["usage_id"], r["anomaly_reason"]) for r in R.impossible_login(src["okta"], src["app_usage"]).collect()}
    # U2 has no time but its session has a login; U3's session has none
    assert found == {("U3", "missing_session_login")}


def test_command_line_checks_publishes_and_ingests(spark, tmp_path, capsys):
    import json

    from gatewatch.__main__ import main
    from gatewatch.sources.contracts import SOURCE_FILES, SOURCE_REQUIRED_COLUMNS
    from gatewatch.sources.loader import load_source

    data = tmp_path / "csv"
    data.mkdir()
    for source, name in SOURCE_FILES.items():
        cols = SOURCE_REQUIRED_COLUMNS[source]
        lines = [",".join(f"{c}{i}" for c in cols) for i in range(60 if source == "okta" else 2)]
        (data / name).write_text("\n".join([",".join(cols), *lines]) + "\n")
    said = lambda: [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert main(["check-csv", str(data)]) == 0 and said()[-1]["violations"] == 0
    assert main(["publish", str(data), str(tmp_path / "env"), "--run-id", "r1"]) == 0
    assert said()[-1] == {s: 60 if s == "okta" else 2 for s in SOURCE_FILES}
    # a second run into the same folder counts its own messages only
    assert main(["publish", str(data), str(tmp_path / "env"), "--run-id", "r2"]) == 0
    assert said()[-1]["okta"] == 60
    assert main(["ingest", str(tmp_path / "env"), str(tmp_path / "land"), "--checkpoint", str(tmp_path / "ck")]) == 0
    assert load_source(spark, str(tmp_path / "land"), "okta").count() == 60
    args = ["ingest", str(tmp_path / "env"), str(tmp_path / "land2"), "--checkpoint", str(tmp_path / "ck2"), "--max-messages"]
    assert main([*args, "25"]) == 0
    rows = lambda: spark.read.option("recursiveFileLookup", True).schema("_pubsub_message_id string").parquet(str(tmp_path / "land2")).count()
    assert 0 < rows() <= 25
    with open(data / SOURCE_FILES["okta"], "a") as f:
        f.write("too,few\n" * 70)
    assert main(["check-csv", str(data), "--out", str(tmp_path / "bad")]) == 1
    assert said()[-1] == {"violations": 70, "shown": 50, "written_to": str(tmp_path / "bad")}
    assert spark.read.json(str(tmp_path / "bad")).count() == 70


def test_bodies_of_all_json_kinds(spark):
    """Only objects land; values that are not text come as JSON writes them."""
    body = ['{"user": "a", "join_date": 5, "location": null, "department": {"x": [1]}, "job_role": true, "other": 1}', "[1]", "null", "3", '"s"',
            "{", "", None, '{"user": "b"}']
    env = spark.createDataFrame([(str(i), b, "hrlifecycle", "dev", "r") for i, b in enumerate(body)], "message_id string, value string, "
                                "source string, pipeline_env string, run_id string")
    by_source, rejects = decode_envelopes(env, "dev")
    got = {r["user"]: r for r in by_source["hrlifecycle"].collect()}
    assert set(got) == {"a", "b"} and got["b"]["location"] is None
    a = got["a"]
    assert (a["join_date"], a["location"], a["department"], a["job_role"]) == ("5", None, '{"x":[1]}', "true")
    assert {(r["message_id"], r["reason"]) for r in rejects.collect()} == {(str(i), "bad_json") for i in range(1, 8)}
