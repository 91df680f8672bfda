"""Batch = stream: streaming forms give the batch rules' rows on fixture data."""

from __future__ import annotations

import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gatewatch.plans import rules as R
from gatewatch.sources.envelope import encode_records
from gatewatch.sources.fixtures import fixture_sources
from gatewatch.sources.loader import load_source
from gatewatch.streaming import live
from gatewatch.streaming.ingest import ingest_stream, write_envelopes

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def _few_state_partitions(spark):
    """Every micro-batch opens a state store and a worker per partition."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="module")
def staged(spark):
    if not Path(SF).exists():
        pytest.skip("test data not present")
    root = tempfile.mkdtemp(prefix="gw-stream-")
    batch = {}
    for source, df in fixture_sources(spark, SF).items():
        typed = df.withColumn("ts", F.col("ts").cast("timestamp")) if "ts" in df.columns else df
        typed.coalesce(1).write.parquet(f"{root}/{source}")
        batch[source] = spark.read.parquet(f"{root}/{source}")
    return root, batch


def _stream(spark, root, source, schema):
    return spark.readStream.schema(schema).parquet(f"{root}/{source}")


def _drain(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)


def test_mfa_bypass_stream_equals_batch(spark, staged):
    root, b = staged
    okta = _stream(spark, root, "okta", b["okta"].schema)
    app = _stream(spark, root, "app_usage", b["app_usage"].schema)
    got = _drain(live.mfa_bypass_stream(okta, app, delay="30 days"), "s_mfa")
    exp = R.mfa_bypass(b["okta"], b["app_usage"])
    assert sorted(got.collect()) == sorted(exp.collect())
    assert got.count() > 0


def test_orphan_events_stream_equals_batch(spark, staged):
    root, b = staged
    streams = {s: _stream(spark, root, s, b[s].schema) for s in ("okta", "saviynt", "ad", "app_usage")}
    events = live.source_events_stream(streams["okta"], streams["saviynt"], streams["ad"], streams["app_usage"])
    got = _drain(live.orphan_events_stream(events, b["hrlifecycle"]), "s_orphans")
    exp = R.orphan_events(R.source_events(b["okta"], b["saviynt"], b["ad"], b["app_usage"]), b["hrlifecycle"])
    assert sorted(got.collect()) == sorted(exp.collect())


def _closing(df, ts, **values):
    """`df` and one row at `ts` that pushes the watermark past all others."""
    row = df.limit(1).select(*[
        (F.lit(values[c]) if c in values else F.lit(ts) if c == "ts" else F.col(c)).cast(df.schema[c].dataType).alias(c)
        for c in df.columns])
    return df.unionByName(row)


def _in_files(df, root, name, parts, jitter_seconds, times=1):
    """Files in time order, each row up to `jitter_seconds` out of place; every
    file is delivered `times` times."""
    path = f"{root}/{name}"
    rows = df.withColumn("_at", F.unix_timestamp("ts") + F.pmod(F.xxhash64(*df.columns), F.lit(jitter_seconds)))
    rows = sorted(rows.collect(), key=lambda r: r["_at"])
    size = -(-len(rows) // parts)
    for k in range(parts):
        chunk = [tuple(r)[:-1] for r in rows[k * size:(k + 1) * size]]
        for t in range(times):
            df.sparkSession.createDataFrame(chunk, df.schema).coalesce(1).write.parquet(f"{path}/{k:03d}{t}")
    return path


def _stream_files(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(path)


CLOSE = "2035-01-01 00:00:00"


def _closed(b, source):
    if source == "okta":
        return _closing(b["okta"], CLOSE, user="closing", req_id="closing", status="success")
    return _closing(b["app_usage"], CLOSE, user="closing", usage_id="closing", session_id=" ")


@pytest.mark.parametrize("times", [1, 2])
def test_travel_and_sequence_equal_batch_over_disordered_and_redelivered_files(spark, staged, times):
    root, b = staged
    okta = _closed(b, "okta")
    path = _in_files(okta, root, f"okta_files{times}", 7, 5400, times)
    q = live.impossible_travel_stream(_stream_files(spark, path, okta.schema)).writeStream.format("memory").queryName(
        f"s_travel{times}").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    if times == 1:
        assert live.dropped_by_watermark(q) == 0
    exp = R.impossible_travel(b["okta"])
    assert sorted(spark.table(f"s_travel{times}").collect()) == sorted(exp.collect())
    assert exp.count() > 5

    app = _closed(b, "app_usage")
    path = _in_files(app, root, f"app_files{times}", 5, 5400, times)
    got = _drain(live.high_risk_sequence_stream(_stream_files(spark, path, app.schema)), f"s_seq{times}")
    exp = R.high_risk_sequence(b["app_usage"])
    assert sorted(got.collect()) == sorted(exp.collect())
    assert exp.count() > 0


@pytest.mark.parametrize("times", [1, 2])
def test_no_recent_login_stream_equals_batch(spark, staged, times):
    """Both reasons and the login time, over disordered and redelivered files."""
    root, b = staged
    # the closing use has a login one second before it, so it is no finding
    okta, app = _closing(b["okta"], CLOSE, user="closing", req_id="closing", status="success"), _closed(b, "app_usage")
    o, a = (_stream_files(spark, _in_files(df, root, f"{n}_nl{times}", 4, 1800, times), df.schema) for df, n in ((okta, "o"), (app, "a")))
    got = _drain(live.no_recent_login_stream(o, a, delay="2 hours"), f"s_nologin{times}")
    exp = R.impossible_login(b["okta"], b["app_usage"].filter(F.col("session_id").isNull() | (F.trim("session_id") == "")))
    assert sorted(got.select(*exp.columns).collect(), key=str) == sorted(exp.collect(), key=str)
    assert {r["anomaly_reason"] for r in got.collect()} == {"no_preceding_login", "application_too_long_after_login"}


def test_redelivered_files_change_no_joined_or_windowed_result(spark, staged):
    """D2, D16, D12 and the evidence rules over files that all come twice."""
    root, b = staged
    files = {s: _in_files(b[s], root, f"{s}_twice", 3, 600, 2) for s in ("okta", "saviynt", "ad", "app_usage")}
    streams = lambda: {s: _stream_files(spark, p, b[s].schema) for s, p in files.items()}
    x = streams()
    got = _drain(live.mfa_bypass_stream(x["okta"], x["app_usage"], delay="30 days"), "s_mfa_twice")
    assert sorted(got.collect()) == sorted(R.mfa_bypass(b["okta"], b["app_usage"]).collect())
    x = streams()
    events = live.source_events_stream(x["okta"], x["saviynt"], x["ad"], x["app_usage"], delay="30 days")
    got = _drain(live.orphan_events_stream(events, b["hrlifecycle"]), "s_orphans_twice")
    exp = R.orphan_events(R.source_events(b["okta"], b["saviynt"], b["ad"], b["app_usage"]), b["hrlifecycle"])
    assert sorted(got.collect()) == sorted(exp.collect())
    app = _closing(b["app_usage"], CLOSE, user="closing", usage_id="closing")
    path = _in_files(app, root, "multi_twice", 3, 600, 2)
    got = _drain(live.multi_app_session_stream(_stream_files(spark, path, app.schema), gap="40 days", delay="30 days"), "s_multi_twice")
    assert sorted(got.collect()) == sorted(R.multi_app_session(b["app_usage"]).collect())
    out: dict[str, list] = {}
    q = live.evidence_stream(streams()["ad"], lambda: b["saviynt"], lambda name, df, i: out.setdefault(name, []).extend(df.collect()),
                             delay="30 days").option("checkpointLocation", tempfile.mkdtemp(prefix="gw-ev-")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(out["shadow_access_events"], key=str) == sorted(R.shadow_access(b["ad"], b["saviynt"]).collect(), key=str)
    assert sorted(out["privilege_escalation_without_request"], key=str) == sorted(
        R.privilege_escalation_without_request(b["ad"], b["saviynt"]).collect(), key=str)


def test_a_late_redelivery_is_counted_and_changes_nothing(spark, staged):
    root, b = staged
    okta = b["okta"].orderBy("ts")
    rows = okta.collect()
    half = len(rows) // 2
    for k, part in enumerate((rows[:half], rows[half:], rows[:half])):
        spark.createDataFrame([tuple(r) for r in part], okta.schema).coalesce(1).write.parquet(f"{root}/late/{k}")
    once = live.first_deliveries(_stream_files(spark, f"{root}/late", okta.schema), "okta", "1 hour")
    q = once.writeStream.format("memory").queryName("s_late").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("s_late").count() == len(rows)
    assert live.dropped_by_watermark(q) > 0


def test_a_hot_user_is_split_by_time(spark):
    """One user with all events: logins of many buckets in one file are many keys,
    and findings over a bucket's border are kept."""
    import datetime as dt

    start = dt.datetime(2024, 3, 1)
    places = ["USA", "Japan", "USA", "UK"]
    rows = [("hot", f"L{i:05d}", "success", places[i % 4], start + dt.timedelta(minutes=97 * i)) for i in range(400)]
    rows.append(("closing", "Z", "success", "USA", dt.datetime(2035, 1, 1)))
    schema = "user string, req_id string, status string, country string, ts timestamp"
    root = tempfile.mkdtemp(prefix="gw-hot-")
    spark.createDataFrame(rows[:-1], schema).coalesce(1).write.parquet(f"{root}/a/0")
    spark.createDataFrame(rows[-1:], schema).coalesce(1).write.parquet(f"{root}/a/1")
    exp = R.impossible_travel(spark.createDataFrame(rows, schema))
    q = live.impossible_travel_stream(_stream_files(spark, f"{root}/a", schema)).writeStream.format("memory").queryName("s_hot").outputMode(
        "append").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(spark.table("s_hot").collect()) == sorted(exp.collect()) and exp.count() > 300


def test_ingest_stream_lands_once(spark):
    if not Path(SF).exists():
        pytest.skip("test data not present")
    src = tempfile.mkdtemp(prefix="gw-env-")
    frames = {s: df.select(*[F.col(c).cast("string") for c in df.columns])
              for s, df in fixture_sources(spark, SF).items() if s in ("okta", "hrlifecycle")}
    env = encode_records(frames, "dev", "r9")
    write_envelopes(env, f"{src}/in")
    write_envelopes(env, f"{src}/in")  # every message delivered twice
    landing = tempfile.mkdtemp(prefix="gw-land-")
    q = ingest_stream(spark, f"{src}/in", landing, f"{src}/ckpt", "dev")
    q.awaitTermination()
    okta = load_source(spark, landing, "okta")
    assert okta.count() == frames["okta"].count()
    assert okta.select("req_id").distinct().count() == okta.count()


def _run_batches(df, fn, name):
    q = df.writeStream.foreachBatch(fn).option(
        "checkpointLocation", tempfile.mkdtemp(prefix=f"gw-{name}-")).trigger(availableNow=True).start()
    q.awaitTermination()


def test_ingest_keeps_files_with_old_times_and_the_last_delivery(spark):
    import os

    src, landing = tempfile.mkdtemp(prefix="gw-env-"), tempfile.mkdtemp(prefix="gw-land-")
    schema = "user string, join_date string, location string"

    def deliver(rows, run, mtime):
        write_envelopes(encode_records({"hrlifecycle": spark.createDataFrame(rows, schema).coalesce(1)}, "dev", run), f"{src}/in")
        for p in Path(f"{src}/in").glob("*.json"):
            if p not in seen:
                os.utime(p, (mtime, mtime))
                seen.add(p)

    def ingest():
        ingest_stream(spark, f"{src}/in", landing, f"{src}/ckpt", "dev", max_files_per_trigger=1).awaitTermination()

    seen: set = set()
    deliver([("a", "1", "first")], "r1", 1_700_000_000)
    ingest()
    deliver([("b", "1", "late file"), ("a", "1", "second")], "r2", 1_700_000_000 - 3 * 3600)  # three hours older
    ingest()  # restarted between the batches
    deliver([("c", "1", "x"), ("c", "1", "y"), ("c", "1", "z")], "r3", 1_700_000_000 + 3 * 3600)
    ingest()
    got = {r["user"]: r["location"] for r in load_source(spark, landing, "hrlifecycle").collect()}
    assert got == {"a": "second", "b": "late file", "c": "z"}


def _queue(spark, rows, run):
    """Files of a queue: messages with and without a final line break, blank lines."""
    root = tempfile.mkdtemp(prefix="gw-queue-")
    frame = spark.createDataFrame(rows, "user string, join_date string, location string").coalesce(1)
    lines = encode_records({"hrlifecycle": frame}, "dev", run).toJSON().collect()
    return root, lines


def test_a_run_stops_at_the_message_bound_and_a_crash_replays(spark, monkeypatch):
    import os

    from gatewatch.streaming import ingest

    root, lines = _queue(spark, [(f"u{i}", "1", f"Zürich {i}") for i in range(120)], "r1")
    Path(f"{root}/in").mkdir()
    Path(f"{root}/in/b.json").write_text("\n".join(lines[:45]))
    Path(f"{root}/in/c.json").write_text("\n" + "\n\n".join(lines[45:90]) + "\n")
    landing = f"{root}/land"

    def run():
        q = ingest_stream(spark, f"{root}/in", landing, f"{root}/ckpt", "dev", max_messages=50)
        q.awaitTermination()
        return spark.read.option("recursiveFileLookup", True).parquet(f"{landing}/hrlifecycle")

    assert run().count() == 50
    Path(f"{root}/in/a.json").write_text("\n".join([*lines[90:], "no json"]) + "\n")
    os.utime(f"{root}/in/a.json", (1_000_000_000, 1_000_000_000))  # a file with an older time is not missed
    real = ingest.land

    def land_and_fail(by_source, to):
        real(by_source, to)
        raise RuntimeError("lost after landing")

    monkeypatch.setattr(ingest, "land", land_and_fail)
    with pytest.raises(Exception, match="lost after landing"):
        run()
    monkeypatch.setattr(ingest, "land", real)
    # the crashed pull comes again as it was and is all that the next run takes
    assert load_source(spark, landing, "hrlifecycle").count() == 99  # one of its 50 messages is no JSON
    assert run().count() == 50 + 49 + 49
    landed = run()
    assert load_source(spark, landing, "hrlifecycle").count() == 120
    for _ in range(2):
        assert run().count() == landed.count()  # nothing is left
    got = load_source(spark, landing, "hrlifecycle").collect()
    assert {r["location"] for r in got} == {f"Zürich {i}" for i in range(120)}
    assert spark.read.parquet(f"{landing}/_rejects").count() >= 1


def test_the_last_delivery_of_a_pull_wins(spark):
    import os

    root, old = _queue(spark, [("u", "1", "old")], "r1")
    _, new = _queue(spark, [("u", "1", "new")], "r1")
    Path(f"{root}/in").mkdir()
    for name, line, at in (("z", old[0], 100), ("a", new[0], 200)):
        Path(f"{root}/in/{name}.json").write_text(line)
        os.utime(f"{root}/in/{name}.json", (at, at))
    ingest_stream(spark, f"{root}/in", f"{root}/land", f"{root}/ckpt", "dev", max_messages=50).awaitTermination()
    assert [r["location"] for r in load_source(spark, f"{root}/land", "hrlifecycle").collect()] == ["new"]


def test_queue_source_plans_and_acknowledges(tmp_path):
    from gatewatch.streaming.message_source import QueueReader

    (tmp_path / "q").mkdir()
    (tmp_path / "q" / "1.json").write_bytes(b"".join(b'{"n": %d}\n' % i for i in range(7)))
    (tmp_path / "q" / "2.json").write_bytes("é\r\n\n  \nlast".encode())
    reader = lambda **o: QueueReader({"path": str(tmp_path / "q"), "log": str(tmp_path / "log"), "max_messages": "4", "split_messages": "3", **o})
    assert reader().initialOffset() == {"pull": 0}
    first = reader()
    assert first.latestOffset() == {"pull": 1} and first.latestOffset() == {"pull": 2} and first.latestOffset() == {"pull": 3}
    assert first.latestOffset() == {"pull": 3}
    lines = lambda a, b: [[r[0] for r in reader().read(p)] for p in reader().partitions({"pull": a}, {"pull": b})]
    assert lines(0, 1) == [['{"n": 0}', '{"n": 1}', '{"n": 2}'], ['{"n": 3}']]
    assert lines(1, 2) == [['{"n": 4}', '{"n": 5}', '{"n": 6}'], ["é"]] and lines(2, 3) == [["last"]]
    places = [r[1:] for p in reader().partitions({"pull": 0}, {"pull": 3}) for r in reader().read(p)]
    assert places == sorted(places) and len(set(places)) == 9
    reader(acknowledge="delete").commit({"pull": 2})
    assert sorted(f.name for f in (tmp_path / "q").iterdir()) == ["2.json"]
    assert lines(2, 3) == [["last"]]
    reader(acknowledge="delete").commit({"pull": 3})
    assert not list((tmp_path / "q").iterdir()) and reader().latestOffset() == {"pull": 3}
    with pytest.raises(ValueError):
        reader(max_messages="0")


def test_streaming_baselines_equal_batch_over_many_batches(spark, staged):
    """Micro-batches share days, come out of order by days, and one is replayed."""
    root, b = staged
    for name, source, kind, rule in (("d", "app_usage", "data", R.excessive_data_transferred), ("v", "ad", "volume", R.ad_volume_spikes)):
        hist, scored = tempfile.mkdtemp(prefix="gw-hist-"), tempfile.mkdtemp(prefix="gw-scored-")
        # every file comes twice, so each batch but the first meets events it has
        path = _in_files(b[source], root, f"{source}_days", 6, 10 * 86400, 2)
        write = live.baseline_batch_writer(f"{hist}/h", f"{scored}/s", kind, max_parts=5)
        kept = []

        def run(batch, batch_id, write=write, kept=kept):
            write(batch, batch_id)
            if batch_id == 2:
                write(batch, batch_id)
                kept.append(batch_id)

        _run_batches(_stream_files(spark, path, b[source].schema), run, name)
        assert kept == [2]
        got = spark.read.parquet(f"{scored}/s")
        key = "user" if kind == "data" else "action"
        value = "total_data_mb" if kind == "data" else "event_count"
        exp = rule(b[source])
        rows = lambda df: sorted((r[key], str(r["activity_date"]), round(r[value], 6)) for r in df.collect())
        assert rows(got.filter("is_finding")) == rows(exp)
        # every (key, day) of every batch is in the history
        days = b[source].groupBy(key, F.to_date("ts").alias("activity_date")).agg(
            (F.sum("data_mb") if kind == "data" else F.count(F.lit(1))).alias(value))
        assert rows(got.select(key, "activity_date", value)) == rows(days)


def test_evidence_batch_writer(spark, staged):
    root, b = staged
    out = {}

    def sink(name, df, batch_id):
        out[name] = out.get(name, 0) + df.count()

    ad = _stream(spark, root, "ad", b["ad"].schema)
    q = ad.writeStream.foreachBatch(live.evidence_batch_writer(lambda: b["saviynt"], sink)).option(
        "checkpointLocation", tempfile.mkdtemp(prefix="gw-ev-")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert out["shadow_access_events"] == R.shadow_access(b["ad"], b["saviynt"]).count()
    assert out["privilege_escalation_without_request"] == R.privilege_escalation_without_request(
        b["ad"], b["saviynt"]).count()


def test_daily_store_reads_touched_days_only_and_survives_replays(spark):
    import datetime as dt

    from gatewatch.streaming.daily_store import DailyStore

    path = tempfile.mkdtemp(prefix="gw-store-")
    store = DailyStore(path, ("id",), "user", F.col("mb").try_cast("double"), "total", max_parts=3)
    schema = "id string, user string, mb string, ts timestamp"
    day = lambda d: dt.datetime(2024, 1, d, 12)
    batch = lambda *rows: spark.createDataFrame(list(rows), schema)
    total = lambda d: sorted((r["user"], r["total"]) for r in store.totals(spark, [day(d).date()]).collect())
    first = batch(("a", "u", "1", day(1)), ("b", "u", "2", day(1)), ("c", "v", "bad", day(2)), ("x", "u", "9", None))
    assert store.add(first, 0) == [day(1).date(), day(2).date()]
    assert total(1) == [("u", 3.0)] and total(2) == [("v", None)]
    # redelivered under a new batch id, with a correction of one event
    assert store.add(batch(("a", "u", "1", day(1)), ("b", "u", "5", day(1))), 1) == [day(1).date()]
    assert total(1) == [("u", 6.0)]
    # other days' files are not read: a day that cannot be read does no harm
    broken = Path(f"{path}/rows/activity_date=2024-01-02/part=b000000000")
    for f in broken.glob("*.parquet"):
        f.write_bytes(b"broken")
    for f in broken.glob(".*.crc"):
        f.unlink()
    for k in (2, 3, 4, 4, 5, 5):  # some are replayed; parts are compacted on the way
        assert store.add(batch((f"n{k}", "u", "10", day(1)), ("b", "u", "5", day(1))), k) == [day(1).date()]
    assert total(1) == [("u", 46.0)]
    assert len(list(Path(f"{path}/rows/activity_date=2024-01-01").glob("part=*"))) <= 3
    # a crash between a compaction and the deletion of its parts leaves rows twice
    store.compact(spark, [day(1).date()])
    (one,) = Path(f"{path}/rows/activity_date=2024-01-01").glob("part=*")
    import shutil
    shutil.copytree(one, one.with_name("part=b000000001"))
    assert store.add(batch(("late", "v", "4", day(1))), 9) == [day(1).date()]
    assert total(1) == [("u", 46.0), ("v", 4.0)]
    assert store.add(batch().limit(0), 10) == []


def test_no_recent_login_batches_give_both_reasons(spark, staged):
    root, b = staged
    found = []
    app = _stream(spark, root, "app_usage", b["app_usage"].schema)
    _run_batches(app, live.no_recent_login_batch_writer(lambda: b["okta"], lambda df, i: found.extend(df.collect())), "nl")
    exp = R.impossible_login(b["okta"], b["app_usage"]).filter(F.col("session_id").isNull() | (F.trim("session_id") == ""))
    assert sorted(found, key=str) == sorted(exp.collect(), key=str)
    assert {r["anomaly_reason"] for r in found} == {"no_preceding_login", "application_too_long_after_login"}


def test_multi_app_session_stream_crosses_midnight(spark):
    import datetime as dt

    root = tempfile.mkdtemp(prefix="gw-multi-")
    apps = ["GitHub", "Snowflake", "Databricks", "Workday", "Salesforce"]
    start = dt.datetime(2024, 3, 1, 22, 0)
    rows = [("u", f"U{i}", a, "S1", start + dt.timedelta(hours=i)) for i, a in enumerate(apps)]
    rows += [("v", f"V{i}", a, "S2", start + dt.timedelta(hours=i)) for i, a in enumerate(apps[:2])]
    schema = "user string, usage_id string, app string, session_id string, ts timestamp"
    for k in range(3):
        part = rows[k::3] + ([("closing", "C", "GitHub", "S9", start + dt.timedelta(days=9))] if k == 2 else [])
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{root}/a/{k:03d}")
    exp = R.multi_app_session(spark.createDataFrame(rows, schema))
    q = live.multi_app_session_stream(_stream_files(spark, f"{root}/a", schema), delay="6 hours")
    got = _drain(q, "s_midnight")
    assert sorted(got.collect()) == sorted(exp.collect()) and exp.count() == 1


def test_multi_app_session_stream_equals_batch(spark, staged):
    root, b = staged
    app = _stream(spark, root, "app_usage", b["app_usage"].schema)
    q = (live.multi_app_session_stream(app, gap="40 days", delay="0 seconds")
         .writeStream.format("memory").queryName("s_multi").outputMode("complete")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table("s_multi")
    exp = R.multi_app_session(b["app_usage"])
    assert sorted(got.collect()) == sorted(exp.collect())
