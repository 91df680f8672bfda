"""Command line: `python -m gatewatch <command> ...` (under spark-submit on a cluster).

  check-csv  DATA_DIR [--out PATH]            contract check of the source CSV files;
                                              all violations as JSON lines below PATH
  publish    DATA_DIR OUT --env E --run-id R  CSV rows -> JSON-lines envelopes
  ingest     IN LANDING --checkpoint C --env E [--max-messages N]
                                              envelopes -> landed Parquet; a run pulls at most
                                              N messages (50,000; 0: all that is there)
  run        LANDING --output-root O --run-id R [--tables a,b] [--dry-run] [--format F]
                                              detections -> finding tables
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F


def _session(app: str) -> SparkSession:
    from gatewatch.session import apply_engine_conf

    spark = SparkSession.builder.appName(app).getOrCreate()
    apply_engine_conf(spark)
    return spark


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="gatewatch", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="cmd", required=True)

    c = sub.add_parser("check-csv")
    c.add_argument("data_dir")
    c.add_argument("--out", help="where to write the violations")

    pub = sub.add_parser("publish")
    pub.add_argument("data_dir")
    pub.add_argument("out")
    pub.add_argument("--env", default="dev")
    pub.add_argument("--run-id", default="manual")

    ing = sub.add_parser("ingest")
    ing.add_argument("envelopes")
    ing.add_argument("landing")
    ing.add_argument("--checkpoint", required=True)
    ing.add_argument("--env", default="dev")
    ing.add_argument("--max-messages", type=int, default=50_000)

    r = sub.add_parser("run")
    r.add_argument("landing")
    r.add_argument("--output-root")
    r.add_argument("--run-id", required=True)
    r.add_argument("--tables")
    r.add_argument("--dry-run", action="store_true")
    r.add_argument("--format", default="parquet")
    r.add_argument("--option", action="append", default=[], help="writer option key=value")

    a = p.parse_args(argv)
    spark = _session(f"gatewatch-{a.cmd}")

    if a.cmd == "check-csv":
        from gatewatch.sources.loader import check_source_files

        problems = check_source_files(spark, a.data_dir)
        if a.out:
            seen = Observation("violations")
            problems.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").json(a.out)
            n = int(seen.get["n"])
        else:
            n = problems.count()
        shown = problems.limit(50).collect()
        for row in shown:
            print(json.dumps(row.asDict()))
        print(json.dumps({"violations": n, "shown": len(shown), "written_to": a.out}))
        return 1 if n else 0

    if a.cmd == "publish":
        from gatewatch.sources.contracts import SOURCE_FILES
        from gatewatch.sources.envelope import encode_records, observed_counts
        from gatewatch.sources.loader import check_source_files, csv_path, read_csv_source
        from gatewatch.streaming.ingest import write_envelopes

        if not check_source_files(spark, a.data_dir).isEmpty():
            print("source files violate the contract; run check-csv", file=sys.stderr)
            return 1
        frames = {s: read_csv_source(spark, csv_path(a.data_dir, s), s) for s in SOURCE_FILES}
        published = Observation("published")
        write_envelopes(encode_records(frames, a.env, a.run_id).observe(published, *observed_counts()), a.out)
        print(json.dumps(published.get))
        return 0

    if a.cmd == "ingest":
        from gatewatch.streaming.ingest import ingest_stream

        ingest_stream(spark, a.envelopes, a.landing, a.checkpoint, a.env, max_messages=a.max_messages or None).awaitTermination()
        return 0

    from gatewatch.plans.runner import run

    options = dict(o.split("=", 1) for o in a.option)
    counts = run(spark, input_root=a.landing, output_root=a.output_root, run_id=a.run_id,
                 tables=a.tables, dry_run=a.dry_run, format=a.format, write_options=options)
    print(json.dumps(counts))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
