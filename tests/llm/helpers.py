"""Comparison of a query with its DuckDB SQL."""

import duckdb

TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def sql_rows(sql, sf_dir):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    out = db.execute(sql)
    return sorted(d[0] for d in out.description), [dict(zip([d[0] for d in out.description], r, strict=True)) for r in out.fetchall()]


def same_rows(df, sql, sf_dir):
    names, want = sql_rows(sql, sf_dir)
    assert sorted(df.columns) == names
    key = lambda r: repr([r[n] for n in names])
    got = sorted(key(r.asDict()) for r in df.collect())
    assert got == sorted(map(key, want))
    return len(got)
