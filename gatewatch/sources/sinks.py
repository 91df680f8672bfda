"""Result sink: replace a finding table, partitioned by day."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame

FILE_FORMATS = frozenset({"parquet", "orc", "json", "csv", "delta", "iceberg"})

# What an indirect warehouse write sets on top of the given options.
REPLACE = {"writeDisposition": "WRITE_TRUNCATE"}
BY_DAY = {"partitionField": "event_date", "partitionType": "DAY"}


def connector_options(options: Mapping[str, str], columns: Collection[str]) -> dict[str, str]:
    """Options of a warehouse write of a table with these columns. `writeMethod`
    is `indirect` (the default: staged files, so a `temporaryGcsBucket` is
    required; the table is replaced, and partitioned by day if it has an
    `event_date`) or `direct` (none of these)."""
    out = {"writeMethod": "indirect", **options}
    method = out["writeMethod"]
    if method == "direct":
        return out
    if method != "indirect":
        raise ValueError(f"writeMethod must be direct or indirect, not {method!r}")
    if not out.get("temporaryGcsBucket"):
        raise ValueError("an indirect write stages files: set temporaryGcsBucket")
    return {**REPLACE, **(BY_DAY if "event_date" in columns else {}), **out}


def write_findings(
    df: DataFrame,
    target: str,
    *,
    format: str = "parquet",
    options: Mapping[str, str] | None = None,
    partition_by_date: bool = True,
) -> None:
    """Replace `target` with `df`.

    File formats: `target` is a path; the table is fully replaced (static
    overwrite, never a dynamic per-partition overwrite) and laid out by
    `event_date` so readers prune by day. Other formats (warehouse
    connectors): `target` is passed as the `table` option together with
    `connector_options`; such a connector must be on the classpath.
    """
    files = format in FILE_FORMATS
    writer = df.write.format(format).mode("overwrite")
    for k, v in (dict(options or {}) if files else connector_options(options or {}, df.columns)).items():
        writer = writer.option(k, v)
    if files:
        writer = writer.option("partitionOverwriteMode", "static")
        if partition_by_date and "event_date" in df.columns:
            writer = writer.partitionBy("event_date")
        writer.save(target)
    else:
        writer.option("table", target).save()
