"""Sinks: directory outputs written by the executors.

Tables and reports are written in parallel; only one-row summaries are
coalesced to one file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by=None, header: bool = True) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.options(header=header, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    elif fmt == "json":
        w.json(path)
    elif fmt == "text":
        w.text(path)
    else:
        w.parquet(path)


def write_report(lines: DataFrame, path: str) -> None:
    """Report line rows -> text files whose names are in the report's order (a range sort; small reports
    come out as one file)."""
    lines.orderBy("section", "row_ord", "line_no").select("line").write.mode("overwrite").text(path)


def write_json_row(df: DataFrame, path: str) -> None:
    """A one-row summary (audit report, version record) as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)
