"""Sinks: replace-mode table writes, stage outputs and the flat CSV export."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerscreen.schema import CSV_TEXT


def write_table(df: DataFrame, path: str, view_name: str = "journal_entries",
                partition_by: list[str] | None = None) -> DataFrame:
    """Replace the table at ``path`` and expose it as a temp view.

    Returns the re-read table, so later stages start from the written copy
    (a lineage cut that survives executor loss)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    out = df.sparkSession.read.parquet(path)
    out.createOrReplaceTempView(view_name)
    return out


def write_stage(df: DataFrame, path: str) -> None:
    """Persist one stage output (Parquet, replace mode)."""
    df.write.mode("overwrite").parquet(path)


def write_export_csv(df: DataFrame, path: str) -> None:
    """The flat reviewer/dashboard export: CSV with a header, replace mode.

    Written by all tasks in parallel (one part file per partition); dates are
    ISO text, null strings stay empty, quotes inside a text are doubled and blanks
    at its ends stay, as spreadsheet tools and CSV readers expect."""
    (df.write.mode("overwrite").options(header=True, dateFormat="yyyy-MM-dd", **CSV_TEXT).csv(path))
