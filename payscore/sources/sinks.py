"""Writing result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str) -> None:
    """Replace the whole table at ``path``."""
    df.write.mode("overwrite").parquet(path)


def overwrite_partition(df: DataFrame, path: str, keys: tuple[str, ...] = ("year_id", "month_id")) -> None:
    """Replace only the partitions that occur in ``df``; all others stay."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def write_file(df: DataFrame, path: str, fmt: str) -> None:
    """Replace ``path`` with parquet, json, csv or text; text formats that can get a header."""
    if fmt not in ("parquet", "json", "csv", "text"):
        raise ValueError(f"unknown format {fmt}")
    df.write.mode("overwrite").format(fmt).option("header", "true").save(path)
