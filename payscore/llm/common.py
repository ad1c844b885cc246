"""What several text operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space that separates words, and what a word is.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Every FOLDS-th document (by its id's checksum) is held out from learning.
FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the documents that nothing is learned from; a null id counts as an empty one."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def words_of(text: Column) -> Column:
    """The words of a text as an array; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def with_row(df: DataFrame, **columns: Column) -> DataFrame:
    """The rows of ``df`` packed in one column ``_row``, so that nothing added can clash with their names."""
    return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("_row"), *[v.alias(k) for k, v in columns.items()])


def unpack(df: DataFrame) -> DataFrame:
    return df.select("_row.*")
