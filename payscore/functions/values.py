"""Defaults for category values, labels, and the repeatable train/test split."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def category_value(value: Column) -> Column:
    """A feature value as text; null and empty become ``"0"``, the text ``"null"`` stays."""
    text = value.cast("string")
    return F.when(text.isNull() | (text == ""), F.lit("0")).otherwise(text)


def label_column(value: Column, mode: int = 0, strict: bool = False) -> Column:
    """Mode 0: 1.0 where the value is 1, else 0.0. Higher modes: the number, 0.0 where missing."""
    missing = value.isNull() | (value == "")
    number = F.when(~missing, value.cast("double") if strict else value.try_cast("double"))
    if mode == 0:
        return F.when(number == 1.0, F.lit(1.0)).otherwise(F.lit(0.0))
    return F.coalesce(number, F.lit(0.0))


def split_bucket(*key: Column) -> Column:
    """0..99 from the key alone, so a row falls on the same side of a split in every run."""
    digest = F.md5(F.concat_ws("|", *key))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100).cast("int")
