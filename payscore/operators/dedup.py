"""One transaction per customer and outcome."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payscore.shared import lookup, store

KEYS = ("trans_stat", "bankacc_id_type", "bankacc_id_no")


def dedup_month(df: DataFrame, keys: Sequence[str] = KEYS, code: str = "mios_trans_code") -> DataFrame:
    """Rows whose code is the smallest (as text) of any group; null keys form a group together."""
    firsts = store(df.groupBy(*keys).agg(F.min(code).alias("_first")).select("_first").distinct(), row_bytes=64)
    return lookup(df, firsts, {code: "_first"}, how="left_semi")


def dedup_year(
    df: DataFrame, keys: Sequence[str] = KEYS, month: str = "acc_cust_month", code: str = "mios_trans_code"
) -> DataFrame:
    """Rows joined to the smallest code and month of each (key, month) group, keeping every group.

    A code that is smallest in several groups repeats its rows. A group without a code or a
    month matches nothing and gives one row of nulls. Every other group comes from rows of
    ``df`` itself and so always matches, which is why an inner join does.
    """
    groups = df.groupBy(*keys, month).agg(F.min(code).alias("_first"))
    groups = store(groups.select("_first", F.col(month).alias("_month")), row_bytes=96)
    found = lookup(df, groups, {code: "_first", month: "_month"}, how="inner")
    empty = groups.df.where(F.col("_first").isNull() | F.col("_month").isNull())
    nulls = empty.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields])
    return found.unionByName(nulls)
