"""Attaching predictions and turning codes back into text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payscore.shared import Stored, lookup, store

# The columns of the display table.
DISPLAY_COLUMNS = """
mios_trans_code sys_no trans_code trans_bat_no trans_stat acc_cust_name bankacc_id_type
bankacc_id_no features train_label train_accuracy acc_cust_sex acc_cust_home acc_cust_age
acc_cust_agerang acc_cust_instancetype acc_cust_amntrang acc_cust_month acc_cust_day
acc_cust_dayrang kk_cnt acc_cust_km
""".split()


def attach_predictions(
    df: DataFrame,
    predictions: DataFrame,
    keys: Sequence[str] = ("trans_code", "trans_bat_no"),
    columns: Sequence[str] = ("train_label", "train_accuracy"),
) -> DataFrame:
    """Left join of predictions on the transaction key; rows without one get nulls."""
    renamed = {k: f"_key_{k}" for k in keys}
    table = store(predictions.select(*keys, *columns).withColumnsRenamed(renamed), row_bytes=128)
    return lookup(df, table, renamed)


def decode_features(
    df: DataFrame,
    catalog: Stored,
    column: str = "features",
    out: str = "features_desc",
) -> DataFrame:
    """Add `` ;type: text`` for every code of the row, in stored order; `` ;`` for an unknown code.

    Each different text of codes is decoded once, whatever its number of codes, and looked up from
    its rows, so rows are not regrouped.
    """
    text = F.concat(F.col("feature_ptype"), F.lit(": "), F.col("feature_desc"))
    # The first row of a code counts; ids give the order.
    first = catalog.df.groupBy(F.col("feature_code").alias("_c")).agg(
        F.min_by(text, F.col("feature_id").cast("long")).alias("_t")
    )
    different = df.select(F.col(column).alias("_f")).where(F.col("_f").isNotNull()).distinct()
    each = different.select("_f", F.posexplode(F.split("_f", "_")).alias("_at", "_code"))
    each = lookup(each, store(first), {"_code": "_c"})
    shown = F.concat(F.lit(" ;"), F.coalesce("_t", F.lit("")))
    parts = each.groupBy("_f").agg(F.sort_array(F.collect_list(F.struct("_at", shown.alias("_s")))).alias("_p"))
    texts = parts.select("_f", F.array_join(F.transform("_p", lambda p: p["_s"]), "").alias("_shown"))
    return lookup(df.drop(out), store(texts), {column: "_f"}).withColumnRenamed("_shown", out)


def display_columns(df: DataFrame, columns: Sequence[str] = DISPLAY_COLUMNS) -> DataFrame:
    return df.select(*columns)
