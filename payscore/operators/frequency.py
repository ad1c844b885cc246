"""How often a customer occurs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payscore.shared import hot_from_counts, lookup, store

KEYS = ("bankacc_id_type", "bankacc_id_no", "trans_stat")


def attach_frequency(df: DataFrame, keys: Sequence[str] = KEYS, out: str = "kk_cnt") -> DataFrame:
    """Add the number of rows with the same key; a key with a null part gets null.

    The default key holds the label, so the count tells something about it; pass other keys
    to use the count as a feature. Counting combines on the map side and the join salts hot
    customers, so a customer with a third of all rows is never in one task, as a window over
    the key would make it.
    """
    keyed = df.select(*keys).na.drop()
    counts = store(keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)), row_bytes=128)
    hot = None
    if not counts.broadcastable:
        total = counts.df.agg(F.sum(out)).first()[0]
        hot = hot_from_counts(counts.df, keys, out, total)
    return lookup(df, counts, {k: k for k in keys}, hot=hot)
