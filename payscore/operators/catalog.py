"""The feature catalog: a stable code for every value of every active feature."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payscore.functions import category_value
from payscore.shared import lookup, numbered, store
from payscore.sources.config import Feature, Range

COLUMNS = (
    "feature_id", "feature_code", "feature_value", "feature_name",
    "feature_pcode", "feature_ptype", "feature_desc", "feature_weight",
)


def feature_values(df: DataFrame, features: Sequence[Feature]) -> DataFrame:
    """Distinct (pcode, value) of all features in one pass; duplicates go before the shuffle."""
    wide = df.select(*[category_value(F.col(f.col_name)).alias(f.pcode) for f in features])
    pcodes = [f.pcode for f in features]
    return wide.unpivot([], pcodes, "feature_pcode", "feature_value").distinct()


def _room(features: Sequence[Feature]) -> dict[str, int]:
    """How many codes fit between each pcode and the next one."""
    starts = sorted({int(f.pcode) for f in features})
    ends = [*starts[1:], 10 ** len(str(starts[-1]))]
    return {str(a): b - a - 1 for a, b in zip(starts, ends)}


def _describe(spark: SparkSession, values: DataFrame, features: Sequence[Feature], ranges: Sequence[Range]) -> DataFrame:
    """Add the feature's text and the value's text, the first configured one or the value itself."""
    ptype = F.coalesce(*[F.when(F.col("feature_pcode") == f.pcode, F.lit(f.desc)) for f in features])
    out = values.withColumn("feature_ptype", ptype)
    texts: dict[tuple[str, str], str] = {}
    for r in ranges:
        texts.setdefault((r.feature_code, r.code), r.desc)
    if not texts:
        return out.withColumn("feature_desc", F.col("feature_value"))
    rows = [(p, c, d) for (p, c), d in texts.items()]
    table = store(spark.createDataFrame(rows, "_pcode string, _code string, _desc string"))
    out = lookup(out, table, {"feature_pcode": "_pcode", "feature_value": "_code"})
    return out.withColumn("feature_desc", F.coalesce("_desc", "feature_value")).drop("_desc")


def _issue(
    values: DataFrame,
    features: Sequence[Feature],
    ranges: Sequence[Range],
    used: dict[str, int],
    last_id: int,
    all_features: Sequence[Feature],
) -> DataFrame:
    """Number new values after the ``used`` ordinals of their feature."""
    spark = values.sparkSession
    values = store(values)
    sizes = {r["feature_pcode"]: r["count"] for r in values.df.groupBy("feature_pcode").count().collect()}
    room = _room(all_features)
    base, run = {}, last_id
    for f in features:
        if used.get(f.pcode, 0) + sizes.get(f.pcode, 0) > room[f.pcode]:
            raise ValueError(f"feature {f.col_name}: codes from {f.pcode} would reach the next feature")
        base[f.pcode] = run
        run += sizes.get(f.pcode, 0)

    def per_feature(numbers: dict[str, int]):
        return F.coalesce(*[F.when(F.col("feature_pcode") == p, F.lit(n)) for p, n in numbers.items()])

    rows = numbered(values, "feature_pcode", [F.col("feature_value")], "_rn")
    rows = _describe(spark, rows, features, ranges)
    ordinal = per_feature({f.pcode: int(f.pcode) + used.get(f.pcode, 0) for f in features}) + F.col("_rn")
    return rows.select(
        (per_feature(base) + F.col("_rn")).cast("string").alias("feature_id"),
        ordinal.cast("string").alias("feature_code"),
        "feature_value",
        F.col("feature_value").alias("feature_name"),
        "feature_pcode",
        "feature_ptype",
        "feature_desc",
        F.lit("1").alias("feature_weight"),
    )


def build_catalog(
    df: DataFrame, features: Sequence[Feature], ranges: Sequence[Range], configured: Sequence[Feature] | None = None
) -> DataFrame:
    """Issue ids 1..n in feature order and codes pcode+1, pcode+2, … in value order.

    Fails when a feature has more values than fit before the next one of all ``configured``
    features (those given, if left out), so that a feature switched on later has its codes free.
    """
    return _issue(feature_values(df, features), features, ranges, {}, 0, configured or features)


def extend_catalog(
    saved: DataFrame,
    df: DataFrame,
    features: Sequence[Feature],
    ranges: Sequence[Range],
    configured: Sequence[Feature] | None = None,
) -> DataFrame:
    """The saved catalog, unchanged, plus codes after its last ones for values it lacks."""
    known = store(saved.select(F.col("feature_pcode").alias("_p"), F.col("feature_value").alias("_v")))
    new = lookup(
        feature_values(df, features), known, {"feature_pcode": "_p", "feature_value": "_v"}, how="left_anti"
    )
    ordinal = F.max(F.col("feature_code").cast("int") - F.col("feature_pcode").cast("int"))
    used = {r[0]: r[1] for r in saved.groupBy("feature_pcode").agg(ordinal).collect()}
    last_id = saved.agg(F.max(F.col("feature_id").cast("int"))).first()[0] or 0
    return saved.select(*COLUMNS).unionByName(_issue(new, features, ranges, used, last_id, configured or features))
