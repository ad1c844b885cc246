"""Customer clusters by bisecting k-means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import BisectingKMeans, BisectingKMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payscore.functions import constant, let
from payscore.shared import lookup, store

FEATURES = ("acc_cust_amntrang", "acc_cust_sex", "acc_cust_agerang", "acc_cust_dayrang")


def _point(features: Sequence[str]) -> Column:
    return F.array(*[F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) for c in features])


def profiles(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Distinct feature combinations with their row counts; buckets leave few of them."""
    return df.groupBy(*features).agg(F.count(F.lit(1)).alias("cnt"))


def fit_clusters(
    df: DataFrame, k: int, features: Sequence[str] = FEATURES, seed: int = 42
) -> BisectingKMeansModel:
    """Train on all rows. Clusters are split by their number of rows, so profiles would not do."""
    points = store(df.select(array_to_vector(_point(features)).alias("point"))).df
    return BisectingKMeans(k=k, seed=seed, featuresCol="point").fit(points)


def assign_clusters(
    df: DataFrame,
    model: BisectingKMeansModel,
    features: Sequence[str] = FEATURES,
    out: str = "acc_cust_km",
) -> DataFrame:
    """Add the cluster of each row: predicted once per profile, then looked up."""
    points = profiles(df, features).withColumn("point", array_to_vector(_point(features)))
    done = model.transform(points.withColumnsRenamed({f: f"_p_{f}" for f in features}))

    def key(column: str) -> Column:
        # A null feature is a profile too, but would match nothing as a join key.
        return F.coalesce(F.concat(F.lit("="), F.col(column)), F.lit(""))

    cluster = F.col(model.getPredictionCol()).cast("string")
    table = store(done.select(*[key(f"_p_{f}").alias(f"_d_{f}") for f in features], cluster.alias(out)))
    keyed = df.withColumns({f"_k_{f}": key(f) for f in features})
    return lookup(keyed, table, {f"_k_{f}": f"_d_{f}" for f in features}).drop(*[f"_k_{f}" for f in features])


def load_clusters(path: str) -> BisectingKMeansModel:
    """Use a clustering saved with ``model.write().overwrite().save(path)``."""
    return BisectingKMeansModel.load(path)


def _distances(features: Sequence[str], centers: Sequence[Sequence[float]]) -> Column:
    """Squared distance to each center.

    Array functions keep this small: written out, it would push the code generated for a whole
    pipeline over the size up to which the JVM compiles it.
    """

    def squared(point: Column, center: Column) -> Column:
        return F.aggregate(
            F.zip_with(point, center, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, x: acc + x
        )

    return let(_point(features), lambda p: F.transform(constant(centers), lambda c: squared(p, c)))


def assign_nearest(
    df: DataFrame,
    centers: Sequence[Sequence[float]],
    features: Sequence[str] = FEATURES,
    out: str = "acc_cust_km",
) -> DataFrame:
    """Add the nearest of given centers, the first one on ties; a projection."""
    nearest = let(_distances(features, centers), lambda d: F.array_position(d, F.array_min(d)) - 1)
    return df.withColumn(out, nearest.cast("string"))


def cluster_report(
    df: DataFrame, centers: Sequence[Sequence[float]], features: Sequence[str] = FEATURES
) -> DataFrame:
    """Rows and summed squared distance per nearest center."""
    d = F.col("_distances")
    per_row = df.withColumn("_distances", _distances(features, centers)).select(
        (F.array_position(d, F.array_min(d)) - 1).cast("string").alias("cluster"), F.array_min(d).alias("d")
    )
    return per_row.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("d").alias("cost"))
