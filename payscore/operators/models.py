"""Saving and loading fitted models as flat tables."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from payscore.operators.bayes import Model, Params, prior_table, round_table, theta_table
from payscore.operators.ensemble import Ensemble, build_ensemble
from payscore.shared import store
from payscore.sources.sinks import write_table


def save_model(spark: SparkSession, model: Model, path: str) -> None:
    """Replace ``path`` with the tables ``prior``, ``theta`` and ``rounds``; no path is stored in
    them, so a saved model can be moved."""
    write_table(prior_table(spark, model), f"{path}/prior")
    write_table(theta_table(model), f"{path}/theta")
    write_table(round_table(spark, model), f"{path}/rounds")


def load_model(spark: SparkSession, path: str) -> Model:
    params: dict[str, Params] = {}
    rounds = spark.read.parquet(f"{path}/rounds").orderBy("model_id", "round").collect()
    for row in rounds:
        p = params.setdefault(row["model_id"], Params())
        if row["alpha"] is not None:
            p.alpha.append(row["alpha"])
            p.error.append(row["error"])
    labels: dict[int, float] = {}
    for row in spark.read.parquet(f"{path}/prior").orderBy("model_id", "round", "class_ix").collect():
        p = params[row["model_id"]]
        if row["class_ix"] == 0:
            p.log_prior.append([])
            p.absent.append([])
        p.log_prior[-1].append(row["log_prior"])
        p.absent[-1].append(row["absent"])
        labels[row["class_ix"]] = row["label"]
    # One group holds the rounds times the classes of one code.
    parts = F.array_sort(F.collect_list(F.struct("round", "class_ix", "log_theta")))
    theta = spark.read.parquet(f"{path}/theta").groupBy("model_id", "slot", "code").agg(parts.alias("parts"))
    levels = theta.select("model_id", "slot", "code", F.col("parts.log_theta").alias("theta"))
    width = len(labels) * len(next(iter(params.values())).log_prior)
    return Model(
        [labels[i] for i in sorted(labels)],
        list(rounds[0]["slots"]),
        params,
        store(levels, 128 + 8 * width),
        rounds[0]["kind"],
        rounds[0]["smoothing"],
    )


def save_ensemble(spark: SparkSession, ensemble: Ensemble, path: str) -> None:
    save_model(spark, ensemble.model, path)
    rows = [(i, m, w) for i, (m, w) in enumerate(zip(ensemble.order, ensemble.weights))]
    write_table(spark.createDataFrame(rows, "place int, model_id string, weight double"), f"{path}/order")


def load_ensemble(spark: SparkSession, path: str) -> Ensemble:
    order = spark.read.parquet(f"{path}/order").orderBy("place").collect()
    return build_ensemble(load_model(spark, path), [r["model_id"] for r in order], [r["weight"] for r in order])
