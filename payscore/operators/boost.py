"""AdaBoost over Naive Bayes rounds."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payscore.functions import argmax, chunks, confidence, constant, softmax, votes
from payscore.operators.bayes import (
    MULTINOMIAL,
    Model,
    add_round,
    check_arguments,
    class_label,
    collect_totals,
    first_round,
    group_sums,
    level_weights,
    log_joint,
    make_profiles,
)
from payscore.shared import Stored, local_table, lookup

#: Errors are kept this far from 0 and 1, where the step would be infinite.
ERROR_MARGIN = 1e-10


def step(error: float, classes: int, alpha: str) -> tuple[float, float]:
    """The clamped error and its step: ``half_log`` ½ln((1−e)/e), ``samme`` ln((K−1)(1−e)/e)."""
    e = min(max(error, ERROR_MARGIN), 1 - ERROR_MARGIN)
    if alpha == "half_log":
        return e, 0.5 * math.log((1 - e) / e)
    if alpha == "samme":
        return e, math.log((classes - 1) * (1 - e) / e)
    raise ValueError(f"unknown step {alpha}")


def round_winners(scores: Column, model: Model) -> Column:
    """The class each round decides for, as an array of positions."""
    return F.transform(chunks(scores, model.rounds, model.classes), argmax)


def _weighted(profiles: Stored, model: Model, scales: dict[str, list[float]]) -> DataFrame:
    """Profiles with ``wrong`` (in the last round) and ``_now``, the weight that round used.

    The weight is worked out from the rounds before, whose steps enter as plain numbers, so
    nothing is carried from round to round but the model itself.
    """
    labels = constant(model.labels)
    df = log_joint(profiles.df, model, by=None if len(model.params) == 1 else "model_id")
    winners = round_winners(F.col("log_joint"), model)
    wrong = F.transform(winners, lambda w: F.get(labels, w) != F.col("label"))
    rows = [(m, [math.exp(a) for a in p.alpha], math.prod(scales[m], start=1.0)) for m, p in model.params.items()]
    df = add_constants(df, rows, "_m string, _grow array<double>, _scale double")
    # The last round has no step yet and is left out.
    grown = F.zip_with("_wrong", "_grow", lambda wrong, grow: F.when(wrong & grow.isNotNull(), grow).otherwise(1.0))
    now = F.col("w") * F.col("_scale") * F.aggregate(grown, F.lit(1.0), lambda acc, x: acc * x)
    last = F.element_at("_wrong", -1).cast("int")
    return df.withColumn("_wrong", wrong).select(
        "model_id", "label", "codes", "cnt", last.alias("wrong"), now.alias("_now")
    )


def add_constants(df: DataFrame, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Add the numbers of each row's model: literals for one model, else a lookup by model id."""
    if len(rows) > 1:
        return lookup(df, local_table(df.sparkSession, rows, schema, 256), {"model_id": "_m"})
    names = [field.split()[0] for field in schema.split(", ")]
    values = {
        n: constant(v).cast("array<double>") if isinstance(v, list) else F.lit(v)
        for n, v in zip(names[1:], rows[0][1:])
    }
    return df.withColumns(values)


def fit_boost(
    df: DataFrame,
    slots: Sequence[str],
    rounds: int = 5,
    label: str = "label",
    codes: str = "codes",
    alpha: str = "half_log",
    kind: str = MULTINOMIAL,
    smoothing: float = 1.0,
    dictionary: DataFrame | None = None,
    by: str | None = None,
) -> Model:
    """Fit ``rounds`` balanced Naive Bayes models, each on the rows the ones before got wrong.

    One pass over the profiles per round: weight summed by class, code and right/wrong gives the
    error (and so the step), the new total for renormalising, and the sums the next round is
    fitted from. Only numbers per class reach the driver.
    """
    check_arguments(kind, smoothing)
    if rounds < 1:
        raise ValueError("at least one round is needed")
    profiles = make_profiles(df, label, codes, None, by)
    sums = group_sums(profiles.df, slots, F.col("w"))
    model, totals = first_round(sums, slots, kind, smoothing, True, None, dictionary)
    scales: dict[str, list[float]] = {m: [] for m in totals}
    known = model.levels.df.select("model_id", "slot", "code")

    for r in range(rounds):
        last = r + 1 == rounds
        weighted = _weighted(profiles, model, scales)
        # The last round needs its error only, not the sums for a next one.
        sums = group_sums(weighted, [] if last else slots, F.col("_now"), ["wrong"])
        parts = {(x["model_id"], x["label"], x["wrong"]): x for x in collect_totals(sums.df, "wrong")}
        change = []
        for m, p in model.params.items():
            def pick(what: str, wrong: int) -> list[float]:
                found = [parts.get((m, c, wrong)) for c in model.labels]
                return [x[what] or 0.0 if x else 0.0 for x in found]

            ok, bad, n = sum(pick("weight", 0)), sum(pick("weight", 1)), sum(totals[m].rows)
            error, a = step(bad / n, model.classes, alpha)
            keep = n / (ok + bad * math.exp(a))
            grow = keep * math.exp(a)
            p.error.append(error)
            p.alpha.append(a)
            scales[m].append(keep)
            change.append((m, keep, grow))
            for what in ("weight", "terms"):
                setattr(totals[m], what, [x * keep + y * grow for x, y in zip(pick(what, 0), pick(what, 1))])
        if not last:
            factors = add_constants(sums.df, change, "_m string, _keep double, _grow double")
            w = F.col("w") * F.when(F.col("wrong") == 1, F.col("_grow")).otherwise(F.col("_keep"))
            levels = level_weights(factors, model.labels, w, known)
            add_round(model, levels, totals, True, None, model.levels)
    return model


def boost_score(
    df: DataFrame, model: Model, codes: str = "codes", slots: Sequence[str] | None = None, by: str | None = None
) -> DataFrame:
    """Add ``raw`` (every round votes its step for its class), ``probability`` (softmax of the
    votes), ``prediction`` (a label) and ``confidence`` (its probability)."""
    df = log_joint(df, model, codes, slots, by, out="_joint")
    if by is None:
        (params,) = model.params.values()
        weights = constant(params.alpha)
    else:
        rows = [(m, p.alpha) for m, p in model.params.items()]
        df = df.withColumn("_by", F.col(by).cast("string"))
        df = lookup(df, local_table(df.sparkSession, rows, "_m string, _alpha array<double>", 256), {"_by": "_m"})
        weights = F.col("_alpha")
    df = df.withColumn("raw", votes(round_winners(F.col("_joint"), model), weights, model.classes))
    df = df.withColumn("probability", softmax(F.col("raw")))
    df = df.withColumn("_winner", argmax(F.col("raw")))
    df = df.withColumn("prediction", class_label(model.labels, F.col("_winner")))
    df = df.withColumn("confidence", confidence(F.col("probability"), F.col("_winner")))
    return df.drop("_joint", "_winner", "_by", "_alpha")
