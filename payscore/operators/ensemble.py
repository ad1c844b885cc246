"""Blending month models into a year model."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payscore.functions import argmax, chunks, confidence, constant, let, softmax, sum_arrays, total, votes
from payscore.operators.bayes import MULTINOMIAL, Model, add_slot_terms, class_label, score_theta, start_scores
from payscore.shared import Stored, lookup_each, store


def month_weights(n: int, current_month: int) -> list[float]:
    """Weights of the month models of a year.

    Twelve models: 3/12 for the current month, 2/12 for the months next to it, the remainder
    shared by nine. The year does not wrap, so the weights sum to 1 only from February to
    November. Any other number of models: equal weights.
    """
    if n != 12:
        return [1.0 / n] * n
    near = 1 if current_month == 12 else 2
    rest = (1 - 3 / 12 - near * 2 / 12) / 9
    out = [rest] * 12
    for i in (current_month - 2, current_month):
        if 0 <= i < 12:
            out[i] = 2 / 12
    out[current_month - 1] = 3 / 12
    return out


@dataclass
class Ensemble:
    """Month models in order, with their weights; ``levels`` has one array over all models per code."""

    model: Model
    order: list[str]
    weights: list[float]
    levels: Stored


def build_ensemble(model: Model, order: Sequence[str], weights: Sequence[float] | str = "equal") -> Ensemble:
    """Line up month models; nothing is fitted. The same model may stand for several months."""
    order = list(order)
    use = [1.0 / len(order)] * len(order) if isinstance(weights, str) else list(weights)
    if len(use) != len(order):
        raise ValueError(f"{len(use)} weights for {len(order)} models")
    missing = sorted(set(order) - set(model.params))
    if missing:
        raise ValueError(f"no model for {', '.join(missing)}")
    zeros = F.array_repeat(F.lit(0.0), model.width)
    rows = model.levels.df.withColumn("theta", score_theta(F.col("theta"), model.kind))
    parts = [
        F.coalesce(F.any_value(F.when(F.col("model_id") == m, F.col("theta")), F.lit(True)), zeros) for m in order
    ]
    levels = rows.groupBy("slot", "code").agg(F.concat(*parts).alias("theta"))
    return Ensemble(model, order, use, store(levels, 128 + 8 * model.width * len(order)))


def _soft(values: Sequence[float]) -> list[float]:
    top = max(values)
    grown = [math.exp(v - top) for v in values]
    return [g / sum(grown) for g in grown]


def ensemble_score(
    df: DataFrame,
    ensemble: Ensemble,
    codes: str = "codes",
    slots: Sequence[str] | None = None,
    vote: str = "joint",
    prob: str | None = "blend",
) -> DataFrame:
    """Add ``raw`` (votes of the months), ``probability`` (softmax of the votes), ``prediction``
    and, with ``prob``, the blended class probabilities as ``prob`` and ``confidence``.

    Scoring by many models costs far more than finding equal rows, so each distinct list of codes
    is scored once and looked up.

    ``vote`` says how a month decides: ``joint`` takes the class with the largest sum of log
    joint scores over its rounds (steps add the same to every class, so they do not matter),
    ``boost`` lets the rounds vote their steps. ``prob="blend"`` weighs the rounds' posteriors by
    softmax of their steps, takes softmax again, and weighs the months by softmax of their
    weights; ``prob="mean"`` sums the posteriors of one-round models times the month weights.
    """
    return attach_scores(df, score_codes(df, ensemble, codes, slots, vote, prob), codes)


def _code_key(codes: str) -> Column:
    return F.coalesce(F.col(codes), F.array().cast("array<string>"))


def score_codes(
    df: DataFrame,
    ensemble: Ensemble,
    codes: str = "codes",
    slots: Sequence[str] | None = None,
    vote: str = "joint",
    prob: str | None = "blend",
) -> Stored:
    """The scores of each distinct list of codes, as ``_codes``; see :func:`ensemble_score`."""
    distinct = df.select(_code_key(codes).alias("_codes")).distinct()
    return store(_score(distinct, ensemble, "_codes", slots, vote, prob), 512)


def attach_scores(df: DataFrame, scores: Stored, codes: str = "codes") -> DataFrame:
    """Look up the scores of each row's codes."""
    return lookup_each(df, [(scores, [(_code_key(codes), "_codes")])])


def _score(
    df: DataFrame, ensemble: Ensemble, codes: str, slots: Sequence[str] | None, vote: str, prob: str | None
) -> DataFrame:
    model = ensemble.model
    t, c, n = model.rounds, model.classes, len(ensemble.order)
    params = [model.params[m] for m in ensemble.order]
    if prob == "mean" and t != 1:
        raise ValueError("the weighted mean is for one-round models")
    slots = list(slots or model.slots)
    # The score terms were worked out when the ensemble was built.
    df, names = add_slot_terms(df, ensemble.levels, slots, codes, MULTINOMIAL)
    start = constant([x for p in params for x in start_scores(p)])
    df = df.withColumn("_joint", sum_arrays(start, [F.col(x) for x in names], n * t * c)).drop(*names)
    # Per month, per round, per class.
    df = df.withColumn("_joint", F.transform(chunks(F.col("_joint"), n, t * c), lambda m: chunks(m, t, c)))
    weights = constant(ensemble.weights)
    alphas = constant([p.alpha or [1.0] for p in params])

    if vote == "joint":
        winners = F.transform("_joint", lambda rounds: argmax(total(rounds, c)))
    elif vote == "boost":
        winners = F.transform(
            "_joint", lambda rounds, i: argmax(votes(F.transform(rounds, argmax), F.get(alphas, i), c))
        )
    else:
        raise ValueError(f"unknown vote {vote}")
    df = df.withColumn("raw", votes(winners, weights, c))

    def scaled(values: Column, factor: Column) -> Column:
        return F.transform(values, lambda x: x * factor)

    if prob == "blend":
        steps = constant([_soft(p.alpha) for p in params])
        shares = constant(_soft(ensemble.weights))

        def month_prob(rounds: Column, i: Column) -> Column:
            parts = F.zip_with(rounds, F.get(steps, i), lambda s, w: scaled(softmax(s), w))
            return scaled(let(total(parts, c), softmax), F.get(shares, i))

        df = df.withColumn("prob", total(F.transform("_joint", month_prob), c))
    elif prob == "mean":
        parts = F.zip_with("_joint", weights, lambda rounds, w: scaled(softmax(F.get(rounds, F.lit(0))), w))
        df = df.withColumn("prob", total(parts, c))
    df = df.withColumn("probability", softmax(F.col("raw")))
    df = df.withColumn("_winner", argmax(F.col("raw")))
    df = df.withColumn("prediction", class_label(model.labels, F.col("_winner")))
    if prob:
        df = df.withColumn("confidence", confidence(F.col("prob"), F.col("_winner")))
    return df.drop("_joint", "_winner")
