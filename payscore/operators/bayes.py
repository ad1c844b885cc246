"""Class-balanced Naive Bayes over coded features, for one or many models at a time.

A model is keyed by (slot, code), never by position in a vector, so it can score rows that were
encoded elsewhere. Many models (one per month, say) are fitted in the same pass: ``by`` names the
column that tells them apart.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from payscore.functions import argmax, constant, softmax, sum_arrays
from payscore.operators.encode import slot_entries
from payscore.shared import Stored, local_table, lookup, lookup_each, split_by, store, with_total

MULTINOMIAL = "multinomial"
BERNOULLI = "bernoulli"
#: Classes and models are looped over in expressions, so their numbers must be moderate.
MAX_CLASSES = 1000
MAX_MODELS = 1000


@dataclass
class Params:
    """The part of one model that does not grow with the data: per round, per class."""

    log_prior: list[list[float]] = field(default_factory=list)
    absent: list[list[float]] = field(default_factory=list)
    alpha: list[float] = field(default_factory=list)
    error: list[float] = field(default_factory=list)


@dataclass
class Model:
    """Fitted models. ``levels`` has model_id, slot, code and log theta per round and class."""

    labels: list[float]
    slots: list[str]
    params: dict[str, Params]
    levels: Stored
    kind: str = MULTINOMIAL
    smoothing: float = 1.0
    #: Number of codes per model.
    sizes: dict[str, int] = field(default_factory=dict)
    #: Models that were asked for and could not be fitted, as their rows have one class only.
    refused: tuple[str, ...] = ()

    @property
    def classes(self) -> int:
        return len(self.labels)

    @property
    def rounds(self) -> int:
        return len(next(iter(self.params.values())).log_prior)

    @property
    def width(self) -> int:
        return self.classes * self.rounds


def check_arguments(kind: str, smoothing: float) -> None:
    if kind not in (MULTINOMIAL, BERNOULLI):
        raise ValueError(f"unknown model kind {kind}")
    if not smoothing >= 0:
        raise ValueError("smoothing must not be negative")


def check_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per numeric feature: can it be used by each kind of model?"""
    parts = []
    for c in columns:
        x = F.col(c)
        parts += [
            F.coalesce(F.sum(F.when(x < 0, 1).otherwise(0)), F.lit(0)).alias(f"{c}_neg"),
            F.coalesce(F.sum(F.when((x == 0) | (x == 1), 0).otherwise(1)), F.lit(0)).alias(f"{c}_non"),
        ]
    totals = df.agg(F.count(F.lit(1)).alias("n"), *parts)
    rows = [
        F.struct(F.lit(c).alias("feature"), F.col("n").alias("n_rows"), F.col(f"{c}_neg").alias("n_negative"),
                 F.col(f"{c}_non").alias("n_not_binary"))
        for c in columns
    ]
    out = totals.select(F.inline(F.array(*rows)))
    return out.withColumns(
        {"multinomial_ok": F.col("n_negative") == 0, "bernoulli_ok": F.col("n_not_binary") == 0}
    )


def label_counts(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("cnt"))


def balance(counts: Mapping[float, float]) -> dict[float, float]:
    """Weight per class: the share of the others for two classes, else normalised odds against."""
    if len(counts) < 2:
        raise ValueError("class weights need at least two classes")
    total = sum(counts.values())
    if len(counts) == 2:
        return {c: 1 - n / total for c, n in counts.items()}
    odds = {c: (1 - n / total) / (n / total) for c, n in counts.items()}
    return {c: o / sum(odds.values()) for c, o in odds.items()}


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """The weights of :func:`balance` as a table: label, cnt, weight."""
    counts = store(label_counts(df, label)).df
    # Totals are rows of their own, joined back: no task holds all labels.
    total = counts.agg(F.sum("cnt").alias("_n"), F.count(F.lit(1)).alias("_classes"))
    share = F.col("cnt") / F.col("_n")
    shared = with_total(counts, total).withColumn("_odds", (1 - share) / share)
    shared = with_total(shared, shared.agg(F.sum("_odds").alias("_all_odds")))
    weight = F.when(F.col("_classes") == 2, 1 - share).otherwise(F.col("_odds") / F.col("_all_odds"))
    return shared.select(label, "cnt", weight.alias("weight"))


def nb_stats(
    df: DataFrame, slots: Sequence[str], label: str = "label", codes: str = "codes", weight: str | None = None
) -> DataFrame:
    """Summed weight per label, slot and code; slot ``""`` holds the sum per label."""
    w = F.col(weight) if weight else F.lit(1.0)
    pairs = df.select(F.col(label).alias("label"), w.alias("_w"), F.inline(slot_entries(slots, codes, head=True)))
    return pairs.where(F.col("code").isNotNull()).groupBy("label", "slot", "code").agg(F.sum("_w").alias("sum_w"))


def make_profiles(
    df: DataFrame,
    label: str = "label",
    codes: str = "codes",
    weight: str | None = None,
    by: str | None = None,
) -> Stored:
    """Rows with equal label and codes as one row with their count and summed weight.

    Such rows get equal predictions and equal weight changes in every round, so a model can be
    fitted on them alone. Copies are merged before the shuffle, whatever their number.
    """
    model_id = F.col(by).cast("string") if by else F.lit("")
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    keyed = df.select(model_id.alias("model_id"), F.col(label).cast("double").alias("label"),
                      F.col(codes).alias("codes"), w.alias("_w"))
    return store(
        keyed.groupBy("model_id", "label", "codes").agg(
            F.count(F.lit(1)).alias("cnt"), F.sum("_w").alias("w")
        )
    )


def group_sums(profiles: DataFrame, slots: Sequence[str], weight: Column, keys: Sequence[str] = ()) -> Stored:
    """Weight per (model, slot, code, label, keys): what one pass over the data gives."""
    pairs = profiles.select("model_id", "label", "cnt", *keys, weight.alias("_w"), F.inline(slot_entries(slots, head=True)))
    pairs = pairs.where(F.col("code").isNotNull())
    return store(
        pairs.groupBy("model_id", "slot", "code", "label", *keys).agg(
            F.sum("_w").alias("w"), F.sum("cnt").alias("cnt")
        )
    )


@dataclass
class Totals:
    """Per class of one model: rows, their weight, and the weight summed over all codes."""

    rows: list[float]
    weight: list[float]
    terms: list[float]


def per_class(labels: Sequence[float], value: Column) -> Column:
    """Sum of ``value`` per label, as an array in label order; an aggregate."""
    return F.array(*[F.sum(F.when(F.col("label") == c, value).otherwise(0.0)) for c in labels])


def collect_totals(sums: DataFrame, *keys: str) -> list[Row]:
    """One short row per model, label and key: what of a pass the driver needs."""
    own = F.col("slot") == ""
    # With a key, right or wrong, there are two rows for each model and class.
    most = MAX_MODELS * MAX_CLASSES * 2 ** len(keys)
    rows = (
        sums.groupBy("model_id", "label", *keys)
        .agg(
            F.sum(F.when(own, F.col("cnt"))).cast("double").alias("rows"),
            F.sum(F.when(own, F.col("w"))).alias("weight"),
            F.sum(F.when(own, 0.0).otherwise(F.col("w"))).alias("terms"),
        )
        .limit(most + 1)
        .collect()
    )
    if len(rows) > most:
        raise ValueError("too many models times classes")
    return rows


def first_totals(sums: DataFrame) -> tuple[list[float], dict[str, Totals]]:
    """The labels in order, and the totals of every model."""
    rows = collect_totals(sums)
    labels = sorted({r["label"] for r in rows})
    if len(labels) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    models = sorted({r["model_id"] for r in rows})
    if len(models) > MAX_MODELS:
        raise ValueError(f"more than {MAX_MODELS} models at a time")
    out = {m: Totals(*([0.0] * len(labels) for _ in range(3))) for m in models}
    for r in rows:
        i = labels.index(r["label"])
        t = out[r["model_id"]]
        t.rows[i], t.weight[i], t.terms[i] = r["rows"], r["weight"], r["terms"]
    return labels, out


def level_weights(
    sums: DataFrame, labels: Sequence[float], value: Column, dictionary: DataFrame | None
) -> DataFrame:
    """Per (model, slot, code) of the data or the dictionary, summed weight per class, zeros for codes without rows."""
    found = sums.where(F.col("slot") != "").groupBy("model_id", "slot", "code").agg(per_class(labels, value).alias("s"))
    if dictionary is None:
        return found
    zeros = F.array(*[F.lit(0.0) for _ in labels])
    ids = "model_id" if "model_id" in dictionary.columns else F.lit("").alias("model_id")
    known = dictionary.select(ids, "slot", "code")
    return known.distinct().join(found, ["model_id", "slot", "code"], "full").withColumn("s", F.coalesce("s", zeros))


def ln(x: Column) -> Column:
    """Natural log with ln 0 = -infinity, where Spark's gives null."""
    return F.when(x > 0, F.log(x)).otherwise(F.lit(-math.inf))


def log_prior(
    labels: Sequence[float], smoothing: float, totals: Totals, balanced: bool, weights: Mapping[float, float] | None
) -> list[float]:
    """``ln(n_c + λ) − ln(Σn + Cλ)``, plus the log of the class weight from unweighted counts."""
    if weights and set(labels) - set(weights):
        raise ValueError("a class has no weight")

    def log(x: float) -> float:
        return math.log(x) if x > 0 else -math.inf

    present = {c: k for c, k in zip(labels, totals.rows) if k > 0}
    extra = weights or (balance(present) if balanced else {})
    rest = math.log(sum(totals.weight) + len(labels) * smoothing)
    return [log(x + smoothing) - rest + log(extra.get(c, 1.0)) for c, x in zip(labels, totals.weight)]


def log_theta(model: Model, levels: DataFrame, totals: Mapping[str, Totals]) -> DataFrame:
    """Add ``t``: per class ``ln(s + λ)`` minus the log of the class's denominator."""
    rest = []
    for m, t in totals.items():
        if model.kind == BERNOULLI:
            rest.append((m, [x + 2.0 * model.smoothing for x in t.weight]))
        else:
            rest.append((m, [x + model.sizes.get(m, 0) * model.smoothing for x in t.terms]))
    rest = [(m, [math.log(x) if x > 0 else math.inf for x in xs]) for m, xs in rest]
    if len(rest) == 1:
        levels = levels.withColumn("_rest", constant(rest[0][1]))
    else:
        table = local_table(levels.sparkSession, rest, "_m string, _rest array<double>")
        levels = lookup(levels, table, {"model_id": "_m"})
    t = [ln(F.get("s", F.lit(c)) + model.smoothing) - F.get("_rest", F.lit(c)) for c in range(model.classes)]
    return levels.withColumn("t", F.array(*t)).drop("_rest")


def absent_sums(levels: DataFrame, classes: int) -> dict[str, list[float]]:
    """Per model and class, the score of a row without any code: Σ ln(1 − e^θ)."""
    parts = [F.sum(ln(1 - F.exp(F.get("t", F.lit(c))))) for c in range(classes)]
    rows = levels.groupBy("model_id").agg(F.array(*parts).alias("a")).collect()
    return {r["model_id"]: list(r["a"]) for r in rows}


def fit_nb(
    df: DataFrame,
    slots: Sequence[str],
    label: str = "label",
    codes: str = "codes",
    weight: str | None = None,
    kind: str = MULTINOMIAL,
    smoothing: float = 1.0,
    balanced: bool = True,
    weights: Mapping[float, float] | None = None,
    dictionary: DataFrame | None = None,
    by: str | None = None,
) -> Model:
    """Fit Naive Bayes on coded rows.

    ``balanced`` adds the log class weight to the prior; ``weights`` gives those weights instead.
    ``dictionary`` (slot, code and model_id with ``by``) adds codes that ``df`` does not hold.
    """
    check_arguments(kind, smoothing)
    profiles = make_profiles(df, label, codes, weight, by)
    sums = group_sums(profiles.df, slots, F.col("w"))
    return first_round(sums, slots, kind, smoothing, balanced, weights, dictionary)[0]


def first_round(
    sums: Stored,
    slots: Sequence[str],
    kind: str,
    smoothing: float,
    balanced: bool,
    weights: Mapping[float, float] | None,
    dictionary: DataFrame | None,
) -> tuple[Model, dict[str, Totals]]:
    labels, totals = first_totals(sums.df)
    levels = level_weights(sums.df, labels, F.col("w"), dictionary)
    sizes = {r["model_id"]: r["count"] for r in levels.groupBy("model_id").count().collect()}
    model = Model(labels, list(slots), {m: Params() for m in totals}, sums, kind, smoothing, sizes)
    add_round(model, levels, totals, balanced, weights, None)
    return model, totals


def add_round(
    model: Model,
    levels: DataFrame,
    totals: Mapping[str, Totals],
    balanced: bool,
    weights: Mapping[float, float] | None,
    earlier: Stored | None,
) -> None:
    """Append one round, fitted from the summed weights, to ``model``."""
    fitted = log_theta(model, levels, totals)
    theta, width = F.col("t"), model.classes
    if earlier is not None:
        before = earlier.df.select("model_id", "slot", "code", F.col("theta").alias("_before"))
        fitted = fitted.join(before, ["model_id", "slot", "code"], "left")
        theta, width = F.concat("_before", "t"), model.width + model.classes
    row_bytes = 128 + 8 * width
    stored = store(fitted.select("model_id", "slot", "code", theta.alias("theta"), "t"), row_bytes)
    absent = absent_sums(stored.df, model.classes) if model.kind == BERNOULLI else {}
    model.levels = Stored(stored.df.drop("t"), stored.rows, row_bytes)
    for m, t in totals.items():
        model.params[m].log_prior.append(log_prior(model.labels, model.smoothing, t, balanced, weights))
        model.params[m].absent.append(absent.get(m, [0.0] * model.classes))


def score_theta(theta: Column, kind: str) -> Column:
    """What a present code adds to the score."""
    if kind == MULTINOMIAL:
        return theta
    return F.transform(theta, lambda t: t - ln(1 - F.exp(t)))


def start_scores(params: Params) -> list[float]:
    """Scores before any code, all rounds in one list."""
    return [p + a for ps, xs in zip(params.log_prior, params.absent) for p, a in zip(ps, xs)]


def add_slot_terms(
    df: DataFrame, levels: Stored, slots: Sequence[str], codes: str, kind: str, by: Column | None = None
) -> tuple[DataFrame, list[str]]:
    """Look up every slot's code and add its array of score terms, null for an unknown code."""
    terms, dims = [f"_term_{i}" for i in range(len(slots))], []
    for i, part in enumerate(split_by(levels, "slot", slots)):
        chosen = [F.col("code").alias(f"_c_{i}"), score_theta(F.col("theta"), kind).alias(terms[i])]
        on = [(F.get(F.col(codes), F.lit(i)), f"_c_{i}")]
        if by is not None:
            chosen.append(F.col("model_id").alias(f"_m_{i}"))
            on.append((by, f"_m_{i}"))
        dims.append((part.select(*chosen), on))
    return lookup_each(df, dims), terms


def log_joint(
    df: DataFrame,
    model: Model,
    codes: str = "codes",
    slots: Sequence[str] | None = None,
    by: str | None = None,
    out: str = "log_joint",
) -> DataFrame:
    """Add the log joint scores, round after round, class after class in each.

    A model table of checked size is broadcast, and rows are scored where they are. With ``by``
    every row is scored by the model named in that column.
    """
    slots = list(slots or model.slots)
    model_id = None if by is None else F.col(by).cast("string")
    if by is None:
        if len(model.params) != 1:
            raise ValueError("several models: name the column that selects one, or blend them")
        (params,) = model.params.values()
        start = constant(start_scores(params))
    else:
        rows = [(m, start_scores(p)) for m, p in model.params.items()]
        starts = local_table(df.sparkSession, rows, "_m string, _start array<double>", 128 + 8 * model.width)
        df = lookup_each(df, [(starts, [(model_id, "_m")])])
        start = F.col("_start")
    df, terms = add_slot_terms(df, model.levels, slots, codes, model.kind, model_id)
    df = df.withColumn(out, sum_arrays(start, [F.col(t) for t in terms], model.width))
    return df.drop(*terms, "_start")


def class_label(labels: Sequence[float], index: Column) -> Column:
    return F.get(F.array(*[F.lit(float(c)) for c in labels]), index)


def nb_score(
    df: DataFrame,
    model: Model,
    codes: str = "codes",
    thresholds: Sequence[float] | None = None,
    by: str | None = None,
) -> DataFrame:
    """Add ``raw`` (log joint), ``probability`` and ``prediction`` (a label).

    With ``thresholds`` the class with the largest probability / threshold wins.
    """
    df = log_joint(df, model, codes, by=by, out="raw").withColumn("probability", softmax(F.col("raw")))
    choice = F.col("raw")
    if thresholds is not None:
        if len(thresholds) != model.classes:
            raise ValueError(f"{len(thresholds)} thresholds for {model.classes} classes")
        if min(thresholds) < 0 or list(thresholds).count(0) > 1:
            raise ValueError("thresholds must be positive, except that one may be 0")
        choice = F.array(
            *[
                F.get("probability", F.lit(i)) / t if t > 0
                else F.when(F.get("probability", F.lit(i)) > 0, F.lit(math.inf)).otherwise(F.lit(0.0))
                for i, t in enumerate(thresholds)
            ]
        )
    return df.withColumn("prediction", class_label(model.labels, argmax(choice)))


def prior_table(spark: SparkSession, model: Model) -> DataFrame:
    """Flat: model_id, round, class_ix, label, log_prior, absent."""
    rows = [
        (m, r, i, float(c), p.log_prior[r][i], p.absent[r][i])
        for m, p in model.params.items()
        for r in range(len(p.log_prior))
        for i, c in enumerate(model.labels)
    ]
    return spark.createDataFrame(
        rows, "model_id string, round int, class_ix int, label double, log_prior double, absent double"
    )


def theta_table(model: Model) -> DataFrame:
    """Flat: model_id, round, slot, code, class_ix, label, log_theta."""
    flat = model.levels.df.select("model_id", "slot", "code", F.posexplode("theta").alias("_p", "log_theta"))
    ix = F.col("_p") % model.classes
    return flat.select(
        "model_id", F.expr(f"cast(_p div {model.classes} as int)").alias("round"), "slot", "code",
        ix.alias("class_ix"), class_label(model.labels, ix).alias("label"), "log_theta",
    )


def round_table(spark: SparkSession, model: Model) -> DataFrame:
    """Flat: model_id, round, alpha, error, and what else is needed to load the model."""
    rows = [
        (m, r, p.alpha[r] if p.alpha else None, p.error[r] if p.error else None,
         model.kind, model.smoothing, list(model.slots))
        for m, p in model.params.items()
        for r in range(len(p.log_prior))
    ]
    return spark.createDataFrame(
        rows,
        "model_id string, round int, alpha double, error double, kind string, smoothing double, slots array<string>",
    )


@dataclass
class ValueModel:
    """A model of numeric feature columns; ``log_theta`` is per class, per column."""

    labels: list[float]
    columns: list[str]
    log_prior: list[float]
    log_theta: list[list[float]]
    kind: str


def fit_nb_values(
    df: DataFrame,
    columns: Sequence[str],
    label: str = "label",
    weight: str | None = None,
    kind: str = MULTINOMIAL,
    smoothing: float = 1.0,
    balanced: bool = True,
    weights: Mapping[float, float] | None = None,
) -> ValueModel:
    """As :func:`fit_nb` for numeric columns: amounts, at least 0, or 0/1 for Bernoulli.

    One aggregate gives the sums and also checks every value; a bad one fails the fit.
    """
    check_arguments(kind, smoothing)
    w = F.col(weight) if weight else F.lit(1.0)
    fine = [
        F.coalesce(F.col(c) >= 0 if kind == MULTINOMIAL else F.col(c).isin(0, 1), F.lit(False)) for c in columns
    ]
    rows = (
        df.groupBy(F.col(label).cast("double").alias("label"))
        .agg(
            F.count(F.lit(1)).cast("double").alias("cnt"),
            F.sum(w).cast("double").alias("n"),
            F.array(*[F.sum(F.col(c).cast("double") * w) for c in columns]).alias("s"),
            F.array(*[F.bool_and(x) for x in fine]).alias("ok"),
        )
        .limit(MAX_CLASSES + 1)
        .collect()
    )
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    bad = [c for i, c in enumerate(columns) if not all(r["ok"][i] for r in rows)]
    if bad:
        raise ValueError(f"{kind} Naive Bayes cannot use the values of {', '.join(bad)}")
    rows.sort(key=lambda r: r["label"])
    totals = Totals([r["cnt"] for r in rows], [r["n"] for r in rows], [sum(r["s"]) for r in rows])
    labels = [r["label"] for r in rows]
    theta = []
    for r, terms in zip(rows, totals.terms):
        below = r["n"] + 2 * smoothing if kind == BERNOULLI else terms + len(columns) * smoothing
        theta.append([math.log(x + smoothing) - math.log(below) if x + smoothing > 0 else -math.inf for x in r["s"]])
    prior = log_prior(labels, smoothing, totals, balanced, weights)
    return ValueModel(labels, list(columns), prior, theta, kind)


def nb_score_values(df: DataFrame, model: ValueModel) -> DataFrame:
    """Add ``raw``, ``probability`` and ``prediction`` from numeric columns; a projection."""
    scores = []
    for prior, theta in zip(model.log_prior, model.log_theta):
        absent = [math.log(1 - math.exp(t)) if t < 0 else -math.inf for t in theta]
        start, steps = prior, theta
        if model.kind == BERNOULLI:
            start, steps = prior + sum(absent), [t - a for t, a in zip(theta, absent)]
        # A feature that is 0 adds nothing, also where its log probability is infinite.
        terms = [F.when(F.col(c) != 0, F.col(c) * F.lit(t)).otherwise(0.0) for c, t in zip(model.columns, steps)]
        scores.append(sum(terms, F.lit(start)))
    df = df.withColumn("raw", F.array(*scores)).withColumn("probability", softmax(F.col("raw")))
    return df.withColumn("prediction", class_label(model.labels, argmax(F.col("raw"))))
