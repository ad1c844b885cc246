"""The jobs: load, derive, catalog, train, score, display."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml.clustering import BisectingKMeansModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payscore.functions import label_column, percent_text
from payscore.operators.bayes import MAX_MODELS, Model
from payscore.operators.bisect import ClusterTree, assign_tree, fit_tree
from payscore.operators.boost import boost_score, fit_boost
from payscore.operators.catalog import build_catalog, extend_catalog
from payscore.operators.cluster import assign_clusters, assign_nearest
from payscore.operators.dedup import dedup_month, dedup_year
from payscore.operators.derive import derive_customers
from payscore.operators.encode import build_dictionary, encode_with_dictionary, index_slots, portrait, slot_entries
from payscore.operators.ensemble import Ensemble, attach_scores, build_ensemble, month_weights, score_codes
from payscore.operators.evaluate import evaluate, split_by_key
from payscore.operators.frequency import attach_frequency
from payscore.operators.models import load_ensemble, load_model, save_ensemble, save_model
from payscore.operators.report import decode_features, display_columns
from payscore.shared import UNMEASURED, Stored, store
from payscore.sources.config import Feature, Range
from payscore.sources.sinks import overwrite_partition, write_table
from payscore.sources.staging import TRANSACTION_COLUMNS, attach_months, read_month, read_year, stage_month, stage_year

KEY = ("trans_code", "trans_bat_no")


def model_features(features: Sequence[Feature], model: str | None = None) -> list[Feature]:
    """Active features, all or those of the ``month`` or ``year`` model, in code order."""
    other = {"month": 2, "year": 1, None: None}[model]
    return sorted((f for f in features if f.feature_flag == 1 and f.model_flag != other), key=lambda f: f.pcode)


def load(spark: SparkSession, root: str, year: int, month: int | None = None) -> DataFrame:
    """Stage the transactions of one month, or of a whole year."""
    if month is None:
        return stage_year(read_year(spark, root, year), year, TRANSACTION_COLUMNS)
    return stage_month(read_month(spark, root, year, month), year, month, TRANSACTION_COLUMNS)


def load_source(
    spark: SparkSession,
    raw: str,
    root: str,
    year: int,
    month: int | None = None,
    columns: Sequence[str] = TRANSACTION_COLUMNS,
) -> DataFrame:
    """Publish the raw files of one month, or of all months of a year, unless they are there; then stage them."""
    attach_months(spark, raw, root, year, range(1, 13) if month is None else [month], columns)
    if month is None:
        return stage_year(read_year(spark, root, year), year, columns)
    return stage_month(read_month(spark, root, year, month), year, month, columns)


def customer_features(
    transactions: DataFrame,
    ranges: Sequence[Range],
    as_of_year: int,
    clusters: ClusterTree | BisectingKMeansModel | Sequence[Sequence[float]] | int,
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """Customer attributes, cluster and frequency of each transaction.

    ``clusters``: a number to train as many, a trained clustering, or fixed centers.
    """
    df = derive_customers(transactions, ranges, as_of_year)
    if isinstance(clusters, int):
        clusters = fit_tree(df, clusters)
    if isinstance(clusters, ClusterTree):
        df = assign_tree(df, clusters)
    elif isinstance(clusters, BisectingKMeansModel):
        df = assign_clusters(df, clusters)
    else:
        df = assign_nearest(df, clusters)
    return attach_frequency(df, keys) if keys else attach_frequency(df)


def catalog(
    customers: DataFrame, features: Sequence[Feature], ranges: Sequence[Range], saved: DataFrame | None = None
) -> Stored:
    """The feature catalog, or the saved one extended by new values."""
    use = model_features(features)
    if saved is None:
        return store(build_catalog(customers, use, ranges, features))
    return store(extend_catalog(saved, customers, use, ranges, features))


@dataclass
class Outcome:
    """What training or scoring gives; ``results`` are all rows, nulls where none was predicted."""

    results: DataFrame
    metrics: DataFrame
    model: Model | Ensemble
    dictionary: DataFrame | None = None


def _coded(customers: DataFrame, codes: Stored, features: Sequence[Feature], label_mode: int) -> DataFrame:
    df = portrait(customers, codes, features, slots="codes")
    # A group without a code is a row of nulls, which has no portrait.
    here = F.col("mios_trans_code").isNotNull()
    return df.withColumns(
        {
            "features": F.when(here, F.col("features")),
            "codes": F.when(here, F.col("codes")),
            "label": label_column(F.col("trans_stat"), label_mode),
        }
    )


def _thin(rows: DataFrame, *more: str) -> DataFrame:
    """What training, scoring and evaluation need of each row, stored; all other columns stay where they are."""
    return store(rows.select(*KEY, "codes", "label", "part", *more), UNMEASURED).df


def _judged(here):
    """Only rows with a whole key are predicted."""
    return here & F.col(KEY[0]).isNotNull() & F.col(KEY[1]).isNotNull()


def _results(scored: DataFrame, columns: Sequence[str], accuracy, here) -> DataFrame:
    """Results with predictions in place: keys are unique, so this equals joining them back."""
    return scored.select(
        *columns,
        F.when(_judged(here), F.col("prediction")).alias("train_label"),
        F.when(_judged(here), accuracy).alias("train_accuracy"),
    )


def train_month(
    customers: DataFrame,
    codes: Stored,
    features: Sequence[Feature],
    n_rounds: int = 5,
    label_mode: int = 0,
    smoothing: float = 1.0,
) -> Outcome:
    """Train a month model on 80 % of the deduplicated rows, predict and evaluate the others."""
    use = model_features(features, "month")
    slots = [f.pcode for f in use]
    rows = split_by_key(_coded(dedup_month(customers), codes, use, label_mode), *KEY)
    thin = _thin(rows)
    index = index_slots(thin, slots)
    train = thin.where((F.col("part") == "train") & F.col("label").isNotNull())
    model = fit_boost(train, slots, n_rounds, smoothing=smoothing, dictionary=index.df)
    here = F.col("part") == "test"
    results = _results(boost_score(rows, model), [*customers.columns, "features"], F.col("confidence"), here)
    metrics = evaluate(boost_score(thin, model).where(_judged(here)))
    return Outcome(results, metrics, model, build_dictionary(index))


def month_models(
    customers: DataFrame,
    codes: Stored,
    features: Sequence[Feature],
    month: str = "acc_cust_month",
    n_rounds: int = 5,
    label_mode: int = 0,
    smoothing: float = 1.0,
) -> Model:
    """As :func:`train_month` for every month, all models in the same passes over the data.

    Rows without a month train no month's model, and rows without a label none at all. A month with
    rows of one class only has no model; it is named in the model's ``refused``.
    """
    use = model_features(features, "month")
    slots = [f.pcode for f in use]
    keys = (month, "trans_stat", "bankacc_id_type", "bankacc_id_no")
    rows = _thin(split_by_key(_coded(dedup_month(customers, keys), codes, use, label_mode), *KEY), month)
    known = rows.select(F.col(month).alias("model_id"), F.inline(slot_entries(slots))).where(F.col("code").isNotNull())
    known = known.where(F.col("model_id").isNotNull())
    train = rows.where((F.col("part") == "train") & F.col(month).isNotNull() & F.col("label").isNotNull())
    classes = train.groupBy(F.col(month).cast("string").alias("m")).agg(F.count_distinct("label").alias("n"))
    refused = sorted(r["m"] for r in classes.where("n < 2").limit(MAX_MODELS).collect())
    if refused:
        train = train.where(~F.col(month).cast("string").isin(refused))
        known = known.where(~F.col("model_id").cast("string").isin(refused))
    model = fit_boost(train, slots, n_rounds, smoothing=smoothing, dictionary=store(known.distinct()).df, by=month)
    return replace(model, refused=tuple(refused))


def score_month(
    customers: DataFrame,
    codes: Stored,
    features: Sequence[Feature],
    model: Model,
    label_mode: int = 0,
    dictionary: DataFrame | None = None,
) -> Outcome:
    """Predict every row, without deduplication. Never writes the model.

    With a saved ``dictionary`` the results also have ``active``, the row's places in the one-hot vector.
    """
    use = model_features(features, "month")
    rows, more = _encoded(_coded(customers, codes, use, label_mode), dictionary, [f.pcode for f in use])
    scored = boost_score(rows, model, slots=[f.pcode for f in use])
    results = _results(scored, [*customers.columns, "features", *more], F.col("confidence"), F.lit(True))
    return Outcome(results, evaluate(scored.where(_judged(F.lit(True)))), model, dictionary)


def _encoded(rows: DataFrame, dictionary: DataFrame | None, slots: Sequence[str]) -> tuple[DataFrame, list[str]]:
    if dictionary is None:
        return rows, []
    done = encode_with_dictionary(rows, dictionary, slots)
    # The year's rows of nulls have no codes and so no vector.
    return done.withColumn("active", F.when(F.col("codes").isNotNull(), F.col("active"))), ["active"]


def train_year(
    customers: DataFrame,
    codes: Stored,
    features: Sequence[Feature],
    months: Model,
    order: Sequence[str],
    current_month: int,
    label_mode: int = 0,
) -> Outcome:
    """Blend month models into a year model; predict and evaluate the 20 % test rows."""
    ensemble = build_ensemble(months, order, month_weights(len(order), current_month))
    return _year(customers, codes, features, ensemble, label_mode, test_only=True)


def score_year(
    customers: DataFrame,
    codes: Stored,
    features: Sequence[Feature],
    ensemble: Ensemble,
    label_mode: int = 0,
    dictionary: DataFrame | None = None,
) -> Outcome:
    """Predict the deduplicated rows of a year; ``dictionary`` as for :func:`score_month`."""
    return _year(customers, codes, features, ensemble, label_mode, test_only=False, dictionary=dictionary)


def _year(
    customers: DataFrame,
    codes: Stored,
    features: Sequence[Feature],
    ensemble: Ensemble,
    label_mode: int,
    test_only: bool,
    dictionary: DataFrame | None = None,
) -> Outcome:
    use = model_features(features, "year")
    slots = [f.pcode for f in use]
    rows = split_by_key(_coded(dedup_year(customers), codes, use, label_mode), *KEY)
    thin = _thin(rows)
    here = F.col("part") == "test" if test_only else F.lit(True)
    encoded, more = _encoded(rows, dictionary, slots)
    if test_only:
        dictionary = build_dictionary(index_slots(thin, slots))
    scores = score_codes(thin, ensemble, slots=slots)
    accuracy = percent_text(F.col("confidence"))
    results = _results(attach_scores(encoded, scores), [*customers.columns, "features", *more], accuracy, here)
    metrics = evaluate(attach_scores(thin, scores).where(_judged(here)))
    return Outcome(results, metrics, ensemble, dictionary)


def display(results: DataFrame, codes: Stored, year: int, month: int) -> DataFrame:
    """The display table's rows for one partition: chosen columns and the features as text."""
    shown = decode_features(display_columns(results), codes)
    return shown.withColumns({"year_id": F.lit(year), "month_id": F.lit(month)})


def publish_display(results: DataFrame, codes: Stored, root: str, year: int, month: int) -> None:
    """Replace one partition of the display table at ``root``; the others stay."""
    overwrite_partition(display(results, codes, year, month), root)


@dataclass
class Saved:
    """What a training run leaves for later ones: catalog, dictionary, metrics and the model."""

    codes: Stored
    dictionary: DataFrame
    metrics: DataFrame
    model: Model | Ensemble


def save_outcome(spark: SparkSession, outcome: Outcome, codes: Stored, path: str) -> None:
    """Replace ``path`` by the tables of a month's or a year's training."""
    if outcome.dictionary is None:
        raise ValueError("only the outcome of a training can be saved")
    write_table(codes.df, f"{path}/catalog")
    write_table(outcome.dictionary, f"{path}/dictionary")
    write_table(outcome.metrics, f"{path}/metrics")
    if isinstance(outcome.model, Ensemble):
        save_ensemble(spark, outcome.model, f"{path}/ensemble")
    else:
        save_model(spark, outcome.model, f"{path}/model")


def load_saved(spark: SparkSession, path: str, year: bool = False) -> Saved:
    """What :func:`save_outcome` wrote for a month, or with ``year`` for a year."""
    codes, dictionary, metrics = (spark.read.parquet(f"{path}/{name}") for name in ("catalog", "dictionary", "metrics"))
    model = load_ensemble(spark, f"{path}/ensemble") if year else load_model(spark, f"{path}/model")
    return Saved(store(codes), dictionary, metrics, model)


def score_batch(
    customers: DataFrame,
    saved: Saved,
    features: Sequence[Feature],
    ranges: Sequence[Range],
    label_mode: int = 0,
) -> tuple[Outcome, Stored]:
    """Score rows that no training has seen with what an earlier run saved; the extended catalog as well.

    Values the catalog lacks get codes after its last ones, so results can be shown; its own codes never
    change. Codes that are new to the dictionary set no place of the vector, and those that are new to the model
    add nothing to the score, in whatever slot they stand.
    """
    codes = catalog(customers, features, ranges, saved.codes.df)
    score = score_year if isinstance(saved.model, Ensemble) else score_month
    return score(customers, codes, features, saved.model, label_mode, saved.dictionary), codes
