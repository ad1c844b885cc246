"""What outlives a run: published months, saved trainings, display partitions."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from payscore import fixtures as fx
from payscore.operators import bayes, boost
from payscore.operators.encode import load_dictionary
from payscore.plans import jobs
from payscore.shared import store
from payscore.sources import attach_months, overwrite_partition, read_month, read_year

SF = "/root/testdata/sf0.001"
COLUMNS = ["code", "stat"]


def raw_month(spark, folder, year, month, stat, n=4):
    df = spark.range(n).select(F.concat(F.lit(f"{year}-{month}-"), "id").alias("CODE"), F.lit(stat).alias("STAT"))
    df.write.mode("overwrite").parquet(f"{folder}/{year}/{month}")


def test_a_month_is_published_once(spark, tmp_path):
    raw, root = str(tmp_path / "raw/{year}/{month}"), str(tmp_path / "t")
    folder = str(tmp_path / "raw")
    raw_month(spark, folder, 2017, 8, "0")
    assert attach_months(spark, raw, root, 2017, [8], COLUMNS) == [8]
    raw_month(spark, folder, 2017, 8, "9")
    raw_month(spark, folder, 2017, 10, "1")
    raw_month(spark, folder, 2016, 8, "5")
    assert attach_months(spark, raw, root, 2017, range(1, 13), COLUMNS) == [10]
    assert attach_months(spark, raw, root, 2017, range(1, 13), COLUMNS) == []
    assert attach_months(spark, raw, root, 2016, [7], COLUMNS) == []
    assert attach_months(spark, raw, root, 2016, [8], COLUMNS) == [8]
    assert rows(read_month(spark, root, 2017, 8).select("stat").distinct()) == [("0",)]
    assert read_year(spark, root, 2017).count() == 8 and read_year(spark, root, 2016).count() == 4


def test_an_interrupted_month_does_not_count_as_there(spark, tmp_path):
    """A folder without files, as a lost job may leave it."""
    raw, root = str(tmp_path / "raw/{year}/{month}"), tmp_path / "t"
    raw_month(spark, str(tmp_path / "raw"), 2017, 3, "0")
    (root / "year_id=2017" / "month_id=3").mkdir(parents=True)
    assert attach_months(spark, raw, str(root), 2017, [3], COLUMNS) == [3]
    assert read_month(spark, str(root), 2017, 3).count() == 4


def test_both_spellings_of_a_month(spark, tmp_path):
    root = str(tmp_path / "t")
    for name in ("8", "08", "09"):
        spark.range(2).write.parquet(f"{root}/year_id=2017/month_id={name}")
    assert read_month(spark, root, 2017, 8).count() == 4 and read_month(spark, root, 2017, 9).count() == 2
    assert attach_months(spark, str(tmp_path / "raw/{year}/{month}"), root, 2017, [8, 9], COLUMNS) == []


@pytest.fixture(scope="module")
def batches(spark):
    tx = fx.wide_transactions(spark, SF)
    first, later = tx.where("year_id <= 1995"), fx.later_batch(tx.where("year_id > 1995"))
    made = (store(jobs.customer_features(t, fx.RANGES, fx.AS_OF_YEAR, fx.CENTERS)).df for t in (first, later))
    return tuple(made)


def test_scoring_a_later_batch(spark, batches, tmp_path):
    first, later = batches
    codes = jobs.catalog(first, fx.FEATURES, fx.RANGES)
    trained = jobs.train_month(first, codes, fx.FEATURES, 2)
    jobs.save_outcome(spark, trained, codes, str(tmp_path / "m"))
    saved = jobs.load_saved(spark, str(tmp_path / "m"))
    assert rows(saved.codes.df) == rows(codes.df) and rows(saved.dictionary) == rows(trained.dictionary)
    assert rows(saved.metrics) == rows(trained.metrics)
    scored, wider = jobs.score_batch(later, saved, fx.FEATURES, fx.RANGES)
    # The catalog grew, and its first codes are the same.
    new = set(rows(wider.df, "feature_pcode", "feature_value")) - set(rows(codes.df, "feature_pcode", "feature_value"))
    assert ("22000", "NEW BANK") in new and set(rows(codes.df)) < set(rows(wider.df))
    results = scored.results
    assert results.count() == later.count() == results.where("train_label is not null").count()
    # A new value sets no place; all places are those of the saved dictionary.
    use = jobs.model_features(fx.FEATURES, "month")
    places = {r["pos"] for r in load_dictionary(saved.dictionary, [f.pcode for f in use]).df.collect()}
    got = {r["bank_code"]: r["active"] for r in results.where("bank_code is not null").collect()}
    assert all(set(a) <= places for a in got.values()) and len(got["NEW BANK"]) < len(use)
    # The same rows by the model in memory, with the catalog as it was.
    plain = jobs.score_month(later, codes, fx.FEATURES, trained.model).results
    assert rows(results, "mios_trans_code", "train_label", "train_accuracy") == rows(
        plain, "mios_trans_code", "train_label", "train_accuracy"
    )


def test_only_a_training_can_be_saved(spark, batches, tmp_path):
    df = batches[0].withColumn("codes", F.array("bank_code")).withColumn("label", F.col("trans_stat").cast("double"))
    outcome = jobs.Outcome(df, df, boost.fit_boost(df, ["b"], 1))
    with pytest.raises(ValueError):
        jobs.save_outcome(spark, outcome, store(df), str(tmp_path / "x"))


def test_display_partitions(spark, tmp_path):
    root = str(tmp_path / "d")
    for month, n in ((7, 3), (8, 5), (8, 2)):
        overwrite_partition(spark.range(n).withColumns({"year_id": F.lit(2001), "month_id": F.lit(month)}), root)
    assert rows(spark.read.parquet(root).groupBy("month_id").count()) == [(7, 3), (8, 2)]


def test_unseen_codes_add_nothing(spark):
    """A row whose every code is new gets the classes' shares alone."""
    df = spark.createDataFrame([(["a", "x"], 1.0)] * 3 + [(["b", "x"], 0.0)] * 2, "codes array<string>, label double")
    model = bayes.fit_nb(df, ["s", "t"])
    new = spark.createDataFrame([(["q", "r"],), ([None, "a"],), (None,)], "codes array<string>")
    raw = {tuple(r["raw"]) for r in bayes.nb_score(new, model).collect()}
    (params,) = model.params.values()
    assert raw == {tuple(params.log_prior[0])}
