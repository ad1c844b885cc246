"""The jobs end to end, and what their plans look like."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from payscore import fixtures as fx
from payscore.operators import bayes, boost, ensemble
from payscore.plans import jobs
from payscore.shared import store
from payscore.sources import overwrite_partition

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def prepared(spark):
    df = jobs.customer_features(fx.wide_transactions(spark, SF), fx.RANGES, fx.AS_OF_YEAR, fx.CENTERS)
    customers = store(df).df
    return customers, jobs.catalog(customers, fx.FEATURES, fx.RANGES)


def test_load(spark, tmp_path):
    overwrite_partition(fx.wide_transactions(spark, SF), str(tmp_path / "t"))
    month = jobs.load(spark, str(tmp_path / "t"), 1998, 3)
    assert 0 < month.count() < jobs.load(spark, str(tmp_path / "t"), 1998).count()
    assert len(month.columns) == 41


def test_trained_clusters(spark):
    df = fx.wide_transactions(spark, SF)
    out = jobs.customer_features(df, fx.RANGES, fx.AS_OF_YEAR, 3)
    assert out.count() == 1500 and out.select("acc_cust_km").distinct().count() == 3


def test_month_then_score_then_display(spark, prepared):
    customers, codes = prepared
    done = jobs.train_month(customers, codes, fx.FEATURES, 2)
    total, predicted = done.results.count(), done.results.where("train_label is not null").count()
    assert 0 < predicted < total / 3 and done.dictionary.count() == done.model.levels.rows
    metrics = done.metrics.first()
    assert metrics["n_rows"] == predicted and metrics["accuracy"] > 0.6
    scored = jobs.score_month(customers, codes, fx.FEATURES, done.model)
    assert scored.results.where("train_label is not null").count() == 1500 == scored.metrics.first()["n_rows"]
    shown = jobs.display(done.results, codes, 2001, 8)
    assert len(shown.columns) == 25 and shown.where("features_desc like ' ;age: %'").count() == total


def test_year(spark, prepared):
    customers, codes = prepared
    months = jobs.month_models(customers, codes, fx.FEATURES, n_rounds=2)
    order = [str(m) for m in range(1, 13)]
    done = jobs.train_year(customers, codes, fx.FEATURES, months, order, fx.CURRENT_MONTH)
    got = done.results.where("train_label is not null")
    assert got.count() == done.metrics.first()["n_rows"]
    assert got.where("train_accuracy rlike '^[0-9]{2}[.][0-9]{2}%$'").count() == got.count()
    scored = jobs.score_year(customers, codes, fx.FEATURES, done.model)
    assert scored.results.where("train_label is null").count() == 0
    test_rows = dict(rows(got, "mios_trans_code", "train_accuracy"))
    all_rows = dict(rows(scored.results, "mios_trans_code", "train_accuracy"))
    assert test_rows and all(all_rows[k] == v for k, v in test_rows.items())


def test_month_models_equal_the_month_job(spark, prepared):
    customers, codes = prepared
    months = jobs.month_models(customers, codes, fx.FEATURES, n_rounds=2)
    part = customers.where("acc_cust_month = '5'")
    alone = jobs.train_month(part, codes, fx.FEATURES, 2).model
    assert months.params["5"].alpha == pytest.approx(alone.params[""].alpha, abs=1e-9)


def executed(df):
    df.collect()
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def test_derivation_reads_only_its_columns(spark):
    plan = executed(fx.transactions(spark, SF).select("mios_trans_code", "plnmio_date"))
    assert "o_totalprice" not in plan and "o_orderpriority" not in plan


def test_scoring_needs_no_shuffle_and_no_python(spark, prepared):
    customers, codes = prepared
    df = customers.withColumn("codes", F.array("bank_code", "mio_class")).withColumn("label", F.col("trans_stat").cast("double"))
    model = boost.fit_boost(df, ["bank", "class"], 2)
    plan = executed(boost.boost_score(df, model).select("mios_trans_code", "prediction"))
    assert "Exchange hashpartitioning" not in plan and "Python" not in plan and "NestedLoop" not in plan
    assert "acc_cust_sex" not in plan.split("ReadSchema")[-1]


def test_filter_on_a_prediction_stays_small(spark, prepared):
    """The filter is pushed below the scoring; its expression must not multiply there."""
    customers, _ = prepared
    df = customers.withColumn("codes", F.array("bank_code", "mio_class")).withColumn("label", F.col("trans_stat").cast("double"))
    model = boost.fit_boost(df, ["bank", "class"], 2, by="acc_cust_month")
    blend = ensemble.build_ensemble(model, sorted(model.params))
    out = ensemble._score(df, blend, "codes", None, "joint", "blend").where("prediction = 1 and confidence > 0.5")
    assert len(executed(out)) < 400_000


def test_nothing_but_plain_joins(spark, prepared):
    customers, codes = prepared
    done = bayes.fit_nb(customers.withColumn("codes", F.array("bank_code")).withColumn("label", F.col("trans_stat").cast("double")), ["b"])
    plan = executed(bayes.theta_table(done))
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_jobs_store_only_what_training_needs(prepared, monkeypatch):
    customers, codes = prepared
    seen = []

    def watched(df, *more):
        seen.append(df.columns)
        return store(df, *more)

    monkeypatch.setattr(jobs, "store", watched)
    jobs.train_month(customers, codes, fx.FEATURES, 1)
    months = jobs.month_models(customers, codes, fx.FEATURES, n_rounds=1)
    order = sorted(months.params)
    year = jobs.train_year(customers, codes, fx.FEATURES, months, order, 8)
    needed = {"trans_code", "trans_bat_no", "codes", "label", "part", "acc_cust_month"}
    tables = [set(columns) for columns in seen if "trans_code" in columns]
    assert len(tables) == 3 and all(columns <= needed for columns in tables)
    # The results have all columns, and their predictions are those that the metrics judge.
    assert set(customers.columns) <= set(year.results.columns)
    assert year.results.where("train_label IS NOT NULL").count() == year.metrics.first()["n_rows"]
