"""Inputs off the friendly path: unseen values, unequal key types, gaps in months, too many codes."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from payscore import fixtures as fx
from payscore import shared
from payscore.functions import date_parts
from payscore.operators import catalog, cluster, encode
from payscore.operators.report import decode_features
from payscore.plans import jobs
from payscore.shared import lookup, store
from payscore.sources import Feature

FEATURES = [Feature(1, "a", "100", "first", 1, 0), Feature(2, "b", "200", "second", 1, 0), Feature(3, "c", "300", "third", 1, 0)]


@pytest.fixture(scope="module")
def coded(spark):
    df = spark.createDataFrame([(1, "x", "p", "u"), (2, "y", "q", "v")], "id int, a string, b string, c string")
    codes = store(catalog.build_catalog(df, FEATURES, []))
    new = df.unionByName(spark.createDataFrame([(3, "x", "unseen", "v"), (4, "unseen", "unseen", "unseen")], df.schema))
    return codes, encode.portrait(new, codes, FEATURES, slots="codes")


def test_an_unseen_value_leaves_the_other_slots_alone(coded):
    got = {r["id"]: r["codes"] for r in coded[1].collect()}
    assert got == {1: ["101", "201", "301"], 2: ["102", "202", "302"], 3: ["101", None, "302"], 4: [None, None, None]}


def test_unseen_values_keep_the_rest_of_the_evidence(spark):
    """Scoring with one new value equals the sum of the other slots' log probabilities."""
    sf = "/root/testdata/sf0.001"
    customers = store(jobs.customer_features(fx.wide_transactions(spark, sf), fx.RANGES, fx.AS_OF_YEAR, fx.CENTERS)).df
    codes = jobs.catalog(customers, fx.FEATURES, fx.RANGES)
    model = jobs.train_month(customers, codes, fx.FEATURES, 2).model
    usual = jobs.score_month(customers, codes, fx.FEATURES, model).results
    odd = customers.withColumn("acc_cust_agerang", F.lit("never seen"))
    strange = jobs.score_month(odd, codes, fx.FEATURES, model).results
    same = usual.select("mios_trans_code", "train_label").join(strange.select("mios_trans_code", F.col("train_label").alias("other")), "mios_trans_code")
    assert strange.select("train_label").distinct().count() > 1
    assert same.where("train_label = other").count() > 0.8 * same.count()


def test_display_shows_every_code(spark, coded):
    codes, df = coded
    shown = decode_features(df.withColumn("features", F.concat_ws("_", "features", F.lit("101_102_201"))), codes)
    texts = {r["id"]: r["features_desc"] for r in shown.collect()}
    assert texts[1].count(" ;") == 6 and texts[4].count(" ;") == 4


def test_too_many_codes_fail(spark):
    df = spark.createDataFrame([("1_2_3",)], "features string").withColumn("codes", encode.code_array(F.col("features")))
    with pytest.raises(Exception, match="more than 2 codes"):
        encode.explode_slots(df, 2).collect()
    with pytest.raises(Exception, match="more than 2 codes"):
        encode.index_slots(df, ["a", "b"])


@pytest.mark.parametrize("kinds", [("int", "bigint"), ("bigint", "int"), ("string", "int"), ("double", "int")])
def test_lookup_of_unequal_types(spark, monkeypatch, kinds):
    fact = spark.range(6000).select(F.when(F.col("id") < 3000, 7).otherwise(F.col("id") % 50).cast(kinds[0]).alias("k"), "id")
    dim = store(spark.range(60).select(F.col("id").cast(kinds[1]).alias("key"), (F.col("id") * 2).alias("v")))
    small = rows(lookup(fact, dim, {"k": "key"}))
    monkeypatch.setattr(shared, "BROADCAST_BYTES", -1)
    assert rows(lookup(fact, dim, {"k": "key"})) == small
    assert sum(1 for r in small if r[2] is not None) == 6000


def test_row_widths_are_measured(spark):
    wide = spark.range(10).select(F.repeat(F.lit("x"), 10_000).alias("t"), F.array_repeat(F.lit(1.0), 1000).alias("a"))
    assert 18_000 <= store(wide).row_bytes <= 20_000


def test_clusters_follow_rows(spark):
    """Two values with 1,000 rows each and twenty rare ones: clusters split by rows, not by values."""
    df = spark.createDataFrame([(float(v),) for v in [0] * 1000 + [1] * 1000 + list(range(100, 120))], "x double")
    centers = sorted(float(c[0]) for c in cluster.fit_clusters(df, 3, ["x"]).clusterCenters())
    assert centers == pytest.approx([0, 1, 109.5])


def test_months_with_gaps(spark):
    sf = "/root/testdata/sf0.001"
    customers = store(jobs.customer_features(fx.wide_transactions(spark, sf), fx.RANGES, fx.AS_OF_YEAR, fx.CENTERS)).df
    month = F.when(F.col("acc_cust_month") == "3", None).otherwise(F.col("acc_cust_month"))
    one = F.when(F.col("acc_cust_month") == "5", F.lit("F")).otherwise(F.col("trans_stat"))
    gaps = store(customers.withColumns({"trans_stat": one, "acc_cust_month": month})).df
    codes = jobs.catalog(gaps, fx.FEATURES, fx.RANGES)
    model = jobs.month_models(gaps, codes, fx.FEATURES, n_rounds=1)
    assert model.refused == ("5",) and "5" not in model.params and "3" not in model.params and len(model.params) == 10


def test_codes_leave_room_for_inactive_features(spark):
    off = FEATURES[1]._replace(feature_flag=0)
    wide = spark.range(150).select(F.col("id").cast("string").alias("a"), F.lit("1").alias("b"), F.lit("1").alias("c"))
    with pytest.raises(ValueError, match="next feature"):
        jobs.catalog(wide, [FEATURES[0], off, FEATURES[2]], [])


@pytest.mark.parametrize("text", ["2017", "2017-05", "2017-05-09 junk", "2017-05-09x", "2017-5-9", "2017-02-30"])
def test_no_whole_date_is_no_date(spark, text):
    assert tuple(spark.range(1).select(*date_parts(F.lit(text))).first()) == (None, None)
