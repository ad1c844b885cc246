"""Catalog, portraits, slots, dictionaries."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from payscore.operators import catalog, encode
from payscore.operators.report import decode_features
from payscore.shared import store
from payscore.sources import Feature, Range

FEATURES = [Feature(1, "b", "200", "second", 1, 0), Feature(2, "a", "100", "first", 1, 0)]
RANGES = [Range(1, "100", "f", 0, 1, "x", "an x"), Range(2, "100", "f", 0, 1, "x", "other"),
          Range(3, "200", "f", 0, 1, "y", "not this feature's")]


@pytest.fixture(scope="module")
def data(spark):
    values = [(1, "x", "p"), (2, "y", None), (3, "", "q"), (4, "x", "p"), (5, "null", "p")]
    return spark.createDataFrame(values, "id int, a string, b string")


def test_feature_values(data):
    assert rows(catalog.feature_values(data, FEATURES)) == [
        ("100", "0"), ("100", "null"), ("100", "x"), ("100", "y"), ("200", "0"), ("200", "p"), ("200", "q")]


def test_catalog(data):
    got = rows(catalog.build_catalog(data, FEATURES, RANGES).drop("feature_name", "feature_weight"))
    assert got == [
        ("1", "201", "0", "200", "second", "0"), ("2", "202", "p", "200", "second", "p"),
        ("3", "203", "q", "200", "second", "q"), ("4", "101", "0", "100", "first", "0"),
        ("5", "102", "null", "100", "first", "null"), ("6", "103", "x", "100", "first", "an x"),
        ("7", "104", "y", "100", "first", "y"),
    ]


def test_catalog_refuses_overflow(spark):
    wide = spark.range(150).select(F.col("id").cast("string").alias("a"), F.lit("1").alias("b"))
    with pytest.raises(ValueError, match="next feature"):
        catalog.build_catalog(wide, FEATURES, [])


def test_extend_catalog_keeps_codes(spark, data):
    saved = store(catalog.build_catalog(data.where("id in (2, 4)"), FEATURES, RANGES)).df
    grown = catalog.extend_catalog(saved, data, FEATURES, RANGES)
    assert set(rows(saved)) <= set(rows(grown)) and grown.count() == 7
    added = rows(grown.join(saved, "feature_id", "left_anti"), "feature_id", "feature_code", "feature_value")
    assert added == [("5", "203", "q"), ("6", "103", "0"), ("7", "104", "null")]
    assert rows(catalog.extend_catalog(store(grown).df, data, FEATURES, RANGES)) == rows(grown)


def portraits(data):
    codes = store(catalog.build_catalog(data, FEATURES, RANGES))
    new = data.unionByName(data.limit(1).selectExpr("9 id", "'unseen' a", "'p' b"))
    return codes, encode.portrait(new, codes, FEATURES)


def test_portrait_and_decode(data):
    codes, df = portraits(data)
    assert rows(df, "id", "features") == [
        (1, "103_202"), (2, "104_201"), (3, "101_203"), (4, "103_202"), (5, "102_202"), (9, "202")]
    shown = dict(rows(decode_features(df, codes), "id", "features_desc"))
    assert shown[1] == " ;first: an x ;second: p" and shown[9] == " ;second: p"
    odd = data.limit(1).withColumn("features", F.lit("777_103"))
    assert decode_features(odd, codes).first()["features_desc"] == " ; ;first: an x"


def test_portrait_shuffled(data, shuffled):
    test_portrait_and_decode(data)


@pytest.fixture(scope="module")
def coded(spark):
    values = [(1, "a2_b1"), (2, "b1_a1"), (3, "a1_b2"), (4, "a2_b1"), (5, "b3_a3")]
    df = spark.createDataFrame(values, "id int, features string")
    return df.withColumn("codes", encode.code_array(F.col("features")))


def test_slots(coded):
    wide = encode.explode_slots(coded, 3)
    assert rows(wide, "id", "feature1", "feature2", "feature3")[1] == (2, "a1", "b1", None)


SLOTS = encode.slot_names(2)


def test_index_and_encode(coded):
    index = encode.index_slots(coded, SLOTS)
    assert rows(index.df, "pos", "slot", "code", "cnt", "idx", "width") == [
        (0, "FEATURE1", "a1", 2, 0, 3), (1, "FEATURE1", "a2", 2, 1, 3), (2, "FEATURE1", "a3", 1, 2, 3),
        (3, "FEATURE2", "b1", 3, 0, 3), (4, "FEATURE2", "b2", 1, 1, 3), (5, "FEATURE2", "b3", 1, 2, 3)]
    direct = rows(encode.encode(coded, index, SLOTS), "id", "active")
    assert direct[0] == (1, [1, 3])
    saved = encode.build_dictionary(index)
    assert saved.count() == 6
    assert rows(encode.encode_with_dictionary(coded, saved, SLOTS), "id", "active") == direct


def test_index_equals_string_indexer(coded):
    from pyspark.ml.feature import StringIndexer

    wide = encode.explode_slots(coded, 2)
    for i, slot in ((1, "FEATURE1"), (2, "FEATURE2")):
        model = StringIndexer(inputCol=f"feature{i}", outputCol="o").fit(wide)
        got = encode.index_slots(coded, SLOTS).df.where(F.col("slot") == slot)
        assert [r["code"] for r in got.orderBy("idx").collect()] == model.labels


def test_unknown_codes_keep_the_vector_length(spark, coded):
    index = encode.index_slots(coded, SLOTS)
    # a1 is known in the first slot only.
    new = spark.createDataFrame([(1, ["zz", "b2"]), (2, ["a1", "a1"])], "id int, codes array<string>")
    out = encode.encode(new, index, SLOTS)
    assert rows(out, "id", "active") == [(1, [4]), (2, [0])]
    vectors = rows(out.withColumn("v", encode.dense_vector(F.col("active"), index.rows)), "id", "v")
    assert vectors[0][1] == [0, 0, 0, 0, 1, 0] and len(vectors[1][1]) == 6


def test_encode_shuffled(coded, shuffled):
    test_index_and_encode(coded)
