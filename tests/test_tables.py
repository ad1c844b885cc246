"""Staging, sinks, joins under skew, deduplication, frequency."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from payscore import shared
from payscore.operators.dedup import dedup_month, dedup_year
from payscore.operators.frequency import attach_frequency
from payscore.operators.report import attach_predictions
from payscore.shared import Stored, lookup, numbered, store
from payscore.sources import (
    conform,
    drop_header_lines,
    overwrite_partition,
    read_month,
    read_year,
    stage_for_scoring,
    stage_month,
    stage_year,
    write_file,
)


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def months(spark):
    data = [(f"{y}{m}{i}", "0", y, m) for y in (2016, 2017) for m in (1, 2) for i in range(3)]
    return spark.createDataFrame(data, "MIOS_TRANS_CODE string, TRANS_STAT string, year_id int, month_id int")


def test_partitions(spark, months, tmp_path):
    root = str(tmp_path / "t")
    overwrite_partition(months, root)
    assert read_month(spark, root, 2017, 2).count() == 3
    assert read_month(spark, root, 2017, 7).count() == 0
    assert read_year(spark, root, 2016).count() == 6
    text = plan(read_month(spark, root, 2017, 2))
    assert "PartitionFilters: [isnotnull(year_id" in text and "PushedFilters: []" in text
    overwrite_partition(months.where("year_id = 2017 and month_id = 2").limit(1), root)
    assert read_month(spark, root, 2017, 2).count() == 1
    assert read_year(spark, root, 2016).count() == 6


def test_staging(months):
    assert stage_month(months, 2016, 1, ["TRANS_STAT", "MIOS_TRANS_CODE"]).columns == ["trans_stat", "mios_trans_code"]
    assert stage_year(months, 2016).count() == 6
    assert rows(stage_for_scoring(months, 2016, 1, ["TRANS_STAT"]).distinct()) == [("1",)]
    assert conform(months, ["trans_stat"]).columns == ["trans_stat"]


def test_files(spark, months, tmp_path):
    df = months.select("MIOS_TRANS_CODE", "TRANS_STAT")
    for fmt in ("parquet", "json", "csv"):
        for _ in range(2):
            write_file(df, str(tmp_path / fmt), fmt)
        back = spark.read.option("header", "true").format(fmt).load(str(tmp_path / fmt))
        assert back.count() == 12 and set(back.columns) == set(df.columns)
    write_file(df.select("MIOS_TRANS_CODE"), str(tmp_path / "text"), "text")
    assert spark.read.text(str(tmp_path / "text")).count() == 12
    with pytest.raises(ValueError):
        write_file(df, str(tmp_path / "x"), "orc2")


def test_header_lines(spark):
    df = spark.createDataFrame([("a,MIOS_TRANS_CODE,b",), ("1,2",), (None,), ("",)], "value string")
    assert rows(drop_header_lines(df, "MIOS_TRANS_CODE")) == [("",), ("1,2",), (None,)]


@pytest.fixture(scope="module")
def skewed(spark):
    """A key with a third of all rows, null keys, and many small keys."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(
        F.concat(F.lit("k"), F.col("id") % 701)
    )
    return store(spark.range(6000).select("id", key.alias("k"))).df


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_lookup_equals_broadcast(spark, skewed, monkeypatch, how):
    table = skewed.where("k is not null and k <> 'k7'").groupBy("k").agg(F.max("id").alias("top"))
    dim = store(table.withColumnRenamed("k", "key"))
    small = rows(lookup(skewed, dim, {"k": "key"}, how))
    monkeypatch.setattr(shared, "BROADCAST_BYTES", -1)
    assert shared.hot_hashes(skewed, [F.col("k")])
    large = lookup(skewed, dim, {"k": "key"}, how)
    assert rows(large) == small and large.columns == lookup(skewed, dim, {"k": "key"}, how).columns
    assert "BroadcastNestedLoop" not in plan(large) and "Cartesian" not in plan(large)


def test_salt_spreads_the_hot_key(spark, skewed, monkeypatch):
    monkeypatch.setattr(shared, "BROADCAST_BYTES", -1)
    dim = store(skewed.where("k is not null").select(F.col("k").alias("key")).distinct())
    salted = skewed.repartition(8).withColumn("_salt", shared.spread(skewed.columns)).where("k = 'hot'")
    sizes = [r["count"] for r in salted.groupBy("_salt").count().collect()]
    assert len(sizes) == shared.SALTS and max(sizes) < 4 * sum(sizes) / len(sizes)
    assert lookup(skewed, dim, {"k": "key"}).count() == 6000


def test_hot_keys_are_few(spark):
    assert shared.hot_hashes(spark.range(50_000), [F.col("id")]) == []


def test_numbered_in_ranges_equals_window(spark, skewed, monkeypatch):
    table = store(skewed.na.drop())
    order = [F.desc("id")]
    small = rows(numbered(table, "k", order, "n"))
    monkeypatch.setattr(shared, "WINDOW_ROWS", 500)
    assert rows(numbered(table, "k", order, "n"), "id", "k", "n") == small


FREQ = "t string, n string, s string, id int"


@pytest.fixture(scope="module")
def customers(spark):
    data = [("I", "1", "0", 1), ("I", "1", "0", 2), ("I", "1", "1", 3), ("I", "2", "0", 4), (None, "2", "0", 5),
            (None, "2", "0", 6)] + [("I", "hot", "0", i) for i in range(7, 40)]
    return spark.createDataFrame(data, FREQ)


def test_frequency(customers):
    got = {r["id"]: r["c"] for r in attach_frequency(customers, ["t", "n", "s"], "c").collect()}
    assert len(got) == 39 and [got[i] for i in (1, 2, 3, 4, 5, 6, 7)] == [2, 2, 1, 1, None, None, 33]


def test_frequency_shuffled(customers, shuffled):
    test_frequency(customers)


def dedup_data(spark):
    data = [("0", "I", "1", "8", "b"), ("0", "I", "1", "8", "a"), ("1", "I", "1", "8", "a"), ("0", None, "2", "8", "d"),
            ("0", None, "2", "9", "c"), ("0", "I", "3", None, "e"), ("0", "I", "4", "8", None)]
    return spark.createDataFrame(data, "s string, t string, n string, m string, code string")


def test_dedup_month(spark):
    got = rows(dedup_month(dedup_data(spark), ["s", "t", "n"], "code"), "s", "n", "code")
    # Null types form one group; a code that is first anywhere keeps all its rows.
    assert got == [("0", "1", "a"), ("0", "2", "c"), ("0", "3", "e"), ("1", "1", "a")]


def test_dedup_year(spark):
    df = dedup_data(spark)
    got = rows(dedup_year(df, ["s", "t", "n"], "m", "code"))
    groups = df.groupBy("s", "t", "n", "m").agg(F.min("code").alias("c")).select("c", F.col("m").alias("g"))
    expected = rows(df.join(groups, (df.code == F.col("c")) & (df.m == F.col("g")), "right").drop("c", "g"))
    assert got == expected and len(got) == 8


def test_dedup_shuffled(spark, shuffled):
    test_dedup_month(spark)
    test_dedup_year(spark)


def test_attach_predictions(spark, customers):
    done = spark.createDataFrame([("I", "1", 1.0, 0.9), ("I", "9", 0.0, 0.8)], "t string, n string, p double, q double")
    got = attach_predictions(customers, done, ["t", "n"], ["p", "q"])
    assert got.count() == 39 and got.where("p is not null").count() == 3


def test_store_counts_rows(spark):
    kept = store(spark.range(17).where("id > 3"), 10)
    assert kept.rows == 13 == kept.df.count() and kept.broadcastable
    assert not Stored(kept.df, 1 << 40, 10).broadcastable


def test_hot_keys_of_empty_and_uneven_tables(spark):
    assert shared.hot_hashes(spark.range(0), [F.col("id")]) == []
    uneven = spark.range(0, 1000, 1, 3).withColumn("k", F.col("id") % 2)
    assert len(shared.hot_hashes(uneven, [F.col("k")])) == 2
