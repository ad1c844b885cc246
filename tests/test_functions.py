import math
import random

import pytest
from helpers import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from payscore import functions as fn
from payscore.fixtures import FEATURES, OVERLAP, RANGES, features_config, ranges_config
from payscore.sources import Range, active_features, load_feature_list, load_ranges


def one(spark, expr, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()], F.lit(0).alias("_"))
    return df.select(expr).first()[0]


@pytest.mark.parametrize(
    "kind, number, expected",
    [
        ("I", "11001519991204899X", ("110015", "1", "18")),  # next to last is 9
        ("I", "110015199912048284", ("110015", "0", "18")),
        ("I", "110015851204824", ("110015", "0", "32")),  # 15 digits: 14th, not the last
        ("I", "12345", ("111111", "1", "1")),
        ("P", "110015199912048284", ("111111", "1", "1")),
        ("", "110015199912048284", ("111111", "1", "1")),
        ("null", "110015199912048284", ("111111", "1", "1")),
        (None, "110015199912048284", ("111111", "1", "1")),
        ("I", None, ("111111", "1", "1")),
        ("I", "110015abcd1204828X", ("110015", "0", "1")),  # no digits in the year
        ("I", "1100151999120482AX", ("110015", "1", "18")),
    ],
)
def test_id_facts(spark, kind, number, expected):
    t, n = F.lit(kind).cast("string"), F.lit(number).cast("string")
    got = spark.range(1).select(fn.id_region(t, n), fn.id_sex(t, n), fn.id_age(t, n, 2017)).first()
    assert tuple(got) == expected


def test_strict_fails_on_bad_digits(spark):
    with pytest.raises(PySparkException):
        spark.createDataFrame([("110015abcd1204828X",)], "n string").select(
            fn.id_age(F.lit("I"), F.col("n"), 2017, strict=True)
        ).collect()


@pytest.mark.parametrize(
    "text, expected",
    [("2017-08-10", (8, 10)), ("2017-08-10 12:30:00", (8, 10)), ("2017-13-45", (None, None)), ("x", (None, None)),
     (None, (None, None))],
)
def test_date_parts(spark, text, expected):
    assert tuple(spark.range(1).select(*fn.date_parts(F.lit(text).cast("string"))).first()) == expected


def brute(value, ranges, flag):
    out = "0"
    for r in sorted(ranges, key=lambda r: r.ord):
        if r.flag != flag:
            continue
        if value in (None, "", "null"):
            out = "9999"
        elif r.start < float(value) <= r.end:
            out = r.code
    return out


def test_bucketize_edges_and_overlaps(spark):
    values = [None, "", "null", "-1", "0", "0.01", "50000", "50000.5", "100000", "150000", "150000.1",
              "1000000", "1000001", "1e5"]
    odd = [Range(1, "5", "f", 5, 9, "a", ""), Range(2, "5", "f", 1, 3, "b", ""), Range(3, "5", "f", 2, 6, "c", ""),
           Range(0, "5", "f", 0, 20, "d", ""), Range(9, "5", "g", 0, 20, "e", "")]
    df = spark.createDataFrame([(v,) for v in values + [str(x / 2) for x in range(-2, 45)]], "v string")
    for ranges, flag in ((RANGES, "amnt_rang"), ([*RANGES, OVERLAP], "amnt_rang"), (odd, "f"), (odd, "none")):
        for v, got in df.select("v", fn.bucketize(F.col("v"), ranges, flag)).collect():
            assert got == brute(v, ranges, flag), (v, flag)


def test_bucketize_many_ranges(spark):
    ranges = [Range(i, "5", "f", i * 3, i * 3 + 2, str(i), "") for i in range(200)]
    df = spark.range(700).select(F.col("id").cast("string").alias("v"))
    for v, got in df.select("v", fn.bucketize(F.col("v"), ranges, "f")).collect():
        assert got == brute(v, ranges, "f")


def test_values_and_labels(spark):
    df = spark.createDataFrame([(None,), ("",), ("null",), ("1",), ("1.0",), ("2",), ("x",)], "v string")
    got = df.select(fn.category_value(F.col("v")), fn.label_column(F.col("v")), fn.label_column(F.col("v"), 1)).collect()
    assert [tuple(r) for r in got] == [
        ("0", 0.0, 0.0), ("0", 0.0, 0.0), ("null", 0.0, 0.0), ("1", 1.0, 1.0), ("1.0", 1.0, 1.0), ("2", 0.0, 2.0),
        ("x", 0.0, 0.0),
    ]


def test_percent_text(spark):
    df = spark.createDataFrame([(0.740522,), (1.0,), (0.0,), (0.12125,), (0.12375,)], "p double")
    assert [r[0] for r in df.select(fn.percent_text(F.col("p"))).collect()] == [
        "74.05%", "100.00%", "0.00%", "12.12%", "12.38%"
    ]


def test_array_functions(spark):
    s = F.array(*[F.lit(x) for x in (800.0, 801.0, 801.0)])
    shares = one(spark, fn.softmax(s))
    assert math.isclose(sum(shares), 1) and math.isclose(shares[1], math.e / (1 + 2 * math.e))
    assert one(spark, fn.argmax(s)) == 1
    shares, winner = fn.softmax_shares(s)
    assert one(spark, winner) == "42.23%"
    assert one(spark, fn.chunks(fn.constant([1, 2, 3, 4, 5, 6]), 3, 2)) == [[1, 2], [3, 4], [5, 6]]
    assert one(spark, fn.total(fn.constant([[1, 2], [3, 4]]), 2)) == [4, 6]
    winners = F.array(F.lit(0), F.lit(1), F.lit(0))
    assert one(spark, fn.votes(winners, fn.constant([1, 2, 4]), 3)) == [5, 2, 0]


@pytest.mark.parametrize("size", [2, 200])
def test_sum_arrays_skips_null_terms(spark, size):
    terms = [fn.constant([1] * size), F.lit(None).cast("array<double>"), fn.constant([3] * size)]
    assert one(spark, fn.sum_arrays(fn.constant([10] * size), terms, size)) == [14.0] * size


def test_config(spark):
    ranges = load_ranges(ranges_config(spark).orderBy(F.desc("ord")))
    assert [r.ord for r in ranges] == list(range(1, 13))
    cfg = features_config(spark)
    assert load_feature_list(cfg) == FEATURES
    assert rows(active_features(cfg), "idx") == [(i,) for i in range(1, 8)]
    assert rows(active_features(cfg, "month"), "idx") == [(i,) for i in range(1, 7)]
    assert rows(active_features(cfg, "year"), "idx") == [(i,) for i in (1, 2, 3, 4, 5, 7)]


def test_many_ranges(spark):
    """Overlapping, touching and empty ranges in random order, against a look at each of them."""
    rng = random.Random(5)
    ranges = []
    for i in range(300):
        start = rng.randint(0, 400) / 4
        ranges.append(Range(rng.randint(0, 150), "1", "r", start, start + rng.choice([-1, 0, 0.25, 1, 5, 40]), f"c{i}", ""))
    texts = [str(rng.randint(-10, 1000) / 8) for _ in range(400)] + ["", "null", None, "x", "NaN", "Infinity", "-Infinity"]

    def brute(text):
        try:
            value = float(text)
        except (TypeError, ValueError):
            return "9999" if text in ("", "null", None) else "0"
        found = [r for r in ranges if r.start < value <= r.end]
        # The highest number wins, the first of equal ones.
        return max(found, key=lambda r: r.ord).code if found else "0"

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = dict(rows(df.select("i", fn.bucketize(F.col("t"), ranges, "r").alias("b"))))
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_few_ends_are_compared_as_many_are_searched(spark, monkeypatch):
    from payscore.functions import bucketize, buckets
    from payscore.sources.config import Range

    ranges = [Range(1, "1", "f", 0, 10, "a", ""), Range(2, "1", "f", 5, 20, "b", ""), Range(3, "1", "f", 30, 40, "c", "")]
    texts = [None, "", "null", "x", "NaN", "-1", "0", "0.5", "5", "5.1", "10", "20", "25", "30", "30.1", "40", "41", "Infinity", "-Infinity"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    few = df.select("t", bucketize(df["t"], ranges, "f").alias("code"))
    # Array functions are not compiled and slow down all of a projection.
    assert "lambda" not in few._jdf.queryExecution().optimizedPlan().toString()
    got = dict(few.collect())
    monkeypatch.setattr(buckets, "FEW_ENDS", 0)
    assert got == dict(df.select("t", bucketize(df["t"], ranges, "f")).collect())
    assert got["5"] == "a" and got["5.1"] == "b" and got["25"] == "0" and got["40"] == "c" and got[None] == "9999"
