"""Naive Bayes, boosting, ensembles and metrics against brute force and Spark ML."""

import math

import numpy as np
import pytest
from helpers import rows
from pyspark.sql import functions as F

from payscore.operators import bayes, boost, encode, ensemble, evaluate, models
from payscore.operators.cluster import FEATURES as POINT
from payscore.operators.cluster import assign_clusters, assign_nearest, fit_clusters, load_clusters
from payscore.shared import store

SLOTS = encode.slot_names(3)
SIZES = (4, 3, 2)


def make(spark, n=400, classes=2, seed=7):
    rng = np.random.default_rng(seed)
    data = []
    for i in range(n):
        a, b, c = (int(rng.integers(k)) for k in SIZES)
        label = (a + b * c + int(rng.random() < 0.2)) % classes
        data.append((i, [f"a{a}", f"b{b}", f"c{c}"], float(label), float(1 + i % 4) / 2, i % 3 + 1))
    return store(spark.createDataFrame(data, "id int, codes array<string>, label double, w double, month int")).df


@pytest.fixture(scope="module")
def two(spark):
    return make(spark)


@pytest.fixture(scope="module")
def three(spark):
    return make(spark, classes=3)


def arrays(df):
    data = df.orderBy("id").collect()
    levels = sorted({(i, c) for r in data for i, c in enumerate(r["codes"])})
    x = np.zeros((len(data), len(levels)))
    for n, r in enumerate(data):
        for i, c in enumerate(r["codes"]):
            x[n, levels.index((i, c))] = 1
    return x, np.array([r["label"] for r in data]), np.array([r["w"] for r in data]), levels


def brute_nb(x, y, w, lam=1.0, balanced=True, bernoulli=False):
    labels = sorted(set(y))
    n = np.array([w[y == c].sum() for c in labels])
    s = np.array([(w[y == c, None] * x[y == c]).sum(0) for c in labels])
    prior = np.log(n + lam) - np.log(n.sum() + len(labels) * lam)
    if balanced:
        share = np.array([(y == c).mean() for c in labels])
        odds = (1 - share) / share
        prior = prior + np.log(1 - share if len(labels) == 2 else odds / odds.sum())
    below = n[:, None] + 2 * lam if bernoulli else s.sum(1, keepdims=True) + x.shape[1] * lam
    return prior, np.log(s + lam) - np.log(below)


def brute_scores(x, prior, theta, bernoulli=False):
    if not bernoulli:
        return prior + x @ theta.T
    absent = np.log(1 - np.exp(theta))
    return prior + absent.sum(1) + x @ (theta - absent).T


def brute_boost(x, y, rounds, samme=False):
    labels = np.array(sorted(set(y)))
    w, out = np.ones(len(y)), []
    for _ in range(rounds):
        prior, theta = brute_nb(x, y, w)
        wrong = labels[brute_scores(x, prior, theta).argmax(1)] != y
        e = w[wrong].sum() / len(y)
        a = math.log((len(labels) - 1) * (1 - e) / e) if samme else 0.5 * math.log((1 - e) / e)
        out.append((prior, theta, a, e))
        w = w * np.where(wrong, math.exp(a), 1)
        w *= len(y) / w.sum()
    return out


def soft(v):
    g = np.exp(v - v.max(-1, keepdims=True))
    return g / g.sum(-1, keepdims=True)


@pytest.mark.parametrize("kind", ["multinomial", "bernoulli"])
@pytest.mark.parametrize("which", ["two", "three"])
def test_nb_equals_brute_force(request, which, kind):
    df = request.getfixturevalue(which)
    x, y, w, _ = arrays(df)
    scored = bayes.nb_score(df, bayes.fit_nb(df, SLOTS, weight="w", kind=kind)).orderBy("id").collect()
    expected = brute_scores(x, *brute_nb(x, y, w, bernoulli=kind == "bernoulli"), kind == "bernoulli")
    np.testing.assert_allclose([r["raw"] for r in scored], expected, atol=1e-9)
    np.testing.assert_allclose([r["probability"] for r in scored], soft(expected), atol=1e-9)
    assert [r["prediction"] for r in scored] == list(np.array(sorted(set(y)))[expected.argmax(1)])


def test_plain_nb_equals_spark_ml(two):
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.functions import array_to_vector

    index = encode.index_slots(two, SLOTS)
    vectors = encode.encode(two, index, SLOTS).withColumn(
        "features", array_to_vector(encode.dense_vector(F.col("active"), index.rows)))
    ml = NaiveBayes(weightCol="w", smoothing=0.5).fit(vectors)
    mine = bayes.fit_nb(two, SLOTS, weight="w", balanced=False, smoothing=0.5)
    np.testing.assert_allclose(mine.params[""].log_prior[0], ml.pi.toArray(), atol=1e-12)
    at = {(r["slot"], r["code"]): r["pos"] for r in index.df.collect()}
    for r in mine.levels.df.collect():
        np.testing.assert_allclose(r["theta"], ml.theta.toArray()[:, at[r["slot"], r["code"]]], atol=1e-12)


def test_class_weights(two, three):
    for df, classes in ((two, 2), (three, 3)):
        got = {r["label"]: r["weight"] for r in bayes.class_weights(df).collect()}
        counts = {r["label"]: r["cnt"] for r in bayes.label_counts(df).collect()}
        assert len(got) == classes and math.isclose(sum(got.values()), 1)
        for c, v in bayes.balance(counts).items():
            assert math.isclose(got[c], v)
    with pytest.raises(ValueError):
        bayes.balance({1.0: 5})


def test_arguments(two):
    for bad in ({"kind": "gaussian"}, {"smoothing": -1}, {"weights": {0.0: 1.0}}):
        with pytest.raises(ValueError):
            bayes.fit_nb(two, SLOTS, **bad)
    model = bayes.fit_nb(two, SLOTS)
    for thresholds in ([1.0], [0.0, 0.0], [-1.0, 1.0]):
        with pytest.raises(ValueError):
            bayes.nb_score(two, model, thresholds=thresholds)
    with pytest.raises(ValueError):
        boost.fit_boost(two, SLOTS, 0)
    with pytest.raises(ValueError):
        boost.step(0.2, 2, "other")


def test_thresholds(two):
    model = bayes.fit_nb(two, SLOTS)
    got = bayes.nb_score(two, model, thresholds=[0.8, 0.2]).collect()
    assert all(r["prediction"] == float(r["probability"][1] / 0.2 > r["probability"][0] / 0.8) for r in got)
    assert {r["prediction"] for r in bayes.nb_score(two, model, thresholds=[1.0, 0.0]).collect()} == {1.0}


def test_custom_weights_move_the_prior_only(two):
    plain = bayes.fit_nb(two, SLOTS, balanced=False)
    own = bayes.fit_nb(two, SLOTS, weights={0.0: 0.9, 1.0: 0.1})
    diff = np.array(own.params[""].log_prior[0]) - plain.params[""].log_prior[0]
    np.testing.assert_allclose(diff, np.log([0.9, 0.1]))
    assert rows(own.levels.df) == rows(plain.levels.df)


def test_zero_smoothing_gives_minus_infinity(spark):
    data = [(["a"], 0.0), (["b"], 1.0), (["b"], 0.0)]
    df = spark.createDataFrame(data, "codes array<string>, label double")
    got = bayes.nb_score(df, bayes.fit_nb(df, ["s"], smoothing=0.0)).where("codes[0] = 'a'").first()
    assert got["raw"][1] == -math.inf and got["prediction"] == 0.0 and got["probability"] == [1.0, 0.0]


def test_check_features(spark):
    df = spark.createDataFrame([(0.0, 1.0, -1.0), (1.0, 2.5, 1.0)], "x double, y double, z double")
    got = rows(bayes.check_features(df, ["x", "y", "z"]), "feature", "multinomial_ok", "bernoulli_ok")
    assert got == [("x", True, True), ("y", True, False), ("z", False, False)]
    df = df.withColumn("label", F.col("x"))
    assert bayes.fit_nb_values(df, ["x", "y"]).labels == [0.0, 1.0]
    with pytest.raises(ValueError, match="of z"):
        bayes.fit_nb_values(df, ["x", "z"])
    with pytest.raises(ValueError, match="of y, z"):
        bayes.fit_nb_values(df, ["x", "y", "z"], kind="bernoulli")


@pytest.mark.parametrize("kind", ["multinomial", "bernoulli"])
def test_numeric_nb_equals_spark_ml(spark, kind):
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import VectorAssembler

    high = 2 if kind == "bernoulli" else 6
    columns = ["p", "q", "r"]
    numbers = [f"cast(pmod(hash(id, '{c}'), {high}) as double) as {c}" for c in columns]
    df = store(spark.range(500).selectExpr("id", "cast(id % 3 as double) label", "cast(1 + id % 2 as double) w", *numbers)).df
    mine = bayes.fit_nb_values(df, columns, weight="w", kind=kind, balanced=False)
    vectors = VectorAssembler(inputCols=columns, outputCol="features").transform(df)
    ml = NaiveBayes(weightCol="w", modelType=kind).fit(vectors)
    np.testing.assert_allclose(mine.log_theta, ml.theta.toArray(), atol=1e-12)
    a = bayes.nb_score_values(df, mine).orderBy("id").collect()
    b = ml.transform(vectors).orderBy("id").collect()
    np.testing.assert_allclose([r["raw"] for r in a], [r["rawPrediction"].toArray() for r in b], atol=1e-9)
    np.testing.assert_allclose([r["probability"] for r in a], [r["probability"].toArray() for r in b], atol=1e-9)
    assert [r["prediction"] for r in a] == [r["prediction"] for r in b]


@pytest.mark.parametrize("samme", [False, True])
def test_boost_equals_brute_force(two, three, samme):
    for df in (two, three):
        x, y, _, levels = arrays(df)
        expected = brute_boost(x, y, 3, samme)
        model = boost.fit_boost(df, SLOTS, 3, alpha="samme" if samme else "half_log")
        p = model.params[""]
        np.testing.assert_allclose(p.error, [e[3] for e in expected], atol=1e-9)
        np.testing.assert_allclose(p.alpha, [e[2] for e in expected], atol=1e-9)
        np.testing.assert_allclose(p.log_prior, [e[0] for e in expected], atol=1e-9)
        votes = np.zeros((len(y), len(model.labels)))
        for prior, theta, a, _ in expected:
            votes[np.arange(len(y)), brute_scores(x, prior, theta).argmax(1)] += a
        got = boost.boost_score(df, model).orderBy("id").collect()
        np.testing.assert_allclose([r["raw"] for r in got], votes, atol=1e-9)
        np.testing.assert_allclose([r["probability"] for r in got], soft(votes), atol=1e-9)
        np.testing.assert_allclose([r["confidence"] for r in got], soft(votes).max(1), atol=1e-9)


def test_boost_shuffled(two, shuffled):
    test_boost_equals_brute_force(two, two, False)


def test_boost_does_not_depend_on_partitions(two):
    a = boost.fit_boost(two.repartition(1), SLOTS, 2).params[""]
    b = boost.fit_boost(two.repartition(7, "id"), SLOTS, 2).params[""]
    np.testing.assert_allclose(a.error, b.error, atol=1e-12)


def test_perfect_fit_is_clamped(spark):
    df = spark.createDataFrame([(["a"], 0.0), (["b"], 1.0)] * 20, "codes array<string>, label double")
    p = boost.fit_boost(df, ["s"], 2).params[""]
    assert p.error[0] == boost.ERROR_MARGIN and all(map(math.isfinite, p.alpha))


def test_dictionary_codes_count_as_levels(spark, two):
    extra = spark.createDataFrame([("FEATURE1", "never")], "slot string, code string")
    known = encode.index_slots(two, SLOTS).df.select("slot", "code").unionByName(extra)
    model = boost.fit_boost(two, SLOTS, 2, dictionary=known)
    assert model.sizes == {"": sum(SIZES) + 1} and model.levels.rows == sum(SIZES) + 1
    got = {r["code"]: r["theta"] for r in model.levels.df.collect()}["never"]
    assert len(got) == 4 and all(map(math.isfinite, got))


def test_models_by_month_equal_single_fits(two):
    both = boost.fit_boost(two, SLOTS, 2, by="month")
    assert sorted(both.params) == ["1", "2", "3"]
    for m in (1, 2, 3):
        part = two.where(F.col("month") == m)
        one = boost.fit_boost(part, SLOTS, 2)
        np.testing.assert_allclose(both.params[str(m)].alpha, one.params[""].alpha, atol=1e-9)
        mine = boost.boost_score(two, both, by="month").where(F.col("month") == m).orderBy("id").collect()
        alone = boost.boost_score(part, one).orderBy("id").collect()
        np.testing.assert_allclose([r["raw"] for r in mine], [r["raw"] for r in alone], atol=1e-9)
    with pytest.raises(ValueError):
        boost.boost_score(two, both)


def test_month_weights():
    assert ensemble.month_weights(4, 9) == [0.25] * 4
    mid = ensemble.month_weights(12, 8)
    assert mid[6:9] == [2 / 12, 3 / 12, 2 / 12] and math.isclose(sum(mid), 1)
    assert round(sum(ensemble.month_weights(12, 1)), 4) == 0.8796
    assert round(sum(ensemble.month_weights(12, 12)), 4) == 1.0648


@pytest.fixture(scope="module")
def monthly(two):
    x, y, _, _ = arrays(two)
    months = np.array([r["month"] for r in two.orderBy("id").collect()])
    model = boost.fit_boost(two, SLOTS, 2, by="month")
    joint = []
    for m in (1, 2, 3):
        fitted = brute_boost(x[months == m], y[months == m], 2)
        joint.append([brute_scores(x, f[0], f[1]) for f in fitted])
    return model, np.array(joint)  # month, round, row, class


def test_ensemble_equals_brute_force(two, monthly):
    model, joint = monthly
    weights = [0.5, 0.3, 0.2]
    blend = ensemble.build_ensemble(model, ["1", "2", "3"], weights)
    got = ensemble.ensemble_score(two, blend).orderBy("id").collect()
    votes = np.zeros(joint.shape[2:])
    prob = np.zeros(joint.shape[2:])
    for m in range(3):
        alphas = np.array(model.params[str(m + 1)].alpha)
        votes[np.arange(len(votes)), (joint[m] + alphas[:, None, None]).sum(0).argmax(1)] += weights[m]
        inner = (soft(joint[m]) * soft(alphas)[:, None, None]).sum(0)
        prob += soft(inner) * soft(np.array(weights))[m]
    np.testing.assert_allclose([r["raw"] for r in got], votes, atol=1e-9)
    np.testing.assert_allclose([r["probability"] for r in got], soft(votes), atol=1e-9)
    np.testing.assert_allclose([r["prob"] for r in got], prob, atol=1e-9)
    np.testing.assert_allclose([r["confidence"] for r in got], prob[np.arange(len(votes)), votes.argmax(1)], atol=1e-9)
    assert [r["prediction"] for r in got] == list(votes.argmax(1))

    ballots = np.zeros(joint.shape[2:])
    for m in range(3):
        inner = np.zeros(joint.shape[2:])
        for r, a in enumerate(model.params[str(m + 1)].alpha):
            inner[np.arange(len(inner)), joint[m, r].argmax(1)] += a
        ballots[np.arange(len(inner)), inner.argmax(1)] += weights[m]
    other = ensemble.ensemble_score(two, blend, vote="boost", prob=None).orderBy("id").collect()
    np.testing.assert_allclose([r["raw"] for r in other], ballots, atol=1e-9)


def test_one_model_may_stand_for_several_months(two, monthly):
    model, _ = monthly
    blend = ensemble.build_ensemble(model, ["2"] * 4)
    alone = ensemble.build_ensemble(model, ["2"], [1.0])
    a, b = (ensemble.ensemble_score(two, e, prob=None).orderBy("id").collect() for e in (blend, alone))
    assert [r["prediction"] for r in a] == [r["prediction"] for r in b]
    with pytest.raises(ValueError):
        ensemble.build_ensemble(model, ["7"])
    with pytest.raises(ValueError):
        ensemble.build_ensemble(model, ["1", "2"], [1.0])


def test_mean_of_plain_models(two):
    model = bayes.fit_nb(two, SLOTS, by="month")
    got = ensemble.ensemble_score(two, ensemble.build_ensemble(model, ["1", "2", "3"]), prob="mean").orderBy("id").collect()
    parts = [
        [r["probability"] for r in bayes.nb_score(two.withColumn("m", F.lit(m)), model, by="m").orderBy("id").collect()]
        for m in "123"
    ]
    np.testing.assert_allclose([r["prob"] for r in got], np.mean(parts, axis=0), atol=1e-9)


def test_slots_are_matched_by_name(two, monthly):
    """A row whose slots come in another order is scored the same; an unknown slot adds nothing."""
    model, _ = monthly
    blend = ensemble.build_ensemble(model, ["1", "2", "3"])
    turned = two.withColumn("codes", F.array(F.get("codes", F.lit(2)), F.lit("zz"), F.get("codes", F.lit(0)), F.get("codes", F.lit(1))))
    a = ensemble.ensemble_score(two, blend).orderBy("id").collect()
    b = ensemble.ensemble_score(turned, blend, slots=["FEATURE3", "OTHER", "FEATURE1", "FEATURE2"]).orderBy("id").collect()
    np.testing.assert_allclose([r["prob"] for r in a], [r["prob"] for r in b], atol=1e-12)


def test_save_and_load(spark, two, monthly, tmp_path):
    model, _ = monthly
    blend = ensemble.build_ensemble(model, ["3", "1"], [0.6, 0.4])
    for _ in range(2):
        models.save_ensemble(spark, blend, str(tmp_path / "m"))
    (tmp_path / "m").rename(tmp_path / "moved")
    back = models.load_ensemble(spark, str(tmp_path / "moved"))
    a, b = (ensemble.ensemble_score(two, e).orderBy("id").collect() for e in (blend, back))
    assert [r["prob"] for r in a] == [r["prob"] for r in b]
    plain = bayes.fit_nb(two, SLOTS, kind="bernoulli")
    models.save_model(spark, plain, str(tmp_path / "nb"))
    again = models.load_model(spark, str(tmp_path / "nb"))
    a, b = (bayes.nb_score(two, e).orderBy("id").collect() for e in (plain, again))
    assert [r["raw"] for r in a] == [r["raw"] for r in b]


def test_split(two):
    df = two.withColumn("key", F.col("id").cast("string"))
    parts = rows(evaluate.split_by_key(df, "key"), "id", "part")
    assert parts == rows(evaluate.split_by_key(df.repartition(5), "key"), "id", "part")
    assert 0.7 < sum(p == "train" for _, p in parts) / len(parts) < 0.9


@pytest.mark.parametrize("cells", [[(0, 0, 40), (0, 1, 10), (1, 0, 5), (1, 1, 45)], [(0, 0, 7), (1, 0, 3)],
                                   [(0, 1, 7), (1, 1, 3)], [(0, 0, 9), (1, 0, 1), (1, 1, 8), (2, 1, 4), (2, 2, 5)]])
def test_metrics_equal_spark_ml(spark, cells):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator

    data = [(float(y), float(p)) for y, p, n in cells for _ in range(n)]
    df = spark.createDataFrame(data, "label double, prediction double")
    got = evaluate.evaluate(df).first()
    names = {"accuracy": "accuracy", "precision": "weightedPrecision", "recall": "weightedRecall", "f1": "f1",
             "fpr": "weightedFalsePositiveRate"}
    for mine, name in names.items():
        assert math.isclose(got[mine], MulticlassClassificationEvaluator(metricName=name).evaluate(df), abs_tol=1e-12)
    if max(y for y, _, _ in cells) == 1:
        for mine, name in (("area_under_roc", "areaUnderROC"), ("area_under_pr", "areaUnderPR")):
            e = BinaryClassificationEvaluator(rawPredictionCol="prediction", metricName=name, numBins=0)
            assert math.isclose(got[mine], e.evaluate(df), abs_tol=1e-12)
    swapped = evaluate.evaluate(df.toDF("prediction", "label")).first()
    assert evaluate.evaluate(df, as_published=True).first() == swapped


@pytest.fixture(scope="module")
def points(spark):
    df = spark.range(900).selectExpr(*[f"cast(pmod(hash(id, {i}), {4 + i}) as string) as {c}" for i, c in enumerate(POINT)])
    return store(df).df


def test_clusters(points, tmp_path):
    costs = {}
    for k in (2, 3, 4):
        model = fit_clusters(points, k)
        costs[k] = model.summary.trainingCost
        assert len(model.clusterCenters()) == k
        assert assign_clusters(points, model).select("acc_cust_km").distinct().count() == k
    assert costs[2] >= costs[3] >= costs[4]
    again = fit_clusters(points, 4)
    assert np.array_equal(again.clusterCenters(), model.clusterCenters())
    model.write().overwrite().save(str(tmp_path / "km"))
    loaded = load_clusters(str(tmp_path / "km"))
    assert rows(assign_clusters(points, loaded)) == rows(assign_clusters(points, model))


def test_nearest_center(points):
    centers = [(0.5, 1.0, 2.0, 3.0), (3.0, 1.0, 0.0, 2.0), (0.5, 1.0, 2.0, 3.0)]
    got = np.array([[float(v) for v in r] for r in assign_nearest(points, centers).collect()])
    distance = ((got[:, None, :4] - np.array(centers)) ** 2).sum(2)
    assert (got[:, 4] == distance.argmin(1)).all()
