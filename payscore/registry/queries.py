"""One query per operator, each over whole tables of a data folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payscore import fixtures as fx
from payscore.functions import bucketize, date_parts, id_age, id_region, id_sex, label_column, softmax_shares
from payscore.operators import bayes, bisect, boost, catalog, cluster, dedup, encode, ensemble, evaluate, frequency, models, report
from payscore.operators.derive import INSTANCE_TYPE, TIME_RANG, derive_customers
from payscore.plans import jobs
from payscore.shared import UNMEASURED, Stored, shared_dir, store
from payscore.sources import Range, active_features, conform, drop_header_lines, load_feature_list, load_ranges, read_month, read_year
from payscore.sources import stage_for_scoring, stage_month, stage_year
from payscore.sources import overwrite_partition, write_file, write_table

SLOTS = encode.slot_names(4)
MONTHS = [str(m) for m in range(1, 13)]
# What the queries on later batches train with.
TRAINING_MONTH = "year_id = 1996 AND month_id = 3"
TRAINING_YEARS = "year_id <= 1995"
METRICS = ["n_rows", "n_correct", "accuracy", "precision", "recall", "f1", "fpr", "area_under_roc", "area_under_pr"]
STAGED = ["MIOS_TRANS_CODE", "TRANS_CODE", "TRANS_BAT_NO", "TRANS_STAT", "BANKACC_ID_NO", "TRANS_AMNT"]


def r6(column: str | Column, name: str | None = None) -> Column:
    col = F.col(column) if isinstance(column, str) else column
    return F.round(col, 6).alias(name or column)


def customers(spark: SparkSession, sf: str) -> DataFrame:
    return derive_customers(fx.transactions(spark, sf), fx.RANGES, fx.AS_OF_YEAR)


def coded(spark: SparkSession, sf: str, label: str = "trans_stat") -> DataFrame:
    """Transactions with four codes and a label, the input of the model queries."""
    df = customers(spark, sf)
    codes = [
        F.concat(F.lit("a"), F.col("acc_cust_amntrang")),
        F.concat(F.lit("b"), F.col("bank_code")),
        F.concat(F.lit("c"), F.col("mio_class")),
        F.concat(F.lit("d"), F.col("acc_cust_dayrang")),
    ]
    if label == "trans_stat":
        value = label_column(F.col("trans_stat"))
    else:
        value = F.when(F.col(label) == "F", 0.0).when(F.col(label) == "O", 1.0).otherwise(2.0)
    amount = F.col("trans_amnt").try_cast("double") / 130000
    return df.select(
        "mios_trans_code", "trans_code", "trans_bat_no", "trans_stat", "month_id",
        F.array(*codes).alias("codes"), value.alias("label"), F.coalesce(amount, F.lit(1.0)).alias("w"),
    )


def catalog_of(spark: SparkSession, df: DataFrame) -> Stored:
    return jobs.catalog(df, fx.FEATURES, fx.RANGES)


# Scalar functions and staging


def id_attributes(spark, sf):
    t, n = F.col("bankacc_id_type"), F.col("bankacc_id_no")
    return fx.transactions(spark, sf).select(
        "mios_trans_code",
        id_region(t, n).alias("acc_cust_home"),
        id_sex(t, n).alias("acc_cust_sex"),
        id_age(t, n, fx.AS_OF_YEAR).alias("acc_cust_age"),
        F.lit(INSTANCE_TYPE).alias("acc_cust_instancetype"),
        F.lit(TIME_RANG).alias("acount_time_rang"),
    )


def date_parts_query(spark, sf):
    month, day = date_parts(F.col("plnmio_date"))
    return fx.transactions(spark, sf).select("mios_trans_code", month.alias("month"), day.alias("day"))


def _bucket(flag: str, value: Callable[[], Column]):
    def run(spark, sf):
        ranges = load_ranges(fx.ranges_config(spark))
        return fx.transactions(spark, sf).select("mios_trans_code", bucketize(value(), ranges, flag).alias("bucket"))

    return run


def bucket_many(spark, sf):
    """2,000 ranges that overlap, the highest number winning."""
    ranges = [
        Range(i * 7919 % 2000, "21000", "fine", 200.0 * i, 200.0 * i + 250 + i % 7 * 40, f"c{i}", "") for i in range(2000)
    ]
    return fx.transactions(spark, sf).select("mios_trans_code", bucketize(F.col("trans_amnt"), ranges, "fine").alias("bucket"))


def stage_month_query(spark, sf):
    return stage_month(fx.transactions(spark, sf), 1997, 5, STAGED)


def stage_year_query(spark, sf):
    return stage_year(fx.transactions(spark, sf), 1998, STAGED)


def stage_for_scoring_query(spark, sf):
    return stage_for_scoring(fx.transactions(spark, sf), 1997, 6, STAGED)


def read_partitions(spark, sf):
    root = f"{shared_dir(spark)}/payscore-{uuid.uuid4().hex}"
    overwrite_partition(conform(fx.transactions(spark, sf), [*STAGED, "YEAR_ID", "MONTH_ID"]), root)
    one = read_month(spark, root, 1997, 5).withColumn("part", F.lit("month"))
    year = read_year(spark, root, 1998).withColumn("part", F.lit("year"))
    return one.unionByName(year).groupBy("part", "year_id", "month_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("mios_trans_code").alias("first_code")
    )


def drop_header_lines_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    lines = docs.select("doc_id", F.explode(F.split("text", "\n")).alias("value"))
    kept = drop_header_lines(lines, "License")
    return kept.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("value")).alias("n_chars")
    )


def job_load(spark, sf):
    """Raw months published once: one month, the same again after its raw files changed, then the whole year."""
    folder = f"{shared_dir(spark)}/payscore-{uuid.uuid4().hex}"
    raw, root = f"{folder}/raw/{{year}}/month={{month}}", f"{folder}/loaded"
    rows = conform(fx.transactions(spark, sf).where("year_id = 1997"), [*STAGED, "MONTH_ID"]).withColumnRenamed("month_id", "month")
    overwrite_partition(rows, f"{folder}/raw/1997", ("month",))
    jobs.load_source(spark, raw, root, 1997, 5, STAGED)
    overwrite_partition(rows.where("month = 5").withColumn("trans_stat", F.lit("9")), f"{folder}/raw/1997", ("month",))
    month = jobs.load_source(spark, raw, root, 1997, 5, STAGED).withColumn("part", F.lit("month"))
    year = jobs.load_source(spark, raw, root, 1997, None, STAGED).withColumn("part", F.lit("year"))
    return month.unionByName(year)


# Frequency and deduplication


def customer_frequency(spark, sf):
    df = fx.transactions(spark, sf).select("mios_trans_code", *frequency.KEYS)
    df = frequency.attach_frequency(df)
    return frequency.attach_frequency(df, frequency.KEYS[:2], "customer_cnt")


def dedup_month_query(spark, sf):
    df = fx.transactions(spark, sf).select("mios_trans_code", *dedup.KEYS)
    return dedup.dedup_month(df)


def dedup_year_query(spark, sf):
    df = customers(spark, sf).select("mios_trans_code", *dedup.KEYS, "acc_cust_month")
    return dedup.dedup_year(df)


# Catalog and encoding


def active_features_query(spark, sf):
    cfg = fx.features_config(spark)
    modes = {m: load_feature_list(active_features(cfg, m)) for m in (None, "month", "year")}
    df = customers(spark, sf)
    parts = [
        df.select(*[F.col(f.col_name).cast("string") for f in fs])
        .unpivot([], [f.col_name for f in fs], "col_name", "value")
        .groupBy("col_name").agg(F.count("value").alias("n_values"))
        .withColumn("mode", F.lit(m or "all"))
        for m, fs in modes.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def feature_values_query(spark, sf):
    df = customers(spark, sf)
    extra = fx.FEATURES[3]._replace(col_name="trans_amnt", pcode="41000")
    return catalog.feature_values(df, [*jobs.model_features(fx.FEATURES), extra])


def feature_catalog_query(spark, sf):
    return catalog.build_catalog(customers(spark, sf), jobs.model_features(fx.FEATURES), fx.RANGES)


def catalog_extend(spark, sf):
    use = jobs.model_features(fx.FEATURES)
    df = customers(spark, sf)
    first = store(catalog.build_catalog(stage_month(df, 1996, 3), use, fx.RANGES)).df
    return catalog.extend_catalog(first, df, use, fx.RANGES)


def portrait_query(spark, sf):
    df = customers(spark, sf)
    out = encode.portrait(df, catalog_of(spark, df), jobs.model_features(fx.FEATURES, "month"))
    return out.select("mios_trans_code", "features")


def slot_explode(spark, sf):
    df = coded(spark, sf).withColumn("features", F.array_join(F.reverse("codes"), "_"))
    return encode.explode_slots(df, 5).select("mios_trans_code", *[f"feature{i}" for i in range(1, 6)])


def slot_index(spark, sf):
    return encode.index_slots(coded(spark, sf), SLOTS).df


def dictionary(spark, sf):
    return encode.build_dictionary(encode.index_slots(coded(spark, sf), SLOTS))


def encode_new(spark, sf):
    df = coded(spark, sf)
    batch = df.where(F.col("trans_bat_no") == "B199603")
    saved = encode.build_dictionary(encode.index_slots(batch, SLOTS))
    out = encode.encode_with_dictionary(df, saved, SLOTS)
    return out.select("mios_trans_code", F.array_join("active", ",").alias("active"))


def label_modes(spark, sf):
    return fx.transactions(spark, sf).select(
        "mios_trans_code",
        label_column(F.col("trans_stat")).alias("binary"),
        label_column(F.col("trans_amnt"), 1).alias("numeric"),
        label_column(F.col("bank_code"), 1).alias("not_numeric"),
    )


# Naive Bayes


def class_weights(spark, sf):
    parts = [
        bayes.class_weights(coded(spark, sf, kind)).select(F.lit(kind).alias("kind"), "label", "cnt", r6("weight"))
        for kind in ("trans_stat", "order_status")
    ]
    return parts[0].unionByName(parts[1])


def _priced(spark: SparkSession, sf: str) -> DataFrame:
    """Nearly as many classes as rows: numeric labels are prices, some predictions the price without cents."""
    price, line = F.col("l_extendedprice").cast("string"), F.col("l_linenumber")
    df = spark.read.parquet(f"{sf}/lineitem.parquet").select(label_column(price, 1).alias("label"), line.alias("line"))
    prediction = F.when(F.col("line") % 3 == 0, F.floor("label").cast("double")).otherwise(F.col("label"))
    return df.select("label", prediction.alias("prediction"))


def class_weights_many(spark, sf):
    table = bayes.class_weights(_priced(spark, sf))
    return table.select("label", "cnt", r6(F.col("weight") * 1_000_000, "weight_ppm"))


def metrics_many(spark, sf):
    out = evaluate.weighted_metrics(evaluate.confusion(_priced(spark, sf)))
    return out.select(*METRICS[:2], *[r6(n) for n in METRICS[2:6]], r6(F.col("fpr") * 1_000_000, "fpr_ppm"))


def check_features(spark, sf):
    df = spark.read.parquet(f"{sf}/lineitem.parquet").withColumns(
        {"returned": (F.col("l_returnflag") == "R").cast("int"), "gap": F.col("l_quantity") - 25}
    )
    return bayes.check_features(df, ["l_quantity", "l_discount", "returned", "gap"])


def nb_stats(spark, sf):
    out = bayes.nb_stats(coded(spark, sf), SLOTS, weight="w")
    return out.select("label", "slot", "code", r6("sum_w"))


def _model_rows(spark: SparkSession, model: bayes.Model) -> DataFrame:
    prior = bayes.prior_table(spark, model).select(
        "model_id", "round", "label", F.lit("").alias("slot"), F.lit("").alias("code"), r6("log_prior", "value")
    )
    theta = bayes.theta_table(model).select("model_id", "round", "label", "slot", "code", r6("log_theta", "value"))
    return prior.unionByName(theta)


def nb_model(spark, sf):
    parts = []
    for kind in ("trans_stat", "order_status"):
        model = bayes.fit_nb(coded(spark, sf, kind), SLOTS)
        parts.append(_model_rows(spark, model).drop("model_id", "round").withColumn("kind", F.lit(kind)))
    return parts[0].unionByName(parts[1])


def nb_plain(spark, sf):
    model = bayes.fit_nb(coded(spark, sf), SLOTS, weight="w", balanced=False, smoothing=0.5)
    return _model_rows(spark, model).drop("model_id", "round")


def nb_bernoulli(spark, sf):
    df = coded(spark, sf)
    scored = bayes.nb_score(df, bayes.fit_nb(df, SLOTS, kind=bayes.BERNOULLI))
    return _scores(scored)


def _scores(scored: DataFrame, *more: Column) -> DataFrame:
    return scored.select(
        "mios_trans_code", "prediction",
        r6(F.get("raw", F.lit(0)), "raw0"), r6(F.get("raw", F.lit(1)), "raw1"),
        r6(F.get("probability", F.lit(1)), "p1"), *more,
    )


def nb_custom_weights(spark, sf):
    model = bayes.fit_nb(coded(spark, sf), SLOTS, weights={0.0: 0.7, 1.0: 0.3})
    return _model_rows(spark, model).drop("model_id", "round")


def nb_score(spark, sf):
    df = coded(spark, sf)
    return _scores(bayes.nb_score(df, bayes.fit_nb(df, SLOTS)))


def nb_thresholds(spark, sf):
    df = coded(spark, sf)
    return _scores(bayes.nb_score(df, bayes.fit_nb(df, SLOTS), thresholds=[0.35, 0.65]))


def nb_values(spark, sf):
    df = spark.read.parquet(f"{sf}/lineitem.parquet").withColumns(
        {"label": (F.col("l_returnflag") == "R").cast("double"), "price": F.col("l_extendedprice") / 10000}
    )
    model = bayes.fit_nb_values(df, ["l_quantity", "l_tax", "price"])
    out = bayes.nb_score_values(df, model)
    return out.groupBy("label", "prediction").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(F.avg(F.get("raw", F.lit(0))), 6).alias("raw0"),
        F.round(F.avg(F.get("probability", F.lit(1))), 6).alias("p1"),
    )


# Boosting


def _rounds(spark: SparkSession, model: bayes.Model) -> DataFrame:
    return bayes.round_table(spark, model).select("model_id", "round", r6("error"), r6("alpha"))


def boost_rounds(spark, sf):
    return _rounds(spark, boost.fit_boost(coded(spark, sf), SLOTS, 4))


def boost_samme(spark, sf):
    return _rounds(spark, boost.fit_boost(coded(spark, sf), SLOTS, 3, alpha="samme"))


def boost_by_month(spark, sf):
    return _rounds(spark, boost.fit_boost(coded(spark, sf), SLOTS, 2, by="month_id"))


def boost_score(spark, sf):
    df = coded(spark, sf)
    scored = boost.boost_score(df, boost.fit_boost(df, SLOTS, 3))
    return _scores(scored, r6("confidence"))


# Year ensembles


def month_weights(spark, sf):
    df = fx.transactions(spark, sf)
    table = [
        (n, now, i + 1, w)
        for n, now in ((12, 1), (12, 8), (12, 12), (5, 8))
        for i, w in enumerate(ensemble.month_weights(n, now))
    ]
    weights = spark.createDataFrame(table, "n int, current_month int, month_id int, weight double")
    counts = df.groupBy("month_id").agg(F.count(F.lit(1)).alias("n_rows"))
    out = counts.join(F.broadcast(weights), "month_id")
    return out.select("n", "current_month", "month_id", r6("weight"), r6(F.col("weight") * F.col("n_rows"), "weighted"))


def _ensemble(df: DataFrame, rounds: int) -> ensemble.Ensemble:
    if rounds == 1:
        model, weights = bayes.fit_nb(df, SLOTS, by="month_id"), "equal"
    else:
        model, weights = boost.fit_boost(df, SLOTS, rounds, by="month_id"), ensemble.month_weights(12, fx.CURRENT_MONTH)
    return ensemble.build_ensemble(model, MONTHS, weights)


def _year(rounds: int, vote: str, prob: str | None):
    def run(spark, sf):
        df = coded(spark, sf)
        out = ensemble.ensemble_score(df, _ensemble(df, rounds), vote=vote, prob=prob)
        columns = ["mios_trans_code", "prediction", r6(F.get("raw", F.lit(1)), "votes1"),
                   r6(F.get("probability", F.lit(1)), "p1")]
        if prob:
            columns += [r6(F.get("prob", F.lit(1)), "prob1"), r6("confidence")]
        return out.select(*columns)

    return run


# Evaluation and reports


def key_split(spark, sf):
    return evaluate.split_by_key(fx.transactions(spark, sf), *jobs.KEY).select("mios_trans_code", "part")


def _predicted(spark, sf):
    df = coded(spark, sf)
    return bayes.nb_score(df, bayes.fit_nb(df, SLOTS))


def confusion(spark, sf):
    return evaluate.confusion(_predicted(spark, sf))


def metrics(spark, sf):
    done = _predicted(spark, sf)
    both = [evaluate.evaluate(done, as_published=p).withColumn("as_published", F.lit(p)) for p in (False, True)]
    out = both[0].unionByName(both[1])
    return out.select("as_published", *METRICS[:2], *[r6(n) for n in METRICS[2:]])


def softmax_shares_query(spark, sf):
    df = spark.read.parquet(f"{sf}/customer.parquet")
    scores = F.array(F.col("c_acctbal") / 1000, F.col("c_nationkey") / F.lit(3.0), F.lit(2.5))
    shares, percent = softmax_shares(scores)
    best = F.round(F.regexp_replace(percent, "%", "").cast("double"), 2)
    return df.select("c_custkey", shares.alias("s"), best.alias("best_percent")).select(
        "c_custkey", "best_percent", *[r6(F.get("s", F.lit(i)), f"share{i}") for i in range(3)]
    )


def attach_predictions(spark, sf):
    done = evaluate.split_by_key(_predicted(spark, sf), *jobs.KEY).where("part = 'test'")
    done = done.select(*jobs.KEY, F.col("prediction").alias("train_label"), r6(F.array_max("probability"), "train_accuracy"))
    base = fx.transactions(spark, sf).select("mios_trans_code", *jobs.KEY)
    return report.attach_predictions(base, done)


def decode_features(spark, sf):
    df = customers(spark, sf)
    codes = catalog_of(spark, df)
    out = encode.portrait(df, codes, jobs.model_features(fx.FEATURES))
    out = out.withColumn("features", F.concat_ws("_", "features", F.lit("99999")))
    return report.decode_features(out, codes).select("mios_trans_code", "features", "features_desc")


def cluster_assign(spark, sf):
    return cluster.assign_nearest(customers(spark, sf), fx.CENTERS).select("mios_trans_code", "acc_cust_km")


def cluster_report(spark, sf):
    out = cluster.cluster_report(customers(spark, sf), fx.CENTERS)
    return out.select("cluster", "n_rows", r6("cost"))


def cluster_train(spark, sf):
    """Train, save, load and assign; the report's rows must be those of the assignment."""
    df = customers(spark, sf)
    path = f"{shared_dir(spark)}/payscore-{uuid.uuid4().hex}"
    bisect.save_tree(spark, bisect.fit_tree(df, 4), path)
    tree = bisect.load_tree(spark, path)
    assigned = bisect.assign_tree(df, tree).groupBy("acc_cust_km").agg(F.count(F.lit(1)).alias("n_assigned"))
    made = bisect.tree_report(spark, tree).join(assigned, F.col("cluster") == F.col("acc_cust_km"), "left")
    centers = [F.round(F.get("center", F.lit(d)), 6).alias(f"center_{c}") for d, c in enumerate(tree.features)]
    return made.select("cluster", "n_rows", "n_assigned", r6("cost"), *centers)


def sinks_roundtrip(spark, sf):
    root = f"{shared_dir(spark)}/payscore-{uuid.uuid4().hex}"
    df = conform(fx.transactions(spark, sf), [*STAGED, "YEAR_ID", "MONTH_ID"])
    overwrite_partition(df, f"{root}/parts")
    overwrite_partition(df.where("year_id = 1997").withColumn("trans_stat", F.lit("9")), f"{root}/parts")
    write_table(df, f"{root}/whole")
    for fmt in ("csv", "json"):
        write_file(df, f"{root}/{fmt}", fmt)
    rows = coded(spark, sf)
    models.save_model(spark, boost.fit_boost(rows, SLOTS, 2), f"{root}/model")
    loaded = models.load_model(spark, f"{root}/model")
    sets = {
        "parts": spark.read.parquet(f"{root}/parts"),
        "whole": spark.read.parquet(f"{root}/whole"),
        "csv": spark.read.csv(f"{root}/csv", header=True),
        "json": spark.read.schema(df.schema).json(f"{root}/json"),
        "model": boost.boost_score(rows, loaded).select(F.col("prediction").cast("int").cast("string").alias("trans_stat")),
    }
    out = None
    for name, part in sets.items():
        part = part.groupBy("trans_stat").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("target", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


# Jobs


def _features(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.customer_features(fx.wide_transactions(spark, sf), fx.RANGES, fx.AS_OF_YEAR, fx.CENTERS)


def job_features(spark, sf):
    return _features(spark, sf).select(
        "mios_trans_code", "acc_cust_sex", "acc_cust_home", "acc_cust_age", "acc_cust_agerang",
        "acc_cust_instancetype", "acc_cust_amntrang", "acount_time_rang", "acc_cust_month", "acc_cust_day",
        "acc_cust_dayrang", "acc_cust_km", "kk_cnt",
    )


def job_features_trained(spark, sf):
    """The features with a clustering trained on one year, saved, and loaded by the job of all years."""
    tx = fx.wide_transactions(spark, sf)
    path = f"{shared_dir(spark)}/payscore-{uuid.uuid4().hex}"
    year = derive_customers(stage_year(tx, 1996), fx.RANGES, fx.AS_OF_YEAR)
    bisect.save_tree(spark, bisect.fit_tree(year, 4), path)
    tree = bisect.load_tree(spark, path)
    df = jobs.customer_features(tx, fx.RANGES, fx.AS_OF_YEAR, tree)
    costs = bisect.tree_report(spark, tree).select(F.col("cluster").alias("acc_cust_km"), r6("cost", "km_cost"))
    return df.join(F.broadcast(costs), "acc_cust_km", "left").select("mios_trans_code", "acc_cust_km", "kk_cnt", "km_cost")


def _prepared(spark: SparkSession, sf: str) -> tuple[DataFrame, Stored]:
    df = store(_features(spark, sf), UNMEASURED).df
    return df, catalog_of(spark, df)


def job_catalog(spark, sf):
    return _prepared(spark, sf)[1].df


def _shown(results: DataFrame, *more: Column) -> DataFrame:
    label, accuracy = F.col("train_label"), F.col("train_accuracy")
    if dict(results.dtypes)["train_accuracy"] == "string":
        # Two decimals of a percentage may fall on either side of a tie; compare the number.
        accuracy = F.regexp_replace(accuracy, "%", "").cast("double")
    return results.select("mios_trans_code", "features", label, r6(accuracy, "train_accuracy"), *more)


def job_train_month(spark, sf):
    return _shown(jobs.train_month(*_prepared(spark, sf), fx.FEATURES, 3).results)


def job_score_month(spark, sf):
    df, codes = _prepared(spark, sf)
    model = jobs.train_month(df, codes, fx.FEATURES, 2).model
    return _shown(jobs.score_month(df, codes, fx.FEATURES, model).results)


def _months(df: DataFrame, codes: Stored) -> bayes.Model:
    return jobs.month_models(df, codes, fx.FEATURES, n_rounds=2)


def job_train_year(spark, sf):
    df, codes = _prepared(spark, sf)
    done = jobs.train_year(df, codes, fx.FEATURES, _months(df, codes), MONTHS, fx.CURRENT_MONTH)
    return _shown(done.results)


def job_score_year(spark, sf):
    df, codes = _prepared(spark, sf)
    weights = ensemble.month_weights(12, fx.CURRENT_MONTH)
    blend = ensemble.build_ensemble(_months(df, codes), MONTHS, weights)
    return _shown(jobs.score_year(df, codes, fx.FEATURES, blend).results)


def job_display(spark, sf):
    df, codes = _prepared(spark, sf)
    done = jobs.train_month(df, codes, fx.FEATURES, 2).results
    shown = jobs.display(done, codes, 2001, fx.CURRENT_MONTH)
    return shown.withColumn("train_accuracy", F.round("train_accuracy", 6))


def job_display_published(spark, sf):
    """Two months of the display table, one of them replaced, read back."""
    df, codes = _prepared(spark, sf)
    root = f"{shared_dir(spark)}/payscore-{uuid.uuid4().hex}"
    done = store(jobs.train_month(df, codes, fx.FEATURES, 2).results).df
    jobs.publish_display(done.where("trans_stat = '1'"), codes, root, 2001, 7)
    jobs.publish_display(done.where("trans_stat = '0'"), codes, root, 2001, 8)
    jobs.publish_display(done, codes, root, 2001, 8)
    return spark.read.parquet(root).withColumn("train_accuracy", F.round("train_accuracy", 6))


def _batches(spark: SparkSession, sf: str, training: str) -> tuple[DataFrame, DataFrame]:
    """The features of the transactions to train with, and of all others, some of which were changed."""
    tx = fx.wide_transactions(spark, sf)
    later = fx.later_batch(tx.where(f"NOT ({training})"))
    first, others = (
        store(jobs.customer_features(part, fx.RANGES, fx.AS_OF_YEAR, fx.CENTERS), UNMEASURED).df for part in (tx.where(training), later)
    )
    return first, others


def _scored_later(spark: SparkSession, path: str, batch: DataFrame, year: bool) -> DataFrame:
    """The batch scored with nothing but what the training left in ``path``."""
    saved = jobs.load_saved(spark, path, year)
    results = jobs.score_batch(batch, saved, fx.FEATURES, fx.RANGES)[0].results
    return _shown(results, F.array_join("active", ",").alias("active"))


def score_unseen(spark, sf):
    first, others = _batches(spark, sf, TRAINING_MONTH)
    path = f"{shared_dir(spark)}/payscore-{uuid.uuid4().hex}"
    codes = catalog_of(spark, first)
    jobs.save_outcome(spark, jobs.train_month(first, codes, fx.FEATURES, 2), codes, path)
    return _scored_later(spark, path, others, year=False)


def _trained_year(df: DataFrame, codes: Stored) -> jobs.Outcome:
    return jobs.train_year(df, codes, fx.FEATURES, _months(df, codes), MONTHS, fx.CURRENT_MONTH)


def score_unseen_year(spark, sf):
    first, others = _batches(spark, sf, TRAINING_YEARS)
    path = f"{shared_dir(spark)}/payscore-{uuid.uuid4().hex}"
    codes = catalog_of(spark, first)
    jobs.save_outcome(spark, _trained_year(first, codes), codes, path)
    return _scored_later(spark, path, others, year=True)


def _saved_tables(spark: SparkSession, path: str, year: bool) -> DataFrame:
    """Metrics and dictionary that a training left, read back."""
    saved = jobs.load_saved(spark, path, year)
    measures = [F.struct(F.lit(n).alias("name"), F.round(F.col(n).cast("double"), 6).alias("value")) for n in METRICS]
    metrics = saved.metrics.select(F.inline(F.array(*measures))).select(
        F.lit("metrics").alias("part"), "name", F.lit("").alias("code"), F.lit("").alias("width"), "value"
    )
    dictionary = saved.dictionary.select(
        F.lit("dictionary").alias("part"), F.col("feature_code").alias("name"), F.col("feature_col_name").alias("code"),
        F.col("feature_vector_cnt").alias("width"), F.col("feature_vector_index").cast("double").alias("value"),
    )
    return metrics.unionByName(dictionary)


def job_month_tables(spark, sf):
    df, codes = _prepared(spark, sf)
    path = f"{shared_dir(spark)}/payscore-{uuid.uuid4().hex}"
    jobs.save_outcome(spark, jobs.train_month(df, codes, fx.FEATURES, 2), codes, path)
    return _saved_tables(spark, path, year=False)


def job_year_tables(spark, sf):
    """Metrics and dictionary of a year's training, and the predictions of its model, all read back."""
    df, codes = _prepared(spark, sf)
    path = f"{shared_dir(spark)}/payscore-{uuid.uuid4().hex}"
    jobs.save_outcome(spark, _trained_year(df, codes), codes, path)
    model = jobs.load_saved(spark, path, year=True).model
    shown = _shown(jobs.score_year(df, codes, fx.FEATURES, model).results)
    rows = shown.select(
        F.lit("predictions").alias("part"), F.col("mios_trans_code").alias("name"), F.col("features").alias("code"),
        F.col("train_label").cast("int").cast("string").alias("width"), F.col("train_accuracy").alias("value"),
    )
    return _saved_tables(spark, path, year=True).unionByName(rows)


def display(spark, sf):
    df = derive_customers(fx.wide_transactions(spark, sf), fx.RANGES, fx.AS_OF_YEAR)
    missing = [c for c in report.DISPLAY_COLUMNS if c not in df.columns]
    return report.display_columns(df.withColumns({c: F.lit("") for c in missing}))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "id_attributes": id_attributes,
    "date_parts": date_parts_query,
    "amount_bucket": _bucket("amnt_rang", lambda: F.col("trans_amnt")),
    "age_bucket": _bucket("age_rang", lambda: id_age(F.col("bankacc_id_type"), F.col("bankacc_id_no"), fx.AS_OF_YEAR)),
    "day_bucket": _bucket("date_rang", lambda: date_parts(F.col("plnmio_date"))[1].cast("string")),
    "bucket_many": bucket_many,
    "stage_month": stage_month_query,
    "stage_year": stage_year_query,
    "stage_for_scoring": stage_for_scoring_query,
    "read_partitions": read_partitions,
    "drop_header_lines": drop_header_lines_query,
    "job_load": job_load,
    "customer_frequency": customer_frequency,
    "dedup_month": dedup_month_query,
    "dedup_year": dedup_year_query,
    "active_features": active_features_query,
    "feature_values": feature_values_query,
    "feature_catalog": feature_catalog_query,
    "catalog_extend": catalog_extend,
    "portrait": portrait_query,
    "slot_explode": slot_explode,
    "slot_index": slot_index,
    "dictionary": dictionary,
    "encode_new": encode_new,
    "label_modes": label_modes,
    "class_weights": class_weights,
    "class_weights_many": class_weights_many,
    "check_features": check_features,
    "nb_stats": nb_stats,
    "nb_model": nb_model,
    "nb_plain": nb_plain,
    "nb_bernoulli": nb_bernoulli,
    "nb_custom_weights": nb_custom_weights,
    "nb_score": nb_score,
    "nb_thresholds": nb_thresholds,
    "nb_values": nb_values,
    "boost_rounds": boost_rounds,
    "boost_samme": boost_samme,
    "boost_by_month": boost_by_month,
    "boost_score": boost_score,
    "month_weights": month_weights,
    "year_vote": _year(2, "joint", None),
    "year_prob": _year(2, "joint", "blend"),
    "year_vote_of_votes": _year(2, "boost", "blend"),
    "year_equal": _year(1, "joint", "mean"),
    "key_split": key_split,
    "confusion": confusion,
    "metrics": metrics,
    "metrics_many": metrics_many,
    "softmax_shares": softmax_shares_query,
    "attach_predictions": attach_predictions,
    "decode_features": decode_features,
    "cluster_assign": cluster_assign,
    "cluster_report": cluster_report,
    "cluster_train": cluster_train,
    "display": display,
    "sinks_roundtrip": sinks_roundtrip,
    "job_features": job_features,
    "job_features_trained": job_features_trained,
    "job_catalog": job_catalog,
    "job_train_month": job_train_month,
    "job_score_month": job_score_month,
    "job_train_year": job_train_year,
    "job_score_year": job_score_year,
    "job_display": job_display,
    "job_display_published": job_display_published,
    "job_month_tables": job_month_tables,
    "job_year_tables": job_year_tables,
    "score_unseen": score_unseen,
    "score_unseen_year": score_unseen_year,
}
