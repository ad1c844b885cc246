"""Example inputs: transactions made from the order tables, and their configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payscore.shared import Stored, lookup
from payscore.sources.config import Feature, Range
from payscore.sources.staging import TRANSACTION_COLUMNS

AS_OF_YEAR = 2017
CURRENT_MONTH = 8

# The example transactions, as text both Spark and other SQL engines run.
TRANSACTIONS_SQL = """
SELECT lpad(cast(o_orderkey AS string), 12, '0') AS mios_trans_code,
 'T' || cast(o_orderkey AS string) AS trans_code,
 'B' || cast(year(o_orderdate)*100 + month(o_orderdate) AS string) AS trans_bat_no,
 CASE WHEN o_orderkey % 401 = 0 THEN NULL WHEN o_custkey % 10 = 0 THEN 'P' ELSE 'I' END AS bankacc_id_type,
 CASE WHEN o_custkey % 10 = 0 THEN 'P' || cast(o_custkey AS string)
      WHEN o_custkey % 97 = 0 THEN '12345'
      WHEN o_custkey % 7 = 0 THEN cast(110000 + c_nationkey AS string) || lpad(cast(40 + o_custkey % 55 AS string),2,'0') || lpad(cast(1 + o_custkey % 12 AS string),2,'0') || lpad(cast(1 + o_custkey % 28 AS string),2,'0') || lpad(cast(o_custkey % 1000 AS string),3,'0')
      ELSE cast(110000 + c_nationkey AS string) || cast(1940 + o_custkey % 60 AS string) || lpad(cast(1 + o_custkey % 12 AS string),2,'0') || lpad(cast(1 + o_custkey % 28 AS string),2,'0') || lpad(cast(o_custkey % 1000 AS string),3,'0') || 'X' END AS bankacc_id_no,
 CASE WHEN o_orderkey % 503 = 0 THEN '' WHEN o_orderkey % 509 = 0 THEN NULL ELSE cast(o_totalprice AS string) END AS trans_amnt,
 cast(cast(o_orderdate AS date) AS string) AS plnmio_date,
 o_orderpriority AS bank_code, c_mktsegment AS mio_class, cast(c_nationkey AS string) AS mgr_branch_no,
 year(o_orderdate) AS year_id, month(o_orderdate) AS month_id,
 CASE WHEN (CASE WHEN o_totalprice > 300000 OR (c_mktsegment = 'BUILDING' AND day(o_orderdate) <= 10) OR (o_orderpriority = '1-URGENT' AND o_totalprice > 150000) THEN 1 ELSE 0 END + CASE WHEN (o_orderkey * 7919) % 11 = 0 THEN 1 ELSE 0 END) % 2 = 1 THEN '1' ELSE '0' END AS trans_stat,
 o_orderstatus AS order_status
FROM orders JOIN customer ON o_custkey = c_custkey
"""

# Ord, feature_code, flag, start, end, code, desc.
RANGES = [
    Range(1, "21000", "amnt_rang", 0, 100000, "1", "to 100k"),
    Range(2, "21000", "amnt_rang", 100000, 200000, "2", "100k-200k"),
    Range(3, "21000", "amnt_rang", 200000, 300000, "3", "200k-300k"),
    Range(4, "21000", "amnt_rang", 300000, 1000000, "4", "over 300k"),
    Range(5, "11000", "age_rang", 0, 20, "1", "to 20"),
    Range(6, "11000", "age_rang", 20, 40, "2", "21-40"),
    Range(7, "11000", "age_rang", 40, 60, "3", "41-60"),
    Range(8, "11000", "age_rang", 60, 200, "4", "over 60"),
    Range(9, "31000", "date_rang", 0, 10, "1", "early"),
    Range(10, "31000", "date_rang", 10, 20, "2", "middle"),
    Range(11, "31000", "date_rang", 20, 31, "3", "late"),
]
OVERLAP = Range(12, "21000", "amnt_rang", 50000, 150000, "9", "overlap")

# Idx, col_name, pcode, desc, feature_flag, model_flag.
FEATURES = [
    Feature(1, "acc_cust_agerang", "11000", "age", 1, 0),
    Feature(2, "acc_cust_sex", "12000", "sex", 1, 0),
    Feature(3, "acc_cust_amntrang", "21000", "amount", 1, 0),
    Feature(4, "bank_code", "22000", "bank", 1, 0),
    Feature(5, "mio_class", "23000", "class", 1, 0),
    Feature(6, "acc_cust_dayrang", "31000", "day", 1, 1),
    Feature(7, "acc_cust_month", "32000", "month", 1, 2),
    Feature(8, "mgr_branch_no", "24000", "branch", 0, 0),
]

# Centers for clustering by (amount, sex, age, day) bucket.
CENTERS = [(1.0, 0.25, 2.0, 1.5), (3.5, 0.75, 2.5, 2.0), (2.0, 0.5, 3.5, 2.75), (2.25, 1.0, 0.5, 1.25)]


def features_config(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        FEATURES, "idx int, col_name string, pcode string, desc string, feature_flag int, model_flag int"
    )


def ranges_config(spark: SparkSession) -> DataFrame:
    rows = [r._replace(start=float(r.start), end=float(r.end)) for r in [*RANGES, OVERLAP]]
    return spark.createDataFrame(
        rows, "ord int, feature_code string, flag string, start double, end double, code string, desc string"
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The example transactions of a data folder; only the columns asked for are read."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_nationkey", "c_mktsegment")
    joined = lookup(orders, Stored(customer, customer.count(), 64), {"o_custkey": "c_custkey"}, how="inner")
    chosen = TRANSACTIONS_SQL[: TRANSACTIONS_SQL.index("FROM orders")]
    return spark.sql(chosen + "FROM {joined}", joined=joined)


def wide_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As :func:`transactions`, with all transaction columns; the rest are constants or copies."""
    df = transactions(spark, sf_dir)
    copies = {
        "sys_no": F.lit("S1"),
        "acc_cust_name": F.concat(F.lit("N"), F.col("bankacc_id_no")),
        "mio_date": F.col("plnmio_date"),
    }
    rest = {c: copies.get(c, F.lit("")) for c in TRANSACTION_COLUMNS if c not in df.columns}
    return df.withColumns(rest).select(*TRANSACTION_COLUMNS, "year_id", "month_id")


# A later batch has dates that are missing and a bank that is new, as text both engines run.
LATER_SQL = {
    "plnmio_date": "CASE WHEN cast(mios_trans_code AS bigint) % 601 = 0 THEN NULL ELSE plnmio_date END",
    "bank_code": "CASE WHEN cast(mios_trans_code AS bigint) % 199 = 0 THEN 'NEW BANK' ELSE bank_code END",
}


def later_batch(transactions: DataFrame) -> DataFrame:
    return transactions.withColumns({c: F.expr(e) for c, e in LATER_SQL.items()})
