"""Reading and staging transactions by month or year."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payscore.sources.sinks import overwrite_partition

# The columns of a bank-debit transaction, all text.
TRANSACTION_COLUMNS = """
mios_trans_code sys_no trans_code trans_bat_no trans_stat trans_bat_seq plnmio_rec_id
branch_bank_acc_no bank_code bank_sub_code bank_sub_name bank_prov_code bank_city_code
bank_acc_type bank_acc_no acc_cust_name bankacc_id_type bankacc_id_no mgr_branch_no cntr_no
ipsn_no trans_class mio_class mio_item_code plnmio_date mio_date trans_amnt cust_no
generate_date unite_trans_code ext01 ext02 ext03 ext04 ext05 bank_trans_stat
bank_trans_desc mio_cust_name gclk_branch_no gclk_clerk_code mio_tx_no
""".split()


#: Why a folder has nothing to read: it is not there, or holds no files yet.
_NOTHING = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _folder(spark: SparkSession, root: str, *parts: str) -> DataFrame | None:
    """The files of one partition folder, with the columns its path stands for; None if there is nothing to read."""
    try:
        return spark.read.option("basePath", root).parquet("/".join([root.rstrip("/"), *parts]))
    except AnalysisException as error:
        if error.getCondition() not in _NOTHING:
            raise
        return None


def read_year(spark: SparkSession, root: str, year: int) -> DataFrame:
    """All months of a year below ``root/year_id=…/month_id=…``; other folders are neither listed nor read."""
    found = _folder(spark, root, f"year_id={year}")
    # A year written in another way is found by its value.
    return (spark.read.parquet(root) if found is None else found).where(F.col("year_id") == year)


def read_month(spark: SparkSession, root: str, year: int, month: int) -> DataFrame:
    """One month below ``root/year_id=…/month_id=…``; a month without files gives no rows.

    Only this month's files are read, whether its folder is spelled with one digit, with two, or there are both.
    """
    return read_year(spark, root, year).where(F.col("month_id") == month)


def _months_of(spark: SparkSession, root: str, year: int) -> set[int]:
    """The months of a year that have files, from their folders' names."""
    found = _folder(spark, root, f"year_id={year}")
    files = [] if found is None else found.inputFiles()
    return {int(m[1]) for m in (re.search(r"/month_id=(\d+)/[^/]*$", f) for f in files) if m}


def attach_months(
    spark: SparkSession,
    raw: str,
    root: str,
    year: int,
    months: Sequence[int],
    columns: Sequence[str] = TRANSACTION_COLUMNS,
    fmt: str = "parquet",
) -> list[int]:
    """Publish raw months as partitions of ``root``, each once; the months that were published.

    ``raw`` names the folder of a month with ``{year}`` and ``{month}`` in it. A month that is there already
    stays as it is, whatever its raw folder holds by now; one without a raw folder is left out. All new months
    go in one write, which puts its files aside and moves whole partitions in place when it is done, so a job
    that is lost half-way leaves nothing that counts as there.
    """
    new, parts, there = [], [], _months_of(spark, root, year)
    for month in months:
        if month in there:
            continue
        try:
            rows = spark.read.format(fmt).option("header", "true").load(raw.format(year=year, month=month))
        except AnalysisException as error:
            if error.getCondition() not in _NOTHING:
                raise
            continue
        new.append(month)
        parts.append(conform(rows, columns).withColumns({"year_id": F.lit(year), "month_id": F.lit(month)}))
    if parts:
        overwrite_partition(reduce(DataFrame.unionByName, parts), root)
    return new


def conform(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns in the given order, whatever their case in ``df``."""
    return df.select(*[F.col(c).alias(c.lower()) for c in columns])


def stage_month(df: DataFrame, year: int, month: int, columns: Sequence[str] | None = None) -> DataFrame:
    return stage_year(df.where(F.col("month_id") == month), year, columns)


def stage_year(df: DataFrame, year: int, columns: Sequence[str] | None = None) -> DataFrame:
    rows = df.where(F.col("year_id") == year)
    return conform(rows, columns) if columns else rows


def stage_for_scoring(
    df: DataFrame, year: int, month: int, columns: Sequence[str] | None = None, label: str = "trans_stat"
) -> DataFrame:
    """A staged month whose label is overwritten with ``"1"``, as its outcome is not known yet."""
    return stage_month(df, year, month, columns).withColumn(label, F.lit("1"))


def drop_header_lines(df: DataFrame, marker: str, column: str = "value") -> DataFrame:
    """Text lines that are not a header, that is, do not contain ``marker``. Null lines stay."""
    return df.where(~F.coalesce(F.contains(F.col(column), F.lit(marker)), F.lit(False)))
