"""Customer attributes from staged transactions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payscore.functions import bucketize, date_parts, id_age, id_region, id_sex
from payscore.sources.config import Range

# Attributes that are the same for every row.
INSTANCE_TYPE = "0"
TIME_RANG = "1"


def derive_customers(df: DataFrame, ranges: Sequence[Range], as_of_year: int, strict: bool = False) -> DataFrame:
    """Add the ten customer attributes, all text.

    A pure projection: no shuffle, and columns nobody asks for are pruned down to the scan.
    """
    id_type, id_no = F.col("bankacc_id_type"), F.col("bankacc_id_no")
    month, day = date_parts(F.col("plnmio_date"), strict)
    return df.withColumns(
        {
            "acc_cust_sex": id_sex(id_type, id_no, strict),
            "acc_cust_home": id_region(id_type, id_no),
            "acc_cust_age": id_age(id_type, id_no, as_of_year, strict),
            "acc_cust_instancetype": F.lit(INSTANCE_TYPE),
            "acc_cust_amntrang": bucketize(F.col("trans_amnt"), ranges, "amnt_rang", strict),
            "acount_time_rang": F.lit(TIME_RANG),
            "acc_cust_month": month.cast("string"),
            "acc_cust_day": day.cast("string"),
        }
    ).withColumns(
        {
            "acc_cust_agerang": bucketize(F.col("acc_cust_age"), ranges, "age_rang", strict),
            "acc_cust_dayrang": bucketize(F.col("acc_cust_day"), ranges, "date_rang", strict),
        }
    )
