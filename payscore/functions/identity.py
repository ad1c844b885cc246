"""Region, sex and age from an ID number, and parts of a date.

IDs of type ``I`` carry the facts: six region digits, then the birth date with a two-digit
year (length 15) or a four-digit year (length 18). Every other ID gets fixed defaults.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What an ID without facts counts as.
NO_REGION = "111111"
NO_SEX = "1"
NO_AGE = "1"
# Fixed value: a whole date, with or without a time of day.
FULL_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}(?:[ T][0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]+)?)?)?$"


def _as_int(text: Column, strict: bool) -> Column:
    return text.cast("int") if strict else text.try_cast("int")


def _has_facts(id_type: Column, id_no: Column) -> Column:
    return (id_type == "I") & F.length(id_no).isin(15, 18)


def id_region(id_type: Column, id_no: Column) -> Column:
    return F.when(_has_facts(id_type, id_no), F.substring(id_no, 1, 6)).otherwise(NO_REGION)


def id_sex(id_type: Column, id_no: Column, strict: bool = False) -> Column:
    """Parity of the next-to-last character, for both lengths. ``strict`` fails on a non-digit."""
    digit = F.when(_has_facts(id_type, id_no), _as_int(F.substring(id_no, -2, 1), strict))
    return F.coalesce((digit % 2).cast("string"), F.lit(NO_SEX))


def id_age(id_type: Column, id_no: Column, as_of_year: int, strict: bool = False) -> Column:
    """Years from the birth year to ``as_of_year``. ``strict`` fails on a non-digit."""
    year = F.when(F.length(id_no) == 15, F.concat(F.lit("19"), F.substring(id_no, 7, 2))).otherwise(
        F.substring(id_no, 7, 4)
    )
    born = F.when(_has_facts(id_type, id_no), _as_int(year, strict))
    return F.coalesce((F.lit(as_of_year) - born).cast("string"), F.lit(NO_AGE))


def date_parts(date: Column, strict: bool = False) -> tuple[Column, Column]:
    """Month and day of month of a ``yyyy-MM-dd`` text, with or without a time; null when it is anything else."""
    text = date.cast("string")
    if strict:
        day = F.to_date(F.when(F.rlike(text, F.lit(FULL_DATE)), F.substring(text, 1, 10)).otherwise(text), "yyyy-MM-dd")
    else:
        day = F.when(F.rlike(text, F.lit(FULL_DATE)), F.substring(text, 1, 10)).try_cast("date")
    return F.month(day), F.dayofmonth(day)
