"""Integer date keys and date parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """Date to ``YYYYMMDD``."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def key_to_date(key: Column) -> Column:
    """``YYYYMMDD`` back to a date; an impossible key becomes null."""
    return F.try_to_date(key.cast("string"), "yyyyMMdd")


def month_key(key: Column) -> Column:
    """``YYYYMMDD`` to ``YYYYMM``."""
    return F.floor(key / F.lit(100)).cast("int")


def parse_report_date(text: Column) -> Column:
    """``yyyy-M-d`` only; other shapes, including a trailing time, become null.

    Full ten-digit dates, the usual case, take the plain cast. Only texts with the shape of a date reach the pattern, which raises
    and drops an exception for each text that it refuses.
    """
    value = text.cast("string")
    by_pattern = F.try_to_timestamp(value, F.lit("yyyy-M-d")).cast("date")
    return F.when(value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), value.try_cast("date")).when(value.rlike(r"(?s)[0-9].*-.*[0-9].*-.*[0-9]"), by_pattern)


def age_in_years(birth: Column, reference: Column) -> Column:
    return F.datediff(reference, birth) / F.lit(365.25)
