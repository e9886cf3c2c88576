"""Dates kept as yyyyMMdd integers or text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_flexible(col: Column) -> Column:
    """8 digits as a day, 6 digits as the first of a month, anything else NULL."""
    text = col.cast("string")
    return F.when(F.length(text) == 8, F.try_to_date(text, "yyyyMMdd")).when(
        F.length(text) == 6, F.try_to_date(F.concat(text, F.lit("01")), "yyyyMMdd")
    )


def parse_day(col: Column) -> Column:
    """yyyyMMdd or NULL."""
    return F.try_to_date(col.cast("string"), "yyyyMMdd")


def month_of(col: Column) -> Column:
    """yyyy-MM text of a yyyyMMdd value, NULL when it is no date."""
    return F.date_format(parse_day(col), "yyyy-MM")


def span_months(lo: Column, hi: Column) -> Column:
    return F.floor(F.months_between(hi, lo)).cast("int")


def span_days(lo: Column, hi: Column) -> Column:
    """Days left over after the whole months between two dates."""
    return F.date_diff(hi, F.add_months(lo, span_months(lo, hi)))


def looks_like_month(col: Column) -> Column:
    return col.rlike(r"^\d{4}-\d{2}")
