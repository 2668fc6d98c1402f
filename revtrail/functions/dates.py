"""Calendar labels: day, month, quarter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_label(day: Column) -> Column:
    """'2025-03'"""
    return F.date_format(day, "yyyy-MM")


def quarter_name(day: Column) -> Column:
    """'Q1', without the year."""
    return F.concat(F.lit("Q"), F.quarter(day).cast("string"))


def quarter_label(day: Column) -> Column:
    """'2025-Q1'"""
    return F.concat(F.year(day).cast("string"), F.lit("-"), quarter_name(day))


def month_index(day: Column) -> Column:
    """Months on one running count, so that neighbours differ by one."""
    return F.year(day) * 12 + F.month(day)


# Attributes of a calendar day, in the order of the date dimension.
CALENDAR = {
    "year": F.year,
    "quarter": quarter_name,
    "month_num": F.month,
    "month_name": lambda day: F.date_format(day, "MMMM"),
    "week_num": F.weekofyear,
    "is_weekday": lambda day: F.weekday(day) < 5,
    "month": month_label,
    "quarter_label": quarter_label,
}
