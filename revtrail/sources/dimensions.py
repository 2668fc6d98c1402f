"""Date dimension and sales rep dimension."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtrail.functions.dates import CALENDAR

def date_spine(tables: list[DataFrame], first: date, last: date) -> DataFrame:
    """One row per day with its calendar attributes, from the earliest to the latest of the
    `date`s in the given tables, but not before `first` or after `last`.

    Without any date the days are those of the settings.
    """
    ends = [rows.agg(F.min("date").alias("start"), F.max("date").alias("end")) for rows in tables]
    whole = reduce(DataFrame.unionByName, ends).agg(
        F.greatest(F.min("start"), F.lit(first)).alias("start"), F.least(F.max("end"), F.lit(last)).alias("end")
    )
    days = whole.where("start <= end").select(
        F.explode(F.sequence("start", "end", F.expr("interval 1 day"))).alias("date")
    )
    return days.select("date", *[f(F.col("date")).alias(name) for name, f in CALENDAR.items()])
