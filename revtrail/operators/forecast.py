"""Probability-weighted revenue forecast against target."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revtrail.functions.dates import month_label, quarter_label
from revtrail.functions.deals import is_open, weighted_points
from revtrail.functions.numbers import rounded_ratio
from revtrail.params import Params


def _open_points(opps: DataFrame, label) -> DataFrame:
    """Exact sum of value times probability points per calendar label."""
    points = weighted_points(F.col("arr_value"), F.col("close_probability"))
    return (
        opps.where(is_open(F.col("stage")) & F.col("created_date").isNotNull())
        .groupBy(label(F.col("created_date")).alias("period"))
        .agg(F.coalesce(F.sum(points), F.lit(0)).alias("points"))
    )


def forecast_monthly(opps: DataFrame, params: Params) -> DataFrame:
    """Expected value per month of creation, its confidence band and running total."""
    monthly = _open_points(opps, month_label)
    # The window runs over one row per month.
    so_far = Window.orderBy("period").rowsBetween(Window.unboundedPreceding, 0)
    points, hundred = F.col("points"), F.lit(100)
    band = F.lit(Decimal(str(params.confidence)))
    return monthly.select(
        F.col("period").alias("month"),
        rounded_ratio(points, hundred, 2).alias("forecast_arr"),
        rounded_ratio(points * (1 - band), hundred, 2).alias("lower_arr"),
        rounded_ratio(points * (1 + band), hundred, 2).alias("upper_arr"),
        F.lit(params.quarterly_target / 3).alias("target_arr"),
        rounded_ratio(F.sum("points").over(so_far), hundred, 2).alias("cumulative_arr"),
    ).orderBy("month")


def forecast_summary(opps: DataFrame, params: Params) -> DataFrame:
    """Expected value per quarter of creation against the quarterly target."""
    quarterly = _open_points(opps, quarter_label)
    target = F.lit(params.quarterly_target)
    points, hundred = F.col("points"), F.lit(100)
    # In hundredths, so that the share is one division.
    gap = points - target * 100
    return quarterly.select(
        F.col("period").alias("quarter"),
        rounded_ratio(points, hundred, 4).alias("forecast_arr"),
        target.alias("target"),
        rounded_ratio(gap, hundred, 4).alias("variance_abs"),
        rounded_ratio(gap, target, 1, even=True).alias("variance_pct"),
    ).orderBy("quarter")
