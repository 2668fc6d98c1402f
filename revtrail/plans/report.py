"""Tables behind the report pages: one function per visual."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revtrail.functions.deals import is_open, is_won, sign_colour, traffic_light
from revtrail.functions.numbers import percent, ratio
from revtrail.operators import forecast
from revtrail.operators.measures import evaluate, rolling_closed_arr
from revtrail.params import QUALIFIED

# Thresholds of the coloured figures.
WIN_RATE_GOOD, WIN_RATE_FAIR = 0.60, 0.45
COVERAGE_GOOD, COVERAGE_FAIR = 3.0, 2.0
CAC_GOOD, CAC_POOR = 10.0, 5.0


def _scaled(value: Column, low: Column, high: Column) -> Column:
    """Place of a value between the least (0) and the greatest (1)."""
    return ratio(value.cast("double") - low.cast("double"), high.cast("double") - low.cast("double"))


def _scaled_by_window(name: str) -> Column:
    # Only for tables with one row per label, owner, month or quarter.
    everything = Window.partitionBy()
    return _scaled(F.col(name), F.min(name).over(everything), F.max(name).over(everything))


# Executive summary ---------------------------------------------------------


def exec_kpis(ds) -> DataFrame:
    names = ["closed_won_arr", "win_rate", "avg_deal_size", "pipeline_coverage"]
    return evaluate(ds, names).select(
        "*",
        traffic_light(F.col("win_rate"), WIN_RATE_GOOD, WIN_RATE_FAIR).alias("win_rate_colour"),
        traffic_light(F.col("pipeline_coverage"), COVERAGE_GOOD, COVERAGE_FAIR).alias(
            "coverage_colour"
        ),
    )


def exec_qtd_gauge(ds) -> DataFrame:
    target = F.lit(ds.params.quarterly_target)
    return evaluate(ds, ["qtd_arr"]).select(
        "qtd_arr", target.alias("target"), ratio(F.col("qtd_arr"), target).alias("attainment")
    )


def exec_arr_trend(ds) -> DataFrame:
    return rolling_closed_arr(ds)


def exec_arr_by_segment(ds) -> DataFrame:
    """Won value of the opportunities whose deals carry each segment, and its share."""
    total = F.sum("closed_won_arr").over(Window.partitionBy())
    return evaluate(ds, ["closed_won_arr"], ["customer_segment"]).select(
        "*", ratio(F.col("closed_won_arr"), total).alias("share_of_total")
    )


def exec_arr_by_region(ds) -> DataFrame:
    return evaluate(ds, ["closed_won_arr"], ["region"])


# Funnel and conversion -----------------------------------------------------


def funnel_steps(ds) -> DataFrame:
    """Leads, qualified, opportunities and won as rows, each against the step before."""
    leads = ds.leads_clean.agg(
        F.count(F.lit(1)).alias("Leads"),
        F.count_if(F.col("lead_status") == QUALIFIED).alias("Qualified"),
    )
    opps = ds.opportunities_clean(["stage"]).agg(
        F.count(F.lit(1)).alias("Opportunities"),
        F.count_if(is_won(F.col("stage"))).alias("Closed Won"),
    )
    steps = leads.unpivot([], ["Leads", "Qualified"], "step", "n").unionByName(
        opps.unpivot([], ["Opportunities", "Closed Won"], "step", "n")
    )
    order = F.array_position(
        F.array(*[F.lit(s) for s in ("Leads", "Qualified", "Opportunities", "Closed Won")]), F.col("step")
    ).cast("int")
    # Four rows.
    before = F.lag("n").over(Window.orderBy("step_no"))
    return steps.withColumn("step_no", order).select(
        "step_no", "step", "n", percent(F.col("n"), before).alias("pct_of_previous")
    )


def conversion_rates(ds) -> DataFrame:
    return evaluate(ds, ["lead_qualified_rate", "win_rate"])


def conversion_by_source(ds) -> DataFrame:
    """Counts per lead source, the source with most wins marked, with data bars."""
    counts = evaluate(ds, ["total_leads", "qualified_leads", "closed_won_count"], ["lead_source"])
    # The window runs over one row per lead source.
    place = F.rank().over(Window.orderBy(F.desc("closed_won_count")))
    return counts.select(
        "*",
        (place == 1).alias("is_best"),
        _scaled_by_window("closed_won_count").alias("won_bar"),
    )


def stage_dropoff(ds) -> DataFrame:
    return evaluate(ds, ["total_opportunities"], ["stage"])


# Forecast against target ---------------------------------------------------


def forecast_variance_kpis(ds) -> DataFrame:
    return evaluate(ds, ["forecast_variance", "forecast_variance_rate"]).select(
        "*", sign_colour(F.col("forecast_variance")).alias("colour")
    )


def forecast_columns() -> list[str]:
    return ["stage", "arr_value", "close_probability", "created_date"]


def forecast_matrix(ds) -> DataFrame:
    """Quarterly forecast with the place of each variance on a red to green scale."""
    summary = forecast.forecast_summary(ds.opportunities_clean(forecast_columns()), ds.params)
    return summary.select("*", _scaled_by_window("variance_pct").alias("variance_scale"))


def coverage_by_stage(ds) -> DataFrame:
    rows = evaluate(ds, ["open_pipeline_arr"], ["stage"])
    return rows.where(is_open(F.col("stage")))


# Reps ----------------------------------------------------------------------
# Counting runs per owner; the rep table, which may be long, joins afterwards.


def _by_owner(ds, *measures: str) -> DataFrame:
    return evaluate(ds, measures, ["owner_id"])


def rep_leaderboard(ds) -> DataFrame:
    """Results per owner with the win rate's place on a red to green scale."""
    rows = _by_owner(
        ds, "closed_won_count", "closed_won_arr", "win_rate", "avg_days_to_close", "stalled_arr"
    )
    # The window runs over one row per owner.
    scaled = rows.withColumn("win_rate_scale", _scaled_by_window("win_rate"))
    return scaled.join(ds.reps.select("owner_id", "rep_name"), "owner_id", "left")


def rep_quota_attainment(ds) -> DataFrame:
    """Won value against annual quota for every rep, also those without a deal."""
    arr = F.coalesce(F.col("closed_won_arr"), F.lit(0))
    won = _by_owner(ds, "closed_won_arr")
    return ds.reps.join(won, "owner_id", "left").select(
        "owner_id",
        "rep_name",
        arr.alias("closed_won_arr"),
        "annual_quota",
        ratio(arr, F.col("annual_quota")).alias("attainment"),
        (arr >= F.col("annual_quota")).alias("quota_met"),
    )


def rep_velocity_scatter(ds) -> DataFrame:
    rows = _by_owner(ds, "avg_days_to_close", "win_rate", "closed_won_arr")
    return rows.join(ds.reps.select("owner_id", "rep_name"), "owner_id", "left")


# Customer segments ---------------------------------------------------------


def arr_vs_cac_by_source(ds) -> DataFrame:
    return evaluate(ds, ["avg_deal_size", "avg_cac"], ["lead_source"])


def cac_efficiency_by_segment(ds) -> DataFrame:
    """Won value per acquisition cost: green from 10 on, red below 5."""
    rows = evaluate(ds, ["cac_efficiency"], ["customer_segment"])
    return rows.select(
        "*", traffic_light(F.col("cac_efficiency"), CAC_GOOD, CAC_POOR).alias("colour")
    )


def won_by_size_band(ds) -> DataFrame:
    return evaluate(ds, ["closed_won_count"], ["deal_size_band"])


# Slicers -------------------------------------------------------------------


def sliced_kpis(ds, filters: dict) -> DataFrame:
    """Headline figures under a set of slicers."""
    names = ["total_leads", "closed_won_arr", "win_rate", "avg_cac", "open_pipeline_arr"]
    return evaluate(ds, names, filters=filters)
