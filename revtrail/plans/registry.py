"""Every answer under its name, as a function of a session and a test data folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from revtrail.operators import (
    analytics,
    cleaning,
    features,
    forecast,
    measures,
    quality,
    segments,
    star,
)
from revtrail.operators.measures import Between, evaluate
from revtrail.plans import report
from revtrail.plans.dataset import Dataset
from revtrail.sources.schemas import schema_of, typed

Answer = Callable[[Dataset], DataFrame]

FORECAST = report.forecast_columns()
SLICERS = {
    "close_date": Between(date(1996, 1, 1), date(1999, 12, 31)),
    "region": ["EUROPE", "ASIA"],
    "lead_source": ["BUILDING", "MACHINERY"],
    "team": ["Enterprise", "SMB"],
}

# A date slicer alone, and three centres of raw deal value, cost and days.
DATES = {"close_date": Between(date(1998, 2, 1), date(1999, 5, 20))}
FIXED_CENTRES = [(320_000.0, 30_000.0, 45.0), (150_000.0, 12_000.0, 40.0), (40_000.0, 2_000.0, 20.0)]


def presented(rows: DataFrame) -> DataFrame:
    """Money as plain numbers, which every consumer of a result reads alike."""
    return rows.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, DecimalType)
            else F.col(f.name)
            for f in rows.schema.fields
        ]
    )


def _typed_import(ds: Dataset) -> DataFrame:
    """Opportunities as a text file would bring them, given their types back."""
    raw = ds.opportunities
    text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    return typed(text, "opportunities")


def _clean_tables(ds: Dataset) -> dict[str, DataFrame]:
    return {
        "leads_clean": ds.leads_clean,
        "opportunities_clean": ds.opportunities_clean(),
        "closed_deals_clean": ds.deals_clean,
    }


def _from_text(rows: DataFrame, table: str) -> DataFrame:
    """A table as a text file would bring it, truth values as 0 and 1, given its types back."""
    names = schema_of(table).names
    kinds = dict(rows.dtypes)
    text = [F.col(c).cast("int") if kinds[c] == "boolean" else F.col(c) for c in names]
    return typed(rows.select(*[t.cast("string").alias(c) for c, t in zip(names, text)]), table)


def _modelled(ds: Dataset) -> DataFrame:
    return ds.opportunity_view([*cleaning.OPPORTUNITY_COLUMNS, *star.FEATURES])


def _forecast_summary(ds: Dataset) -> DataFrame:
    return forecast.forecast_summary(ds.opportunities_clean(FORECAST), ds.params)


def _segment_features(ds: Dataset) -> DataFrame:
    return ds.deal_view(["deal_id", "customer_segment", *segments.FEATURE_COLUMNS])


def _fixed_clusters(ds: Dataset) -> DataFrame:
    """Deals with the nearest of three given centres in raw feature values."""
    rows = _segment_features(ds).select("deal_id", *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(segments.FEATURE_COLUMNS)])
    whole = rows.where(" and ".join(f"_x{i} is not null" for i in range(len(segments.FEATURE_COLUMNS))))
    return segments.assigned_to(whole, FIXED_CENTRES)


def _named_by_segment(ds: Dataset) -> DataFrame:
    """Archetype names for a given assignment: the customer segment as the cluster."""
    position = (
        F.when(F.col("customer_segment") == "SMB", 0)
        .when(F.col("customer_segment") == "Mid-Market", 1)
        .otherwise(2)
    )
    return segments.name_clusters(
        segments.cluster_profile(_segment_features(ds).withColumn("cluster", position))
    )


def _measure(name: str, *axis: str, **how) -> Answer:
    return lambda ds: evaluate(ds, [name], axis, **how)


ANSWERS: dict[str, Answer] = {
    # raw tables, import, dimensions
    "raw_leads": lambda ds: ds.leads,
    "raw_opportunities": lambda ds: ds.opportunities,
    "raw_closed_deals": lambda ds: ds.closed_deals,
    "typed_import": _typed_import,
    "typed_leads_clean": lambda ds: _from_text(ds.leads_clean, "leads_clean"),
    "typed_opportunities_modelled": lambda ds: _from_text(_modelled(ds), "opportunities_modelled"),
    "typed_closed_deals_clean": lambda ds: _from_text(ds.deals_clean, "closed_deals_clean"),
    "typed_dim_rep": lambda ds: _from_text(ds.reps, "dim_rep"),
    "typed_dim_date": lambda ds: _from_text(ds.dim_date, "dim_date"),
    "typed_forecast_summary": lambda ds: _from_text(_forecast_summary(ds), "forecast_summary"),
    "dim_rep": lambda ds: ds.reps,
    "dim_date": lambda ds: ds.dim_date,
    # profiles and audits
    "null_profile": lambda ds: quality.null_profile(
        {
            "leads": ds.leads,
            "opportunities": ds.opportunities,
            "closed_deals": ds.closed_deals,
        }
    ),
    "duplicate_leads": lambda ds: quality.duplicate_keys(ds.leads, "lead_id"),
    "duplicate_lead_total": lambda ds: quality.duplicate_key_total(ds.leads, "lead_id"),
    "won_missing_close_date": lambda ds: quality.won_missing_close_date(ds.opportunities),
    "arr_outliers": lambda ds: quality.arr_outliers(ds.opportunities, ds.params),
    "clean_row_counts": lambda ds: quality.row_counts(_clean_tables(ds)),
    "imputation_audit": lambda ds: quality.imputation_audit(ds.opportunities_clean()),
    "band_conformance": lambda ds: quality.band_conformance(ds.opportunities),
    "relationship_integrity": lambda ds: quality.relationship_integrity(
        ds.opportunities_clean(["opp_id", "lead_id", "owner_id", "created_date", "close_date"]),
        ds.deals_clean,
        ds.leads_clean,
        ds.reps,
        ds.dim_date,
    ),
    "date_order_violations": lambda ds: quality.date_order_violations(
        ds.opportunities_clean(["stage", "created_date", "close_date"])
    ),
    "cac_efficiency_summary": lambda ds: quality.describe(
        ds.deal_view(["cac_efficiency"]), "cac_efficiency"
    ),
    # cleaning
    "leads_clean": lambda ds: ds.leads_clean,
    "qualified_leads": lambda ds: cleaning.qualified_only(ds.leads_clean),
    "stage_avg_days": lambda ds: cleaning.stage_averages(ds.opportunities),
    "arr_median_by_segment": lambda ds: cleaning.arr_medians(ds.arr_counts),
    "opportunities_clean": lambda ds: ds.opportunities_clean(),
    "closed_deals_clean": lambda ds: ds.deals_clean,
    "closed_deals_build": lambda ds: cleaning.closed_deals_build(
        ds.opportunities_clean(["opp_id", "stage", "arr_value", "close_date", "lead_source"]), ds.params
    ),
    # analytical questions
    "funnel_by_source": lambda ds: analytics.funnel_by_source(
        ds.leads_clean, ds.opportunities_clean(["opp_id", "lead_id", "stage"])
    ),
    "funnel_overall": lambda ds: analytics.funnel_overall(
        ds.leads_clean, ds.opportunities_clean(["opp_id", "lead_id", "stage"])
    ),
    "stage_velocity": lambda ds: analytics.stage_velocity(
        ds.opportunities_clean(["stage", "days_in_stage"])
    ),
    "coverage_ratio": lambda ds: analytics.pipeline_coverage(
        ds.opportunities_clean(["stage", "arr_value"]), ds.params
    ),
    "win_rate_by_rep": lambda ds: analytics.win_rate_by_rep(
        ds.opportunities_clean(["owner_id", "stage"]), ds.reps
    ),
    "arr_cac_by_segment_source": lambda ds: analytics.arr_cac_by_segment_source(
        ds.deals_clean, ds.opportunities, ds.leads_clean, ds.heavy
    ),
    "rolling_3mo_arr": lambda ds: analytics.rolling_3mo_arr(ds.deals_clean),
    "forecast_by_quarter": lambda ds: analytics.forecast_by_quarter(
        ds.opportunities_clean(FORECAST)
    ),
    "top_open_deals": lambda ds: analytics.top_open_deals(
        ds.opportunities_clean(["opp_id", "owner_id", "stage", "arr_value", "created_date"]),
        ds.params,
    ),
    # features, segments, forecast
    "open_deal_age": lambda ds: ds.opportunity_view(["opp_id", "stage", "days_since_created"]),
    "stalled_deals": lambda ds: ds.opportunity_view(
        ["opp_id", "stage", "days_since_created", "is_stalled"]
    ).where("is_stalled"),
    "stalled_summary": lambda ds: features.stalled_summary(
        ds.opportunity_view(["stage", "is_stalled", "arr_value"])
    ),
    "deal_size_band": lambda ds: ds.opportunity_view(["opp_id", "arr_value", "deal_size_band"]),
    "cac_efficiency": lambda ds: ds.deal_view(["deal_id", "arr_value", "cac", "cac_efficiency"]),
    "opportunities_modelled": _modelled,
    "segment_features": _segment_features,
    "standardized_features": lambda ds: segments.standardized_features(_segment_features(ds)),
    "kmeans_segments": lambda ds: ds.deal_clusters,
    "kmeans_fixed_centres": _fixed_clusters,
    "kmeans_profile": lambda ds: segments.name_clusters(segments.cluster_profile(ds.deal_clusters)),
    "kmeans_cluster_counts": lambda ds: quality.frequencies(ds.deal_clusters, "cluster_label"),
    "cluster_naming": _named_by_segment,
    "closed_deals_segmented": lambda ds: ds.deal_view(star.SEGMENTED_COLUMNS),
    "cluster_mix": lambda ds: segments.cluster_mix(ds.deal_clusters),
    "forecast_monthly": lambda ds: forecast.forecast_monthly(
        ds.opportunities_clean(FORECAST), ds.params
    ),
    "forecast_summary": _forecast_summary,
    # star views
    "star_opportunities": lambda ds: ds.opportunity_view(star.OPPORTUNITY_VIEW),
    "star_opportunities_created": lambda ds: ds.opportunity_view(
        ["opp_id", "created_date", *star.DATE_ATTRIBUTES], date_role="created"
    ),
    "star_deals": lambda ds: ds.deal_view(c for c in star.DEAL_VIEW if c != "cluster_label"),
    # measures
    "m01_total_leads": _measure("total_leads", "region"),
    "m02_qualified_leads": _measure("qualified_leads", "lead_source"),
    "m03_lead_qualified_rate": _measure("lead_qualified_rate", "lead_source"),
    "m04_total_opportunities": _measure("total_opportunities", "industry"),
    "m05_closed_won_count": _measure("closed_won_count", "team"),
    "m06_win_rate": _measure("win_rate", "rep_region"),
    "m07_closed_won_arr": _measure("closed_won_arr", "year", "quarter"),
    "m08_avg_deal_size": _measure("avg_deal_size", "company_size"),
    "m09_avg_days_to_close": _measure("avg_days_to_close", "owner_id"),
    "m10a_open_arr": _measure("open_pipeline_arr", "region"),
    "m10b_coverage_ratio": _measure("pipeline_coverage", "region"),
    "m11_forecast_arr": _measure("forecast_arr", "industry", "company_size"),
    "m12_forecast_variance": _measure("forecast_variance", "region"),
    "m13_forecast_variance_rate": _measure("forecast_variance_rate", "region"),
    "m14_cac_by_source": _measure("avg_cac", "lead_source"),
    "m15_cac_efficiency": _measure("cac_efficiency", "lead_source"),
    "m16_stalled_count": _measure("stalled_count", "stage"),
    "m17_stalled_arr": _measure("stalled_arr", "team"),
    "m18_rolling_3m_arr": measures.rolling_closed_arr,
    "m19_qtd_arr": measures.quarter_to_date_arr,
    "m18_by_year": _measure("rolling_3m_arr", "year"),
    "m18_by_region": _measure("rolling_3m_arr", "region"),
    "m18_sliced": _measure("rolling_3m_arr", "region", filters=DATES),
    "m19_by_year": _measure("qtd_arr", "year"),
    "m19_by_region": _measure("qtd_arr", "region"),
    "m19_sliced": _measure("qtd_arr", "region", filters=DATES),
    "m14_sliced_by_size_band": _measure("avg_cac", "lead_source", filters={"deal_size_band": ["Q4"]}),
    "segment_sliced_kpis": lambda ds: evaluate(
        ds, ["closed_won_count", "closed_won_arr", "segment_arr"], filters={"customer_segment": ["SMB", "Enterprise"]}
    ),
    "m20_arr_by_segment": measures.arr_by_segment,
    "m21_cohort_won_arr": measures.cohort_won_arr,
    "measures_all": measures.measures_all,
    "measures_two_axes": lambda ds: evaluate(
        ds,
        ["closed_won_count", "closed_won_arr", "win_rate", "avg_cac", "cac_efficiency"],
        ["region", "lead_source"],
    ),
    "measures_replace_context": lambda ds: evaluate(
        ds,
        ["closed_won_count", "open_pipeline_arr", "forecast_arr", "win_rate"],
        ["stage"],
        context="replace",
    ),
    # report tables
    "exec_kpis": report.exec_kpis,
    "exec_qtd_gauge": report.exec_qtd_gauge,
    "exec_arr_trend": report.exec_arr_trend,
    "exec_arr_by_segment": report.exec_arr_by_segment,
    "exec_arr_by_region": report.exec_arr_by_region,
    "funnel_steps": report.funnel_steps,
    "conversion_rates": report.conversion_rates,
    "conversion_by_source": report.conversion_by_source,
    "stage_dropoff": report.stage_dropoff,
    "forecast_variance_kpis": report.forecast_variance_kpis,
    "forecast_matrix": report.forecast_matrix,
    "coverage_by_stage": report.coverage_by_stage,
    "rep_leaderboard": report.rep_leaderboard,
    "rep_quota_attainment": report.rep_quota_attainment,
    "rep_velocity_scatter": report.rep_velocity_scatter,
    "arr_vs_cac_by_source": report.arr_vs_cac_by_source,
    "cac_efficiency_by_segment": report.cac_efficiency_by_segment,
    "won_by_size_band": report.won_by_size_band,
    "sliced_kpis": lambda ds: report.sliced_kpis(ds, SLICERS),
}


def answer(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return presented(ANSWERS[name](Dataset.from_testdata(spark, folder)))

    run.__name__ = name
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: answer(name) for name in ANSWERS}
