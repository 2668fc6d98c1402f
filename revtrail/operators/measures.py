"""Named business measures, evaluated over any axis and any filters.

A measure is a formula over parts; a part is one aggregate over one fact. All parts of
a fact that a question needs share one aggregation, and facts meet only after they
have been summed up to the axis, so no fact multiplies another.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revtrail.functions.dates import month_index, month_label
from revtrail.functions.deals import is_decided, is_open, is_won, weighted_points
from revtrail.functions.numbers import ratio
from revtrail.operators import star
from revtrail.params import QUALIFIED, Params


@dataclass(frozen=True)
class Part:
    fact: str
    needs: tuple[str, ...]
    value: Callable[[Any], Column]
    # The column the part itself filters on, if any.
    filters_on: str | None = None
    counts: bool = False


@dataclass(frozen=True)
class Between:
    """Filter value for a range, both ends included."""

    low: Any
    high: Any


def _stage() -> Column:
    return F.col("stage")


def _arr() -> Column:
    return F.col("arr_value")


def _closed_on_a_day() -> Column:
    return is_won(_stage()) & F.col("close_date").isNotNull()


# Time measures: first day of the window that ends on the last day in context.
WINDOWS: dict[str, Callable[[Column], Column]] = {
    "rolling_3m_arr": lambda last: F.date_add(F.add_months(last, -3), 1),
    "qtd_arr": lambda last: F.trunc(last, "quarter"),
}


PARTS: dict[str, Part] = {
    # The lead view holds each lead once, so counting leads needs no distinct.
    "total_leads": Part("leads", ("lead_id",), lambda ds: F.count("lead_id"), counts=True),
    "qualified_leads": Part(
        "leads",
        ("lead_id", "lead_status"),
        lambda ds: F.count(F.when(F.col("lead_status") == QUALIFIED, F.col("lead_id"))),
        "lead_status",
        counts=True,
    ),
    # One row per opportunity; `relationship_integrity` checks that the key is unique.
    "opportunities": Part("opportunities", ("opp_id",), lambda ds: F.count("opp_id"), counts=True),
    "won": Part(
        "opportunities", ("stage",), lambda ds: F.count_if(is_won(_stage())), "stage", counts=True
    ),
    "decided": Part(
        "opportunities", ("stage",), lambda ds: F.count_if(is_decided(_stage())), "stage", counts=True
    ),
    "won_arr": Part(
        "opportunities",
        ("stage", "arr_value"),
        lambda ds: F.sum(F.when(is_won(_stage()), _arr())),
        "stage",
    ),
    "open_arr": Part(
        "opportunities",
        ("stage", "arr_value"),
        lambda ds: F.sum(F.when(is_open(_stage()), _arr())),
        "stage",
    ),
    "weighted_points": Part(
        "opportunities",
        ("stage", "arr_value", "close_probability"),
        lambda ds: F.sum(
            F.when(is_open(_stage()), weighted_points(_arr(), F.col("close_probability")))
        ),
    ),
    "days_to_close": Part(
        "opportunities",
        ("stage", "created_date", "close_date"),
        lambda ds: F.sum(F.when(_closed_on_a_day(), F.datediff("close_date", "created_date"))),
    ),
    "dated_wins": Part(
        "opportunities",
        ("stage", "close_date"),
        lambda ds: F.count_if(_closed_on_a_day()),
        counts=True,
    ),
    "stalled": Part(
        "opportunities",
        ("is_stalled",),
        lambda ds: F.count_if(F.col("is_stalled")),
        "is_stalled",
        counts=True,
    ),
    "stalled_arr": Part(
        "opportunities",
        ("is_stalled", "arr_value"),
        lambda ds: F.sum(F.when(F.col("is_stalled"), _arr())),
        "is_stalled",
    ),
    # Sums of won value per closing day; `_in_windows` adds them up.
    "rolling_3m_arr": Part("days", ("stage", "arr_value", "close_date"), lambda ds: F.sum("arr_value")),
    "qtd_arr": Part("days", ("stage", "arr_value", "close_date"), lambda ds: F.sum("arr_value")),
    "cac": Part("deals", ("cac",), lambda ds: F.sum("cac")),
    "cac_rows": Part("deals", ("cac",), lambda ds: F.count("cac"), counts=True),
    "deal_arr": Part("deals", ("arr_value",), lambda ds: F.sum("arr_value"), "customer_segment"),
}


@dataclass(frozen=True)
class Measure:
    parts: tuple[str, ...]
    formula: Callable[..., Column]


def _part(name: str) -> Measure:
    return Measure((name,), lambda p, _: p[name])


def _rate(above: str, below: str) -> Measure:
    return Measure((above, below), lambda p, _: ratio(p[above], p[below]))


def _forecast(p: Mapping[str, Column]) -> Column:
    return p["weighted_points"].cast("double") / 100


def _variance(p: Mapping[str, Column], params: Params) -> Column:
    return _forecast(p) - params.quarterly_target


MEASURES: dict[str, Measure] = {
    "total_leads": _part("total_leads"),
    "qualified_leads": _part("qualified_leads"),
    "lead_qualified_rate": _rate("qualified_leads", "total_leads"),
    "total_opportunities": _part("opportunities"),
    "closed_won_count": _part("won"),
    "win_rate": _rate("won", "decided"),
    "closed_won_arr": _part("won_arr"),
    "avg_deal_size": _rate("won_arr", "won"),
    "avg_days_to_close": _rate("days_to_close", "dated_wins"),
    "open_pipeline_arr": _part("open_arr"),
    "pipeline_coverage": Measure(
        ("open_arr",), lambda p, params: ratio(p["open_arr"], F.lit(params.quarterly_target))
    ),
    "forecast_arr": Measure(("weighted_points",), lambda p, _: _forecast(p)),
    "forecast_variance": Measure(("weighted_points",), _variance),
    "forecast_variance_rate": Measure(
        ("weighted_points",),
        lambda p, params: ratio(_variance(p, params), F.lit(params.quarterly_target)),
    ),
    "avg_cac": _rate("cac", "cac_rows"),
    "cac_efficiency": _rate("won_arr", "cac"),
    "stalled_count": _part("stalled"),
    "stalled_arr": _part("stalled_arr"),
    "segment_arr": _part("deal_arr"),
    "rolling_3m_arr": _part("rolling_3m_arr"),
    "qtd_arr": _part("qtd_arr"),
}

_VIEWS = {
    "leads": star.LEAD_VIEW,
    "opportunities": star.OPPORTUNITY_VIEW,
    "days": star.OPPORTUNITY_VIEW,
    "deals": star.DEAL_VIEW,
}


def _view(ds, fact: str, columns: list[str], date_role: str) -> DataFrame:
    if fact == "leads":
        return star.lead_view(ds, columns)
    if fact == "deals":
        return star.deal_view(ds, columns)
    return star.opportunity_view(ds, columns, date_role)


def _passes(column: str, allowed: Any) -> Column:
    if isinstance(allowed, Between):
        return F.col(column).between(F.lit(allowed.low), F.lit(allowed.high))
    return F.col(column).isin(*allowed)


def _filtered(ds, fact: str, needed: Iterable[str], filters: Mapping[str, Any], date_role: str) -> DataFrame:
    """Rows of a fact that pass the filters, with the columns that are needed.

    A segment filter keeps the opportunities that have any deal of the segments, whatever
    the one segment their axis shows.
    """
    by_deal = fact in ("opportunities", "days") and "customer_segment" in filters
    plain = {c: allowed for c, allowed in filters.items() if not (by_deal and c == "customer_segment")}
    columns = [*needed, *plain, *(["opp_id"] if by_deal else [])]
    rows = _view(ds, fact, columns, date_role)
    for column, allowed in plain.items():
        rows = rows.where(_passes(column, allowed))
    if by_deal:
        deals = ds.deals_clean.where(_passes("customer_segment", filters["customer_segment"]))
        rows = rows.join(deals.select("opp_id").distinct(), "opp_id", "left_semi")
    return rows


def _reached(fact: str, axis: list[str], filters: Mapping[str, Any]) -> dict[str, Any]:
    reach = set(_VIEWS[fact])
    missing = [a for a in axis if a not in reach]
    if missing:
        raise ValueError(f"axis {', '.join(missing)} does not reach the {fact}")
    # A filter acts on the facts its column reaches and leaves the others alone.
    return {c: allowed for c, allowed in filters.items() if c in reach}


def _totals(ds, fact, parts, axis, filters, date_role) -> DataFrame:
    """One row per axis value with the parts of one fact."""
    acting = _reached(fact, axis, filters)
    needed = [*axis, *[c for p in parts for c in PARTS[p].needs]]
    rows = _filtered(ds, fact, needed, acting, date_role)
    return rows.groupBy(*axis).agg(*[PARTS[p].value(ds).alias(f"_{p}") for p in parts])


def _in_windows(ds, parts: list[str], axis: list[str], filters: Mapping[str, Any]) -> DataFrame:
    """Won value in the windows that end on the last calendar day in context.

    Date filters and date axes move the window: they choose the last day, and the days
    before it count even where the filter leaves them out. All other filters and axes
    choose rows. The calendar, the ends and their days are bounded by the settings.
    """
    acting = _reached("days", axis, filters)
    date_columns = {*star.DATE_ATTRIBUTES, "close_date"}
    days = ds.dim_date.withColumn("close_date", F.col("date"))
    for column, allowed in acting.items():
        if column in date_columns:
            days = days.where(_passes(column, allowed))
    on_dates = [a for a in axis if a in date_columns]
    others = [a for a in axis if a not in date_columns]
    ends = days.groupBy(*on_dates).agg(F.max("date").alias("_last"))

    rest = {c: allowed for c, allowed in acting.items() if c not in date_columns}
    won = _filtered(ds, "days", [*others, "stage", "arr_value", "close_date"], rest, "close")
    daily = (
        won.where(_closed_on_a_day())
        .groupBy(*others, F.col("close_date").alias("_day"))
        .agg(F.sum("arr_value").alias("_arr"))
    )
    found = []
    for p in parts:
        first = WINDOWS[p](F.col("_last"))
        window = ends.select(*on_dates, F.explode(F.sequence(first, F.col("_last"))).alias("_day"))
        found.append(
            daily.join(F.broadcast(window), "_day").groupBy(*axis).agg(F.sum("_arr").alias(f"_{p}"))
        )
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)


def evaluate(
    ds,
    measures: Iterable[str],
    axis: Iterable[str] = (),
    filters: Mapping[str, Any] | None = None,
    context: str = "respect",
    date_role: str = "close",
) -> DataFrame:
    """Measures per axis value, one row in all without an axis.

    context="respect": a measure counts the rows of its axis value only. "replace": a
    measure that filters a column itself ignores that column on the axis, so its total
    repeats on every value.
    """
    measures, axis, filters = list(measures), list(axis), dict(filters or {})
    parts = list(dict.fromkeys(p for m in measures for p in MEASURES[m].parts))
    facts = list(dict.fromkeys(PARTS[p].fact for p in parts))
    unknown = [c for c in filters if not any(c in _VIEWS[f] for f in facts)]
    if unknown:
        raise ValueError(f"filter {', '.join(unknown)} reaches none of {', '.join(facts)}")
    totals = []
    for f in facts:
        own = [p for p in parts if PARTS[p].fact == f]
        if f == "days":
            totals.append(_in_windows(ds, own, axis, filters))
        else:
            totals.append(_totals(ds, f, own, axis, filters, date_role))
    if len(parts) == 1 or (len(totals) == 1 and facts != ["days"]):
        merged = totals[0]
    else:
        # Each part comes from one fact only, so the greatest of its values is the value.
        union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), totals)
        merged = union.groupBy(*axis).agg(*[F.max(f"_{p}").alias(f"_{p}") for p in parts])

    values = {}
    for p in parts:
        value = F.col(f"_{p}")
        if PARTS[p].counts:
            value = F.coalesce(value, F.lit(0))
        if context == "replace" and PARTS[p].filters_on in axis:
            others = [a for a in axis if a != PARTS[p].filters_on]
            # The window runs over one row per axis value.
            value = F.sum(value).over(Window.partitionBy(*others))
        values[p] = value
    return merged.select(
        *axis, *[MEASURES[m].formula(values, ds.params).alias(m) for m in measures]
    )


def _won(ds, *columns: str) -> DataFrame:
    rows = ds.opportunity_view(["stage", "close_date", "arr_value", *columns])
    return rows.where(_closed_on_a_day())


def rolling_closed_arr(ds) -> DataFrame:
    """Won value per closing month and over that month and the two before it, for every
    month of the calendar."""
    day = F.col("close_date")
    monthly = _won(ds).groupBy(month_label(day).alias("month")).agg(F.sum("arr_value").alias("closed_won_arr"))
    months = ds.dim_date.groupBy("month").agg(F.min("date").alias("_first"))
    every = months.join(monthly, "month", "left").withColumn("_at", month_index(F.col("_first")))
    # The window runs over one row per month.
    recent = Window.orderBy("_at").rangeBetween(-2, 0)
    return every.select(
        "month", "closed_won_arr", F.sum("closed_won_arr").over(recent).alias("rolling_3m_arr")
    ).orderBy("month")


def quarter_to_date_arr(ds) -> DataFrame:
    """Won value per day and from the start of its quarter on, for every day of the calendar."""
    daily = _won(ds).groupBy(F.col("close_date").alias("date")).agg(F.sum("arr_value").alias("closed_won_arr"))
    every = ds.dim_date.select("date").join(daily, "date", "left")
    so_far = (
        Window.partitionBy(F.trunc("date", "quarter"))
        .orderBy("date")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return every.select(
        "date", "closed_won_arr", F.sum("closed_won_arr").over(so_far).alias("qtd_arr")
    )


def arr_by_segment(ds) -> DataFrame:
    """Deal value per customer segment and in total."""
    rows = ds.deal_view(["customer_segment", "arr_value"]).rollup("customer_segment")
    return rows.agg(
        F.grouping("customer_segment").alias("_all"), F.sum("arr_value").alias("segment_arr")
    ).select(
        F.when(F.col("_all") == 1, "Total").otherwise(F.col("customer_segment")).alias(
            "customer_segment"
        ),
        "segment_arr",
    )


def cohort_won_arr(ds) -> DataFrame:
    """Won value by the quarter the opportunity was created in."""
    return evaluate(ds, ["closed_won_arr"], ["quarter_label"], date_role="created")


def measures_all(ds) -> DataFrame:
    """Every measure without an axis, as one row."""
    return evaluate(ds, MEASURES)
