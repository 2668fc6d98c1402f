"""Stage tests and deal arithmetic."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from revtrail.params import CLOSED_LOST, CLOSED_WON, DECIDED_STAGES, SEGMENTS


def is_won(stage: Column) -> Column:
    return stage == CLOSED_WON


def is_lost(stage: Column) -> Column:
    return stage == CLOSED_LOST


def is_decided(stage: Column) -> Column:
    return stage.isin(*DECIDED_STAGES)


def is_open(stage: Column) -> Column:
    return ~stage.isin(*DECIDED_STAGES)


def weighted_points(arr: Column, probability: Column) -> Column:
    """Deal value times closing probability in per cent points, kept exact."""
    return arr * probability


def segment_of(arr: Column, edges: tuple[int, int]) -> Column:
    small, middle = edges
    return (
        F.when(arr < small, SEGMENTS[0]).when(arr < middle, SEGMENTS[1]).otherwise(SEGMENTS[2])
    )


def days_since(as_of: date, day: Column) -> Column:
    return F.datediff(F.lit(as_of), day)


def canonical_label(raw: Column, labels: tuple[str, ...]) -> Column:
    """Map any spelling of a known label to that label; trim the others."""
    trimmed = F.trim(raw)
    known = F.lower(trimmed)
    label = trimmed
    for name in labels:
        label = F.when(known == name.lower(), name).otherwise(label)
    return label


def blank_to(raw: Column, default: str) -> Column:
    return F.coalesce(F.nullif(F.trim(raw), F.lit("")), F.lit(default))


def traffic_light(value: Column, good: float, fair: float) -> Column:
    """'green' from `good` on, 'amber' from `fair` on, 'red' below; null stays null."""
    return (
        F.when(value >= good, "green").when(value >= fair, "amber").when(value < fair, "red")
    )


def sign_colour(value: Column) -> Column:
    return F.when(value >= 0, "green").when(value < 0, "red")
