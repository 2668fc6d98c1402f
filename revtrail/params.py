"""Business settings shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

# Stage names in funnel order.
DISCOVERY = "Discovery"
EVALUATION = "Evaluation"
PROPOSAL = "Proposal"
NEGOTIATION = "Negotiation"
CLOSED_WON = "Closed Won"
CLOSED_LOST = "Closed Lost"
STAGES = (DISCOVERY, EVALUATION, PROPOSAL, NEGOTIATION, CLOSED_WON, CLOSED_LOST)
DECIDED_STAGES = (CLOSED_WON, CLOSED_LOST)

# Accepted closing probability (per cent) and days in stage, by stage.
PROBABILITY_BANDS = {
    DISCOVERY: (10, 25),
    EVALUATION: (25, 45),
    PROPOSAL: (45, 65),
    NEGOTIATION: (65, 85),
    CLOSED_WON: (100, 100),
    CLOSED_LOST: (0, 0),
}
DAYS_BANDS = {
    DISCOVERY: (3, 21),
    EVALUATION: (7, 35),
    PROPOSAL: (5, 30),
    NEGOTIATION: (5, 45),
    CLOSED_WON: (1, 14),
    CLOSED_LOST: (1, 30),
}

# Canonical lead source labels.
LEAD_SOURCES = (
    "Organic Search",
    "Paid Ads",
    "Referral",
    "Outbound SDR",
    "Event",
    "Partner",
)

# Lead statuses the measures and the imputation refer to.
NEW = "New"
QUALIFIED = "Qualified"

# Customer segments by deal size, and the three deal archetypes.
SEGMENTS = ("SMB", "Mid-Market", "Enterprise")
HIGH_VALUE = "High Value Fast Close"
MID_MARKET = "Mid Market Standard"
LONG_TAIL = "Long Tail"

# Size bands, smallest first.
SIZE_BANDS = ("Q1", "Q2", "Q3", "Q4")


@dataclass(frozen=True)
class Params:
    """Tunable settings; the defaults describe the standard sales year."""

    as_of: date = date(2026, 6, 1)
    quarterly_target: int = 1_200_000
    segment_edges: tuple[int, int] = (25_000, 100_000)
    outlier_bounds: tuple[int, int] = (5_000, 500_000)
    stall_multiplier: float = 1.5
    confidence: float = 0.15
    lead_sources: tuple[str, ...] = LEAD_SOURCES
    clusters: int = 3
    kmeans_starts: int = 20
    kmeans_seed: int = 42
    kmeans_rounds: int = 300
    # All starts are followed until no centre moves further than this many standard deviations.
    kmeans_tolerance: float = 0.01
    # The calendar: first and last day of the date dimension, and the last closing day.
    first_day: date = date(2024, 6, 1)
    last_day: date = date(2026, 5, 31)
    # A table of labels is broadcast only if it holds no more rows than this.
    broadcast_rows: int = 10_000
    # A join key with more rows than this is dealt out to several tasks.
    hot_rows: int = 5_000_000
