"""Data-quality profiles and audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtrail.functions.deals import is_won
from revtrail.params import DAYS_BANDS, PROBABILITY_BANDS, Params

# Columns whose gaps the profile reports.
PROFILED = {
    "leads": ("lead_status",),
    "opportunities": ("arr_value", "close_date"),
    "closed_deals": ("cac", "customer_segment"),
}


def stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def null_profile(tables: dict[str, DataFrame], profiled: dict = PROFILED) -> DataFrame:
    """(tbl, col, n_null): each table is read once, whatever the number of columns."""
    parts = []
    for name, columns in profiled.items():
        gaps = tables[name].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        parts.append(
            gaps.unpivot([], list(columns), "col", "n_null").select(
                F.lit(name).alias("tbl"), "col", "n_null"
            )
        )
    return stack(parts)


def duplicate_keys(rows: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, most frequent first."""
    return (
        rows.groupBy(key)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where("occurrences > 1")
        .orderBy(F.desc("occurrences"), key)
    )


def duplicate_key_total(rows: DataFrame, key: str) -> DataFrame:
    repeated = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return repeated.agg(F.count(F.lit(1)).alias("duplicated_keys"))


def won_missing_close_date(opps: DataFrame) -> DataFrame:
    return opps.where(is_won(F.col("stage")) & F.col("close_date").isNull()).select(
        "opp_id", "stage", "created_date", "close_date"
    )


def arr_outliers(opps: DataFrame, params: Params) -> DataFrame:
    """Known deal values outside the plausible range."""
    low, high = params.outlier_bounds
    arr = F.col("arr_value")
    return opps.where((arr < low) | (arr > high)).select("opp_id", "arr_value").orderBy("arr_value")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table."""
    return stack(
        [
            rows.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("tbl"), "n_rows", F.lit(len(rows.columns)).alias("n_columns")
            )
            for name, rows in tables.items()
        ]
    )


def imputation_audit(opps_clean: DataFrame) -> DataFrame:
    """How many values were filled in, and how many are still missing."""
    return opps_clean.agg(
        F.sum("arr_imputed_flag").alias("arr_imputed"),
        F.sum("close_date_imputed_flag").alias("close_date_imputed"),
        F.count_if(F.col("arr_value").isNull()).alias("arr_still_null"),
    )


def band_conformance(opps: DataFrame) -> DataFrame:
    """Rows per known stage whose probability or days lie outside the stage's band."""
    bands = opps.sparkSession.createDataFrame(
        [(s, *PROBABILITY_BANDS[s], *DAYS_BANDS[s]) for s in PROBABILITY_BANDS],
        "stage string, low_p int, high_p int, low_d int, high_d int",
    )
    # Six rows, one per known stage.
    banded = opps.join(F.broadcast(bands), "stage")
    return banded.groupBy("stage").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~F.col("close_probability").between(F.col("low_p"), F.col("high_p"))).alias(
            "probability_violations"
        ),
        F.count_if(~F.col("days_in_stage").between(F.col("low_d"), F.col("high_d"))).alias(
            "days_violations"
        ),
    )


def _counted(rows: DataFrame, column: str, side: str) -> DataFrame:
    """Rows per key, added up before the shuffle; the key keeps its type."""
    other = "n_one" if side == "n_many" else "n_many"
    return (
        rows.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("k"))
        .agg(F.count(F.lit(1)).alias(side))
        .withColumn(other, F.lit(0).cast("long"))
    )


def _relationship(name: str, many: DataFrame, key: str, one: DataFrame, one_key: str) -> DataFrame:
    both = _counted(many, key, "n_many").unionByName(_counted(one, one_key, "n_one"))
    keys = both.groupBy("k").agg(F.sum("n_many").alias("n_many"), F.sum("n_one").alias("n_one"))
    orphan = F.col("n_one") == 0
    return keys.agg(
        F.count_if(F.col("n_one") > 1).alias("duplicate_keys"),
        F.count_if(orphan).alias("orphan_keys"),
        F.coalesce(F.sum(F.when(orphan, F.col("n_many"))), F.lit(0)).alias("orphan_rows"),
    ).select(F.lit(name).alias("relationship"), "*")


def relationship_integrity(
    opps: DataFrame, deals: DataFrame, leads: DataFrame, reps: DataFrame, dates: DataFrame
) -> DataFrame:
    """One-side uniqueness and many-side orphans of the six star relationships.

    Each relationship reads one column of each side and counts per key before anything is
    shuffled, so owners and days, which are few, shuffle a few rows a task.
    """
    return stack(
        [
            _relationship("R1", opps, "lead_id", leads, "lead_id"),
            _relationship("R2", opps, "owner_id", reps, "owner_id"),
            _relationship("R3", opps, "close_date", dates, "date"),
            _relationship("R4", opps, "created_date", dates, "date"),
            _relationship("R5", deals, "opp_id", opps, "opp_id"),
            _relationship("R6", deals, "close_date", dates, "date"),
        ]
    )


def date_order_violations(opps: DataFrame) -> DataFrame:
    """Opportunities that close before they were created, per stage."""
    wrong = F.col("close_date") < F.col("created_date")
    return opps.groupBy("stage").agg(F.count_if(wrong).alias("closed_before_created"))


def describe(rows: DataFrame, column: str) -> DataFrame:
    """Mean, least and greatest value to two places."""
    value = F.col(column).cast("double")
    return rows.agg(
        F.round(F.avg(value), 2).alias("mean"),
        F.round(F.min(value), 2).alias("min"),
        F.round(F.max(value), 2).alias("max"),
    )


def frequencies(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)
