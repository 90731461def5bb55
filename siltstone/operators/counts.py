"""Stage counters, their conservation, and distributions for reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

OUTCOMES = ("accepted", "rejected", "quarantined", "skipped")


def stage_counts(rows: DataFrame, stage: str, unit: str, outcome: str) -> DataFrame:
    """(stage, unit, read, accepted, rejected, quarantined, skipped): rows by outcome for each unit."""
    x = F.col(outcome)
    return rows.groupBy(F.lit(stage).alias("stage"), F.col(unit).cast("string").alias("unit")).agg(F.count("*").alias("read"), *(F.count_if(x == o).alias(o) for o in OUTCOMES))


def batch_counts(rows: DataFrame, unit: str, ordinal: str, outcome: str, batch_rows: int) -> DataFrame:
    """(unit, batch, first, last, read, outcomes): a row for each ``batch_rows`` ordinals of each unit.

    A record's batch follows from its place in its archive, so that runs and resumed runs agree.
    """
    x = F.col(outcome)
    batch = F.floor(F.col(ordinal) / batch_rows).cast("long").alias("batch")
    return rows.groupBy(F.col(unit).cast("string").alias("unit"), batch).agg(
        F.min(ordinal).cast("long").alias("first"), F.max(ordinal).cast("long").alias("last"), F.count("*").alias("read"), *(F.count_if(x == o).alias(o) for o in OUTCOMES)
    )


def observed(rows: DataFrame, stage: str, outcome: str) -> tuple[DataFrame, Observation]:
    """``rows``, whose counts by outcome the observation has once they have been written or counted."""
    seen = Observation(stage)
    return rows.observe(seen, F.count(F.lit(1)).alias("read"), *(F.count_if(F.col(outcome) == o).alias(o) for o in OUTCOMES)), seen


def reconciled(seen: dict, written: DataFrame, outcome: str) -> list[tuple[str, int, int]]:
    """(count, as observed, as read again) of what differs: none, if what was made was written once.

    Where a shuffle follows what is observed, a task that ran twice can be in it twice; observe in the stage that writes.
    """
    again = written.agg(F.count(F.lit(1)).alias("read"), *(F.count_if(F.col(outcome) == o).alias(o) for o in OUTCOMES)).first().asDict()
    return [(k, seen[k], n) for k, n in again.items() if seen[k] != n]


def conserve(counts: DataFrame) -> DataFrame:
    """Units whose outcomes do not add up to what was read: each blocks."""
    total = sum((F.col(o) for o in OUTCOMES), F.lit(0))
    return counts.withColumn("unexplained", F.col("read") - total).where("unexplained <> 0")


def totals(counts: DataFrame) -> DataFrame:
    """Each unit's counts, and each stage's over all units (unit null)."""
    return counts.rollup("stage", "unit").agg(*(F.sum(c).alias(c) for c in ("read", *OUTCOMES))).where("stage IS NOT NULL")


def view_counts(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("rows"))


def distribution(df: DataFrame, column: str) -> DataFrame:
    """(value, rows, share): counts of each value and its share of all, six decimals."""
    counted = df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("rows"))
    total = counted.agg(F.sum("rows").alias("_all"))
    return counted.join(F.broadcast(total)).select("value", "rows", F.round(F.col("rows") / F.col("_all"), 6).alias("share"))  # total is one row


def missingness(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """Rows, and nulls in each column, by coverage group."""
    return df.groupBy(*by).agg(F.count("*").alias("rows"), *(F.count_if(F.col(c).isNull()).alias(f"{c}_missing") for c in columns))
