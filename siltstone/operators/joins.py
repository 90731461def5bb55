"""Joins on verified keys only, with the evidence for them and a report of what they did.

There is no join by time, nearness or similarity: a pair of record families whose
key is not proven is unsupported.  Null keys match nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class JoinRefused(ValueError):
    """The evidence does not allow the join."""


def key_profile(df: DataFrame, keys: list[str], by: list[str] | None = None) -> DataFrame:
    """Rows, different keys and rows with a null in the key, by era, format and the like."""
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    # Keys are counted first, so that a frequent key is one row in what is shuffled next.
    counted = df.groupBy(*(by or []), *keys).agg(F.count("*").alias("_n"))
    full = F.when(~null, 1)
    return counted.groupBy(*(by or [])).agg(F.sum("_n").alias("rows"), F.count(full).alias("distinct_keys"), F.coalesce(F.sum(F.when(null, F.col("_n"))), F.lit(0)).alias("null_keys"))


def key_counts(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    return df.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias(name))


def coverage(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """One row: keys and rows matched and unmatched on both sides, and how many rows a join makes."""
    both = key_counts(left, keys, "l").join(key_counts(right, keys, "r"), keys, "full_outer")
    sum_of = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    here, there = F.col("l").isNotNull(), F.col("r").isNotNull()
    return both.agg(
        F.count_if(here & there).alias("matched_keys"),
        F.count_if(here & ~there).alias("left_only_keys"),
        F.count_if(~here & there).alias("right_only_keys"),
        sum_of(F.when(here & there, F.col("l"))).alias("left_matched_rows"),
        sum_of(F.when(here & ~there, F.col("l"))).alias("left_unmatched_rows"),
        sum_of(F.when(~here & there, F.col("r"))).alias("right_unmatched_rows"),
        sum_of(F.col("l") * F.col("r")).alias("joined_rows"),
        F.coalesce(F.max(F.when(here & there, F.col("l"))), F.lit(0)).alias("left_most"),
        F.coalesce(F.max(F.when(here & there, F.col("r"))), F.lit(0)).alias("right_most"),
        F.count_if((F.col("l") > 1) & (F.col("r") > 1)).alias("many_to_many_keys"),
    )


def cardinality(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """``coverage`` with the class of the pair: 1:1, 1:n, n:1 or m:n."""
    kind = F.when(F.col("many_to_many_keys") > 0, "m:n").when((F.col("left_most") > 1) & (F.col("right_most") > 1), "m:n").when(F.col("left_most") > 1, "n:1").when(F.col("right_most") > 1, "1:n").otherwise("1:1")
    return coverage(left, right, keys).withColumn("cardinality", kind)


def unmatched(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` without a match, those with a null key among them."""
    return left.join(right.select(*keys), keys, "left_anti")


@dataclass(frozen=True)
class KeyEvidence:
    """A key, the classes it may have, and by what it was established; accepted only by review."""

    keys: tuple[str, ...]
    allowed: tuple[str, ...]
    source: str
    accepted: bool = False


def verified_join(left: DataFrame, right: DataFrame, evidence: KeyEvidence, how: str = "left") -> tuple[DataFrame, dict]:
    """The join and its report; refused before it runs where the evidence or the data forbid it.

    ``join_status`` says of each row whether it matched.
    """
    if not evidence.accepted:
        raise JoinRefused("the key is not accepted: the pairing is unsupported")
    keys = list(evidence.keys)
    report = cardinality(left, right, keys).first().asDict()  # one row
    if report["cardinality"] not in evidence.allowed:
        raise JoinRefused(f"{report['cardinality']} on {keys}; allowed: {evidence.allowed}")
    marked = right.withColumn("_matched", F.lit(True))
    joined = left.join(marked, keys, how).withColumn("join_status", F.when(F.col("_matched"), "matched").otherwise("unmatched")).drop("_matched")
    return joined, report | {"keys": keys, "evidence": evidence.source}


def expected_rows(report: dict, left_rows: int, how: str = "left") -> int:
    """How many rows the join must have."""
    return report["joined_rows"] + (left_rows - report["left_matched_rows"] if how == "left" else 0)
