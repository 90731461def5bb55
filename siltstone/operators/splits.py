"""Splits by stable hash of a group, so that no group is in two of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.contracts import SplitContract
from siltstone.functions.canonical import bucket_of


def split_of(group: Column, contract: SplitContract) -> Column:
    bucket = bucket_of(group, contract.contract_id, contract.salt)
    found = F.lit(None).cast("string")
    for name, below in reversed(contract.thresholds):
        found = F.when(bucket < below, name).otherwise(found)
    return F.when(group.isNull(), F.lit(contract.missing)).otherwise(found)


def assign_split(df: DataFrame, contract: SplitContract) -> DataFrame:
    """``df`` with ``split``; rows without a group get the contract's name for them."""
    if contract.thresholds[-1][1] != 10_000 or any(a[1] >= b[1] for a, b in zip(contract.thresholds, contract.thresholds[1:], strict=False)):
        raise ValueError("thresholds must rise to 10000")
    return df.withColumn("split", split_of(F.col(contract.group), contract))


def group_key(columns: list[str]) -> Column:
    """The first of the columns, strongest grouping first, that is not null."""
    return F.coalesce(*(F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}:"), F.col(c).cast("string"))) for c in columns))


def split_counts(df: DataFrame, group: str) -> DataFrame:
    """(split, records, groups).  Groups are counted after one row per group is left."""
    by_group = df.groupBy("split", group).agg(F.count("*").alias("_n"))
    return by_group.groupBy("split").agg(F.sum("_n").alias("records"), F.count(group).alias("groups"))


def split_isolation(df: DataFrame, group: str) -> DataFrame:
    """Groups in more than one split: none, or the split is broken."""
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(F.min("split").alias("a"), F.max("split").alias("b")).where("a <> b").select(group, "a", "b")
