"""Metadata of other sources, as of cards or players: registered, licensed and dated by themselves, and only ever laid beside.

A side source is no archive: it has a provider, versions with the time from which each holds, and
a licence of its own.  Its facts are joined by a declared key as of a time into one struct
beside a record, with where they are from; nothing of the record is changed, and no row is added or lost.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.contracts import Contract
from siltstone.functions.canonical import tagged


class ExternalRefused(ValueError):
    """The side source may not be laid beside records."""


@dataclass(frozen=True)
class ExternalSource(Contract):
    """``key`` names the columns of the side source by which it is joined, ``version`` and ``valid_from`` those that date a row."""

    name: str
    provider: str
    key: tuple[str, ...]
    version: str
    valid_from: str
    facts: tuple[str, ...]
    license_status: str = "pending"
    license_evidence: str = ""
    source_url: str = ""


def external_id(source: ExternalSource, version: Column) -> Column:
    """Of the provider, the source's name and the version."""
    return F.concat(F.lit("external:v1:"), F.sha2(F.concat(tagged("s", F.lit(source.provider)), tagged("s", F.lit(source.name)), tagged("s", version.cast("string"))), 256))


def versions(rows: DataFrame, source: ExternalSource) -> DataFrame:
    """The registration: a row for each version, with how many facts it has."""
    counted = rows.groupBy(F.col(source.version).cast("string").alias("version")).agg(F.min(source.valid_from).alias("valid_from"), F.count("*").alias("rows"))
    return counted.select(external_id(source, F.col("version")).alias("external_id"), F.lit(source.provider).alias("provider"), F.lit(source.name).alias("name"), "version", "valid_from", "rows", F.lit(source.license_status).alias("license_status"), F.lit(source.license_evidence).alias("license_evidence"), F.lit(source.source_url).alias("source_url"))


def beside(records: DataFrame, rows: DataFrame, source: ExternalSource, keys: dict[str, str], as_of: Column, name: str = "external") -> DataFrame:
    """``records`` with the struct ``name``: the facts of the latest version up to ``as_of``, and their provenance, or null.

    ``keys`` maps the source's key columns to those of the records.  Refused without a verified licence, for
    binary facts (pictures are not kept), for a name that the records have, and where one version says two
    things of a key.
    """
    if source.license_status != "verified" or not source.license_evidence:
        raise ExternalRefused(f"{source.name}: license {source.license_status}")
    if set(keys) != set(source.key):
        raise ExternalRefused(f"{source.name}: the key is {source.key}")
    if name in records.columns:
        raise ExternalRefused(f"records have a column {name}")
    if any(isinstance(rows.schema[c].dataType, T.BinaryType) for c in source.facts):
        raise ExternalRefused(f"{source.name}: binary facts")
    dated = rows.dropna(subset=list(source.key)).where(F.col(source.valid_from) <= as_of)
    place = F.struct(F.lit(source.provider).alias("provider"), F.lit(source.name).alias("source"), F.col(source.version).cast("string").alias("version"), F.col(source.valid_from).alias("valid_from"), external_id(source, F.col(source.version)).alias("external_id"), F.lit(source.license_evidence).alias("license_evidence"))
    latest = Window.partitionBy(*source.key).orderBy(F.desc(source.valid_from), F.desc(source.version))
    again = dated.groupBy(*source.key, source.version).agg(F.count_distinct(F.struct(*source.facts)).alias("n")).where("n > 1")
    if again.head(1):
        raise ExternalRefused(f"{source.name}: one version says two things of a key")
    one = dated.withColumn("_rank", F.row_number().over(latest)).where("_rank = 1")  # a row for each version of a key
    side = one.select(*(F.col(k).alias(f"_key_{k}") for k in source.key), F.struct(*source.facts, place.alias("provenance")).alias(name))
    condition = [F.col(f"`{keys[k]}`") == F.col(f"_key_{k}") for k in source.key]
    return records.join(side, condition, "left").drop(*(f"_key_{k}" for k in source.key))
