"""Validation gates: each a DataFrame of violations, empty if the gate holds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators import counts, decisions, duplicates, splits

VIOLATION = "gate string, disposition string, subject string, detail string"

# The gates and what a violation of each means.
GATES = {
    "input_integrity": "fatal_source",
    "filename": "warning",
    "schema_fingerprint": "unsupported",
    "csv_structure": "rejected",
    "type_conversion": "rejected",
    "identifier_uniqueness": "release_blocking",
    "join_cardinality": "release_blocking",
    "split_isolation": "release_blocking",
    "duplicate_collision": "quarantined",
    "future_leak": "release_blocking",
    "perspective": "release_blocking",
    "provenance": "release_blocking",
    "privacy": "release_blocking",
    "row_counts": "release_blocking",
    "parquet_readability": "release_blocking",
    "manifest": "release_blocking",
}
BLOCKING = ("fatal_source", "release_blocking", "command_failure")


def violations(rows: DataFrame, gate: str, subject, detail) -> DataFrame:
    """``rows`` as violations of ``gate``."""
    text = lambda x: (x if not isinstance(x, str) else F.lit(x)).cast("string")
    return rows.select(F.lit(gate).alias("gate"), F.lit(GATES[gate]).alias("disposition"), text(subject).alias("subject"), text(detail).alias("detail"))


def listed(spark: SparkSession, gate: str, found: list[tuple[str, str]]) -> DataFrame:
    """Violations that a check of schemas or footers listed."""
    return spark.createDataFrame([(gate, GATES[gate], s, d) for s, d in found], VIOLATION)


def input_integrity(problems: DataFrame) -> DataFrame:
    return violations(problems, "input_integrity", F.col("source_archive_id"), F.col("problem"))


def filename(catalog: DataFrame) -> DataFrame:
    return violations(catalog.where("source_kind = 'unknown' OR name_diagnostic IS NOT NULL"), "filename", F.col("path"), F.col("name_diagnostic"))


def schema_fingerprint(inspected: DataFrame, known: list[str]) -> DataFrame:
    bad = inspected.where(F.col("raw_schema_fingerprint").isNotNull() & ~F.col("raw_schema_fingerprint").isin(known))
    return violations(bad, "schema_fingerprint", F.col("path"), F.col("raw_schema_fingerprint"))


def csv_structure(diagnostics: DataFrame) -> DataFrame:
    return violations(diagnostics, "csv_structure", F.concat_ws("#", "archive", "record_ordinal"), F.col("reason"))


def type_conversion(typed: DataFrame, locator: list[str]) -> DataFrame:
    bad = typed.where(F.size("errors") > 0).select(*locator, F.explode("errors").alias("e"))
    return violations(bad, "type_conversion", F.concat_ws("#", *locator), F.concat_ws(":", "e.code", "e.field"))


def identifier_uniqueness(df: DataFrame, id_column: str) -> DataFrame:
    again = df.groupBy(id_column).agg(F.count("*").alias("n")).where("n > 1")
    return violations(again, "identifier_uniqueness", F.col(id_column), F.col("n"))


def join_cardinality(report: DataFrame, allowed: list[str], least_coverage: float) -> DataFrame:
    """``report``: rows of ``cardinality``."""
    total = F.col("matched_keys") + F.col("left_only_keys")
    bad = report.where(~F.col("cardinality").isin(allowed) | (F.col("matched_keys") < total * least_coverage))
    return violations(bad, "join_cardinality", F.col("cardinality"), F.concat_ws("/", F.col("matched_keys").cast("string"), total.cast("string")))


def split_isolation(df: DataFrame, group: str) -> DataFrame:
    return violations(splits.split_isolation(df, group), "split_isolation", F.col(group), F.concat_ws(",", "a", "b"))


def duplicate_collision(df: DataFrame, id_column: str, content: str, quarantined: DataFrame) -> DataFrame:
    """Collisions that are not in the quarantine."""
    bad = duplicates.collisions(df, id_column, content).join(quarantined.select(id_column), id_column, "left_anti")
    return violations(bad, "duplicate_collision", F.col(id_column), F.col("contents"))


def future_leak(samples: DataFrame, game: str, position: str) -> DataFrame:
    return violations(decisions.leaks(samples, game, position), "future_leak", F.col(game), F.col(position))


def perspective(samples: DataFrame, safe: list[str]) -> DataFrame:
    found = [(f, "not declared safe") for f in decisions.input_violations(samples.schema, safe)] + [(f, "forbidden name") for f in decisions.forbidden_names(samples.schema)]
    return listed(samples.sparkSession, "perspective", found)


def provenance(df: DataFrame, id_column: str, registered: DataFrame) -> DataFrame:
    """Rows without source archives, or with one that is not registered."""
    empty = df.where(F.coalesce(F.size("provenance.source_archives"), F.lit(0)) <= 0)
    named = df.select(F.col(id_column), F.explode("provenance.source_archives").alias("archive"))
    stray = named.join(registered.select(F.col("path").alias("archive")), "archive", "left_anti")
    return violations(empty, "provenance", F.col(id_column), "empty").unionByName(violations(stray, "provenance", F.col(id_column), F.col("archive")))


def privacy(holds: DataFrame) -> DataFrame:
    return violations(holds, "privacy", F.concat_ws(".", "column", "pattern"), F.col("hits"))


def row_counts(stage_counts: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Units that don't add up, and a difference between rows emitted and rows in shards."""
    unexplained = violations(counts.conserve(stage_counts), "row_counts", F.col("unit"), F.col("unexplained"))
    emitted = stage_counts.agg(F.coalesce(F.sum("accepted"), F.lit(0)).alias("emitted"))
    written = artifacts.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("written"))
    both = emitted.join(F.broadcast(written)).where("emitted <> written")  # one row each
    return unexplained.unionByName(violations(both, "row_counts", "all", F.concat_ws("/", F.col("emitted").cast("string"), F.col("written").cast("string"))))


def parquet_readability(shards: DataFrame) -> DataFrame:
    """``shards``: each shard with its problem, if it has one."""
    return violations(shards.where("problem IS NOT NULL"), "parquet_readability", F.col("path"), F.concat_ws(": ", "problem", "detail"))


def nothing_released(entered: int, left: int, what: str, spark: SparkSession) -> DataFrame:
    """A view without a row though rows entered it: they must not vanish unseen."""
    return listed(spark, "row_counts", [(what, f"0 of {entered}")] if entered and not left else [])


def manifest(differences: DataFrame) -> DataFrame:
    return violations(differences, "manifest", F.col("path"), F.col("problem"))


def run_gates(found: list[DataFrame]) -> DataFrame:
    """All violations of all gates."""
    return reduce(DataFrame.unionByName, found)


def dispositions(found: DataFrame) -> DataFrame:
    return found.groupBy("gate", "disposition").agg(F.count("*").alias("violations"))


def blocks(found: DataFrame) -> bool:
    """Whether a violation forbids the release.  A run that finds one has itself succeeded."""
    return bool(found.where(F.col("disposition").isin(*BLOCKING)).head(1))
