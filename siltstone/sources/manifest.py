"""The source catalog: an audit document, and the semantic projection that has a digest."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.canonical import canonical_encode
from siltstone.sources.inspection import inspection_id

CATALOG_SCHEMA = "source-manifest-v1"
#: What identity is made of; nothing else enters, unless a new version says so.
SEMANTIC = ["source_archive_id", "provider", "source_kind", "expansion", "format", "source_url", "license_status"]


INSPECTIONS = ["source_archive_id", "inspection_id", "method", "scope", "raw_schema_fingerprint", "problem", "inspected_at"]


def inspected(reports: DataFrame, method: str, scope: str) -> DataFrame:
    """Reports (source_archive_id, raw_schema_fingerprint, problem, inspected_at) with their identity.

    It is of archive, method, scope and what was found; when and by whom it was found is not in it.
    """
    named = reports.withColumns({"method": F.lit(method), "scope": F.lit(scope)})
    parts = [F.col(c) for c in ("source_archive_id", "method", "scope", "raw_schema_fingerprint", "problem")]
    return named.withColumn("inspection_id", inspection_id(*parts)).select(*INSPECTIONS)


def append_inspections(found: DataFrame, path: str) -> None:
    """Add to the table of inspections at ``path``; nothing in it is ever changed, and repeats stand beside each other."""
    found.select(*INSPECTIONS).write.mode("append").parquet(path)


def audit_catalog(records: DataFrame, inspections: DataFrame, as_of=None, examples: int = 3) -> DataFrame:
    """Every record with its inspections up to ``as_of`` and its diagnostics.

    ``inspections`` counts reports; of one identity they are one of ``findings``, with how often and when it
    was last found.  The ``examples`` findings last found are listed, the latest first.  ``fingerprints`` over 1 says that
    inspections disagree.
    """
    known = inspections.where(F.col("inspected_at") <= as_of) if as_of is not None else inspections
    each = known.groupBy("source_archive_id", "inspection_id").agg(F.count("*").alias("times"), F.max("inspected_at").alias("last"), F.first("raw_schema_fingerprint").alias("fingerprint"), F.first("problem").alias("problem"))
    ranked = each.withColumn("_rank", F.row_number().over(Window.partitionBy("source_archive_id").orderBy(F.desc("last"), "inspection_id")))
    listed = F.sort_array(F.collect_list(F.when(F.col("_rank") <= examples, F.struct("_rank", "inspection_id", "fingerprint", "problem", "times", "last"))))
    reports = ranked.groupBy("source_archive_id").agg(
        F.sum("times").alias("inspections"), F.count("*").alias("findings"), F.count_distinct("fingerprint").alias("fingerprints"), F.count("problem").alias("problems"), listed.alias("latest")
    )
    diagnosed = F.array_compact(F.array(*(F.when(c, F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"))) for code, severity, c in (
        ("unknown_kind", "warning", F.col("source_kind") == "unknown"),
        ("source_url_missing", "warning", F.col("source_url").isNull()),
        ("license_not_verified", "release_blocking", F.col("license_status") != "verified"),
        ("never_inspected", "warning", F.col("inspections").isNull()),
        ("inspections_disagree", "warning", F.col("fingerprints") > 1),
        ("inspection_problem", "warning", F.col("problems") > 0),
    ))))
    return records.join(reports, "source_archive_id", "left").withColumn("diagnostics", diagnosed)


def semantic_projection(catalog: DataFrame) -> DataFrame:
    """The allowed columns of each archive, in canonical order."""
    missing = [c for c in SEMANTIC if c not in catalog.columns]
    if missing:
        raise ValueError(f"the catalog lacks {missing}")
    return catalog.select(*SEMANTIC).distinct().orderBy("source_archive_id")


def catalog_digest(projection: DataFrame) -> DataFrame:
    """One row: the digest of the set of archives.  The catalog has a row per archive."""
    if sorted(projection.columns) != sorted(SEMANTIC):
        raise ValueError("only the semantic projection has a digest")
    encoded = projection.select(canonical_encode(projection.schema, SEMANTIC).alias("e")).distinct()
    body = F.concat(F.lit(CATALOG_SCHEMA + "|"), F.array_join(F.sort_array(F.collect_list("e")), ""))
    return encoded.agg(F.sha2(body, 256).alias("catalog_digest"))
