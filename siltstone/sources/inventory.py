"""Discovery of archives under configured roots, their recognition, pairing and drift."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.names import base_name, recognise
from siltstone.sources.config import inside

PATHS = "root string, path string, bytes long, duplicate_of string, diagnostic string"


def discover(spark: SparkSession, roots: list[str]) -> DataFrame:
    """Each candidate ``.csv.gz`` once, in order of path, with diagnostics.

    Names one archive reached by two paths (a link, or nested roots) has one real
    path; the second sighting names the first.  A link out of its root is listed
    and not followed.
    """
    rows, seen = [], {}
    for root in sorted(set(roots)):
        if not os.path.isdir(root):
            rows.append((root, root, None, None, "missing_root"))
            continue
        for folder, folders, names in os.walk(root):
            folders.sort()
            for name in sorted(names):
                if not name.lower().endswith(".csv.gz"):
                    continue
                path = os.path.join(folder, name)
                real = os.path.realpath(path)
                if not inside(real, root):
                    rows.append((root, path, None, None, "leads_out_of_root"))
                elif not os.path.isfile(real):
                    rows.append((root, path, None, None, "unreadable"))
                else:
                    rows.append((root, path, os.path.getsize(real), seen.get(real), "duplicate_path" if real in seen else None))
                    seen.setdefault(real, path)
    return spark.createDataFrame(rows, PATHS)  # one row a file


def recognised(paths: DataFrame) -> DataFrame:
    """``paths`` with source_kind, expansion, format and the name's diagnostic."""
    named = paths.withColumn("file_name", base_name(F.col("path"))).withColumn("_n", recognise(F.col("file_name")))
    return named.select(*paths.columns, "file_name", "_n.source_kind", "_n.expansion", "_n.format", F.col("_n.diagnostic").alias("name_diagnostic"))


def processable(catalog: DataFrame) -> DataFrame:
    """Replay and game archives; drafts and unknown files are only catalogued."""
    return catalog.where(F.col("source_kind").isin("replay", "game"))


def inventory_report(catalog: DataFrame, roots: list[str]) -> DataFrame:
    """Counts by kind, each row with the roots that they are of: no claim goes beyond them."""
    scope = F.struct(F.array(*map(F.lit, sorted(set(roots)))).alias("roots"), F.lit("configured roots of this run").alias("meaning"))
    return catalog.groupBy("source_kind").agg(F.count("*").alias("files"), F.count("diagnostic").alias("diagnosed"), F.sum("bytes").alias("bytes")).withColumn("scope", scope)


def candidate_pairs(catalog: DataFrame, evidence: DataFrame) -> DataFrame:
    """Replay and game archives of equal expansion and format whose key is proven.

    ``evidence``: (expansion, format, key, verdict).  Archives are never paired by
    nearness or order.
    """
    proven = evidence.where("verdict = 'accepted'").select("expansion", "format", "key")
    side = lambda kind: catalog.where(F.col("source_kind") == kind).select(F.col("path").alias(kind), "expansion", "format")
    return side("replay").join(side("game"), ["expansion", "format"]).join(proven, ["expansion", "format"])


def reconcile(previous: DataFrame, current: DataFrame, key: str = "path", content: str = "sha256", state: str = "state") -> DataFrame:
    """Drift between two inventories: (key, drift, old and new content).

    ``state`` of the current rows is supported, unsupported, incomplete or unknown;
    a changed content overrides it.
    """
    old = previous.select(F.col(key), F.col(content).alias("old_content"))
    new = current.select(F.col(key), F.col(content).alias("new_content"), F.col(state).alias("state"))
    both = old.join(new, key, "full_outer")
    drift = F.when(F.col("old_content").isNull() & F.col("new_content").isNotNull(), F.concat(F.lit("new_"), F.coalesce("state", F.lit("unknown")))).when(F.col("state").isNull(), "removed").when(~F.col("old_content").eqNullSafe(F.col("new_content")), "changed").otherwise(F.coalesce("state", F.lit("unknown")))
    return both.select(key, drift.alias("drift"), "old_content", "new_content")
