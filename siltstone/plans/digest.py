"""Dataset digests: a hash tree over record hashes, whatever the order, files or partitions."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.contracts import canonical_json

#: Hexadecimal digits of the tree's nodes, widest first.  Part of the digest's version.
WIDTHS = (6, 3, 0)
VERSION = "dataset-digest-v1"


def dataset_digest(df: DataFrame, record_hash: str = "record_hash") -> DataFrame:
    """One row (dataset_digest, records).

    Equal hashes are counted first, so that copies, however many, are one entry.
    A node then holds its children in order: about N / 16^6 entries in a leaf.
    """
    level = df.groupBy(F.col(record_hash).alias("k")).agg(F.count("*").alias("n")).select("k", F.concat_ws(":", "k", F.col("n").cast("string")).alias("entry"), "n")
    for width in WIDTHS:
        node = F.substring("k", 1, width) if width else F.lit("")
        level = level.groupBy(node.alias("k")).agg(F.sha2(F.array_join(F.sort_array(F.collect_list("entry")), ","), 256).alias("h"), F.sum("n").alias("n"))
        level = level.select("k", F.concat_ws(":", "k", "h").alias("entry"), "n", "h")
    return level.select(F.col("h").alias("dataset_digest"), F.col("n").alias("records"))


def semantic_release_id(catalog_digest: str, fingerprints: list[str], contracts: dict[str, str], config: str, dataset: str) -> str:
    """Of inputs, contracts and logical records; neither time nor files enter."""
    body = {"version": "semantic-release-v1", "catalog": catalog_digest, "fingerprints": sorted(set(fingerprints)), "contracts": contracts, "config": config, "dataset": dataset}
    return "release:v1:" + hashlib.sha256(canonical_json(body).encode()).hexdigest()


def build_audit_id(semantic_id: str, execution: dict) -> str:
    """Of one concrete execution: versions, times and host facts."""
    return "build:v1:" + hashlib.sha256(canonical_json({"release": semantic_id, "execution": execution}).encode()).hexdigest()


def compare_builds(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (columns, side) that only one of two builds has; copies count."""
    left, right = a.select(*columns), b.select(*columns)
    return left.exceptAll(right).withColumn("side", F.lit("first")).unionByName(right.exceptAll(left).withColumn("side", F.lit("second")))
