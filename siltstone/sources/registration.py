"""Registration of archives by their exact compressed bytes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.canonical import tagged
from siltstone.sources.gzcsv import Fatal, decompressed, open_stream

RECORD_SCHEMA = "source-archive-record-v1"
HASHED = "path string, sha256 string, compressed_bytes long, decompressed_bytes long, integrity string"


def hash_archives(paths: DataFrame, parallelism: int = 64, ratio: int = 1000, most: int = 1 << 42) -> DataFrame:
    """SHA-256 and length of each file's bytes, and whether they decompress, in one streaming pass."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        class Tee:
            def __init__(self, source):
                self.source, self.sum, self.n = source, hashlib.sha256(), 0

            def read(self, n):
                part = self.source.read(n)
                self.sum.update(part)
                self.n += len(part)
                return part

        for batch in batches:
            for path in batch.column("path").to_pylist():
                made, state = 0, "ok"
                try:
                    with open_stream(path) as source:
                        tee = Tee(source)
                        try:
                            for part in decompressed(tee, ratio, most):
                                made += len(part)
                        except Fatal as error:
                            state = str(error)
                            while tee.read(1 << 20):
                                pass
                    row = (path, tee.sum.hexdigest(), tee.n, made, state)
                except OSError as error:
                    row = (path, None, None, None, f"unreadable: {type(error).__name__}")
                kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], ["path", "sha256", "compressed_bytes", "decompressed_bytes", "integrity"])

    return paths.select("path").distinct().repartition(parallelism, "path").mapInArrow(hashed, HASHED)


def archive_id(provider: str, sha256: Column) -> Column:
    """Of the provider's namespace and the compressed bytes alone."""
    return F.when(sha256.isNotNull(), F.concat(F.lit("archive:v1:"), F.sha2(F.concat(tagged("s", F.lit(provider)), tagged("s", sha256)), 256)))


def registrations(catalog: DataFrame, hashes: DataFrame, provider: str) -> DataFrame:
    """A record for each archive, the first path in order giving its file name."""
    rows = catalog.join(hashes, "path").where("sha256 IS NOT NULL").withColumn("source_archive_id", archive_id(provider, F.col("sha256")))
    first = F.min(F.struct("path", "file_name", "source_kind", "expansion", "format"))
    grouped = rows.groupBy("source_archive_id", "sha256", "compressed_bytes").agg(first.alias("f"), F.countDistinct("source_kind").alias("kinds"))
    return grouped.select(
        F.lit(RECORD_SCHEMA).alias("source_archive_record_schema_id"),
        "source_archive_id",
        F.lit(provider).alias("provider"),
        F.col("f.file_name").alias("original_filename"),
        "sha256",
        "compressed_bytes",
        F.when(F.col("kinds") == 1, F.col("f.source_kind")).otherwise("unknown").alias("source_kind"),
        F.when(F.col("kinds") == 1, F.col("f.expansion")).alias("expansion"),
        F.when(F.col("kinds") == 1, F.col("f.format")).alias("format"),
        F.when(F.col("kinds") > 1, "conflicting_kinds").alias("diagnostic"),
        F.lit(None).cast("string").alias("source_url"),
        F.lit("pending").alias("license_status"),
        F.current_timestamp().alias("ingested_at"),
    )


def register(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Rows to append: those of archives not registered yet.  A known one is never changed."""
    return new.join(existing.select("source_archive_id"), "source_archive_id", "left_anti").select(*new.columns)


def verify(registered: DataFrame, hashes: DataFrame, provider: str) -> DataFrame:
    """Registered archives whose bytes are gone, changed or corrupt now: (source_archive_id, problem)."""
    now = hashes.withColumn("source_archive_id", archive_id(provider, F.col("sha256"))).groupBy("source_archive_id").agg(F.max(F.col("integrity") == "ok").alias("sound"), F.max("integrity").alias("state"))
    found = registered.select("source_archive_id").join(now, "source_archive_id", "left")
    problem = F.when(F.col("sound").isNull(), "bytes_missing_or_changed").when(~F.col("sound"), F.col("state"))
    return found.select("source_archive_id", problem.alias("problem")).where("problem IS NOT NULL")


def license_states(registered: DataFrame, reviews: DataFrame) -> DataFrame:
    """(source_archive_id, license_status, evidence): the latest review, else as registered.

    ``reviews``: append-only (source_archive_id, review_no, license_status, evidence).
    """
    latest = reviews.groupBy("source_archive_id").agg(F.max_by(F.struct("license_status", "evidence"), "review_no").alias("r"))
    status = F.coalesce("r.license_status", "license_status").alias("license_status")
    return registered.join(latest, "source_archive_id", "left").select("source_archive_id", status, F.col("r.evidence").alias("evidence"))


def license_holds(states: DataFrame) -> DataFrame:
    """Archives that block a release: all that are not verified with evidence."""
    return states.where(~F.coalesce((F.col("license_status") == "verified") & (F.length("evidence") > 0), F.lit(False)))
