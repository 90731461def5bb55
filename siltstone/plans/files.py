"""Writing views as Parquet shards, listing them with hashes, and checking the list."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.sources.config import safe_name

ARTIFACT = "path string, bytes long, rows long, sha256 string"


def partition_plan(df: DataFrame, columns: list[str], most: int = 1000, least_rows: int = 1) -> list[str]:
    """The columns, if their values are few and every one safe in a path; else it raises."""
    if not columns:
        return []
    found = df.groupBy(*columns).agg(F.count("*").alias("n")).limit(most + 1).collect()  # most + 1 rows
    if len(found) > most:
        raise ValueError(f"{columns} have over {most} values")
    for row in found:
        for c in columns:
            safe_name(str(row[c]))
        if row["n"] < least_rows:
            raise ValueError(f"a partition has fewer than {least_rows} rows")
    return columns


def write_view(df: DataFrame, path: str, partition_by: list[str] | None = None, order: list[str] | None = None, compression: str = "zstd", shard_bytes: int = 512 << 20, max_rows: int = 0) -> None:
    """Typed Parquet shards of about ``shard_bytes``, sorted inside each shard.

    The rebalance lets adaptive execution join small partitions and split large
    ones by measured size.
    """
    spark = df.sparkSession
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(shard_bytes))
    try:
        out = df.hint("rebalance", *(partition_by or []))
        if order:
            out = out.sortWithinPartitions(*(partition_by or []), *order)
        writer = out.write.mode("errorifexists").option("compression", compression)
        if max_rows:
            writer = writer.option("maxRecordsPerFile", max_rows)
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def list_files(top: str) -> list[str]:
    """Relative paths of data files; Hadoop's hidden and marker files are left out."""
    found = []
    for folder, folders, names in os.walk(top):
        folders[:] = sorted(f for f in folders if not f.startswith((".", "_")))
        found += [os.path.relpath(os.path.join(folder, n), top) for n in sorted(names) if not n.startswith((".", "_"))]
    return found


def artifact_manifest(spark: SparkSession, top: str, parallelism: int = 64) -> DataFrame:
    """(path, bytes, rows, sha256) of each data file below ``top``; Parquet footers give the rows."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                at, total = os.path.join(top, path), hashlib.sha256()
                with open(at, "rb") as f:
                    while part := f.read(1 << 20):
                        total.update(part)
                rows = pq.ParquetFile(at).metadata.num_rows if path.endswith(".parquet") else None
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([os.path.getsize(at)], pa.int64()), pa.array([rows], pa.int64()), pa.array([total.hexdigest()])], ["path", "bytes", "rows", "sha256"])

    paths = spark.createDataFrame([(p,) for p in list_files(top)], "path string")
    return paths.repartition(parallelism, "path").mapInArrow(measured, ARTIFACT)


def manifest_digest(artifacts: DataFrame) -> str:
    """Of all files' paths, sizes, rows and hashes."""
    lines = sorted(f"{r['path']}|{r['bytes']}|{r['rows']}|{r['sha256']}" for r in artifacts.collect())  # one row a file
    return "artifacts:v1:" + hashlib.sha256("\n".join(lines).encode()).hexdigest()


def verify_manifest(declared: DataFrame, actual: DataFrame) -> DataFrame:
    """(path, problem): files that are missing, extra or differ."""
    d, a = declared.select("path", F.struct("bytes", "rows", "sha256").alias("d")), actual.select("path", F.struct("bytes", "rows", "sha256").alias("a"))
    problem = F.when(F.col("a").isNull(), "missing").when(F.col("d").isNull(), "extra").when(~F.col("a").eqNullSafe(F.col("d")), "mismatch")
    return d.join(a, "path", "full_outer").select("path", problem.alias("problem")).where("problem IS NOT NULL")


SHARD = "path string, rows long, problem string, detail string"

# Arrow's names of types as Spark has them.
SPARK_NAMES = {"int64": "bigint", "int32": "int", "int16": "smallint", "int8": "tinyint", "bool": "boolean", "large_string": "string", "large_binary": "binary", "date32[day]": "date"}


def arrow_name(kind: pa.DataType) -> str:
    """An Arrow type by the name that Spark gives it."""
    if pa.types.is_struct(kind):
        return "struct<" + ",".join(f"{kind.field(k).name}:{arrow_name(kind.field(k).type)}" for k in range(kind.num_fields)) + ">"
    if pa.types.is_map(kind):
        return f"map<{arrow_name(kind.key_type)},{arrow_name(kind.item_type)}>"
    if pa.types.is_list(kind) or pa.types.is_large_list(kind):
        return f"array<{arrow_name(kind.value_type)}>"
    if pa.types.is_timestamp(kind):
        return "timestamp" if kind.tz else "timestamp_ntz"
    if pa.types.is_decimal(kind):
        return f"decimal({kind.precision},{kind.scale})"
    return SPARK_NAMES.get(str(kind), str(kind))


def footer_problems(found: pa.Schema, wanted: list[tuple[str, str, bool]]) -> list[tuple[str, str]]:
    """(problem, detail) of a shard's columns against those declared: (name, type, whether it may be null)."""
    if found.names != [n for n, _, _ in wanted]:
        return [("columns", ",".join(found.names))]
    problems = [("type", f"{n}: {arrow_name(f.type)}") for f, (n, kind, _) in zip(found, wanted, strict=True) if arrow_name(f.type) != kind]
    return problems + [("nullability", n) for f, (n, _, nullable) in zip(found, wanted, strict=True) if f.nullable and not nullable]


def verified_shards(spark: SparkSession, top: str, schema: T.StructType, partition_by: list[str] | None = None, parallelism: int = 64) -> DataFrame:
    """(path, rows, problem, detail): each shard below ``top`` under the declared schema.

    Tasks read each footer for columns, types, nullability and count, and then every row, a batch at a time.
    A sound shard has one row without a problem; others have one for each problem.
    """
    wanted = [(f.name, f.dataType.simpleString(), f.nullable) for f in schema.fields if f.name not in (partition_by or [])]

    def checked(path: str) -> list[tuple]:
        try:
            with pq.ParquetFile(os.path.join(top, path)) as shard:
                rows = shard.metadata.num_rows
                problems = footer_problems(shard.schema_arrow, wanted)
                read = sum(batch.num_rows for batch in shard.iter_batches(65_536))
        except (pa.ArrowException, OSError, ValueError) as error:
            return [(path, None, "unreadable", type(error).__name__)]
        if read != rows:
            problems.append(("count", f"{read} of {rows}"))
        return [(path, rows, *p) for p in problems] or [(path, rows, None, None)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string()]
        for batch in batches:
            for path in batch.column("path").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*checked(path), strict=True), kinds, strict=True)], ["path", "rows", "problem", "detail"])

    paths = [(p,) for p in list_files(top) if p.endswith(".parquet")]
    return spark.createDataFrame(paths, "path string").repartition(max(1, min(parallelism, len(paths))), "path").mapInArrow(run, SHARD)


def by_folder(shards: DataFrame) -> DataFrame:
    """``shards`` with all of one folder and problem as one row: how many a folder has is the cluster's matter."""
    folder = F.regexp_replace("path", "/[^/]*$", "").alias("path")
    return shards.groupBy(folder, "problem").agg(F.sum("rows").alias("rows"), F.min("detail").alias("detail")).select("path", "rows", "problem", "detail")


def write_json(path: str, value) -> None:
    """The document, under its name only once it is whole."""
    with open(path + ".incomplete", "w", encoding="utf-8") as f:
        json.dump(value, f, sort_keys=True, indent=1, ensure_ascii=False)
        f.flush()
        os.fsync(f.fileno())
    os.replace(path + ".incomplete", path)


def write_quarantine(df: DataFrame, path: str, reason: str | None, keep: list[str], release_root: str) -> None:
    """Held-back rows: identity, locator and hash columns and the reason (or each row's own); raw values stay out."""
    from siltstone.sources.config import PathError, inside

    if inside(path, release_root):
        raise PathError("the quarantine must lie outside the release")
    df.select(*keep, F.lit(reason).alias("reason") if reason else F.col("reason")).write.mode("errorifexists").parquet(path)
