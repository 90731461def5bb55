"""Helpers shared by the operators: cutting lineage and reading tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of small tables are broadcast up to so many, of a few numbers each.
FEW = 1_000_000

#: White space that separates words: space and the characters 9 to 13.
WORD = "[^\\x20\\x09-\\x0D]+"
GAP = "[\\x20\\x09-\\x0D]+"

#: Paths that are taken while ``cut_alone`` makes its table.
_meanwhile: ContextVar[list[str] | None] = ContextVar("meanwhile", default=None)

#: What ``is_few`` has found, while its tables are in use.
_few: WeakKeyDictionary[DataFrame, bool] = WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is the one named in ``spark.checkpoint.dir``.  Only where that is unset and
    the master is local (as in tests) a temporary folder is made and named there.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"spark.checkpoint.dir names no shared folder, and {master} is no local master")
        found = "file://" + tempfile.mkdtemp(prefix="siltstone-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the application ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    if (paths := _meanwhile.get()) is not None:
        paths.append(path)
    return path


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it again.

    This ends the lineage there: what follows is not recomputed from the
    source, and survives the loss of any executor.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_alone(name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """``make()``, cut; the tables that were cut meanwhile are then deleted, as only this one is read again."""
    outer = _meanwhile.set(paths := [])
    try:
        made = make()
    finally:
        _meanwhile.reset(outer)
    out, spark = cut(made, name), made.sparkSession
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return out


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once for each row.

    An expression that a lambda of a higher-order function mentions is else
    evaluated for each element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def is_few(table: DataFrame) -> bool:
    """Whether a cut table's rows may be broadcast; they are counted once."""
    if table not in _few:
        _few[table] = table.count() <= FEW
    return _few[table]


def maybe_broadcast(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if is_few(table) else table


def whole_row(df: DataFrame) -> Column:
    """All columns in one struct, so that no name of theirs clashes with another."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns))


def numbered(rows: DataFrame, by: list[Column], name: str) -> DataFrame:
    """``rows`` with ``nth``, their number from 0 in the order of ``by``, cut: many tasks number them."""
    dealt = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    dealt = cut(dealt.withColumn("part", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), name)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    starts = dealt.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    return dealt.join(F.broadcast(starts), "part").withColumn("nth", F.col("start") + F.col("row")).drop("part", "row", "start")
