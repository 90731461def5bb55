"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_top(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where that is unset and the master local, a new one, named there."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"spark.checkpoint.dir names no shared folder, and {master} is no local master")
        found = "file://" + tempfile.mkdtemp(prefix="siltstone-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def fresh_table(spark: SparkSession, name: str) -> str:
    """A new path there, deleted when the application ends."""
    path = f"{shared_top(spark)}/{name}-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written there and read again: computed once, and whole after the loss of any executor."""
    path = fresh_table(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
