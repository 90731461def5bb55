"""New archives as they arrive: a file stream that names each once and ends when none is left.

Only names and sizes are taken up; hashing and inspection follow in the batch
operators.  The stream's checkpoint remembers what was seen, so a rerun lists
only what came since.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.names import base_name, recognise


def arrivals(spark: SparkSession, root: str) -> DataFrame:
    """A streaming frame of (path, bytes, modified, source_kind, expansion, format, name_diagnostic)."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", "*.csv.gz").option("recursiveFileLookup", "true").load(root)
    named = files.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")).withColumn("_n", recognise(base_name(F.col("path"))))
    return named.select("path", "bytes", "modified", "_n.source_kind", "_n.expansion", "_n.format", F.col("_n.diagnostic").alias("name_diagnostic"))


def record_arrivals(spark: SparkSession, root: str, inventory: str, checkpoint: str) -> None:
    """Append all archives that have come since the last run to the inventory table."""
    stream = arrivals(spark, root).writeStream.format("parquet").option("path", inventory).option("checkpointLocation", checkpoint)
    stream.trigger(availableNow=True).start().awaitTermination()
