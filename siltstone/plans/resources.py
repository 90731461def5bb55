"""What each stage of a run took from every process: time, memory, spill and bytes, read from Spark's event log.

The event log is itself data: Spark reads it as JSON in tasks and adds it up by
stage.  A session writes a log that this reads with the settings ``RECORDED``:
memory of the JVMs and of the Python workers below them is sampled from ``/proc``
on each executor, not on the driver alone.

Attempts of a stage are added up, and the peaks are the highest of any process in
any attempt.  Stages of which no task ended have zeros.  Lines that are cut off,
as those of a run that was killed, are skipped and counted (``damaged_lines``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Settings of a session whose log has all figures.  Its codec is none that Spark's text reader opens, so logs stay plain.
RECORDED = {
    "spark.eventLog.enabled": "true",
    "spark.eventLog.compress": "false",
    "spark.eventLog.logStageExecutorMetrics": "true",
    "spark.executor.processTreeMetrics.enabled": "true",
    "spark.executor.metrics.pollingInterval": "200ms",
}

# Names of the event log's fields.
PEAKS = "JVMHeapMemory LONG, JVMOffHeapMemory LONG, ProcessTreeJVMRSSMemory LONG, ProcessTreePythonRSSMemory LONG, ProcessTreeOtherRSSMemory LONG"
EVENTS = f"""
`Event` STRING, `Stage ID` LONG, `Stage Attempt ID` LONG, `Executor ID` STRING, `Executor Metrics` STRUCT<{PEAKS}>, `Task Executor Metrics` STRUCT<{PEAKS}>,
`Stage Info` STRUCT<`Stage ID`: LONG, `Stage Attempt ID`: LONG, `Stage Name`: STRING, `Submission Time`: LONG, `Completion Time`: LONG, `Failure Reason`: STRING>,
`Task Info` STRUCT<`Executor ID`: STRING, `Failed`: BOOLEAN, `Killed`: BOOLEAN>,
`Task Metrics` STRUCT<`Executor Run Time`: LONG, `Executor CPU Time`: LONG, `JVM GC Time`: LONG, `Peak Execution Memory`: LONG, `Memory Bytes Spilled`: LONG, `Disk Bytes Spilled`: LONG,
  `Shuffle Read Metrics`: STRUCT<`Remote Bytes Read`: LONG, `Local Bytes Read`: LONG>, `Shuffle Write Metrics`: STRUCT<`Shuffle Bytes Written`: LONG>,
  `Input Metrics`: STRUCT<`Bytes Read`: LONG, `Records Read`: LONG>, `Output Metrics`: STRUCT<`Bytes Written`: LONG, `Records Written`: LONG>>,
`_damaged` STRING
"""
MB = 1 << 20


def events(spark: SparkSession, log: str) -> DataFrame:
    """The lines of a log: a file, a rolled log's folder, or a folder of logs."""
    reader = spark.read.schema(EVENTS).option("columnNameOfCorruptRecord", "_damaged").option("recursiveFileLookup", "true").option("pathGlobFilter", "*[0-9a-z]")
    return reader.json(log)


def damaged_lines(found: DataFrame) -> DataFrame:
    """Lines that are whole events, and lines that are none."""
    return found.agg(F.count("Event").alias("events"), F.count("_damaged").alias("damaged"))


def stage_resources(found: DataFrame) -> DataFrame:
    """A row a stage: its name, attempts, tasks, seconds, peaks in MB by kind of process, spill, and bytes and rows in and out.

    ``seconds`` is the stage's wall time, ``run_seconds`` and ``cpu_seconds`` are
    summed over its tasks; CPU time is that of JVM threads, so what Python workers
    compute shows in the difference.
    """
    ended = F.col("Event") == "SparkListenerTaskEnd"
    done = F.col("Event") == "SparkListenerStageCompleted"
    peaks = F.coalesce(F.col("`Task Executor Metrics`"), F.col("`Executor Metrics`"))
    info, task, metrics = F.col("`Stage Info`").getField, F.col("`Task Info`").getField, F.col("`Task Metrics`").getField
    total = lambda x: F.coalesce(F.sum(F.when(ended, x)), F.lit(0))
    peak = lambda x: F.round(F.coalesce(F.max(x), F.lit(0)) / MB, 1)
    kept = found.where(F.col("Event").isin("SparkListenerTaskEnd", "SparkListenerStageCompleted", "SparkListenerStageExecutorMetrics"))
    return (
        kept.withColumn("stage", F.coalesce(info("Stage ID"), F.col("`Stage ID`")))
        .groupBy("stage")
        .agg(
            F.max(info("Stage Name")).alias("name"),
            F.sum(done.cast("long")).alias("attempts"),
            F.sum((done & info("Failure Reason").isNotNull()).cast("long")).alias("failed_attempts"),
            total(F.lit(1)).alias("tasks"),
            total((task("Failed") | task("Killed")).cast("long")).alias("failed_tasks"),
            F.coalesce(F.sum(F.when(done, info("Completion Time") - info("Submission Time"))) / 1000, F.lit(0.0)).alias("seconds"),
            (total(metrics("Executor Run Time")) / 1000).alias("run_seconds"),
            (total(metrics("Executor CPU Time")) / 1e9).alias("cpu_seconds"),
            (total(metrics("JVM GC Time")) / 1000).alias("gc_seconds"),
            F.count_distinct(task("Executor ID")).alias("executors"),
            peak(peaks["JVMHeapMemory"]).alias("peak_heap_mb"),
            peak(peaks["ProcessTreeJVMRSSMemory"]).alias("peak_jvm_rss_mb"),
            peak(peaks["ProcessTreePythonRSSMemory"]).alias("peak_python_rss_mb"),
            peak(F.when(ended, metrics("Peak Execution Memory"))).alias("peak_execution_mb"),
            total(metrics("Memory Bytes Spilled")).alias("spilled_memory_bytes"),
            total(metrics("Disk Bytes Spilled")).alias("spilled_disk_bytes"),
            total(metrics("Shuffle Read Metrics")["Remote Bytes Read"] + metrics("Shuffle Read Metrics")["Local Bytes Read"]).alias("shuffle_read_bytes"),
            total(metrics("Shuffle Write Metrics")["Shuffle Bytes Written"]).alias("shuffle_write_bytes"),
            total(metrics("Input Metrics")["Bytes Read"]).alias("input_bytes"),
            total(metrics("Input Metrics")["Records Read"]).alias("input_rows"),
            total(metrics("Output Metrics")["Bytes Written"]).alias("output_bytes"),
            total(metrics("Output Metrics")["Records Written"]).alias("output_rows"),
        )
    )
