"""Measurements of a run: throughput, memory and sizes, with what they were taken on."""

from __future__ import annotations

import os
import platform
import resource
import time
from contextlib import contextmanager

import pyspark
from pyspark.sql import DataFrame, SparkSession

STATS = "stage string, metric string, value double, environment string"


class Stats:
    def __init__(self, config: str):
        self.rows: list[tuple[str, str, float, str]] = []
        self.environment = f"{platform.machine()} {os.cpu_count()} cores, Python {platform.python_version()}, Spark {pyspark.__version__}, config {config[:12]}"

    def add(self, stage: str, metric: str, value: float) -> None:
        self.rows.append((stage, metric, float(value), self.environment))

    @contextmanager
    def timed(self, stage: str, rows: int | None = None, compressed: int | None = None):
        """Seconds of the block, and of what it read per second and minute."""
        began, done = time.monotonic(), {"rows": rows, "compressed": compressed}
        yield done
        took = max(time.monotonic() - began, 1e-9)
        self.add(stage, "seconds", took)
        if done["rows"] is not None:
            self.add(stage, "rows_per_second", done["rows"] / took)
        if done["compressed"] is not None:
            self.add(stage, "compressed_gb_per_minute", done["compressed"] / 1e9 / took * 60)
        self.add(stage, "peak_rss_mb", resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024)

    def sizes(self, stage: str, source_bytes: int, output_bytes: int) -> None:
        self.add(stage, "output_bytes", output_bytes)
        self.add(stage, "compression_ratio", source_bytes / max(output_bytes, 1))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, STATS)
