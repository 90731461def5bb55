"""Resource figures of all processes, from the event log of a run in a process of its own."""

from __future__ import annotations

import json
import os
import subprocess
import sys

import pytest

from siltstone.plans import resources

JOB = """
import sys, time
import pandas as pd
from pyspark.sql import SparkSession, functions as F
from siltstone.plans import resources
made = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.eventLog.dir", "file://" + sys.argv[1]).config("spark.eventLog.rolling.enabled", sys.argv[2])
for k, v in resources.RECORDED.items():
    made = made.config(k, v)
spark = made.getOrCreate()
def slow(batches):
    for b in batches:
        held = bytearray(50 << 20)
        time.sleep(1)
        yield b
spark.range(1000).write.parquet(sys.argv[1] + "/../rows")
rows = spark.read.parquet(sys.argv[1] + "/../rows").mapInPandas(slow, "id long").groupBy((F.col("id") % 7).alias("k")).count()
assert len(rows.collect()) == 7
spark.stop()
"""


@pytest.mark.parametrize("rolling", ["true", "false"])
def test_each_stage_has_figures_of_its_processes(spark, tmp_path, rolling):
    log = tmp_path / "log"
    log.mkdir()
    subprocess.run([sys.executable, "-c", JOB, str(log), rolling], check=True, timeout=240, env={**os.environ, "PYTHONPATH": os.environ["PYTHONPATH"]}, capture_output=True)
    found = resources.events(spark, str(log))
    stages = {r["stage"]: r for r in resources.stage_resources(found).collect()}
    assert len(stages) >= 4  # stages that were skipped have none
    assert all(r["attempts"] == 1 and r["failed_tasks"] == 0 and r["tasks"] > 0 and r["seconds"] > 0 for r in stages.values())
    assert max(r["peak_python_rss_mb"] for r in stages.values()) > 50
    assert max(r["peak_jvm_rss_mb"] for r in stages.values()) > 50
    assert sum(r["output_rows"] for r in stages.values()) == 1000
    assert sum(r["shuffle_write_bytes"] for r in stages.values()) == sum(r["shuffle_read_bytes"] for r in stages.values()) > 0
    assert resources.damaged_lines(found).first()["damaged"] == 0


def test_failures_attempts_and_damage(spark, tmp_path):
    def task(stage, attempt, run, failed=False):
        return {"Event": "SparkListenerTaskEnd", "Stage ID": stage, "Stage Attempt ID": attempt, "Task Info": {"Executor ID": "1", "Failed": failed, "Killed": False}, "Task Executor Metrics": {"JVMHeapMemory": run << 20, "ProcessTreePythonRSSMemory": 0}, "Task Metrics": {"Executor Run Time": run, "Executor CPU Time": run * 1_000_000}}

    def stage(number, attempt, reason=None):
        info = {"Stage ID": number, "Stage Attempt ID": attempt, "Stage Name": f"s{number}", "Submission Time": 1000, "Completion Time": 3000}
        return {"Event": "SparkListenerStageCompleted", "Stage Info": info | ({"Failure Reason": reason} if reason else {})}

    lines = [task(0, 0, 10, failed=True), stage(0, 0, "lost"), task(0, 1, 30), stage(0, 1), stage(1, 0), {"Event": "SparkListenerJobEnd", "Job ID": 0}]
    lines.append({"Event": "SparkListenerStageExecutorMetrics", "Executor ID": "driver", "Stage ID": 1, "Stage Attempt ID": 0, "Executor Metrics": {"JVMHeapMemory": 5 << 20, "ProcessTreePythonRSSMemory": 7 << 20}})
    (tmp_path / "app-1").write_text("\n".join(map(json.dumps, lines)) + '\n{"Event":"SparkListenerTas')
    found = resources.events(spark, str(tmp_path))
    a, b = resources.stage_resources(found).orderBy("stage").collect()
    assert (a["attempts"], a["failed_attempts"], a["tasks"], a["failed_tasks"], a["seconds"], a["run_seconds"], a["peak_heap_mb"]) == (2, 1, 2, 1, 4.0, 0.04, 30.0)
    assert (b["tasks"], b["peak_heap_mb"], b["peak_python_rss_mb"], b["cpu_seconds"]) == (0, 5.0, 7.0, 0.0)
    assert resources.damaged_lines(found).first()["damaged"] == 1


def test_a_log_without_stages_gives_no_rows(spark, tmp_path):
    (tmp_path / "app-2").write_text("")
    assert resources.stage_resources(resources.events(spark, str(tmp_path))).count() == 0
