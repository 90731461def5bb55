"""Resumable units: each stage of each archive is written apart and promoted whole."""

from __future__ import annotations

import json
import os
import shutil
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siltstone.contracts import digest
from siltstone.plans.files import write_json
from siltstone.sources.config import resolve_under, safe_name

MARKER = "_COMPLETE"


def checkpoint_id(archive_sha256: str, fingerprint: str, contract_digest: str, stage_version: str, config: str) -> str:
    """Any change of input, schema, contract, code version or configuration gives another unit."""
    return digest({"archive": archive_sha256, "fingerprint": fingerprint, "contract": contract_digest, "stage": stage_version, "config": config})[:40]


def complete(path: str) -> bool:
    return os.path.isfile(os.path.join(path, MARKER))


def promote(temporary: str, final: str, record: dict) -> None:
    """The finished folder under its name, in one step; only marked folders are read."""
    write_json(os.path.join(temporary, MARKER), record)
    os.rename(temporary, final)


def run_unit(spark: SparkSession, root: str, stage: str, unit: str, make: Callable[[], DataFrame], check: Callable[[DataFrame], None] | None = None) -> tuple[DataFrame, bool]:
    """The unit's rows, and whether they were made now.

    What an interrupted run left is discarded and made anew from the source: there
    is no reading on inside a gzip stream.
    """
    final = resolve_under(root, f"{safe_name(stage)}/{safe_name(unit)}")
    if complete(final):
        return spark.read.parquet(final), False
    temporary = resolve_under(root, f"{safe_name(stage)}/.incomplete-{safe_name(unit)}")
    shutil.rmtree(temporary, ignore_errors=True)
    shutil.rmtree(final, ignore_errors=True)  # not marked, so never complete
    make().write.parquet(temporary)
    written = spark.read.parquet(temporary)
    if check:
        check(written)
    promote(temporary, final, {"stage": stage, "unit": unit, "rows": written.count()})
    return spark.read.parquet(final), True


def unit_record(root: str, stage: str, unit: str) -> dict:
    with open(resolve_under(root, f"{stage}/{unit}/{MARKER}"), encoding="utf-8") as f:
        return json.load(f)
