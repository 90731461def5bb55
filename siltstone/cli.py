"""Command line: inventory, inspect, manifest, normalize, build, validate and stats.

Exit codes: 0 done, 2 the command failed, 3 a release is blocked.  Findings about
sources do not make a command fail.
"""

from __future__ import annotations

import argparse
import importlib
import json
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.plans import build as plans
from siltstone.plans import files, resources
from siltstone.plans.stats import Stats
from siltstone.sources import inspection, manifest, registration
from siltstone.sources.config import Config, config_digest, load_config, resolve_under


def session() -> SparkSession:
    return SparkSession.builder.appName("siltstone").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def emit(df: DataFrame) -> None:
    """Rows as JSON lines; these are reports, of a row per archive or metric."""
    for row in df.toJSON().toLocalIterator():
        print(row)


def run(verb: str, config: Config, evidence_module: str | None, release: str | None, event_log: str | None = None) -> int:
    spark = session()
    stats = Stats(config_digest(config))
    if verb in ("inventory", "inspect", "manifest", "stats"):
        with stats.timed(verb) as done:
            catalog = plans.take_inventory(spark, config).persist()
            done["rows"], done["compressed"] = catalog.count(), catalog.agg(F.coalesce(F.sum("compressed_bytes"), F.lit(0))).first()[0]
        if verb == "inventory":
            emit(catalog.select("path", "source_kind", "expansion", "format", "name_diagnostic", "sha256", "integrity"))
        elif verb == "inspect":
            emit(inspection.group_schemas(catalog))
            emit(inspection.reconcile_counts(catalog))
            reports = catalog.where("source_archive_id IS NOT NULL").select("source_archive_id", "raw_schema_fingerprint", "problem", F.current_timestamp().alias("inspected_at"))
            manifest.append_inspections(manifest.inspected(reports, "header-1", "first record"), resolve_under(config.intermediate_root, "inspections"))
        elif verb == "manifest":
            records = registration.registrations(catalog.select("path", "file_name", "source_kind", "expansion", "format"), catalog.select("path", "sha256", "compressed_bytes"), config.provider)
            emit(manifest.catalog_digest(manifest.semantic_projection(records)))
        else:
            emit(stats.frame(spark))
            if event_log:
                emit(resources.stage_resources(resources.events(spark, event_log)).orderBy("stage"))
        return 0
    if verb == "validate":
        top = resolve_under(config.release_root, release or "")
        with open(os.path.join(top, "release.json"), encoding="utf-8") as f:
            declared = spark.createDataFrame([tuple(a[c] for c in ("path", "bytes", "rows", "sha256")) for a in json.load(f)["artifacts"]], files.ARTIFACT)
        problems = files.verify_manifest(declared, files.artifact_manifest(spark, top).where("path <> 'release.json'"))
        emit(problems)
        return 3 if problems.head(1) else 0
    evidence = importlib.import_module(evidence_module).evidence()
    if verb == "normalize":
        archives = [r.asDict(recursive=True) for r in plans.take_inventory(spark, config).orderBy("path").collect()]
        found = plans.normalized_units(spark, config, archives, evidence)
        if found.outcomes is not None:
            emit(found.outcomes.groupBy("archive", "outcome", "reason").count())
        for path, reason in found.excluded:
            print(json.dumps({"path": path, "excluded": reason}))
        return 0
    made = plans.build(spark, config, evidence)
    emit(plans.candidate_report(spark, made))
    return 3 if made.blocked else 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="siltstone", description=__doc__)
    parser.add_argument("verb", choices=("inventory", "inspect", "manifest", "normalize", "build", "validate", "stats"))
    parser.add_argument("--config", required=True)
    parser.add_argument("--evidence", help="module with evidence(), for normalize and build")
    parser.add_argument("--release", help="name of a release below the release root, for validate")
    parser.add_argument("--event-log", help="Spark's event log of a run whose stages' resources stats reports")
    given = parser.parse_args(argv)
    try:
        return run(given.verb, load_config(given.config), given.evidence, given.release, given.event_log)
    except Exception as error:  # the command's boundary
        print(json.dumps({"command_failure": f"{type(error).__name__}: {error}"}), file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
