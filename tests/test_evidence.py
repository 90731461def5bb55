"""Batch counts, stored inspections and drift of profiles."""

from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from siltstone.operators import counts
from siltstone.sources import external, inspection, manifest


def test_observed_counts_agree_with_what_is_written_and_show_a_loss(spark, tmp_path):
    rows = spark.range(100).select(F.lit("a").alias("unit"), F.col("id").alias("n"), F.when(F.col("id") % 10 == 0, "rejected").otherwise("accepted").alias("outcome"))
    df, seen = counts.observed(rows, "stage", "outcome")
    df.write.parquet(str(tmp_path / "t"))
    written = spark.read.parquet(str(tmp_path / "t"))
    assert counts.reconciled(seen.get, written, "outcome") == []
    assert counts.reconciled(seen.get, written.where("n < 95"), "outcome") == [("read", 100, 95), ("accepted", 90, 85)]
    assert counts.reconciled(seen.get, written.unionByName(written.where("n = 0")), "outcome") == [("read", 100, 101), ("rejected", 10, 11)]
    got = [tuple(r) for r in counts.batch_counts(written, "unit", "n", "outcome", 40).orderBy("batch").collect()]
    assert got == [("a", 0, 0, 39, 40, 36, 4, 0, 0), ("a", 1, 40, 79, 40, 36, 4, 0, 0), ("a", 2, 80, 99, 20, 18, 2, 0, 0)]


def test_inspections_stand_beside_each_other_and_are_joined_as_of_a_time(spark, tmp_path):
    path = str(tmp_path / "inspections")
    schema = "source_archive_id string, raw_schema_fingerprint string, problem string, inspected_at timestamp"
    day = lambda k: datetime(2024, 1, k)
    for k, rows in ((1, [("a", "f1", None), ("b", None, "unreadable")]), (2, [("a", "f1", None)]), (3, [("a", "f2", None), ("c", "f9", None)])):
        manifest.append_inspections(manifest.inspected(spark.createDataFrame([(*r, day(k)) for r in rows], schema), "tool", "header"), path)
    table = spark.read.parquet(path)
    assert table.count() == 5 and table.where("source_archive_id = 'a'").select("inspection_id").distinct().count() == 2
    other = manifest.inspected(spark.createDataFrame([("a", "f1", None, day(9))], schema), "another tool", "header").first()["inspection_id"]
    assert other not in {r["inspection_id"] for r in table.collect()}
    records = spark.createDataFrame([(x, "replay", "u", "verified") for x in "abd"], "source_archive_id string, source_kind string, source_url string, license_status string")
    codes = lambda r: [d["code"] for d in r["diagnostics"]]
    now = {r["source_archive_id"]: r for r in manifest.audit_catalog(records, table).collect()}
    assert (now["a"]["inspections"], now["a"]["findings"], now["a"]["fingerprints"], codes(now["a"])) == (3, 2, 2, ["inspections_disagree"])
    assert [x["fingerprint"] for x in now["a"]["latest"]] == ["f2", "f1"] and codes(now["b"]) == ["inspection_problem"] and codes(now["d"]) == ["never_inspected"]
    then = {r["source_archive_id"]: r for r in manifest.audit_catalog(records, table, F.lit(day(2))).collect()}
    assert (then["a"]["inspections"], then["a"]["findings"], codes(then["a"])) == (2, 1, [])


def test_renames_hold_only_if_the_evidence_agrees(spark):
    old = spark.createDataFrame([("1", "x", None)], "n string, s string, e string")
    new = spark.createDataFrame([("2", "7", None)], "m string, t string, e string")
    found = inspection.profile_drift(inspection.profile(old, old.columns), inspection.profile(new, new.columns), {"n": "m", "s": "t"})
    assert sorted(((r["column"] or "", r["new_column"] or "", r["drift"]) for r in found.collect())) == [("", "t", "added"), ("e", "e", "none"), ("n", "m", "renamed"), ("s", "", "removed")]
    plain = inspection.profile_drift(inspection.profile(old, old.columns), inspection.profile(old, old.columns))
    assert {r["drift"] for r in plain.collect()} == {"none"}


SIDE = external.ExternalSource("cards", "maker", ("k",), "version", "since", ("colour",), "verified", "letter")


def test_external_facts_stay_beside_and_are_refused_without_licence(spark):
    records = spark.createDataFrame([("a", "mine"), ("a", "mine"), ("b", "mine"), (None, "mine"), ("z", "mine")], "card string, colour string")
    rows = spark.createDataFrame([("a", "v1", 1, "red"), ("a", "v2", 5, "blue"), ("a", "v3", 9, "green"), ("b", "v3", 9, "green"), (None, "v1", 1, "none")], "k string, version string, since int, colour string")
    found = external.beside(records, rows, SIDE, {"k": "card"}, F.lit(6)).orderBy("card").collect()
    assert [(r["card"], r["colour"], r["external"] and (r["external"]["colour"], r["external"]["provenance"]["version"])) for r in found] == [(None, "mine", None), ("a", "mine", ("blue", "v2")), ("a", "mine", ("blue", "v2")), ("b", "mine", None), ("z", "mine", None)]
    assert found[1]["external"]["provenance"]["license_evidence"] == "letter"
    for bad in (replace(SIDE, license_status="pending"), replace(SIDE, license_evidence=""), replace(SIDE, key=("k", "j"))):
        with pytest.raises(external.ExternalRefused):
            external.beside(records, rows, bad, {"k": "card"}, F.lit(6))
    with pytest.raises(external.ExternalRefused, match="binary"):
        external.beside(records, rows.withColumn("colour", F.col("colour").cast("binary")), SIDE, {"k": "card"}, F.lit(6))
    with pytest.raises(external.ExternalRefused, match="two things"):
        external.beside(records, rows.unionByName(rows.withColumn("colour", F.lit("other"))), SIDE, {"k": "card"}, F.lit(6))
    with pytest.raises(external.ExternalRefused, match="have a column"):
        external.beside(records, rows, SIDE, {"k": "card"}, F.lit(6), "colour")
