import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from siltstone.contracts import FieldRule, InterpretationContract
from siltstone.sources import config as C
from siltstone.sources import gzcsv, inspection, inventory, manifest, registration

HEADER = ["rec_id", "game_key", "pos", "actor", "action", "note", "result"]


def archive(folder, name, body, header=HEADER, raw=None):
    path = os.path.join(folder, name)
    os.makedirs(folder, exist_ok=True)
    data = raw if raw is not None else gzip.compress(((",".join(header) + "\n").encode() if header else b"") + body, mtime=0)
    with open(path, "wb") as f:
        f.write(data)
    return path


def rows_of(spark, path, **limits):
    return [r.asDict() for r in gzcsv.read_archives(spark, [path], None, C.Limits(**limits)).orderBy("record_ordinal").collect()]


def test_reader_quotes_newlines_and_ordinals(spark, tmp_path):
    path = archive(tmp_path, "replay_data_public.A.F.csv.gz", b'1,g,0,a,x,"a, ""b""\nc",w\r\n2,g,1,a,y,,\n3,g,2,a,z,n,w')
    rows = rows_of(spark, path)
    assert [r["record_ordinal"] for r in rows] == [0, 1, 2]
    assert rows[0]["fields"][5:] == ['a, "b"\nc', "w"] and rows[1]["fields"][5:] == ["", ""]


@pytest.mark.parametrize(
    ("body", "reason"),
    [(b"1,2\n", "wrong_arity"), (b"1,g,0,a,x,\xff\xfe,w\n", "invalid_encoding"), (b"1,g,0,a,x," + b"y" * 3000 + b",w\n", "field_limit"), (b"1,g,0,a,x," + b"y" * 9000 + b",w\n", "record_limit"), (b'1,g,0,a,x,a"b"c,w\n', "misplaced_quote")],
)
def test_rejected_records_keep_their_place(spark, tmp_path, body, reason):
    path = archive(tmp_path, "replay_data_public.A.F.csv.gz", b"0,g,0,a,x,n,w\n" + body + b"2,g,0,a,x,n,w\n")
    rows = rows_of(spark, path, field_bytes=2000, record_bytes=8000)
    assert [r["record_kind"] for r in rows] == ["record", "rejected", "record"]
    assert rows[1]["reason"] == reason and rows[2]["record_ordinal"] == 2


def test_fatal_errors_are_of_one_archive(spark, tmp_path):
    good = archive(tmp_path, "game_data_public.A.F.csv.gz", b"0,g,0,a,x,n,w\n")
    whole = gzip.compress(b",".join(x.encode() for x in HEADER) + b"\n" + os.urandom(50_000).hex().encode())
    cut = archive(tmp_path, "replay_data_public.A.F.csv.gz", b"", raw=whole[: len(whole) // 2])
    quote = archive(tmp_path, "replay_data_public.B.F.csv.gz", b'0,g,0,a,x,"n,w\n1,g,0,a,x,n,w\n')
    bomb = archive(tmp_path, "replay_data_public.C.F.csv.gz", b"0" * 30_000_000)
    rows = gzcsv.read_archives(spark, [good, cut, quote, bomb], HEADER, C.Limits(expansion_ratio=200))
    reasons = {os.path.basename(r["archive"]).split(".")[1]: r["reason"] for r in rows.where("record_kind = 'fatal'").collect()}
    assert reasons["B"] == "unterminated_quote" and reasons["C"] == "expansion_limit" and "gzip" in reasons["A"]
    assert [r["archive"] for r in gzcsv.accepted(rows).collect()] == [good]


def test_header_mismatch_is_fatal(spark, tmp_path):
    path = archive(tmp_path, "replay_data_public.A.F.csv.gz", b"0,g\n", header=["game_key", "rec_id"])
    rows = gzcsv.read_archives(spark, [path], ["rec_id", "game_key"]).collect()
    assert [(r["record_kind"], r["reason"]) for r in rows] == [("fatal", "header_mismatch")]


@pytest.mark.parametrize(("body", "header"), [(b"", HEADER), (b"", None)])
def test_empty_archives(spark, tmp_path, body, header):
    path = archive(tmp_path, "replay_data_public.A.F.csv.gz", body, header=header)
    assert rows_of(spark, path) == []


def test_discovery_registration_and_manifest(spark, tmp_path):
    root = str(tmp_path / "raw")
    one = archive(root, "replay_data_public.A.F.csv.gz", b"1,g,0,a,x,n,w\n")
    archive(root + "/nested", "game_data_public.A.F.csv.gz", b"1,g,0,a,x,n,l\n")
    archive(root, "notes.csv.gz", b"")
    with open(one, "rb") as f:
        archive(root, "replay_data_public.COPY.F.csv.gz", b"", raw=f.read())
    os.symlink("/etc/hostname", os.path.join(root, "draft_data_public.A.F.csv.gz"))
    found = inventory.recognised(inventory.discover(spark, [root, root]))
    assert found.count() == 5
    assert found.where("diagnostic = 'leads_out_of_root'").count() == 1
    sound = found.where("diagnostic IS NULL")
    hashes = registration.hash_archives(sound)
    assert hashes.where("integrity = 'ok'").count() == 4
    records = registration.registrations(sound, hashes, "demo")
    assert records.count() == 3  # equal bytes are one archive
    assert registration.register(records, records).count() == 0
    a = manifest.catalog_digest(manifest.semantic_projection(records)).first()[0]
    b = manifest.catalog_digest(manifest.semantic_projection(records.withColumn("ingested_at", F.lit(None)).orderBy(F.desc("sha256")))).first()[0]
    assert a == b != manifest.catalog_digest(manifest.semantic_projection(records.limit(2))).first()[0]
    heads = inspection.with_fingerprint(inspection.inspect_headers(sound))
    assert inspection.reconcile_counts(heads).first()["reconciled"]
    assert heads.select("raw_schema_fingerprint").distinct().count() == 1
    assert registration.verify(records, hashes.where("path LIKE '%nested%'"), "demo").count() == 2
    reviews = spark.createDataFrame([(records.first()["source_archive_id"], 1, "verified", "letter")], "source_archive_id string, review_no int, license_status string, evidence string")
    assert registration.license_holds(registration.license_states(records, reviews)).count() == 2
    evidence = spark.createDataFrame([("A", "F", "game_key", "accepted")], "expansion string, format string, key string, verdict string")
    assert inventory.candidate_pairs(sound, evidence).count() == 1
    assert inventory.inventory_report(sound, [root]).count() == 3


def test_paths(tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "out"
    raw.mkdir()
    out.mkdir()
    make = lambda **x: C.Config(**({"raw_roots": (str(raw),), "intermediate_root": str(out / "i"), "quarantine_root": str(out / "q"), "release_root": str(out / "r"), "provider": "demo"} | x))
    C.check_roots(make())
    os.symlink(raw, out / "link")
    for bad in ({"release_root": str(raw / "r")}, {"intermediate_root": str(out / "link")}, {"quarantine_root": str(tmp_path)}):
        with pytest.raises(C.PathError):
            C.check_roots(make(**bad))
    with pytest.raises(C.PathError):
        C.resolve_under(str(out), "../raw")
    with pytest.raises(C.PathError):
        C.safe_name("a/b")
    assert C.config_digest(make()) == C.config_digest(make(started_at="now", release_root=str(out / "x"))) != C.config_digest(make(compression="gzip"))
    with open(out / "c.json", "w") as f:
        json.dump({"raw_roots": [str(raw)], "intermediate_root": str(out / "i"), "quarantine_root": str(out / "q"), "release_root": str(out / "r"), "provider": "demo", "limits": {"batch_rows": 7}}, f)
    assert C.load_config(str(out / "c.json")).limits.batch_rows == 7


def test_contracts_and_drift(spark):
    contract = InterpretationContract("c", 1, "fp", ("a", "b"), (FieldRule("x", "a"),))
    assert inspection.compatibility(contract, ["a", "b"])["ignored"] == ["b"]
    for header in (["b"], ["a", "b", "c"], ["b", "a"]):
        with pytest.raises(inspection.ContractError):
            inspection.compatibility(contract, header)
    corrected = InterpretationContract("c", 2, "fp", ("a", "b"), (FieldRule("y", "b"),))
    assert inspection.Registry([corrected, contract]).contract_for("fp").version == 2
    with pytest.raises(inspection.ContractError):
        inspection.Registry([]).contract_for("fp")
    with pytest.raises(ValueError):
        FieldRule("best_action", "a")
    df = spark.createDataFrame([(["a", "b"], ["z", "b"])], "old array<string>, new array<string>")
    assert df.select(inspection.classify_drift(F.col("old"), F.col("new"), {"a": "z"})["drift"]).first()[0] == "rename"
    p = inspection.profile(spark.createDataFrame([("1",), ("2",)], "v string"), ["v"])
    q = inspection.profile(spark.createDataFrame([("1",), ("x",), (None,)], "v string"), ["v"])
    assert inspection.type_drift(p, q).first()["new_kind"] == "string" and inspection.type_drift(p, p).count() == 0
