import json
import os

import pytest
from pyspark.sql import functions as F

from siltstone.contracts import DecisionContract, FieldRule, IdentityContract, InterpretationContract, SplitContract
from siltstone.operators.joins import JoinRefused, KeyEvidence
from siltstone.operators.safety import SafetyMatrix, UnsafeDerivation
from siltstone.plans import build, files, gates, publish, stats, units
from siltstone.sources import config as C
from siltstone.sources import inspection
from siltstone.streaming import arrivals
from tests.test_sources import archive

GAME = ["game_key", "result"]
REPLAY = ["rec_id", "game_key", "pos", "actor", "action", "seen"]


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    top = tmp_path_factory.mktemp("build")
    raw = str(top / "raw")
    lines = "".join(f"{g * 10 + p},g{g},{p},a,{'play' if p % 2 else 'draw'},s{p}\n" for g in range(8) for p in range(6))
    archive(raw, "replay_data_public.AAA.F.csv.gz", lines.encode() + b"x,g0,9,a,play,s9\n1,2\n", REPLAY)
    archive(raw, "game_data_public.AAA.F.csv.gz", "".join(f"g{g},w\n" for g in range(8)).encode(), GAME)
    archive(raw, "draft_data_public.AAA.F.csv.gz", b"1\n", ["x"])
    archive(raw, "replay_data_public.BBB.F.csv.gz", b"1\n", ["other"])
    config = C.Config((raw,), str(top / "mid"), str(top / "held"), str(top / "out"), "demo")
    catalog = build.take_inventory(spark, config)
    prints = {r["file_name"].split("_")[0] + r["expansion"]: r["raw_schema_fingerprint"] for r in catalog.collect()}
    registry = inspection.Registry([
        InterpretationContract("replay", 1, prints["replayAAA"], tuple(REPLAY), (FieldRule("rec_id", "rec_id", "integer", required=True), FieldRule("game_key", "game_key", required=True), FieldRule("pos", "pos", "integer", required=True), FieldRule("actor", "actor"), FieldRule("action", "action"), FieldRule("seen", "seen", safe=True))),
        InterpretationContract("game", 1, prints["gameAAA"], tuple(GAME), (FieldRule("game_key", "game_key", required=True), FieldRule("result", "result"))),
    ])
    return config, evidence_of(registry, catalog), build.build(spark, config, evidence_of(registry, catalog)), top


SAFE = SafetyMatrix("safety-v1", (("seen", "earlier", "shown to the actor"), ("action", "earlier", "the actor's own")))
GAME_IDS = IdentityContract("game", "v1", "game_key", ("expansion", "format"), (("AAA", "F"),), locator=("game_key",))
EVENT_IDS = IdentityContract("event", "v1", "rec_id", ("expansion", "format"), (("AAA", "F"),))


def evidence_of(registry, catalog, **changes):
    """What the fixture's builds rely on: a letter for all archives' bytes."""
    licenses = {r["source_archive_id"]: ("verified", "letter") for r in catalog.where("source_archive_id IS NOT NULL").collect()}
    given = {"least_coverage": 1.0, "safety": SAFE, "games": GAME_IDS, "events": EVENT_IDS} | changes
    return build.Evidence(registry, KeyEvidence(("game_key",), ("n:1",), "fixture", True), DecisionContract("d1", "game", "pos", "action", ("play",), ("seen",)), SplitContract(), licenses, **given)


def lines_of(games=range(8), first=0):
    return "".join(f"{first + g * 10 + p},g{g},{p},a,{'play' if p % 2 else 'draw'},s{p}\n" for g in games for p in range(6)).encode()


@pytest.fixture
def another(spark, made, tmp_path):
    """A function that builds with further archives beside the fixture's: {file name: (lines, header)}."""
    config, evidence, _, _ = made

    def run(more, **changes):
        for name, (lines, header) in more.items():
            archive(str(tmp_path / "more"), name, lines, header)
        config2 = C.Config((*config.raw_roots, str(tmp_path / "more")), str(tmp_path / "mid"), str(tmp_path / "held"), str(tmp_path / "out"), "demo")
        return build.build(spark, config2, evidence_of(evidence.registry, build.take_inventory(spark, config2), **changes)), config2

    return run


def test_events_of_two_archives_are_one_with_both(spark, another):
    """The same replay events in a second archive, with a few of its own: nothing is lost, and each says who holds it."""
    release, _ = another({"replay_data_public.AAA.F.csv.gz": (lines_of() + b"900,g0,9,a,play,s9\n", REPLAY)})
    assert not release.blocked and release.record["rows"] == 25
    view = spark.read.parquet(os.path.join(release.top, "decision_imitation"))
    assert sorted(r["n"] for r in view.select(F.size("provenance.source_archives").alias("n")).collect()) == [1] + [2] * 24
    events = spark.read.parquet(os.path.join(release.top, "replay_events"))
    assert events.count() == 49 and events.where("provenance.copies = 2").count() == 48
    assert {r["event_id_basis"] for r in events.collect()} == {"native"}
    stage = next(s for s in release.record["stages"] if s["stage"] == "identity")
    assert stage["read"] == stage["accepted"] == 48 + 49 + 8 and stage["quarantined"] == 0


def test_unequal_events_of_one_identity_are_quarantined(spark, another):
    release, config = another({"replay_data_public.AAA.F.csv.gz": (lines_of([0]).replace(b"play", b"pass") + lines_of(range(1, 8)), REPLAY)})
    assert not release.blocked and release.record["rows"] == 24 - 3
    held = [d for d in os.listdir(config.quarantine_root) if d.endswith("-events")]
    rows = spark.read.parquet(os.path.join(config.quarantine_root, held[0])).collect()
    assert len(rows) == 6 and {r["reason"] for r in rows} == {"identity_collision"}


def test_a_release_of_nothing_is_blocked(another):
    """Without a verified identity copies are not found: all decisions stand twice, are ambiguous, and none is left."""
    release, _ = another({"replay_data_public.AAA.F.csv.gz": (lines_of() + b"900,g0,9,a,draw,s9\n", REPLAY)}, events=IdentityContract("event", "v1", None))
    assert release.blocked and release.record["rows"] == 0
    assert [r["detail"] for r in release.violations.where("gate = 'row_counts'").collect()] == ["0 of 48"]
    stage = next(s for s in release.record["stages"] if s["stage"] == "decision")
    assert (stage["read"], stage["accepted"], stage["quarantined"]) == (48, 0, 48)


def test_archives_are_excluded_alone_and_with_a_reason(another):
    """One that breaks off, one without its other side, and one of bytes already read: none blocks the release."""
    release, _ = another({
        "replay_data_public.BBB.F.csv.gz": (b'1,"g0,9,a,play,s9\n', REPLAY),
        "replay_data_public.CCC.F.csv.gz": (lines_of(first=1000), REPLAY),
        "replay_data_public.AAA.F.csv.gz": (lines_of() + b"x,g0,9,a,play,s9\n1,2\n", REPLAY),
    })
    assert not release.blocked and release.record["rows"] == 24
    reasons = {os.path.basename(p): r for p, r in release.record["excluded"] if "/more/" in p}
    assert reasons["replay_data_public.BBB.F.csv.gz"] == "fatal source error"
    assert reasons["replay_data_public.CCC.F.csv.gz"] == "no game archive of CCC.F under a proven key"
    # Which of two equal archives is read first follows from their paths.
    assert any(r.startswith("the same bytes as") for _, r in release.record["excluded"])


def test_views_and_report(spark, made):
    _, _, release, _ = made
    assert release.record["views"] == {"decision_imitation": 24, "replay_events": 48, "games": 8}
    games = spark.read.parquet(os.path.join(release.top, "games"))
    assert {r["normalized"]["result"] for r in games.collect()} == {"w"} and "raw" not in games.columns
    assert games.schema["normalized"].dataType["result"].metadata["raw"] == "result"
    events = spark.read.parquet(os.path.join(release.top, "replay_events"))
    both = events.select("_game", "split").unionByName(games.select("_game", "split")).distinct()
    assert both.count() == 8 and events.join(games, "game_id", "left_anti").count() == 0
    report = {(r["stage"], r["metric"]): r["value"] for r in build.candidate_report(spark, release).collect()}
    assert report["decision", "yield"] == "24/24" and report["quality", "observed_action_status observed"] == "24"
    assert report["identity", "read of all"] == "56" and any(k[1] == "license verified" for k in report)


def test_unsafe_inputs_are_refused_before_the_run(made):
    from siltstone.operators import safety

    config, evidence, _, _ = made
    spark = __import__("pyspark.sql", fromlist=["SparkSession"]).SparkSession.getActiveSession()
    with pytest.raises(UnsafeDerivation, match="seen of earlier"):
        build.build(spark, config, evidence_of(evidence.registry, build.take_inventory(spark, config), safety=SafetyMatrix("v", SAFE.safe[1:])))
    events = spark.createDataFrame([("g", 1, "play", "s", 1)], "game string, pos long, action string, seen string, result long")
    from pyspark.sql import Window

    order = Window.partitionBy("game").orderBy("pos")
    contract = DecisionContract("d", "game", "pos", "action", ("play",), ("seen",))
    safety.prove(events, contract, SAFE)
    safety.prove(events.withColumn("seen", F.upper(F.lag("seen").over(order))), contract, SAFE)
    for unsafe in (F.lead("seen").over(order), F.col("result"), F.max("seen").over(Window.partitionBy("game")), F.max("seen").over(order.rowsBetween(-1, 1)), F.concat("seen", F.lead("action").over(order))):
        with pytest.raises(UnsafeDerivation):
            safety.prove(events.withColumn("seen", unsafe.cast("string")), contract, SAFE)
    table = {(r["field"], r["boundary"]): (r["safe"], r["evidence"]) for r in SAFE.frame(spark, ["seen", "result"]).collect()}
    assert table["seen", "earlier"] == (True, "shown to the actor") and table["result", "earlier"] == (False, None) and len(table) == 6
    with pytest.raises(ValueError):
        SafetyMatrix("v", (("seen", "later", "why"),))


def test_build_is_whole_and_repeatable(spark, made):
    config, evidence, release, _ = made
    assert not release.blocked and release.record["rows"] == 24
    assert {r for _, r in release.record["excluded"]} >= {"draft is catalogued only"}
    assert any("unsupported" in r for _, r in release.record["excluded"])
    assert {r["detail"] for r in release.violations.where("gate = 'csv_structure'").collect()} == {"wrong_arity", "type_conversion"}
    again = build.build(spark, config, evidence, {"run": 2})
    assert again.semantic_release_id == release.semantic_release_id and again.record["build_audit_id"] != release.record["build_audit_id"]
    view = spark.read.parquet(os.path.join(release.top, "decision_imitation"))
    assert view.select("_game").distinct().count() == 8 and "post_decision" not in view.columns
    report = build.candidate_report(spark, release)
    assert report.where("stage = 'join' AND metric = 'cardinality'").first()["value"] == "n:1"


def test_unlicensed_sources_are_not_built(spark, made):
    config, evidence, _, _ = made
    with pytest.raises(JoinRefused):
        build.build(spark, config, build.Evidence(evidence.registry, evidence.key, evidence.decision, evidence.split, {}, least_coverage=1.0, safety=SAFE))


def test_manifest_tampering_and_publication(spark, made, tmp_path):
    _, _, release, _ = made
    declared = spark.createDataFrame([tuple(a[c] for c in ("path", "bytes", "rows", "sha256")) for a in release.record["artifacts"]], files.ARTIFACT)
    actual = files.artifact_manifest(spark, release.top).where("path <> 'release.json'")
    assert files.verify_manifest(declared, actual).count() == 0
    assert gates.blocks(gates.manifest(files.verify_manifest(declared, actual.limit(0))))
    extra = actual.unionByName(spark.createDataFrame([("x", 1, 1, "y")], files.ARTIFACT))
    assert [r["problem"] for r in files.verify_manifest(declared, extra).collect()] == ["extra"]
    assert [r["problem"] for r in files.verify_manifest(declared, actual.withColumn("rows", F.lit(0).cast("long"))).collect()] == ["mismatch"] * declared.count()
    texts = dict.fromkeys(publish.SECTIONS, "text")
    card = publish.render_card(release.record, {k: v for k, v in texts.items() if k not in ("Licences", "Provenance")})
    holds = spark.createDataFrame([], "source_archive_id string")
    assert publish.preflight(release.record, declared, actual, holds, card, "hub", ("hub",)) == []
    bad = publish.preflight(release.record, declared, actual.limit(0), spark.createDataFrame([("a",)], "source_archive_id string"), card.replace("\n## Citation\n", ""), "elsewhere", ("hub",))
    assert len(bad) == declared.count() + 3

    class Client:
        sent: list = []

        def upload(self, destination, path):
            self.sent.append(path)

    assert publish.publish([], declared, Client(), "hub") and Client.sent == []
    assert publish.publish([], declared, Client(), "hub", dry_run=False) == Client.sent
    assert publish.verify_upload(declared, actual).count() == 0
    with pytest.raises(publish.PublicationRefused):
        publish.publish(bad, declared, Client(), "hub")
    with pytest.raises(publish.PublicationRefused):
        publish.render_card(release.record, {})


def test_units_resume_and_never_show_partial_output(spark, tmp_path):
    calls = []

    def make(fail=False):
        calls.append(1)
        return spark.range(5).select(F.when(F.lit(fail) & (F.col("id") == 3), F.raise_error(F.lit("stop"))).otherwise(F.col("id")).alias("id"))

    with pytest.raises(Exception):  # noqa: B017
        units.run_unit(spark, str(tmp_path), "s", "u", lambda: make(True))
    assert not units.complete(str(tmp_path / "s" / "u"))
    rows, new = units.run_unit(spark, str(tmp_path), "s", "u", make)
    assert new and rows.count() == 5
    rows, new = units.run_unit(spark, str(tmp_path), "s", "u", make)
    assert not new and len(calls) == 2 and units.unit_record(str(tmp_path), "s", "u")["rows"] == 5
    base = ("sha", "fp", "contract", "stage", "config")
    ids = {units.checkpoint_id(*base)} | {units.checkpoint_id(*(x + "!" if k == j else x for k, x in enumerate(base))) for j in range(5)}
    assert len(ids) == 6


def test_views_and_quarantine(spark, tmp_path):
    df = spark.range(100).select("id", F.concat(F.lit("e"), F.col("id") % 3).alias("expansion"))
    files.write_view(df, str(tmp_path / "v"), files.partition_plan(df, ["expansion"]), ["id"], max_rows=10)
    assert files.artifact_manifest(spark, str(tmp_path / "v")).agg(F.sum("rows"), F.max("rows")).first()[0:2] == (100, 10)
    shards = files.verified_shards(spark, str(tmp_path / "v"), df.schema, ["expansion"])
    assert shards.where("problem IS NOT NULL").count() == 0 and shards.agg(F.sum("rows")).first()[0] == 100
    assert {r["problem"] for r in files.verified_shards(spark, str(tmp_path / "v"), df.schema).collect()} == {"columns"}
    with pytest.raises(ValueError):
        files.partition_plan(df, ["id"], most=10)
    with pytest.raises(C.PathError):
        files.partition_plan(df.withColumn("expansion", F.lit("a/b")), ["expansion"])
    files.write_quarantine(df.withColumn("secret", F.lit("x")), str(tmp_path / "q"), "why", ["id"], str(tmp_path / "v"))
    assert spark.read.parquet(str(tmp_path / "q")).columns == ["id", "reason"]
    with pytest.raises(C.PathError):
        files.write_quarantine(df, str(tmp_path / "v" / "q"), "why", ["id"], str(tmp_path / "v"))


def test_each_gate_finds_its_failure(spark):
    one = lambda rows, schema: spark.createDataFrame(rows, schema)
    sample = one([("g", 1, [(2,)])], "game string, pos int, h array<struct<position:int>>").select("game", "pos", F.struct(F.col("h").alias("history"), F.lit(1).alias("hidden")).alias("input"))
    artifacts = one([("p", 1, 4, "x")], files.ARTIFACT)
    counted = one([("s", "u", 5, 4, 0, 0, 0)], "stage string, unit string, read long, accepted long, rejected long, quarantined long, skipped long")
    report = one([("m:n", 1, 0)], "cardinality string, matched_keys long, left_only_keys long")
    found = gates.run_gates([
        gates.input_integrity(one([("a", "truncated_gzip")], "source_archive_id string, problem string")),
        gates.filename(one([("p", "unknown", "unrecognised_name")], "path string, source_kind string, name_diagnostic string")),
        gates.schema_fingerprint(one([("p", "fp")], "path string, raw_schema_fingerprint string"), ["other"]),
        gates.csv_structure(one([("p", 1, "wrong_arity")], "archive string, record_ordinal long, reason string")),
        gates.type_conversion(one([("p", [("f", "r", "not_integer")])], "archive string, errors array<struct<field:string,raw:string,code:string>>"), ["archive"]),
        gates.identifier_uniqueness(one([("i",), ("i",)], "id string"), "id"),
        gates.join_cardinality(report, ["n:1"], 0.5),
        gates.split_isolation(one([("g", "train"), ("g", "test")], "g string, split string"), "g"),
        gates.duplicate_collision(one([("i", "a"), ("i", "b")], "id string, c string"), "id", "c", one([], "id string")),
        gates.future_leak(sample, "game", "pos"),
        gates.perspective(sample, []),
        gates.provenance(one([("i", (["stray"],)), ("j", ([],))], "id string, provenance struct<source_archives:array<string>>"), "id", one([("known",)], "path string")),
        gates.privacy(inspection.privacy_holds(inspection.privacy_scan(one([("x@y.example",)], "t string"), ["t"]), one([], "column string, pattern string, decision string"))),
        gates.row_counts(counted, artifacts.withColumn("rows", F.lit(9).cast("long"))),
        gates.parquet_readability(one([("p", None, "unreadable", "x"), ("q", 1, None, None)], files.SHARD)),
        gates.manifest(files.verify_manifest(artifacts, artifacts.limit(0))),
    ])
    assert {r["gate"] for r in gates.dispositions(found).collect()} == set(gates.GATES)
    assert gates.blocks(found) and not gates.blocks(found.where("gate = 'filename'"))


def test_stats_and_arrivals(spark, tmp_path):
    s = stats.Stats("0" * 64)
    with s.timed("stage", rows=10, compressed=1000):
        pass
    s.sizes("stage", 100, 50)
    assert {r["metric"] for r in s.frame(spark).collect()} == {"seconds", "rows_per_second", "compressed_gb_per_minute", "peak_rss_mb", "output_bytes", "compression_ratio"}
    raw, table, state = (str(tmp_path / x) for x in ("raw", "table", "state"))
    archive(raw, "replay_data_public.A.F.csv.gz", b"")
    arrivals.record_arrivals(spark, raw, table, state)
    archive(raw, "game_data_public.A.F.csv.gz", b"")
    arrivals.record_arrivals(spark, raw, table, state)
    arrivals.record_arrivals(spark, raw, table, state)
    assert sorted(r["source_kind"] for r in spark.read.parquet(table).collect()) == ["game", "replay"]


def test_command_line(spark, made, capsys, tmp_path, monkeypatch):
    from siltstone import cli

    config, _, release, top = made
    monkeypatch.setattr(cli, "session", lambda: spark)
    path = str(tmp_path / "c.json")
    with open(path, "w") as f:
        json.dump({"raw_roots": list(config.raw_roots), "intermediate_root": config.intermediate_root, "quarantine_root": config.quarantine_root, "release_root": config.release_root, "provider": "demo"}, f)
    for verb in ("inventory", "inspect", "manifest", "stats"):
        assert cli.main([verb, "--config", path]) == 0
    (tmp_path / "app-1").write_text(json.dumps({"Event": "SparkListenerStageCompleted", "Stage Info": {"Stage ID": 4, "Stage Name": "count", "Submission Time": 0, "Completion Time": 1}}))
    assert cli.main(["stats", "--config", path, "--event-log", str(tmp_path / "app-1")]) == 0
    assert '"stage":4,"name":"count"' in capsys.readouterr().out.replace(" ", "")
    assert cli.main(["inventory", "--config", path]) == 0
    assert cli.main(["validate", "--config", path, "--release", os.path.basename(release.top)]) == 0
    assert cli.main(["inventory", "--config", str(tmp_path / "none.json")]) == 2
    assert "replay_data_public" in capsys.readouterr().out
