"""A full build: licensed, compatible archive pairs to a validated release.

The driver loops over units (a stage of an archive); all rows stay in Spark.  Every
archive is accounted for: built, or listed with the reason why not.
"""

from __future__ import annotations

import os
import shutil
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.contracts import DecisionContract, IdentityContract, InterpretationContract, SplitContract
from siltstone.functions import canonical
from siltstone.operators import counts, decisions, identity, joins, normalize, safety, splits
from siltstone.plans import digest, files, gates, units
from siltstone.sources import gzcsv, inspection, inventory, manifest, registration
from siltstone.sources.config import Config, check_roots, config_digest, resolve_under
from siltstone.sources.tables import stored

STAGE_VERSION = "normalize-1"


@dataclass
class Evidence:
    """What a build may rely on; each part comes from a review, none is inferred."""

    registry: inspection.Registry
    key: joins.KeyEvidence
    decision: DecisionContract
    split: SplitContract
    #: (license_status, evidence) by source_archive_id: a review is of bytes, not of a name.
    licenses: dict[str, tuple[str, str]] = field(default_factory=dict)
    privacy_cleared: tuple[tuple[str, str], ...] = ()
    #: Share of the events' keys that must have a game.
    least_coverage: float = field(kw_only=True)
    #: What an actor knows of each field at each boundary in time.
    safety: safety.SafetyMatrix = field(kw_only=True)
    #: By what games and events are known; without, by their archive and place alone, and copies are not found.
    games: IdentityContract = field(default=IdentityContract("game", "v1", None), kw_only=True)
    events: IdentityContract = field(default=IdentityContract("event", "v1", None), kw_only=True)


@dataclass
class Release:
    semantic_release_id: str
    top: str
    record: dict
    violations: DataFrame
    blocked: bool


def take_inventory(spark: SparkSession, config: Config) -> DataFrame:
    """Every archive with its name's parts, hash, integrity, header, fingerprint and identity."""
    check_roots(config)
    named = inventory.recognised(inventory.discover(spark, list(config.raw_roots)).where("diagnostic IS NULL"))
    hashes = registration.hash_archives(named)
    headers = inspection.with_fingerprint(inspection.inspect_headers(named))
    return named.join(hashes, "path", "left").join(headers, "path", "left").withColumn("source_archive_id", registration.archive_id(config.provider, F.col("sha256")))


def typed_archive(spark: SparkSession, config: Config, path: str, contract: InterpretationContract) -> DataFrame:
    """All rows of an archive: typed records with ``outcome`` accepted or rejected and ``reason``."""
    rows = gzcsv.read_archives(spark, [path], list(contract.header), config.limits)
    typed = normalize.to_typed(normalize.named_fields(rows, list(contract.header)), contract)
    required = F.array(*(F.lit(f.name) for f in contract.fields if f.required)).cast("array<string>")
    broken = F.exists("errors", lambda e: F.array_contains(required, e["field"]))
    bad = F.col("record_kind") != "record"
    outcome = F.when(F.col("record_kind") == "fatal", "fatal").when(bad | broken, "rejected").otherwise("accepted")
    reason = F.when(bad, F.col("reason")).when(broken, "type_conversion")
    return typed.withColumn("outcome", outcome).withColumn("reason", reason)


@dataclass
class Units:
    """Accepted typed records by kind with their contracts, all rows' outcomes, and what was left out with its reason."""

    kept: dict[str, list[DataFrame]]
    contracts: dict[str, list[InterpretationContract]]
    outcomes: DataFrame | None
    excluded: list[tuple[str, str]]


def normalized_units(spark: SparkSession, config: Config, archives: list[dict], evidence: Evidence) -> Units:
    """Each archive typed by its contract, or excluded: no other archive is touched by why."""
    found = Units({"replay": [], "game": []}, {"replay": [], "game": []}, None, [])
    outcomes, seen = [], {}
    ready = []
    for a in archives:
        if a["source_kind"] not in found.kept:
            found.excluded.append((a["path"], f"{a['source_kind']} is catalogued only"))
            continue
        if a["integrity"] != "ok":
            found.excluded.append((a["path"], a["integrity"]))
            continue
        status, proof = evidence.licenses.get(a["source_archive_id"], ("pending", ""))
        if status != "verified" or not proof:
            found.excluded.append((a["path"], f"license {status}"))
            continue
        if a["source_archive_id"] in seen:
            found.excluded.append((a["path"], f"the same bytes as {seen[a['source_archive_id']]}"))
            continue
        try:
            contract = evidence.registry.contract_for(a["raw_schema_fingerprint"] or "")
            inspection.compatibility(contract, a["header"])
        except inspection.ContractError as error:
            found.excluded.append((a["path"], f"unsupported: {error}"))
            continue
        seen[a["source_archive_id"]] = a["path"]
        unit = units.checkpoint_id(a["sha256"], a["raw_schema_fingerprint"], contract.digest(), STAGE_VERSION, config_digest(config))
        typed, seen_counts = counts.observed(typed_archive(spark, config, a["path"], contract), f"normalize-{unit}", "outcome")
        rows, _ = units.run_unit(spark, config.intermediate_root, "normalize", unit, lambda df=typed: df, lambda written, o=seen_counts: agreed(o.get, written))
        if rows.where("outcome = 'fatal'").head(1):
            found.excluded.append((a["path"], "fatal source error"))
            continue
        ready.append((a, contract, rows))
    for path, why in unpaired(spark, [a for a, _, _ in ready], evidence.key):
        found.excluded.append((path, why))
    gone = {p for p, _ in found.excluded}
    for a, contract, rows in ready:
        if a["path"] in gone:
            continue
        outcomes.append(rows.select("archive", "record_ordinal", "outcome", "reason", "errors"))
        notes = {"source_archive_id": a["source_archive_id"], "expansion": a["expansion"], "format": a["format"], "contract_id": contract.contract_id, "contract_version": contract.version, "raw_schema_fingerprint": a["raw_schema_fingerprint"]}
        found.kept[a["source_kind"]].append(rows.where("outcome = 'accepted'").withColumns({k: F.lit(v) for k, v in notes.items()}))
        if contract not in found.contracts[a["source_kind"]]:
            found.contracts[a["source_kind"]].append(contract)
    found.outcomes = reduce(DataFrame.unionByName, outcomes) if outcomes else None
    return found


def agreed(seen: dict, written: DataFrame) -> None:
    """Refuse a unit whose rows read again are not those seen being written.

    The stage that counts them also writes them, and a task that was lost and ran again is counted once.
    """
    differ = counts.reconciled(seen, written, "outcome")
    if differ:
        raise ValueError(f"rows as written and as read again differ: {differ}")


def unpaired(spark: SparkSession, archives: list[dict], key: joins.KeyEvidence) -> list[tuple[str, str]]:
    """Archives that have no other side of their expansion and format under a proven key."""
    if not archives:
        return []
    catalog = spark.createDataFrame([(a["path"], a["source_kind"], a["expansion"], a["format"]) for a in archives], "path string, source_kind string, expansion string, format string")
    verdict = catalog.select("expansion", "format").distinct().select("expansion", "format", F.lit(",".join(key.keys)).alias("key"), F.lit("accepted" if key.accepted else "pending").alias("verdict"))
    pairs = inventory.candidate_pairs(catalog, verdict).select("replay", "game").collect()  # pairs of archives
    paired = {p for r in pairs for p in r}
    other = {"replay": "game", "game": "replay"}
    return [(a["path"], f"no {other[a['source_kind']]} archive of {a['expansion']}.{a['format']} under a proven key") for a in archives if a["path"] not in paired]


def records(kept: list[DataFrame], contracts: list[InterpretationContract], game: IdentityContract, event: IdentityContract | None) -> tuple[DataFrame, DataFrame, str]:
    """(collapsed, quarantined, identity column): records that several archives hold are one, before anything follows from their order."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), kept)
    fields = list(dict.fromkeys(f.name for c in contracts for f in c.fields))
    rows = identity.game_ids(rows, game)
    name = "game_id"
    if event is not None:
        rows, name = identity.event_ids(rows, event), "event_id"
    rows = stored(identity.with_content(rows, ["expansion", "format", *fields]).drop("raw", "outcome", "reason", "record_kind"), "identified")
    held = [c for c in rows.columns if c not in (name, "content_hash", "source_archive_id", "record_ordinal")]
    kept, held, _ = identity.collapsed(rows, name, "source_archive_id", "record_ordinal", held)
    return stored(kept, "collapsed"), stored(held, "collided"), name


def changed_archives(spark: SparkSession, archives: list[dict]) -> DataFrame:
    """(source_archive_id, problem) of archives whose bytes are no longer those that were listed before reading."""
    listed = spark.createDataFrame([(a["path"], a["source_archive_id"], a["sha256"]) for a in archives], "path string, source_archive_id string, listed string")
    now = registration.hash_archives(listed.select("path")).select("path", F.col("sha256").alias("now"))
    return listed.join(now, "path", "left").where("NOT (listed <=> now)").select("source_archive_id", F.lit("changed while it was read").alias("problem"))


def conserved(spark: SparkSession, stage: str, read: int, accepted: int, quarantined: int, skipped: int = 0) -> DataFrame:
    """One row of counts, as of a stage over all archives."""
    row = (stage, "all", read, accepted, 0, quarantined, skipped)
    return spark.createDataFrame([row], "stage string, unit string, read long, accepted long, rejected long, quarantined long, skipped long")


def total(rows: DataFrame, column: str = "copies") -> int:
    return rows.agg(F.coalesce(F.sum(column), F.lit(0))).first()[0]


def build(spark: SparkSession, config: Config, evidence: Evidence, execution: dict | None = None) -> Release:
    """The release under its semantic identity; blocked ones are written apart and never promoted.

    Three views: ``replay_events`` and ``games``, each record once with all archives that hold it, and
    ``decision_imitation``.  Every row read is in one of them, in the quarantine, or counted with the reason why not.
    """
    catalog = take_inventory(spark, config)
    archives = [r.asDict(recursive=True) for r in catalog.orderBy("path").collect()]  # one row an archive
    found_units = normalized_units(spark, config, archives, evidence)
    excluded, outcomes = found_units.excluded, found_units.outcomes
    if not found_units.kept["replay"] or not found_units.kept["game"]:
        raise joins.JoinRefused(f"no compatible pair of archives: {excluded}")
    events, held_events, _ = records(found_units.kept["replay"], found_units.contracts["replay"], evidence.games, evidence.events)
    games, held_games, _ = records(found_units.kept["game"], found_units.contracts["game"], evidence.games, None)
    scope = ["expansion", "format", *evidence.key.keys]
    fields = list(dict.fromkeys(f.name for c in found_units.contracts["game"] for f in c.fields))
    right = games.select(*scope, F.struct("game_id", "source_archives", *(c for c in fields if c not in scope)).alias("game"))
    joined, join_report = joins.verified_join(events, right, joins.KeyEvidence(tuple(scope), evidence.key.allowed, evidence.key.source, evidence.key.accepted))
    joined = joined.withColumn("_game", F.concat_ws("|", *scope))
    expected, entered = joins.expected_rows(join_report, events.count()), joined.count()
    contract = DecisionContract(**{**evidence.decision.__dict__, "game": "_game"})
    safety.prove(joined, contract, evidence.safety)
    joined = stored(joined, "joined")
    carried = ("event_id", "game_id", "source_archives", "source_archive_id", "record_ordinal", "expansion", "format", "contract_id", "contract_version", "raw_schema_fingerprint")
    samples = decisions.decision_samples(joined, contract, carry=carried)
    locator = ["_game", contract.position]
    id_schema = samples.select(*locator).schema
    samples = samples.withColumn("sample_id", canonical.make_id("decision", contract.version, canonical.canonical_encode(id_schema, locator)))
    provenance = F.struct("source_archives", "event_id", "game_id", "record_ordinal", "raw_schema_fingerprint", F.col("contract_id").alias("interpretation_contract_id"), "contract_version", F.lit(config.builder_version).alias("builder_version"), F.lit("decision").alias("stage"))
    samples = samples.withColumn("content_hash", F.sha2(F.concat(*(canonical.encode_value(F.col(c), samples.schema[c].dataType, 6) for c in ("input", "label"))), 256)).withColumn("provenance", provenance)
    samples = stored(samples.drop("source_archives", "contract_id", "contract_version", "raw_schema_fingerprint", "source_archive_id", "record_ordinal"), "samples")
    # Rows of one position are no decision that can be told; they stay, held apart.
    again = samples.groupBy("sample_id").agg(F.count("*").alias("n")).where("n > 1").select("sample_id")
    held = samples.join(again, "sample_id", "left_semi")
    split = SplitContract(**{**evidence.split.__dict__, "group": "_game"})
    clean = splits.assign_split(samples.join(again, "sample_id", "left_anti"), split)
    view = stored(decisions.policy_view(clean), "policy-view")
    grouped = lambda rows: splits.assign_split(rows.withColumn("_game", F.concat_ws("|", *scope)), split)
    views = {
        "decision_imitation": (view, "sample_id"),
        "replay_events": (normalize.released(grouped(events), found_units.contracts["replay"], ["event_id", "event_id_basis", "event_native_id", "game_id", "expansion", "format", "_game", "split", "content_hash"], ["record_ordinal"], config.builder_version, "normalize"), "event_id"),
        "games": (normalize.released(grouped(games), found_units.contracts["game"], ["game_id", "game_id_basis", "game_native_id", "expansion", "format", "_game", "split", "content_hash"], ["record_ordinal"], config.builder_version, "normalize"), "game_id"),
    }

    record_hash = F.sha2(F.concat_ws("|", "sample_id", "content_hash", "label.observed_action", "_game", "split"), 256)
    hashes = view.select(record_hash.alias("record_hash"))
    for name in ("replay_events", "games"):
        df, key = views[name]
        hashes = hashes.unionByName(df.select(F.sha2(F.concat_ws("|", F.lit(name), key, "content_hash", "split", F.array_join("provenance.source_archives", ",")), 256).alias("record_hash")))
    dataset = digest.dataset_digest(hashes).first()
    gone = {p for p, _ in excluded}
    used = [a for a in archives if a["path"] not in gone]
    sources = catalog.select("source_archive_id", F.lit(config.provider).alias("provider"), "source_kind", "expansion", "format", F.lit(None).cast("string").alias("source_url"), F.lit("verified").alias("license_status")).where(F.col("path").isin([a["path"] for a in used]))
    catalog_digest = manifest.catalog_digest(manifest.semantic_projection(sources)).first()[0]
    contracts = {"decision": contract.digest(), "split": evidence.split.digest(), "encoding": canonical.ENCODING, "safety": evidence.safety.digest(), "game_identity": evidence.games.digest(), "event_identity": evidence.events.digest(), **{c.contract_id: c.digest() for c in evidence.registry.contracts}}
    release_id = digest.semantic_release_id(catalog_digest, [a["raw_schema_fingerprint"] for a in archives if a["raw_schema_fingerprint"]], contracts, config_digest(config), dataset["dataset_digest"] if dataset else "")
    short = release_id.rsplit(":", 1)[1][:24]
    top = resolve_under(config.release_root, f".incomplete-{short}")
    shutil.rmtree(top, ignore_errors=True)
    for name, (df, key) in views.items():
        files.write_view(df, os.path.join(top, name), order=[key], compression=config.compression, shard_bytes=config.shard_bytes)
    for name, rows, reason, keep in (("samples", held, F.lit("ambiguous_position"), ["sample_id", "content_hash"]), ("events", held_events, F.col("quarantine_reason"), ["event_id", "content_hash", "source_archive_id", "record_ordinal"]), ("games", held_games, F.col("quarantine_reason"), ["game_id", "content_hash", "source_archive_id", "record_ordinal"])):
        at = resolve_under(config.quarantine_root, f"{short}-{name}")
        if rows.head(1) and not os.path.isdir(at):
            files.write_quarantine(rows.withColumn("reason", reason), at, None, keep, config.release_root)
    artifacts = files.artifact_manifest(spark, top).persist()
    written = {name: spark.read.parquet(os.path.join(top, name)) for name in views}
    decisions_made, decisions_held, released = samples.count(), held.count(), {name: df.count() for name, df in written.items()}
    skipped = clean.count() - released["decision_imitation"]
    accepted = {k: reduce(DataFrame.unionByName, (df.select("record_ordinal") for df in found_units.kept[k])).count() for k in ("replay", "game")}
    stages = [
        counts.stage_counts(outcomes, "normalize", "archive", "outcome"),
        conserved(spark, "identity", accepted["replay"] + accepted["game"], total(events) + total(games), total(held_events) + total(held_games)),
        conserved(spark, "join", expected, entered, 0),
        conserved(spark, "decision", decisions_made, released["decision_imitation"], decisions_held, skipped),
    ]
    counts.batch_counts(outcomes, "archive", "record_ordinal", "outcome", config.limits.batch_rows).write.parquet(os.path.join(resolve_under(config.intermediate_root, "batches"), f"{short}-{uuid.uuid4().hex[:12]}"))
    join_row = spark.createDataFrame([(join_report["cardinality"], join_report["matched_keys"], join_report["left_only_keys"])], "cardinality string, matched_keys long, left_only_keys long")
    shown = spark.createDataFrame([(sum(released.values()),)], "rows long")
    wanted = conserved(spark, "release", released["decision_imitation"] + events.count() + games.count(), released["decision_imitation"] + events.count() + games.count(), 0)
    registered = catalog.select(F.col("source_archive_id").alias("path"))
    cleared = spark.createDataFrame([(c, p, "cleared") for c, p in evidence.privacy_cleared], "column string, pattern string, decision string")
    found = gates.run_gates([
        gates.input_integrity(changed_archives(spark, used)),
        gates.filename(catalog),
        gates.schema_fingerprint(catalog.where("source_kind IN ('replay', 'game')"), [c.raw_fingerprint for c in evidence.registry.contracts]),
        gates.type_conversion(outcomes, ["archive", "record_ordinal"]),
        gates.join_cardinality(join_row, list(evidence.key.allowed), evidence.least_coverage),
        gates.duplicate_collision(samples, "sample_id", "content_hash", held),
        gates.csv_structure(outcomes.where("outcome = 'rejected'")),
        gates.split_isolation(reduce(DataFrame.unionByName, (df.select("_game", "split") for df in written.values())), "_game"),
        gates.future_leak(written["decision_imitation"], "_game", contract.position),
        gates.perspective(written["decision_imitation"], list(contract.safe)),
        gates.row_counts(stages[0], spark.createDataFrame([(sum(accepted.values()),)], "rows long")),
        *(gates.row_counts(s, s.select(F.col("accepted").alias("rows"))) for s in stages[1:]),
        gates.row_counts(wanted, shown),
        gates.row_counts(wanted, artifacts),
        gates.nothing_released(decisions_made, released["decision_imitation"], "decision_imitation", spark),
        gates.manifest(files.verify_manifest(artifacts, files.artifact_manifest(spark, top))),
        *(gates.parquet_readability(files.verified_shards(spark, os.path.join(top, name), df.schema).withColumn("path", F.concat(F.lit(f"{name}/"), "path"))) for name, (df, _) in views.items()),
        *(gates.identifier_uniqueness(written[name], key) for name, (_, key) in views.items()),
        *(gates.provenance(written[name], key, registered) for name, (_, key) in views.items()),
        *(gates.privacy(inspection.privacy_holds(inspection.privacy_scan_all(df), cleared)) for df in written.values()),
    ])
    report = os.path.join(resolve_under(config.intermediate_root, "violations"), f"{short}-{uuid.uuid4().hex[:12]}")  # of this run
    found.write.parquet(report)
    found = spark.read.schema(gates.VIOLATION).parquet(report)
    blocked = gates.blocks(found)
    statuses = {c: {str(r[0]): r[1] for r in samples.groupBy(c).count().collect()} for c in ("observed_action_status", "information_completeness", "reconstruction_level")}  # closed domains
    record = {
        "semantic_release_id": release_id,
        "build_audit_id": digest.build_audit_id(release_id, execution or {}),
        "artifact_manifest_digest": files.manifest_digest(artifacts),
        "catalog_digest": catalog_digest,
        "config_digest": config_digest(config),
        "contracts": contracts,
        "split_contract": evidence.split.contract_id,
        "schemas": {name: df.schema.simpleString() for name, (df, _) in views.items()},
        "rows": released["decision_imitation"],
        "views": released,
        "stages": [r.asDict() for s in stages for r in s.collect()],  # a row for each archive and stage
        "quality": statuses,
        "join": join_report,
        "excluded": excluded,
        "reproducibility": "semantic",
        "sources": [{"source_archive_id": a["source_archive_id"], "original_filename": a["file_name"], "license_status": "verified", "license_evidence": evidence.licenses[a["source_archive_id"]][1]} for a in used],
        "artifacts": [r.asDict() for r in artifacts.orderBy("path").collect()],
        "blocked": blocked,
    }
    files.write_json(os.path.join(top, "release.json"), record)
    if not blocked:
        final = resolve_under(config.release_root, short)
        if not os.path.isdir(final):
            os.rename(top, final)
        top = final
    return Release(release_id, top, record, found, blocked)


def candidate_report(spark: SparkSession, release: Release) -> DataFrame:
    """(stage, metric, value): exclusions, licences, counts of each stage, coverage, yield, quality and violations of a candidate."""
    record = release.record
    rows = [("sources", f"excluded: {reason}", path) for path, reason in record["excluded"]]
    rows += [("sources", f"license {s['license_status']}", f"{s['source_archive_id']}: {s['license_evidence']}") for s in record["sources"]]
    rows += [("join", k, str(v)) for k, v in record["join"].items()]
    rows += [(s["stage"], f"{k} of {s['unit']}", str(s[k])) for s in record["stages"] for k in ("read", *counts.OUTCOMES)]
    rows += [("quality", f"{c} {v}", str(n)) for c, found in record["quality"].items() for v, n in sorted(found.items())]
    made = sum(record["quality"]["observed_action_status"].values())
    rows += [("decision", "rows", str(record["rows"])), ("decision", "yield", f"{record['rows']}/{made}"), ("release", "blocked", str(release.blocked))]
    rows += [("release", f"violations of {r['gate']}: {r['disposition']}", str(r["violations"])) for r in gates.dispositions(release.violations).collect()]
    return spark.createDataFrame(rows, "stage string, metric string, value string")
