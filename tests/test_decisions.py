"""Decisions of games of any length against a plain walk, and identities that come first."""

import random

import pytest
from pyspark.sql import functions as F

from siltstone.contracts import DecisionContract, IdentityContract
from siltstone.operators import decisions, identity

CONTRACT = DecisionContract("d1", "g", "p", "a", ("x",), ("s", "u"), history=3, outcome=("o",))


def walked(rows):
    """(g, p, o) of each decision with what was known, the last entries' positions, rows before, and the next action."""
    out = []
    for game in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == game]
        for g, p, a, _, _, o in mine:
            if a not in ("x", None):
                continue
            key = lambda r: (r[1] is not None, r[1] or 0)  # noqa: E731  null positions come first
            earlier = sorted((r for r in mine if key(r) < key((g, p))), key=key)
            last = lambda k: next((r[k] for r in reversed(earlier) if r[k] is not None), None)  # noqa: E731, B023
            later = sorted((r for r in mine if key(r) > key((g, p))), key=key)
            out.append((g, p, o, last(3), last(4), tuple(r[1] for r in earlier[-3:]), len(earlier), later[0][2] if later else None))
    return sorted(out, key=repr)


def found(samples):
    rows = samples.select("g", "p", "post_decision.o", "input.s", "input.u", "input.history.position", "input.prior_rows", "post_decision.next_action").collect()
    return sorted(((*r[:5], tuple(r[5]), r[6], r[7]) for r in rows), key=repr)


@pytest.mark.parametrize("segment_rows", [7, 40, None])
def test_a_game_of_a_third_of_all_rows(spark, segment_rows):
    """Positions are unique, so that every value follows from the walk; one game is long, one has no name."""
    rng = random.Random(3)
    rows = []
    for k in range(900):
        game = "hot" if k % 3 == 0 else None if k % 11 == 0 else f"g{rng.randrange(40)}"
        rows.append((game, 10_000 - k * 7 % 9001, rng.choice(["x", "y", None]), rng.choice([None, None, "s%d" % k]), rng.choice([None, k]), k))
    table = spark.createDataFrame(rows, "g string, p long, a string, s string, u long, o long").repartition(5)
    assert found(decisions.decision_samples(table, CONTRACT, segment_rows=segment_rows)) == walked(rows)


def test_twins_of_a_long_game_know_earlier_positions_alone(spark):
    rows = [("hot", k // 3, "x", f"s{k // 3}", None, 0) for k in range(60)] + [("hot", None, "x", None, None, 1)]
    table = spark.createDataFrame(rows, "g string, p long, a string, s string, u long, o long")
    for size in (5, None):
        for r in decisions.decision_samples(table, CONTRACT, segment_rows=size).collect():
            positions = [h["position"] for h in r["input"]["history"]]
            if r["p"] is None:
                assert positions == [] and r["input"]["prior_rows"] == 0
            else:
                assert positions == ([p - 1] * 3 if (p := r["p"]) else [None]) and r["input"]["prior_rows"] == 1 + 3 * p
                assert r["input"]["s"] == (f"s{p - 1}" if p else None) and r["observed_action_status"] == "ambiguous"


def test_long_games_are_spread_over_tasks(spark):
    table = spark.range(20_000).select(F.lit("hot").alias("g"), F.col("id").alias("p"), F.lit("x").alias("a"), F.lit("s").alias("s"), F.col("id").alias("u"), F.col("id").alias("o"))
    bounds = decisions.segment_bounds(table, "g", "p", 1000)
    assert 15 <= len(bounds.first()["_bounds"]) <= 20
    seen = decisions.in_segments(table, CONTRACT, ["a"], bounds)
    most = seen.groupBy("_segment").count().agg(F.max("count"), F.count("*")).first()
    assert most[0] <= 2200 and most[1] >= 15
    with pytest.raises(TypeError):
        decisions.segment_bounds(table.withColumn("p", F.col("p").cast("string")), "g", "p", 1000)


def test_an_aim_has_a_status_of_its_own(spark):
    table = spark.createDataFrame([("g", 1, "x", "s", 1, 1, "t"), ("g", 2, "x", "s", 1, 1, None)], "g string, p long, a string, s string, u long, o long, t string")
    aimed = DecisionContract("d1", "g", "p", "a", ("x",), ("s",), target="t")
    assert [r["action_target_status"] for r in decisions.decision_samples(table, aimed).orderBy("p").collect()] == ["observed", "missing"]
    assert "action_target_status" not in decisions.decision_samples(table, CONTRACT).columns


RECORDS = "archive string, ordinal long, expansion string, rec long, game string, v string"


def test_identities_rest_on_verified_scopes_alone(spark):
    contract = IdentityContract("game", "v1", "game", ("expansion",), (("A",),), "archive", ("ordinal",))
    rows = [("a1", 1, "A", 1, "g", "x"), ("a2", 9, "A", 1, "g", "x"), ("a1", 2, "B", 1, "g", "x"), ("a2", 2, "B", 1, "g", "x"), ("a1", 3, "A", 1, None, "x"), (None, 4, "A", 1, None, "x"), ("a1", 5, None, 1, "g", "x")]
    got = identity.game_ids(spark.createDataFrame(rows, RECORDS), contract).collect()
    assert [r["game_id_basis"] for r in got] == ["native", "native", "archive_locator", "archive_locator", "archive_locator", "none", "archive_locator"]
    ids = [r["game_id"] for r in got]
    assert ids[0] == ids[1] and ids[5] is None and len(set(ids)) == 6
    assert [r["game_native_id"] for r in got] == ["g", "g", "g", "g", None, None, "g"]
    events = identity.event_ids(identity.game_ids(spark.createDataFrame(rows, RECORDS), contract), IdentityContract("event", "v1", "rec", (), ((),), "archive", ("ordinal",)))
    assert [r["event_id_basis"] for r in events.collect()] == ["native"] * 5 + ["none", "native"]
    with pytest.raises(ValueError):
        IdentityContract("game", "v1", "game", ("expansion",), (("A", "B"),))
    with pytest.raises(ValueError):
        IdentityContract("game", "v1", None, ("expansion",), (("A",),))


def test_collapse_keeps_every_place_and_loses_no_record(spark):
    rows = [("a1", k, "A", k, "g", "v") for k in range(5)] + [("a2", 10 + k, "A", k, "g", "v") for k in range(3)] + [("a1", 20, "A", 1, "g", "v"), ("a3", 0, "A", 4, "g", "other"), ("a3", 1, "A", None, "g", "a"), ("a3", 2, "A", None, "g", "b")]
    table = spark.createDataFrame(rows, RECORDS).withColumn("event_id", F.col("rec").cast("string"))
    kept, held, places = identity.collapsed(identity.with_content(table, ["v"]), "event_id", "archive", "ordinal")
    got = {r["event_id"]: (r["source_archives"], r["copies"], r["archive"], r["ordinal"]) for r in kept.collect()}
    assert got == {"0": (["a1", "a2"], 2, "a1", 0), "1": (["a1", "a2"], 3, "a1", 1), "2": (["a1", "a2"], 2, "a1", 2), "3": (["a1"], 1, "a1", 3)}
    assert sorted((r["event_id"] or "", r["quarantine_reason"], r["copies"]) for r in held.collect()) == [("", "no_identity", 1), ("", "no_identity", 1), ("4", "identity_collision", 1), ("4", "identity_collision", 1)]
    assert places.count() == len(rows) and kept.agg(F.sum("copies")).first()[0] + held.agg(F.sum("copies")).first()[0] == len(rows)
    assert {r["rec"] for r in kept.collect()} == {0, 1, 2, 3}


def test_identities_of_any_form_are_gathered_by_one_shuffle(spark):
    digits = "0123456789abcdef" * 4
    ids = [digits, digits.upper(), "x" + digits, "x" + digits.upper(), digits[:-1], digits + "g", "", "x", "é:" + digits, None]
    # Each id with as many contents as its number of hundreds says, in one archive or two.
    rows = [(x, f"c{c}" if k % 2 else digits[c:] + digits[:c], a, 7 - k) for k, x in enumerate(ids) for c in range(1 + (k % 3 == 2)) for a in ("a", "b")[: 1 + k % 2]]
    table = spark.createDataFrame(rows + rows[:1], "event_id string, content_hash string, archive string, ordinal int")
    contents = lambda x: {r[1] for r in rows if r[0] == x}
    want = {(r[0], r[1], "a", r[3], tuple(sorted(q[2] for q in rows if q[:2] == r[:2])), sum(q[:2] == r[:2] for q in [*rows, rows[0]]), "no_identity" if r[0] is None else "identity_collision" if len(contents(r[0])) > 1 else None) for r in rows}
    found = identity.by_content(table, "event_id", "archive", "ordinal", [])
    assert {(r[0], r[1], r[2], r[3], tuple(r[4]), r[5], r[6]) for r in found.collect()} == want and found.count() == len(want)
    counted = identity.classes(table, "event_id", "archive")
    kinds = {x: "no_identity" if x is None else "identity_collision" if len(contents(x)) > 1 else "source_duplicate" if len({r[2] for r in rows if r[0] == x}) > 1 else "exact_duplicate" if x == digits else "unique" for x in ids}
    assert {tuple(r) for r in counted.collect()} == {(kind, sum(k == kind for k in kinds.values()), sum(len(contents(x)) for x in ids if kinds[x] == kind), sum(kinds[r[0]] == kind for r in [*rows, rows[0]])) for kind in kinds.values()}
    numbers = table.where("event_id IS NOT NULL").withColumn("event_id", F.crc32(F.col("event_id").cast("binary")))
    assert identity.by_content(numbers, "event_id", "archive", "ordinal", []).schema["event_id"].dataType.simpleString() == "bigint"
    shuffles = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange ")
    kept, held, _ = identity.collapsed(table, "event_id", "archive", "ordinal")
    assert shuffles(kept) == 1 and shuffles(held) == 1
    assert shuffles(identity.classes(table, "event_id", "archive")) == 2  # the other is of a row a class


def test_adapters_keep_ids_and_name_what_they_lose(spark):
    samples = spark.createDataFrame([("a", "v1", 3, "x"), ("b", "v1", None, "y")], "sample_id string, decision_contract_version string, score int, note string")
    made = decisions.adapter(samples, {"twice": F.col("score") * 2}, "sample_id", ["score", "note"])
    assert sorted((r["sample_id"], r["decision_contract_version"], r["twice"], r["lossy"]) for r in made.collect()) == [("a", "v1", 6, ["note", "score"]), ("b", "v1", None, ["note", "score"])]
    with pytest.raises(ValueError, match="keeps"):
        decisions.adapter(samples, {"sample_id": F.lit("z")}, "sample_id", [])
    with pytest.raises(ValueError, match="have no"):
        decisions.adapter(samples, {}, "sample_id", ["absent"])
