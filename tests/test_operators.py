import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltstone.contracts import DecisionContract, FieldRule, InterpretationContract, SplitContract
from siltstone.functions import canonical
from siltstone.operators import counts, decisions, duplicates, joins, normalize, splits
from siltstone.plans import digest

PLAIN = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@PLAIN
@given(st.lists(st.tuples(st.one_of(st.none(), st.text(max_size=6)), st.one_of(st.none(), st.text(max_size=6))), min_size=2, max_size=8, unique=True))
def test_encoding_is_injective(spark, rows):
    rows = [tuple(None if x is None else x.encode("utf-8", "ignore").decode() for x in r) for r in rows]
    df = spark.createDataFrame(rows, "a string, b string")
    assert df.select(canonical.canonical_encode(df.schema, ["a", "b"]).alias("e")).distinct().count() == len(set(rows))


def test_encoding_of_types(spark):
    df = spark.sql("SELECT 'é;' s, -3L i, true b, CAST(1.5 AS DECIMAL(18,4)) d, TIMESTAMP'1970-01-01 00:00:01Z' t, TIMESTAMP_NTZ'1970-01-01 00:00:01' n, array('x', NULL) a, struct(1 AS x, CAST(NULL AS STRING) AS y) r, 1.25D f")
    got = df.select(*(canonical.encode_value(F.col(f.name), f.dataType, 2 if f.name == "f" else None).alias(f.name) for f in df.schema.fields)).first().asDict()
    assert got == {"s": "s3:é;;", "i": "i2:-3;", "b": "b1:1;", "d": "d6:1.5000;", "t": "t7:1000000;", "n": "t7:1000000;", "a": "l7:s1:x;N;;", "r": "r7:i1:1;N;;", "f": "d4:1.25;"}
    with pytest.raises(ValueError):
        canonical.encode_value(F.col("f"), df.schema["f"].dataType)


def test_digest_does_not_depend_on_order_and_counts_copies(spark):
    df = spark.range(500).select(F.sha2(F.col("id").cast("string"), 256).alias("record_hash"))
    one = digest.dataset_digest(df).first()
    assert digest.dataset_digest(df.repartition(13).orderBy(F.rand(3))).first() == one
    assert digest.dataset_digest(df.unionByName(df.limit(1))).first() != one
    assert digest.dataset_digest(df.limit(0)).collect() in ([], [one]) or digest.dataset_digest(df.limit(0)).count() <= 1
    assert digest.compare_builds(df, df.where("record_hash > '8'"), ["record_hash"]).where("side = 'first'").count() == df.where("record_hash <= '8'").count()


def test_release_identity():
    base = dict(catalog_digest="c", fingerprints=["b", "a"], contracts={"x": "1"}, config="k", dataset="d")
    a = digest.semantic_release_id(**base)
    assert a == digest.semantic_release_id(**base | {"fingerprints": ["a", "b", "a"]}) != digest.semantic_release_id(**base | {"contracts": {"x": "2"}})
    assert digest.build_audit_id(a, {"t": 1}) != digest.build_audit_id(a, {"t": 2})


def test_strict_cast(spark):
    df = spark.createDataFrame([("7",), (" 7 ",), ("07",), ("1e3",), ("x",), (None,), ("-0",), ("9223372036854775808",)], "v string")
    got = [r[0] for r in df.select(canonical.strict_cast(F.col("v"), "integer")).collect()]
    assert got == [7, None, None, None, None, None, 0, None]


CONTRACT = InterpretationContract("c", 1, "fp", ("a", "b"), (FieldRule("n", "a", "integer", required=True), FieldRule("t", "b", "timestamp", group="reconstructed", origin="reconstructed")))


def test_typing_and_normalization(spark, tmp_path):
    rows = spark.createDataFrame([("arc", 0, {"a": "1", "b": ""}), ("arc", 1, {"a": "x", "b": "2024-01-01 00:00:00"}), ("arc", 2, {"a": "", "b": "z"})], "archive string, record_ordinal long, raw map<string,string>")
    typed = normalize.to_typed(rows, CONTRACT)
    accepted, rejected = normalize.split_accepted(typed, CONTRACT)
    assert [r["n"] for r in accepted.collect()] == [1] and rejected.count() == 2
    assert [sorted((e["field"], e["code"]) for e in r["errors"]) for r in typed.orderBy("record_ordinal").collect()] == [[], [("n", "not_integer")], [("n", "missing"), ("t", "not_timestamp")]]
    out = normalize.normalize(accepted, CONTRACT, ["record_ordinal"], "b1", "normalize")
    out.write.parquet(str(tmp_path / "n"))
    back = spark.read.parquet(str(tmp_path / "n"))
    assert back.schema["reconstructed"].dataType["t"].metadata == {"origin": "reconstructed", "raw": "b", "contract": "c"}
    assert back.first()["provenance"]["source_archives"] == ["arc"]
    assert normalize.lineage(CONTRACT)[0] == ("a", "normalized", "n", "integer", "source_direct")
    assert normalize.migrate(out, [(1, lambda d: d.withColumn("v", F.lit(2)))], 1).columns[-1] == "v"
    with pytest.raises(ValueError):
        normalize.migrate(out, [(3, lambda d: d)], 1)
    with pytest.raises(ValueError):
        normalize.pseudonymise(F.lit("x"), "s", "")


@pytest.mark.parametrize(
    ("left", "right", "kind"),
    [([("a", 1), ("b", 2)], [("a", 1)], "1:1"), ([("a", 1), ("a", 2)], [("a", 1)], "n:1"), ([("a", 1)], [("a", 1), ("a", 2)], "1:n"), ([("a", 1), ("a", 2)], [("a", 1), ("a", 2)], "m:n")],
)
def test_cardinality_and_refusal(spark, left, right, kind):
    a, b = spark.createDataFrame([*left, (None, 9)], "k string, v int"), spark.createDataFrame([*right, (None, 9)], "k string, w int")
    report = joins.cardinality(a, b, ["k"]).first()
    assert report["cardinality"] == kind
    assert joins.key_profile(a, ["k"]).first().asDict() == {"rows": len(left) + 1, "distinct_keys": len({k for k, _ in left}), "null_keys": 1}
    evidence = joins.KeyEvidence(("k",), ("1:1", "n:1", "1:n"), "test", True)
    if kind == "m:n":
        with pytest.raises(joins.JoinRefused):
            joins.verified_join(a, b, evidence)
    else:
        out, said = joins.verified_join(a, b, evidence)
        assert out.count() == joins.expected_rows(said, a.count())
        assert out.where("k IS NULL").first()["join_status"] == "unmatched"
    with pytest.raises(joins.JoinRefused):
        joins.verified_join(a, b, joins.KeyEvidence(("k",), ("1:1",), "none"))


def test_duplicates(spark):
    df = spark.createDataFrame([("i", "A", "x"), ("i", "A", "x"), ("j", "A", "y"), ("j", "B", "y"), ("k", "A", "z"), ("k", "B", "w"), ("l", "A", "v")], "id string, archive string, content string")
    got = {(r["id"], r["content"]): r["dup_class"] for r in duplicates.classified(df, "id", "content", "archive").collect()}
    assert got == {("i", "x"): "exact_duplicate", ("j", "y"): "source_duplicate", ("k", "z"): "identity_collision", ("k", "w"): "identity_collision", ("l", "v"): "unique"}
    kept, held = duplicates.quarantine(df, "id", "content")
    assert kept.count() == 5 and {r["id"] for r in held.collect()} == {"k"}
    assert duplicates.collapse(df, "id", "content", "archive").where("id = 'j'").first()["provenance"] == ["A", "B"]


def test_splits(spark):
    contract = SplitContract(group="g")
    df = spark.createDataFrame([(i, None if i % 50 == 0 else f"g{i % 97}") for i in range(1000)], "i int, g string")
    a = splits.assign_split(df, contract)
    assert splits.split_isolation(a, "g").count() == 0
    assert {r["i"]: r["split"] for r in a.collect()} == {r["i"]: r["split"] for r in splits.assign_split(df.repartition(7), contract).collect()}
    assert a.where("g IS NULL").select("split").distinct().collect()[0][0] == "excluded"
    assert splits.assign_split(df, SplitContract(group="g", salt="other")).exceptAll(a).count() > 0
    with pytest.raises(ValueError):
        splits.assign_split(df, SplitContract(group="g", thresholds=(("a", 9000), ("b", 8000))))


DECISION = DecisionContract("v1", "game", "pos", "action", ("play", "pass"), ("seen",), history=2, outcome=("outcome",), actor="actor")


def test_decisions_see_only_the_past(spark):
    rows = [("g", 0, "a", "s0", "play", "w"), ("g", 1, "b", "s1", "draw", "w"), ("g", 2, "a", None, "pass", "w"), ("g", 3, "a", "s3", None, "w"), ("g", 4, "a", "s4", "play", "w"), ("g", 4, "a", "s4", "pass", "w")]
    df = spark.createDataFrame(rows, "game string, pos int, actor string, seen string, action string, outcome string")
    found = decisions.decision_samples(df, DECISION)
    got = {(r["pos"], r["label"]["observed_action"]): r for r in found.collect()}
    assert got[0, "play"]["input"]["history"] == [] and got[0, "play"]["state_quality_flags"] == ["no_prior_rows", "unknown_seen"]
    assert got[2, "pass"]["input"]["seen"] == "s1" and [h["position"] for h in got[2, "pass"]["input"]["history"]] == [0, 1]
    assert got[3, None]["observed_action_status"] == "missing" and not got[3, None]["usable_for_policy_imitation"]
    assert got[4, "play"]["observed_action_status"] == "ambiguous"
    view = decisions.policy_view(found)
    assert "post_decision" not in view.columns and view.count() == 2
    assert decisions.input_violations(found.schema, ["seen"]) == [] and decisions.input_violations(found.schema, []) == ["input.seen", "input.history.seen"]
    assert decisions.leaks(found.where("pos < 4"), "game", "pos").count() == 0
    with pytest.raises(ValueError):
        decisions.with_usability(found)
    odd = found.drop("usable_for_policy_imitation").withColumn("reconstruction_level", F.lit("new_kind"))
    assert decisions.with_usability(odd).where("usable_for_policy_imitation").count() == 0
    assert decisions.forbidden_names(found.withColumn("x", F.struct(F.lit(1).alias("best_action"))).schema) == ["x.best_action"]
    levels = spark.range(1).select(decisions.worst_level(F.lit("source_direct"), F.lit("partial_reconstruction")), decisions.worst_level(F.lit("source_direct"), F.lit("odd"))).first()
    assert tuple(levels) == ("partial_reconstruction", "unavailable")


def test_counts(spark):
    df = spark.createDataFrame([("u", "accepted"), ("u", "rejected"), ("u", "lost"), ("v", "accepted")], "u string, o string")
    found = counts.stage_counts(df, "s", "u", "o")
    assert [(r["unit"], r["unexplained"]) for r in counts.conserve(found).collect()] == [("u", 1)]
    assert counts.totals(found).where("unit IS NULL").first()["read"] == 4
    assert sum(r["share"] for r in counts.distribution(df, "o").collect()) == pytest.approx(1)
