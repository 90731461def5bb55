"""Named queries over the driver's tables, each with the same rows in DuckDB's SQL.

The tables stand in for archives: events for a game's events, orders and lines for
a pair of record families, documents for contents that several sources hold.
"""

from __future__ import annotations

import gzip
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.contracts import DecisionContract, FieldRule, IdentityContract, InterpretationContract, SplitContract
from siltstone.functions import canonical
from siltstone.functions.names import recognise
from siltstone.operators import counts, decisions, duplicates, identity, joins, normalize, splits
from siltstone.plans import digest, files, gates
from siltstone.sources import external, gzcsv, inspection, inventory, manifest, registration
from siltstone.sources.tables import fresh_table, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- SQL of the canonical encoding and the stable bucket

SPLIT = SplitContract(group="user_id")


def tag(kind: str, text: str) -> str:
    return f"coalesce('{kind}' || strlen({text})::VARCHAR || ':' || {text} || ';', 'N;')"


def tag_int(x: str) -> str:
    return tag("i", f"({x})::BIGINT::VARCHAR")


def tag_money(x: str) -> str:
    return tag("d", f"({x})::DECIMAL(38,2)::VARCHAR")


def tag_time(x: str) -> str:
    return tag("t", f"epoch_us({x})::VARCHAR")


def sql_bucket(group: str, contract: SplitContract = SPLIT) -> str:
    return f"(('0x' || substr(sha256('{contract.contract_id}|{contract.salt}|' || ({group})::VARCHAR), 1, 15))::BIGINT % 10000)"


def sql_split(group: str, contract: SplitContract = SPLIT) -> str:
    cases = " ".join(f"WHEN {sql_bucket(group, contract)} < {below} THEN '{name}'" for name, below in contract.thresholds)
    return f"CASE WHEN {group} IS NULL THEN '{contract.missing}' {cases} END"


EVENT_SCALES = {"value": 2}
EVENT_CONTENT = ["ts", "user_id", "event_type", "value", "props"]
SQL_EVENT = " || ".join([tag_time("ts"), tag_int("user_id"), tag("s", "event_type"), tag_money("value"), tag("s", "props")])
LINE_CONTENT = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate"]
LINE_SCALES = {"l_quantity": 2, "l_extendedprice": 2}
SQL_LINE = " || ".join([tag_int("l_partkey"), tag_int("l_suppkey"), tag_money("l_quantity"), tag_money("l_extendedprice"), tag("s", "l_returnflag"), tag("s", "l_linestatus"), tag_time("l_shipdate")])


# --- identity, content and splits


@query(f"SELECT event_id, user_id, {sql_bucket('user_id')} AS bucket, {sql_split('user_id')} AS split FROM events")
def group_split(spark, d):
    events = splits.assign_split(table(spark, d, "events"), SPLIT)
    return events.select("event_id", "user_id", canonical.bucket_of(F.col("user_id"), SPLIT.contract_id, SPLIT.salt).alias("bucket"), "split")


@query(f"SELECT split, count(*)::BIGINT AS records, count(DISTINCT user_id)::BIGINT AS groups FROM (SELECT user_id, {sql_split('user_id')} AS split FROM events) GROUP BY split")
def split_counts(spark, d):
    return splits.split_counts(splits.assign_split(table(spark, d, "events"), SPLIT), "user_id")


@query(f"SELECT user_id, min(split) AS a, max(split) AS b FROM (SELECT user_id, {sql_split('user_id')} AS split FROM events) GROUP BY user_id HAVING count(DISTINCT split) > 1")
def split_isolation(spark, d):
    return splits.split_isolation(splits.assign_split(table(spark, d, "events"), SPLIT), "user_id")


CONVERSATIONS = SplitContract(contract_id="conversations-v1", group="conv_id")


@query(f"SELECT split, count(*)::BIGINT AS records, count(DISTINCT conv_id)::BIGINT AS groups FROM (SELECT conv_id, {sql_split('conv_id', CONVERSATIONS)} AS split FROM conversations) GROUP BY split")
def conversation_split_counts(spark, d):
    return splits.split_counts(splits.assign_split(table(spark, d, "conversations"), CONVERSATIONS), "conv_id")


@query(f"SELECT event_id, 'event:v1:' || sha256('s5:event;' || 's2:v1;' || {tag_int('event_id')}) AS record_id FROM events")
def record_ids(spark, d):
    events = table(spark, d, "events")
    return events.select("event_id", canonical.make_id("event", "v1", canonical.canonical_encode(events.schema, ["event_id"])).alias("record_id"))


@query(f"SELECT event_id, sha256({SQL_EVENT}) AS content_hash FROM events")
def content_hashes(spark, d):
    events = table(spark, d, "events")
    return events.select("event_id", canonical.content_hash(events.schema, EVENT_CONTENT, EVENT_SCALES).alias("content_hash"))


def sql_digest(hashes: str) -> str:
    """The hash tree over a query with the columns k and n."""
    level = f"SELECT k, k || ':' || n AS entry, n FROM (SELECT k, count(*)::BIGINT AS n FROM ({hashes}) GROUP BY k)"
    for width in digest.WIDTHS:
        node = f"substr(k, 1, {width})" if width else "''"
        level = f"SELECT k, k || ':' || h AS entry, n, h FROM (SELECT {node} AS k, sha256(string_agg(entry, ',' ORDER BY entry)) AS h, sum(n)::BIGINT AS n FROM ({level}) GROUP BY 1)"
    return f"SELECT h AS dataset_digest, n AS records FROM ({level})"


@query(sql_digest(f"SELECT sha256({SQL_EVENT}) AS k FROM events"))
def dataset_digest(spark, d):
    events = table(spark, d, "events")
    return digest.dataset_digest(events.select(canonical.content_hash(events.schema, EVENT_CONTENT, EVENT_SCALES).alias("record_hash")))


@query(sql_digest(f"SELECT sha256({tag_int('o_orderkey')} || {tag_int('o_custkey')} || {tag('s', 'o_orderstatus')} || {tag_money('o_totalprice')} || {tag_time('o_orderdate')} || {tag('s', 'o_orderpriority')}) AS k FROM orders"))
def orders_digest(spark, d):
    orders = table(spark, d, "orders")
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    return digest.dataset_digest(orders.select(canonical.content_hash(orders.schema, columns, {"o_totalprice": 2}).alias("record_hash")))


@query("SELECT c_custkey, sha256('8:test-key|customers|' || c_name) AS pseudonym FROM customer")
def pseudonyms(spark, d):
    return table(spark, d, "customer").select("c_custkey", normalize.pseudonymise(F.col("c_name"), "customers", "test-key").alias("pseudonym"))


# --- duplicates and collisions

SQL_DOCS = "SELECT sha256(coalesce('s' || strlen(text)::VARCHAR || ':' || text || ';', 'N;')) AS id, lang AS content, source FROM documents"


def document_contents(spark, d) -> DataFrame:
    docs = table(spark, d, "documents")
    return docs.select(canonical.content_hash(docs.schema, ["text"]).alias("id"), F.col("lang").alias("content"), "source")


@query(f"""
WITH c AS (SELECT id, content, count(*) AS rows, count(DISTINCT source) AS archives FROM ({SQL_DOCS}) GROUP BY id, content),
k AS (SELECT *, count(*) OVER (PARTITION BY id) AS contents FROM c)
SELECT CASE WHEN contents > 1 THEN 'identity_collision' WHEN archives > 1 THEN 'source_duplicate' WHEN rows > 1 THEN 'exact_duplicate' ELSE 'unique' END AS dup_class,
  count(*)::BIGINT AS contents, sum(rows)::BIGINT AS rows FROM k GROUP BY 1""")
def dup_classes(spark, d):
    return duplicates.class_counts(duplicates.classified(document_contents(spark, d), "id", "content", "source"))


@query(f"SELECT id, content, string_agg(DISTINCT source, ',' ORDER BY source) AS sources, count(*)::BIGINT AS copies FROM ({SQL_DOCS}) GROUP BY id, content")
def dup_collapse(spark, d):
    found = duplicates.collapse(document_contents(spark, d), "id", "content", "source")
    return found.select("id", "content", F.array_join("provenance", ",").alias("sources"), "copies")


SQL_LINES = f"SELECT l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR AS id, sha256({SQL_LINE}) AS content, l_partkey FROM lineitem"


def line_contents(spark, d) -> DataFrame:
    lines = table(spark, d, "lineitem")
    return lines.select(F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id"), canonical.content_hash(lines.schema, LINE_CONTENT, LINE_SCALES).alias("content"), "l_partkey")


@query(f"SELECT id, count(DISTINCT content)::BIGINT AS contents, count(*)::BIGINT AS rows FROM ({SQL_LINES}) GROUP BY id HAVING count(DISTINCT content) > 1")
def id_collisions(spark, d):
    return duplicates.collisions(line_contents(spark, d), "id", "content")


@query(f"WITH l AS ({SQL_LINES}), b AS (SELECT id FROM l GROUP BY id HAVING count(DISTINCT content) > 1) SELECT CASE WHEN id IN (SELECT id FROM b) THEN 'quarantined' ELSE 'accepted' END AS disposition, count(*)::BIGINT AS rows FROM l GROUP BY 1")
def collision_quarantine(spark, d):
    accepted, held = duplicates.quarantine(line_contents(spark, d), "id", "content")
    return accepted.withColumn("disposition", F.lit("accepted")).unionByName(held.withColumn("disposition", F.lit("quarantined"))).groupBy("disposition").agg(F.count("*").alias("rows"))


@query(f"WITH l AS ({SQL_LINES}), b AS (SELECT id FROM l GROUP BY id HAVING count(DISTINCT content) > 1) SELECT id, count(*)::BIGINT AS rows, array_to_string(list_sort(list(DISTINCT l_partkey))[1:3], ',') AS examples FROM l WHERE id IN (SELECT id FROM b) GROUP BY id")
def collision_examples(spark, d):
    found = duplicates.collision_examples(line_contents(spark, d), "id", "content", "l_partkey")
    return found.select("id", "rows", F.array_join(F.col("examples").cast("array<string>"), ",").alias("examples"))


# --- identity of games and events

ORDER_IDS = IdentityContract("game", "v1", "o_orderkey", ("o_orderstatus",), (("F",), ("O",)), "o_orderpriority", ("o_custkey", "o_orderdate"))
SQL_ORDER_BASIS = "CASE WHEN o_orderkey IS NOT NULL AND o_orderstatus IN ('F', 'O') THEN 'native' WHEN o_orderpriority IS NOT NULL AND o_custkey IS NOT NULL AND o_orderdate IS NOT NULL THEN 'archive_locator' ELSE 'none' END"
SQL_ORDER_ID = f"""CASE {SQL_ORDER_BASIS} WHEN 'native' THEN 'game:v1:' || sha256('s4:game;s2:v1;s6:native;' || {tag("s", "o_orderstatus")} || {tag_int("o_orderkey")})
  WHEN 'archive_locator' THEN 'game:v1:' || sha256('s4:game;s2:v1;s15:archive_locator;' || {tag("s", "o_orderpriority")} || {tag_int("o_custkey")} || {tag_time("o_orderdate")}) END"""


def ordered_games(spark, d) -> DataFrame:
    """Orders as games: the key is verified for two of three statuses; priorities stand in for archives."""
    return identity.game_ids(table(spark, d, "orders"), ORDER_IDS)


@query(f"SELECT o_orderkey, {SQL_ORDER_ID} AS game_id, {SQL_ORDER_BASIS} AS game_id_basis, o_orderkey::VARCHAR AS game_native_id FROM orders")
def game_ids(spark, d):
    return ordered_games(spark, d).select("o_orderkey", "game_id", "game_id_basis", "game_native_id")


LINE_IDS = IdentityContract("event", "v1", "l_linenumber", ("l_linestatus",), (("F",),), "l_returnflag", ("l_partkey", "l_suppkey"))
SQL_LINE_BASIS = "CASE WHEN game_id IS NULL THEN 'none' WHEN l_linenumber IS NOT NULL AND l_linestatus = 'F' THEN 'native' WHEN l_returnflag IS NOT NULL AND l_partkey IS NOT NULL AND l_suppkey IS NOT NULL THEN 'archive_locator' ELSE 'none' END"
SQL_LINE_ID = f"""CASE {SQL_LINE_BASIS} WHEN 'native' THEN 'event:v1:' || sha256('s5:event;s2:v1;s6:native;' || {tag("s", "game_id")} || {tag("s", "l_linestatus")} || {tag_int("l_linenumber")})
  WHEN 'archive_locator' THEN 'event:v1:' || sha256('s5:event;s2:v1;s15:archive_locator;' || {tag("s", "game_id")} || {tag("s", "l_returnflag")} || {tag_int("l_partkey")} || {tag_int("l_suppkey")}) END"""
SQL_LINE_IDS = f"SELECT *, {SQL_LINE_ID} AS event_id, {SQL_LINE_BASIS} AS event_id_basis FROM (SELECT lineitem.*, game_id, game_id_basis FROM lineitem LEFT JOIN (SELECT o_orderkey, {SQL_ORDER_ID} AS game_id, {SQL_ORDER_BASIS} AS game_id_basis FROM orders) ON l_orderkey = o_orderkey)"


def ordered_events(spark, d) -> DataFrame:
    """Lines as events of orders: the number is verified for finished lines, the rest are known by their place."""
    games = ordered_games(spark, d).select("o_orderkey", "game_id", "game_id_basis")
    lines = table(spark, d, "lineitem")
    return identity.event_ids(lines.join(games, lines["l_orderkey"] == games["o_orderkey"], "left"), LINE_IDS)


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, game_id, game_id_basis, event_id, event_id_basis, l_linenumber::VARCHAR AS event_native_id FROM ({SQL_LINE_IDS})")
def event_ids(spark, d):
    return ordered_events(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", "game_id", "game_id_basis", "event_id", "event_id_basis", "event_native_id")


SQL_SENT = f"""SELECT event_id, sha256({tag_int("l_partkey")} || {tag_money("l_quantity")}) AS content_hash, archive, l_linenumber AS ordinal FROM (
  SELECT *, 'first' AS archive FROM ({SQL_LINE_IDS}) UNION ALL SELECT * REPLACE (CASE WHEN l_partkey % 50 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity), 'second' FROM ({SQL_LINE_IDS}) WHERE l_suppkey % 2 = 0)"""


def twice_sent(spark, d) -> DataFrame:
    """The lines in one archive, and half of them in another, which says something else of a few."""
    lines = ordered_events(spark, d).select("event_id", "l_partkey", "l_quantity", "l_suppkey", F.col("l_linenumber").alias("ordinal"))
    changed = F.when(F.col("l_partkey") % 50 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    sent = lambda archive, quantity: F.struct(F.lit(archive).alias("archive"), quantity.alias("l_quantity"))
    first, second = sent("first", F.col("l_quantity")), sent("second", changed)
    # Each line is joined to its order once, and then sent once or twice.
    both = lines.withColumn("_sent", F.explode(F.when(F.col("l_suppkey") % 2 == 0, F.array(first, second)).otherwise(F.array(first))))
    both = both.select("event_id", "l_partkey", "ordinal", "_sent.archive", "_sent.l_quantity")
    return identity.with_content(both, ["l_partkey", "l_quantity"], {"l_quantity": 2})


@query(f"""
WITH c AS (SELECT event_id, content_hash, string_agg(DISTINCT archive, ',' ORDER BY archive) AS source_archives, count(*)::BIGINT AS copies, min({{'a': archive, 'o': ordinal}}) AS place FROM ({SQL_SENT}) GROUP BY ALL),
k AS (SELECT *, count(*) OVER (PARTITION BY event_id) AS contents FROM c)
SELECT event_id, content_hash, place.a AS archive, place.o AS ordinal, source_archives, copies, CASE WHEN event_id IS NULL THEN 'no_identity' WHEN contents > 1 THEN 'identity_collision' ELSE '' END AS quarantine_reason FROM k""")
def event_collapse(spark, d):
    found = identity.by_content(twice_sent(spark, d), "event_id", "archive", "ordinal", ["l_partkey", "l_quantity"])
    return found.select("event_id", "content_hash", "archive", "ordinal", F.array_join("source_archives", ",").alias("source_archives"), "copies", F.coalesce("quarantine_reason", F.lit("")).alias("quarantine_reason"))


@query(f"""
WITH c AS (SELECT event_id, content_hash, count(DISTINCT archive) AS archives, count(*) AS n FROM ({SQL_SENT}) GROUP BY ALL),
k AS (SELECT event_id, count(*) AS contents, sum(n) AS records, max(archives) AS archives FROM c GROUP BY event_id)
SELECT CASE WHEN event_id IS NULL THEN 'no_identity' WHEN contents > 1 THEN 'identity_collision' WHEN archives > 1 THEN 'source_duplicate' WHEN records > 1 THEN 'exact_duplicate' ELSE 'unique' END AS dup_class,
  count(*)::BIGINT AS identities, sum(contents)::BIGINT AS contents, sum(records)::BIGINT AS records FROM k GROUP BY 1""")
def event_classes(spark, d):
    return identity.classes(twice_sent(spark, d), "event_id", "archive")


# --- key evidence and verified joins


@query("SELECT l_returnflag, count(*)::BIGINT AS rows, count(DISTINCT l_orderkey)::BIGINT AS distinct_keys, count(*) FILTER (l_orderkey IS NULL)::BIGINT AS null_keys FROM lineitem GROUP BY l_returnflag")
def key_profile(spark, d):
    return joins.key_profile(table(spark, d, "lineitem"), ["l_orderkey"], ["l_returnflag"])


def order_pair(spark, d) -> tuple[DataFrame, DataFrame]:
    return table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "order_key"), table(spark, d, "orders").withColumnRenamed("o_orderkey", "order_key")


SQL_COVERAGE = """
WITH l AS (SELECT l_orderkey AS k, count(*) AS l FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY 1), r AS (SELECT o_orderkey AS k, count(*) AS r FROM orders WHERE o_orderkey IS NOT NULL GROUP BY 1),
b AS (SELECT l, r FROM l FULL JOIN r USING (k))
SELECT count(*) FILTER (l IS NOT NULL AND r IS NOT NULL)::BIGINT AS matched_keys, count(*) FILTER (r IS NULL)::BIGINT AS left_only_keys, count(*) FILTER (l IS NULL)::BIGINT AS right_only_keys,
  coalesce(sum(l) FILTER (r IS NOT NULL), 0)::BIGINT AS left_matched_rows, coalesce(sum(l) FILTER (r IS NULL), 0)::BIGINT AS left_unmatched_rows, coalesce(sum(r) FILTER (l IS NULL), 0)::BIGINT AS right_unmatched_rows,
  coalesce(sum(l * r), 0)::BIGINT AS joined_rows, coalesce(max(l) FILTER (r IS NOT NULL), 0)::BIGINT AS left_most, coalesce(max(r) FILTER (l IS NOT NULL), 0)::BIGINT AS right_most, count(*) FILTER (l > 1 AND r > 1)::BIGINT AS many_to_many_keys
FROM b"""


@query(SQL_COVERAGE)
def join_coverage(spark, d):
    return joins.coverage(*order_pair(spark, d), ["order_key"])


@query(f"SELECT CASE WHEN many_to_many_keys > 0 OR (left_most > 1 AND right_most > 1) THEN 'm:n' WHEN left_most > 1 THEN 'n:1' WHEN right_most > 1 THEN '1:n' ELSE '1:1' END AS cardinality, matched_keys, joined_rows FROM ({SQL_COVERAGE})")
def join_cardinality(spark, d):
    return joins.cardinality(*order_pair(spark, d), ["order_key"]).select("cardinality", "matched_keys", "joined_rows")


@query("SELECT l_orderkey AS order_key, l_linenumber, l_partkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey IS NULL THEN 'unmatched' ELSE 'matched' END AS join_status FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey")
def verified_join(spark, d):
    evidence = joins.KeyEvidence(("order_key",), ("n:1", "1:1"), "profile of the whole tables", True)
    joined, _ = joins.verified_join(*order_pair(spark, d), evidence)
    return joined.select("order_key", "l_linenumber", "l_partkey", "o_custkey", "o_orderstatus", "join_status")


@query("SELECT o_orderkey AS order_key, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def unmatched_orders(spark, d):
    lines, orders = order_pair(spark, d)
    return joins.unmatched(orders, lines, ["order_key"]).select("order_key", "o_custkey")


@query("SELECT lang, count(*)::BIGINT AS rows, count(*) FILTER (quality IS NULL)::BIGINT AS quality_missing, count(*) FILTER (toxic IS NULL)::BIGINT AS toxic_missing FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang")
def outcome_coverage(spark, d):
    return counts.missingness(table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id", "left"), ["quality", "toxic"], ["lang"])


PART_FACTS = external.ExternalSource("part-metadata", "makers", ("p_partkey",), "version", "valid_from", ("p_brand", "p_size"), "verified", "letter")
SQL_VERSIONS = "SELECT p_partkey, p_brand, p_size, 'v1' AS version, DATE '1990-01-01' AS valid_from FROM part UNION ALL SELECT p_partkey, p_brand, p_size + 100, 'v2', DATE '1995-06-01' FROM part WHERE p_partkey % 3 = 0 UNION ALL SELECT p_partkey, p_brand, p_size + 200, 'v3', DATE '1999-01-01' FROM part"


def part_versions(spark, d) -> DataFrame:
    """Parts as metadata of another source: a third has a second version, and all a third that is not yet valid."""
    parts = table(spark, d, "part").select("p_partkey", "p_brand", "p_size")
    dated = lambda df, more, version, day: df.select("p_partkey", "p_brand", (F.col("p_size") + more).alias("p_size"), F.lit(version).alias("version"), F.to_date(F.lit(day)).alias("valid_from"))
    return dated(parts, 0, "v1", "1990-01-01").unionByName(dated(parts.where("p_partkey % 3 = 0"), 100, "v2", "1995-06-01")).unionByName(dated(parts, 200, "v3", "1999-01-01"))


@query(f"""
WITH v AS (SELECT * FROM ({SQL_VERSIONS}) WHERE valid_from <= DATE '1998-01-01' QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY valid_from DESC) = 1)
SELECT l_orderkey, l_linenumber, l_partkey, p_brand AS brand, p_size AS size, CASE WHEN p_partkey IS NOT NULL THEN 'makers' END AS provider, version,
  CASE WHEN p_partkey IS NOT NULL THEN 'external:v1:' || sha256('s6:makers;s13:part-metadata;' || {tag("s", "version")}) END AS external_id
FROM lineitem LEFT JOIN v ON p_partkey = l_partkey + (CASE WHEN l_linenumber = 7 THEN 1000000000 ELSE 0 END)""")
def external_metadata(spark, d):
    """Lines with their part's metadata beside them as of a day; lines of one number have none."""
    lines = table(spark, d, "lineitem").withColumn("part", F.col("l_partkey") + F.when(F.col("l_linenumber") == 7, 1_000_000_000).otherwise(0))
    found = external.beside(lines, part_versions(spark, d), PART_FACTS, {"p_partkey": "part"}, F.to_date(F.lit("1998-01-01")))
    return found.select("l_orderkey", "l_linenumber", "l_partkey", F.col("external.p_brand").alias("brand"), F.col("external.p_size").alias("size"), "external.provenance.provider", "external.provenance.version", "external.provenance.external_id")


@query(f"SELECT 'external:v1:' || sha256('s6:makers;s13:part-metadata;' || {tag('s', 'version')}) AS external_id, version, min(valid_from)::VARCHAR AS valid_from, count(*)::BIGINT AS rows FROM ({SQL_VERSIONS}) GROUP BY version")
def external_versions(spark, d):
    return external.versions(part_versions(spark, d), PART_FACTS).select("external_id", "version", F.col("valid_from").cast("string").alias("valid_from"), "rows")


# --- decisions

EVENTS = DecisionContract("decision-v1", "user_id", "event_id", "event_type", ("purchase", "signup"), ("value",), history=3, outcome=("props",))

SQL_DECISIONS = """
SELECT user_id, event_id, last_value(value IGNORE NULLS) OVER p AS known_value, coalesce(list(event_id) OVER h, []) AS hist, coalesce(list(event_type) OVER h, []) AS acts, count(*) OVER p AS prior_rows,
  event_type, lead(event_type) OVER o AS next_action, props FROM events
WINDOW o AS (PARTITION BY user_id ORDER BY event_id), p AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), h AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)"""
SQL_SAMPLES = f"SELECT * FROM ({SQL_DECISIONS}) WHERE event_type IN ('purchase', 'signup')"


@query(f"""
SELECT user_id, event_id, known_value, array_to_string(hist, ',') AS history, array_to_string(acts, ',') AS actions, prior_rows::BIGINT AS prior_rows, event_type AS observed_action, next_action, props,
  array_to_string(list_filter(['no_prior_rows', 'unknown_value'], lambda x: (x = 'no_prior_rows' AND prior_rows = 0) OR (x = 'unknown_value' AND known_value IS NULL)), ',') AS flags, true AS usable
FROM ({SQL_SAMPLES})""")
def decision_samples(spark, d):
    found = decisions.decision_samples(table(spark, d, "events"), EVENTS)
    return found.select("user_id", "event_id", F.col("input.value").alias("known_value"), F.array_join(F.col("input.history.position").cast("array<string>"), ",").alias("history"), F.array_join("input.history.action", ",").alias("actions"), F.col("input.prior_rows").alias("prior_rows"), F.col("label.observed_action").alias("observed_action"), F.col("post_decision.next_action").alias("next_action"), F.col("post_decision.props").alias("props"), F.array_join("state_quality_flags", ",").alias("flags"), F.col("usable_for_policy_imitation").alias("usable"))


@query(f"SELECT user_id, event_id, event_type AS observed_action, len(hist)::INT AS history_length FROM ({SQL_SAMPLES})")
def policy_view(spark, d):
    found = decisions.policy_view(decisions.decision_samples(table(spark, d, "events"), EVENTS))
    return found.select("user_id", "event_id", F.col("label.observed_action").alias("observed_action"), F.size("input.history").alias("history_length"))


@query(f"SELECT user_id, event_id FROM ({SQL_SAMPLES}) WHERE len(list_filter(hist, lambda x: x >= event_id)) > 0")
def leak_check(spark, d):
    return decisions.leaks(decisions.decision_samples(table(spark, d, "events"), EVENTS), "user_id", "event_id")


TURNS = DecisionContract("turns-v1", "conv_id", "turn", "role", ("assistant",), ("text",), history=2)


@query("""
SELECT conv_id, turn, last_text, prior_rows::BIGINT AS prior_rows, next_role FROM (
  SELECT conv_id, turn, role, last_value(text IGNORE NULLS) OVER p AS last_text, count(*) OVER p AS prior_rows, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role FROM conversations
  WINDOW p AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) WHERE role = 'assistant'""")
def conversation_decisions(spark, d):
    found = decisions.decision_samples(table(spark, d, "conversations"), TURNS)
    return found.select("conv_id", "turn", F.col("input.text").alias("last_text"), F.col("input.prior_rows").alias("prior_rows"), F.col("post_decision.next_action").alias("next_role"))


@query("SELECT doc_id, lang, quality::VARCHAR AS quality, toxic::VARCHAR AS toxic FROM documents LEFT JOIN labels USING (doc_id)")
def augmentation(spark, d):
    found = decisions.augment(table(spark, d, "documents").select("doc_id", "lang"), table(spark, d, "labels"), "doc_id", "labels")
    return found.select("doc_id", "lang", *(F.col(f"labels.{c}").cast("string").alias(c) for c in ("quality", "toxic")))


# --- counts and reports

SQL_OUTCOMES = "SELECT *, CASE WHEN user_id IS NULL THEN 'quarantined' WHEN value < 1 THEN 'rejected' WHEN event_type = 'error' THEN 'skipped' ELSE 'accepted' END AS outcome FROM events"
SQL_STAGE = f"SELECT 'normalize' AS stage, event_type AS unit, count(*)::BIGINT AS read, " + ", ".join(f"count(*) FILTER (outcome = '{o}')::BIGINT AS {o}" for o in counts.OUTCOMES) + f" FROM ({SQL_OUTCOMES}) GROUP BY event_type"


def outcomes(spark, d) -> DataFrame:
    outcome = F.when(F.col("user_id").isNull(), "quarantined").when(F.col("value") < 1, "rejected").when(F.col("event_type") == "error", "skipped").otherwise("accepted")
    return table(spark, d, "events").withColumn("outcome", outcome)


@query(SQL_STAGE)
def stage_counts(spark, d):
    return counts.stage_counts(outcomes(spark, d), "normalize", "event_type", "outcome")


@query(f"SELECT stage, unit, read, accepted, rejected, quarantined, skipped, read - accepted - rejected - quarantined - skipped AS unexplained FROM ({SQL_STAGE}) WHERE read <> accepted + rejected + quarantined + skipped")
def count_conservation(spark, d):
    return counts.conserve(counts.stage_counts(outcomes(spark, d), "normalize", "event_type", "outcome"))


SQL_BATCHES = "SELECT event_type AS unit, event_id // 1000 AS batch, min(event_id)::BIGINT AS first, max(event_id)::BIGINT AS last, count(*)::BIGINT AS read, " + ", ".join(f"count(*) FILTER (outcome = '{o}')::BIGINT AS {o}" for o in counts.OUTCOMES)


@query(f"{SQL_BATCHES} FROM ({SQL_OUTCOMES}) GROUP BY ALL")
def batch_counts(spark, d):
    """Events by type as archives: outcomes of each thousand ordinals, as written, which agree with what was observed while writing."""
    rows, seen = counts.observed(outcomes(spark, d).select("event_type", "event_id", "outcome"), "normalize", "outcome")
    written = stored(rows, "batches")
    if differ := counts.reconciled(seen.get, written, "outcome"):
        raise ValueError(f"observed and written counts differ: {differ}")
    return counts.batch_counts(written, "event_type", "event_id", "outcome", 1000)


@query(f"SELECT stage, unit, " + ", ".join(f"sum({c})::BIGINT AS {c}" for c in ("read", *counts.OUTCOMES)) + f" FROM ({SQL_STAGE}) GROUP BY ROLLUP (stage, unit) HAVING stage IS NOT NULL")
def stage_totals(spark, d):
    return counts.totals(counts.stage_counts(outcomes(spark, d), "normalize", "event_type", "outcome"))


@query(f"SELECT outcome AS value, count(*)::BIGINT AS rows, round(count(*) / (SELECT count(*) FROM events)::DOUBLE, 6) AS share FROM ({SQL_OUTCOMES}) GROUP BY outcome")
def quality_distribution(spark, d):
    return counts.distribution(outcomes(spark, d), "outcome")


@query("SELECT o_orderstatus, o_orderpriority, count(*)::BIGINT AS rows FROM orders GROUP BY ALL")
def view_counts(spark, d):
    return counts.view_counts(table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"])


# --- typing, inspection and governance

TYPED = InterpretationContract("documents-v1", 1, "raw:v1:demo", ("n_chars", "lang", "source"), (FieldRule("n_chars", "n_chars", "integer", required=True), FieldRule("lang", "lang"), FieldRule("flag", "source", "boolean")))


@query("SELECT doc_id, n_chars, lang, 'not_boolean:flag' AS errors FROM documents")
def typed_conversion(spark, d):
    raw = F.create_map(F.lit("n_chars"), F.col("n_chars").cast("string"), F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source"))
    typed = normalize.to_typed(table(spark, d, "documents").select("doc_id", raw.alias("raw")), TYPED)
    return typed.select("doc_id", "n_chars", "lang", F.array_join(F.transform("errors", lambda e: F.concat_ws(":", e["code"], e["field"])), ",").alias("errors"))


PROFILED = ["doc_id", "text", "lang", "source", "n_chars"]


def sql_profile(c: str) -> str:
    lexical = ", ".join(f"count(*) FILTER (regexp_matches(x, '{p.replace(chr(92) + 'd', '[0-9]')}'))::BIGINT AS {kind}" for kind, p in canonical.LEXICAL.items())
    return f"SELECT '{c}' AS column, count(*)::BIGINT AS rows, count(*) FILTER (x IS NULL)::BIGINT AS nulls, count(*) FILTER (x = '')::BIGINT AS empty, {lexical}, coalesce(max(length(x)), 0)::BIGINT AS longest FROM (SELECT {c}::VARCHAR AS x FROM documents)"


@query(" UNION ALL ".join(map(sql_profile, PROFILED)))
def column_profile(spark, d):
    return inspection.profile(table(spark, d, "documents"), PROFILED)


def changed_orders(spark, d) -> tuple[DataFrame, DataFrame]:
    """Orders, and a later version of them: a column renamed, one gone, one new, one of other type, one with nulls, one renamed falsely."""
    old = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", F.col("o_orderdate").cast("date").alias("o_orderdate"))
    new = old.select(
        F.col("o_orderkey"), F.col("o_custkey").alias("o_customer"), F.when(F.col("o_orderkey") % 7 > 0, F.col("o_orderstatus")).alias("o_orderstatus"),
        F.concat(F.lit("EUR "), F.col("o_totalprice").cast("string")).alias("o_totalprice"), F.col("o_orderkey").alias("o_rank"), F.col("o_orderdate"), F.lit("x").alias("o_note"),
    )
    return old, new


@query("""
SELECT 'o_orderkey' AS column, 'o_orderkey' AS new_column, CASE WHEN count(o_orderkey) > 0 THEN 'none' END AS drift FROM orders
UNION ALL SELECT 'o_custkey', 'o_customer', CASE WHEN count(*) = count(o_custkey) THEN 'renamed' END FROM orders
UNION ALL SELECT 'o_orderstatus', 'o_orderstatus', CASE WHEN count(o_orderstatus) = count(*) AND count(*) FILTER (o_orderkey % 7 = 0) > 0 THEN 'nullability' ELSE 'none' END FROM orders
UNION ALL SELECT 'o_totalprice', 'o_totalprice', CASE WHEN count(o_totalprice) > 0 THEN 'type' ELSE 'none' END FROM orders
UNION ALL SELECT 'o_orderpriority', NULL, 'removed' UNION ALL SELECT NULL, 'o_rank', 'added' UNION ALL SELECT 'o_orderdate', 'o_orderdate', 'semantic' UNION ALL SELECT NULL, 'o_note', 'added'""")
def profile_drift(spark, d):
    """Drift of every class between the profiles of two versions, with declared renames and meanings; one rename is not so."""
    old, new = changed_orders(spark, d)
    profiles = [inspection.profile(x, x.columns) for x in (old, new)]
    return inspection.profile_drift(*profiles, {"o_custkey": "o_customer", "o_orderpriority": "o_rank"}, {"o_orderdate": ("day of order", "day of delivery"), "o_orderkey": ("key", "key")})


def sql_privacy(t: str, c: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS column, '{k}' AS pattern, count(*) FILTER (regexp_matches({c}, '{p}'))::BIGINT AS hits FROM {t}" for k, p in inspection.IDENTIFYING.items())


@query(sql_privacy("documents", "text"))
def privacy_scan(spark, d):
    return inspection.privacy_scan(table(spark, d, "documents"), ["text"])


@query(sql_privacy("pages", "html"))
def privacy_scan_pages(spark, d):
    return inspection.privacy_scan(table(spark, d, "pages"), ["html"])


@query("SELECT source, doc_id, k::INT AS representative FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents) WHERE k <= 2")
def representatives(spark, d):
    found = inspection.select_representatives(table(spark, d, "documents").select("source", "doc_id"), ["source"], ["doc_id"], 2)
    return found.select("source", "doc_id", "representative")


@query("SELECT lang, source, count(*)::BIGINT AS archives FROM documents GROUP BY ALL")
def schema_groups(spark, d):
    return inspection.group_schemas(table(spark, d, "documents"), ["lang", "source"])


# Names as archives may have them, and what must be read from them.
NAMES = [
    ("replay_data_public.AAA.FmtX.csv.gz", "replay", "AAA", "FmtX", None),
    ("game_data_public.BB-2.Sealed_Old.csv.gz", "game", "BB-2", "Sealed_Old", None),
    ("draft_data_public.CCC.FmtY.csv.gz", "draft", "CCC", "FmtY", None),
    ("Replay_data_public.AAA.FmtX.csv.gz", "unknown", None, None, "unrecognised_name"),
    ("replay_data_public.AAA.csv.gz", "unknown", None, None, "unrecognised_name"),
    ("replay_data_public.A.B.C.csv.gz", "unknown", None, None, "unrecognised_name"),
    ("notes.csv.gz", "unknown", None, None, "unrecognised_name"),
    ("replay_data_public.AAA.FmtX.csv", "unknown", None, None, "not_an_archive"),
]


def sql_values(rows: list[tuple], names: str) -> str:
    cell = lambda x: "NULL" if x is None else str(x) if isinstance(x, (int, bool)) else "'" + x.replace("'", "''") + "'"
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(cell, r)) + ')' for r in rows)}) AS v({names})"


@query(sql_values(NAMES, "file_name, source_kind, expansion, format, diagnostic"))
def filename_recognition(spark, d):
    names = spark.createDataFrame([(n[0],) for n in NAMES], "file_name string").withColumn("r", recognise(F.col("file_name")))
    return names.select("file_name", "r.source_kind", "r.expansion", "r.format", "r.diagnostic")


@query(sql_values([("a", "supported"), ("b", "removed"), ("c", "changed"), ("d", "new_unknown"), ("e", "unsupported")], "path, drift"))
def drift_reconcile(spark, d):
    old = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3"), ("e", "5")], "path string, sha256 string")
    new = spark.createDataFrame([("a", "1", "supported"), ("c", "9", "supported"), ("d", "4", None), ("e", "5", "unsupported")], "path string, sha256 string, state string")
    return inventory.reconcile(old, new).select("path", "drift")


@query(sql_values([(1, "none"), (2, "additive"), (3, "removal"), (4, "reorder"), (5, "removal")], "n, drift"))
def header_drift(spark, d):
    rows = [(1, ["a", "b"], ["a", "b"]), (2, ["a", "b"], ["a", "b", "c"]), (3, ["a", "b"], ["a"]), (4, ["a", "b"], ["b", "a"]), (5, ["a", "b"], ["a", "z"])]
    df = spark.createDataFrame(rows, "n int, old array<string>, new array<string>")
    return df.select("n", inspection.classify_drift(F.col("old"), F.col("new"))["drift"].alias("drift"))


@query("SELECT 'raw:v1:' || sha256('s1:a;s2:bc;|' || 's1:,;' || 's2:lf;' || 's5:false;' || 's5:utf-8;') AS fingerprint")
def raw_fingerprints(spark, d):
    row = spark.createDataFrame([(["a", "bc"], ",", "lf", False, "utf-8")], "header array<string>, delimiter string, newline string, bom boolean, encoding string")
    return inspection.with_fingerprint(row).select(F.col("raw_schema_fingerprint").alias("fingerprint"))


SQL_CATALOG = "SELECT 'archive:v1:' || sha256('s4:demo;s' || strlen(s_name) || ':' || s_name || ';') AS id, s_name FROM supplier"


def supplier_catalog(spark, d) -> DataFrame:
    """Suppliers as if their names were digests of archives."""
    rows = table(spark, d, "supplier")
    null = F.lit(None).cast("string")
    return rows.select(registration.archive_id("demo", F.col("s_name")).alias("source_archive_id"), F.lit("demo").alias("provider"), F.lit("replay").alias("source_kind"), null.alias("expansion"), null.alias("format"), null.alias("source_url"), F.lit("pending").alias("license_status"))


@query(f"SELECT sha256('source-manifest-v1|' || string_agg(e, '' ORDER BY e)) AS catalog_digest FROM (SELECT 's' || strlen(id) || ':' || id || ';' || 's4:demo;s6:replay;N;N;N;s7:pending;' AS e FROM ({SQL_CATALOG}))")
def catalog_digest(spark, d):
    return manifest.catalog_digest(manifest.semantic_projection(supplier_catalog(spark, d)))


@query("""
WITH s AS (SELECT l_suppkey AS k, l_shipdate AS day, l_linestatus AS fingerprint, CASE WHEN l_returnflag = 'R' THEN 'truncated' END AS problem FROM lineitem WHERE l_shipdate <= DATE '1998-01-01'),
f AS (SELECT k, fingerprint, problem, count(*) AS times FROM s GROUP BY ALL),
r AS (SELECT k, sum(times)::BIGINT AS inspections, count(*)::BIGINT AS findings, count(DISTINCT fingerprint)::BIGINT AS fingerprints, count(problem)::BIGINT AS problems FROM f GROUP BY k),
t AS (SELECT k, max(day) AS last FROM s GROUP BY k)
SELECT s_name, coalesce(inspections, 0)::BIGINT AS inspections, coalesce(findings, 0)::BIGINT AS findings, t.last::TIMESTAMP AS last,
  array_to_string(list_filter(['source_url_missing', 'license_not_verified', 'never_inspected', 'inspections_disagree', 'inspection_problem'],
    lambda x: x IN ('source_url_missing', 'license_not_verified') OR (x = 'never_inspected' AND inspections IS NULL) OR (x = 'inspections_disagree' AND fingerprints > 1) OR (x = 'inspection_problem' AND problems > 0)), ',') AS diagnostics
FROM supplier LEFT JOIN r ON r.k = s_suppkey LEFT JOIN t ON t.k = s_suppkey""")
def audit_catalog(spark, d):
    """Suppliers as archives, their lines as inspections appended to a table, as of a day."""
    names = supplier_catalog(spark, d).join(table(spark, d, "supplier").select(registration.archive_id("demo", F.col("s_name")).alias("source_archive_id"), "s_name", "s_suppkey"), "source_archive_id")
    lines = table(spark, d, "lineitem").join(names.select("source_archive_id", "s_suppkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    found = manifest.inspected(lines.select("source_archive_id", F.col("l_linestatus").alias("raw_schema_fingerprint"), F.when(F.col("l_returnflag") == "R", "truncated").alias("problem"), F.col("l_shipdate").cast("timestamp").alias("inspected_at")), "header", "first record")
    path = fresh_table(spark, "inspections")
    for half in (0, 1):  # two runs
        manifest.append_inspections(found.where(F.month("inspected_at") % 2 == half), path)
    made = manifest.audit_catalog(names, spark.read.parquet(path), F.lit("1998-01-01").cast("timestamp"))
    return made.select("s_name", F.coalesce("inspections", F.lit(0)).alias("inspections"), F.coalesce("findings", F.lit(0)).alias("findings"), F.element_at("latest", 1)["last"].alias("last"), F.array_join("diagnostics.code", ",").alias("diagnostics"))


@query(f"SELECT id AS source_archive_id FROM ({SQL_CATALOG}) WHERE s_name NOT IN (SELECT s_name FROM supplier WHERE s_suppkey % 2 = 0)")
def registration_append(spark, d):
    """Registering all suppliers where those of even key are known: the others are new."""
    known = table(spark, d, "supplier").where("s_suppkey % 2 = 0").select(registration.archive_id("demo", F.col("s_name")).alias("source_archive_id"))
    return registration.register(known, supplier_catalog(spark, d)).select("source_archive_id")


@query("SELECT n_nationkey::VARCHAR AS n_nationkey, n_name, n_regionkey::VARCHAR AS n_regionkey FROM nation")
def gz_reader_roundtrip(spark, d):
    """The nations (25 rows), written as a gzip CSV archive and read again."""
    names = ["n_nationkey", "n_name", "n_regionkey"]
    folder = shared_folder(spark)
    path = os.path.join(folder, "replay_data_public.NATIONS.Demo.csv.gz")
    lines = [",".join(names), *(",".join(f'"{x}"' for x in r) for r in table(spark, d, "nation").select(*names).collect())]
    with open(path, "wb") as f:
        f.write(gzip.compress(("\n".join(lines) + "\n").encode(), mtime=0))
    rows = gzcsv.accepted(gzcsv.read_archives(spark, [path], names))
    return rows.select(*(F.col("fields")[k].alias(n) for k, n in enumerate(names)))


@query("SELECT 'orders' AS view, count(*)::BIGINT AS rows, 0::BIGINT AS problems FROM orders")
def artifact_verify(spark, d):
    """Orders written as shards, listed with hashes, and the list checked against the files."""
    top = os.path.join(shared_folder(spark), "release")
    files.write_view(table(spark, d, "orders"), os.path.join(top, "orders"), order=["o_orderkey"])
    declared = files.artifact_manifest(spark, top)
    problems = files.verify_manifest(declared, files.artifact_manifest(spark, top)).agg(F.count("*").alias("problems"))
    return declared.agg(F.sum("rows").alias("rows")).join(F.broadcast(problems)).select(F.lit("orders").alias("view"), "rows", "problems")  # one row each


@query("SELECT 'second' AS side, count(*)::BIGINT AS rows FROM events WHERE event_type = 'signup'")
def build_comparison(spark, d):
    """A build without signups against a whole one."""
    events = table(spark, d, "events")
    return digest.compare_builds(events.where("event_type <> 'signup'"), events, ["event_id", "event_type"]).groupBy("side").agg(F.count("*").alias("rows"))


# --- gates and rules over tables with findings of each kind

BY_EVENT = SplitContract(contract_id="events-v1", group="event_id")
SQL_BY_EVENT = f"SELECT user_id, {sql_split('event_id', BY_EVENT)} AS split FROM events"


@query(f"SELECT user_id, min(split) AS a, max(split) AS b FROM ({SQL_BY_EVENT}) WHERE user_id IS NOT NULL GROUP BY user_id HAVING count(DISTINCT split) > 1")
def split_violations(spark, d):
    """Users whose events a split by event deals out to several parts."""
    dealt = splits.assign_split(table(spark, d, "events"), BY_EVENT).where("user_id IS NOT NULL")
    return splits.split_isolation(dealt, "user_id").select("user_id", "a", "b")


SQL_GROUP = "coalesce('user_id:' || CASE WHEN event_type <> 'signup' THEN user_id END, 'event_type:' || event_type, 'event_id:' || event_id)"


@query(f"SELECT split_part(g, ':', 1) AS basis, split, count(*)::BIGINT AS records, count(DISTINCT g)::BIGINT AS groups FROM (SELECT g, {sql_split('g', SPLIT)} AS split FROM (SELECT {SQL_GROUP} AS g FROM events)) GROUP BY ALL")
def split_by_strongest_group(spark, d):
    """Events split by user where that is known, else by type: how many of each basis lie in each part."""
    known = table(spark, d, "events").withColumn("user_id", F.when(F.col("event_type") != "signup", F.col("user_id")))
    keyed = known.select(splits.group_key(["user_id", "event_type", "event_id"]).alias(SPLIT.group))
    dealt = splits.assign_split(keyed, SPLIT).withColumn("basis", F.split_part(F.col(SPLIT.group), F.lit(":"), F.lit(1)))
    by_group = dealt.groupBy("basis", "split", SPLIT.group).agg(F.count("*").alias("n"))
    return by_group.groupBy("basis", "split").agg(F.sum("n").alias("records"), F.count("*").alias("groups"))


@query("SELECT l_suppkey, l_shipdate, count(*)::BIGINT AS archives, 'no_readable_representative' AS blocker FROM lineitem GROUP BY ALL HAVING count(*) FILTER (WHERE l_returnflag <> 'R') = 0")
def schema_blockers(spark, d):
    """Groups of lines, as archives of one schema, none of which can be read (returned ones can't)."""
    lines, group = table(spark, d, "lineitem").select("l_suppkey", "l_shipdate", "l_returnflag"), ["l_suppkey", "l_shipdate"]
    return inspection.blockers(lines.groupBy(*group).agg(F.count("*").alias("archives")), lines.where("l_returnflag <> 'R'"), group)


SQL_TIES = """
WITH e AS (SELECT user_id, event_id // 3 AS pos, event_type, value FROM events), g AS (SELECT user_id, pos, list(value) AS here, count(*) AS n FROM e GROUP BY ALL),
p AS (SELECT user_id, pos, n, coalesce(sum(n) OVER w, 0)::BIGINT AS prior_rows, coalesce(array_agg(pos) OVER h, []) AS near, coalesce(array_agg(n) OVER h, []) AS counts FROM g
  WINDOW w AS (PARTITION BY user_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), h AS (PARTITION BY user_id ORDER BY pos ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING))
SELECT user_id, pos, event_type AS observed_action, n > 1 AS tied, prior_rows,
  array_to_string(list_reverse(list_reverse(flatten(list_transform(near, lambda x, i: list_transform(range(counts[i]), lambda k: x))))[1:3]), ',') AS history
FROM p JOIN e USING (user_id, pos) WHERE event_type IN ('purchase', 'signup')"""


def tied_decisions(spark, d, segment_rows: int | None = decisions.SEGMENT_ROWS) -> DataFrame:
    events = table(spark, d, "events").withColumn("pos", F.floor(F.col("event_id") / 3).cast("long"))
    contract = DecisionContract("ties-v1", "user_id", "pos", "event_type", ("purchase", "signup"), ("value",), history=3)
    found = decisions.decision_samples(events, contract, segment_rows=segment_rows)
    return found.select("user_id", "pos", F.col("label.observed_action").alias("observed_action"), (F.col("observed_action_status") == "ambiguous").alias("tied"), F.col("input.prior_rows").alias("prior_rows"), F.array_join(F.col("input.history.position").cast("array<string>"), ",").alias("history"))


@query(SQL_TIES)
def decision_ties(spark, d):
    """Decisions where three events share a position: tied ones are ambiguous and know earlier positions alone."""
    return tied_decisions(spark, d)


WHOLE = DecisionContract("whole-v1", "kind", "event_id", "event_type", ("purchase", "signup"), ("value", "user_id"), history=4, outcome=("props",))


@query("""
SELECT event_id, last_value(value IGNORE NULLS) OVER p AS known_value, last_value(user_id IGNORE NULLS) OVER p AS known_user, array_to_string(coalesce(list(event_id) OVER h, []), ',') AS history, (count(*) OVER p)::BIGINT AS prior_rows, lead(event_type) OVER o AS next_action
FROM (SELECT *, event_id % 3 > 0 AS long FROM events)
WINDOW o AS (PARTITION BY CASE WHEN long THEN -1 ELSE user_id END ORDER BY event_id), p AS (PARTITION BY CASE WHEN long THEN -1 ELSE user_id END ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), h AS (PARTITION BY CASE WHEN long THEN -1 ELSE user_id END ORDER BY event_id ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)
QUALIFY event_type IN ('purchase', 'signup')""")
def decisions_of_a_long_game(spark, d):
    """Two thirds of all events are one game, parted in segments; the rest are their users' games."""
    events = table(spark, d, "events").withColumn("kind", F.when(F.col("event_id") % 3 > 0, F.lit(-1).cast("long")).otherwise(F.col("user_id").cast("long")))
    found = decisions.decision_samples(events, WHOLE, segment_rows=1000)
    return found.select("event_id", F.col("input.value").alias("known_value"), F.col("input.user_id").alias("known_user"), F.array_join(F.col("input.history.position").cast("array<string>"), ",").alias("history"), F.col("input.prior_rows").alias("prior_rows"), F.col("post_decision.next_action").alias("next_action"))


@query("SELECT user_id, event_id FROM events WHERE event_id % 5 = 0")
def leaks_found(spark, d):
    """Samples whose history was made to reach their own position, one in five."""
    own = F.when(F.col("event_id") % 5 == 0, F.col("event_id")).otherwise(F.col("event_id") - 1)
    samples = table(spark, d, "events").select("user_id", "event_id", F.struct(F.array(F.struct(own.alias("position"))).alias("history")).alias("input"))
    return decisions.leaks(samples, "user_id", "event_id")


@query("SELECT 'load' AS stage, event_type AS unit, (count(*) + 1)::BIGINT AS read, count(*)::BIGINT AS accepted, 0::BIGINT AS rejected, 0::BIGINT AS quarantined, 0::BIGINT AS skipped, 1::BIGINT AS unexplained FROM events WHERE event_type <> 'signup' GROUP BY event_type")
def unexplained_counts(spark, d):
    """A stage that says it read one row more than it accounts for, in all units but one."""
    rows = table(spark, d, "events").withColumn("outcome", F.lit("accepted"))
    stage = counts.stage_counts(rows, "load", "event_type", "outcome")
    return counts.conserve(stage.withColumn("read", F.col("read") + (F.col("unit") != "signup").cast("long")))


def faulty_shards(spark, d) -> DataFrame:
    """Orders written in shards: a quarter as declared, a quarter with another type, one that may hold nulls, one cut short."""
    top = shared_folder(spark)
    rows = table(spark, d, "orders").select(F.coalesce("o_orderkey", F.lit(0).cast("long")).alias("o_orderkey"), F.col("o_custkey").cast("long").alias("o_custkey"), "o_orderstatus")
    part = lambda k: rows.where(F.pmod("o_custkey", F.lit(4)) == k)
    files.write_view(part(0), os.path.join(top, "sound"), order=["o_orderkey"])
    files.write_view(part(1).withColumn("o_custkey", F.col("o_custkey").cast("string")), os.path.join(top, "type"))
    files.write_view(part(2).withColumn("o_orderkey", F.nullif("o_orderkey", F.lit(-1).cast("long"))), os.path.join(top, "nulls"))
    files.write_view(part(3), os.path.join(top, "short"))
    for path in files.list_files(os.path.join(top, "short")):
        os.truncate(os.path.join(top, "short", path), os.path.getsize(os.path.join(top, "short", path)) - 100)
    return files.verified_shards(spark, top, rows.schema)


@query("""
SELECT coalesce(problem, 'none') AS problem, CASE problem WHEN 'unreadable' THEN 0 ELSE count(*) END::BIGINT AS rows FROM (
  SELECT CASE o_custkey % 4 WHEN 1 THEN 'type' WHEN 2 THEN 'nullability' WHEN 3 THEN 'unreadable' END AS problem FROM orders) GROUP BY problem""")
def shard_problems(spark, d):
    return faulty_shards(spark, d).groupBy(F.coalesce("problem", F.lit("none")).alias("problem")).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))


@query("""
SELECT 'identifier_uniqueness' AS gate, 'release_blocking' AS disposition, count(*)::BIGINT AS violations FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'duplicate_collision', 'quarantined', count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_partkey) > 1 AND l_orderkey % 2 = 1)
UNION ALL SELECT 'provenance', 'release_blocking', count(*) FROM orders WHERE o_custkey % 3 <> 0
UNION ALL SELECT 'input_integrity', 'fatal_source', count(*) FROM supplier WHERE s_suppkey % 4 = 0
UNION ALL SELECT 'filename', 'warning', count(*) FROM supplier
UNION ALL SELECT 'schema_fingerprint', 'unsupported', count(*) FROM nation WHERE n_regionkey > 1
UNION ALL SELECT 'csv_structure', 'rejected', count(*) FROM part WHERE p_partkey % 7 = 0
UNION ALL SELECT 'type_conversion', 'rejected', count(*) FROM documents
UNION ALL SELECT 'join_cardinality', 'release_blocking', 1
UNION ALL SELECT 'row_counts', 'release_blocking', 1
UNION ALL SELECT 'manifest', 'release_blocking', count(*) FROM region
UNION ALL SELECT 'perspective', 'release_blocking', 1
UNION ALL SELECT 'parquet_readability', 'release_blocking', 3
UNION ALL SELECT 'future_leak', 'release_blocking', count(*) FROM events WHERE event_id % 5 = 0
UNION ALL SELECT 'split_isolation', 'release_blocking', count(*) FROM (SELECT user_id FROM (""" + SQL_BY_EVENT + """) WHERE user_id IS NOT NULL GROUP BY 1 HAVING count(DISTINCT split) > 1)
UNION ALL SELECT 'privacy', 'release_blocking', count(*) FROM (""" + sql_privacy("documents", "text") + """) WHERE hits > 0""")
def gate_summary(spark, d):
    """Every gate over a table with violations of its kind, counted by gate and disposition."""
    lines, orders = table(spark, d, "lineitem"), table(spark, d, "orders")
    supplier, documents, events = table(spark, d, "supplier"), table(spark, d, "documents"), table(spark, d, "events")
    archive = F.concat(F.lit("c"), (F.col("o_custkey") % 3).cast("string"))
    held = lines.where("l_orderkey % 2 = 0").select("l_orderkey").distinct()
    raw = F.create_map(F.lit("n_chars"), F.col("n_chars").cast("string"), F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source"))
    own = F.when(F.col("event_id") % 5 == 0, F.col("event_id")).otherwise(F.col("event_id") - 1)
    samples = events.select("user_id", "event_id", F.struct(F.array(F.struct(own.alias("position"))).alias("history")).alias("input"))
    stage = counts.stage_counts(events.withColumn("outcome", F.lit("accepted")), "load", "event_type", "outcome")
    unsafe = events.select(F.struct(F.col("value").alias("undeclared"), F.lit(1).alias("prior_rows")).alias("input"))
    found = gates.run_gates([
        gates.identifier_uniqueness(lines, "l_orderkey"),
        gates.duplicate_collision(lines, "l_orderkey", "l_partkey", held),
        gates.provenance(orders.select("o_orderkey", F.struct(F.array(archive).alias("source_archives")).alias("provenance")), "o_orderkey", spark.createDataFrame([("c0",)], "path string")),
        gates.input_integrity(supplier.where("s_suppkey % 4 = 0").select(F.col("s_name").alias("source_archive_id"), F.lit("changed").alias("problem"))),
        gates.filename(supplier.select(F.col("s_name").alias("path"), F.lit("unknown").alias("source_kind"), F.lit("unrecognised_name").alias("name_diagnostic"))),
        gates.schema_fingerprint(table(spark, d, "nation").select(F.col("n_name").alias("path"), F.col("n_regionkey").cast("string").alias("raw_schema_fingerprint")), ["0", "1"]),
        gates.csv_structure(table(spark, d, "part").where("p_partkey % 7 = 0").select(F.lit("parts").alias("archive"), F.col("p_partkey").alias("record_ordinal"), F.lit("field_count").alias("reason"))),
        gates.type_conversion(normalize.to_typed(documents.select("doc_id", raw.alias("raw")), TYPED), ["doc_id"]),
        gates.join_cardinality(joins.cardinality(orders.withColumnRenamed("o_custkey", "k"), lines.withColumnRenamed("l_suppkey", "k"), ["k"]), ["1:1"], 0.0),
        gates.row_counts(stage, orders.agg((F.count("*") + events.count()).alias("rows"))),
        gates.manifest(table(spark, d, "region").select(F.col("r_name").alias("path"), F.lit("missing").alias("problem"))),
        gates.perspective(unsafe, ["value"]),
        gates.parquet_readability(files.by_folder(faulty_shards(spark, d))),
        gates.future_leak(samples, "user_id", "event_id"),
        gates.split_isolation(splits.assign_split(events, BY_EVENT).where("user_id IS NOT NULL"), "user_id"),
        gates.privacy(inspection.privacy_holds(inspection.privacy_scan(documents, ["text"]), spark.createDataFrame([], "column string, pattern string, decision string"))),
    ])
    return gates.dispositions(found)


@query(" UNION ALL ".join(f"SELECT * FROM ({sql_privacy(t, c)})" for t, c in (("documents", "text"), ("documents", "lang"), ("documents", "source"))))
def privacy_scan_fields(spark, d):
    """Every string field of the documents, at any depth."""
    return inspection.privacy_scan_all(table(spark, d, "documents"))


@query("SELECT s_name AS source_archive_id, CASE s_suppkey % 3 WHEN 0 THEN 'verified' ELSE 'held' END AS state FROM supplier")
def license_holds(spark, d):
    """Suppliers as sources, of which one in three has a review: the others are held."""
    rows = table(spark, d, "supplier")
    known = rows.select(F.col("s_name").alias("source_archive_id"), F.lit("pending").alias("license_status"))
    reviews = rows.where("s_suppkey % 3 = 0").select(F.col("s_name").alias("source_archive_id"), F.lit(1).alias("review_no"), F.lit("verified").alias("license_status"), F.lit("letter").alias("evidence"))
    held = registration.license_holds(registration.license_states(known, reviews)).select("source_archive_id", F.lit("held").alias("state"))
    return known.select("source_archive_id").join(held, "source_archive_id", "left").select("source_archive_id", F.coalesce("state", F.lit("verified")).alias("state"))


@query("SELECT s_name AS id, CASE WHEN s_suppkey % 5 = 0 THEN 'removed' WHEN s_suppkey % 5 = 1 THEN 'changed' WHEN s_suppkey % 5 = 2 THEN 'new_unknown' ELSE 'supported' END AS drift FROM supplier")
def inventory_drift(spark, d):
    """Two inventories of the suppliers: of each five one is gone, one changed and one new."""
    rows = table(spark, d, "supplier").select(F.col("s_name").alias("path"), F.col("s_suppkey").alias("k"), F.sha2("s_name", 256).alias("sha256"))
    old = rows.where("k % 5 <> 2").select("path", "sha256")
    new = rows.where("k % 5 <> 0").select("path", F.when(F.col("k") % 5 == 1, F.lit("other")).otherwise(F.col("sha256")).alias("sha256"), F.when(F.col("k") % 5 == 2, F.lit(None)).otherwise(F.lit("supported")).alias("state"))
    return inventory.reconcile(old, new).select(F.col("path").alias("id"), "drift")


@query("SELECT l_orderkey, l_linenumber, l_quantity::DOUBLE AS quantity, l_shipmode AS mode, 0::BIGINT AS n_flags, 'lines-v1' AS contract, 'lineitem' AS archive FROM (SELECT *, l_returnflag AS l_shipmode FROM lineitem)")
def normalized_events(spark, d):
    """Lines typed by a contract and put in the normalized groups."""
    contract = InterpretationContract("lines-v1", 1, "raw:v1:lines", ("quantity", "flag"), (FieldRule("quantity", "quantity", "decimal", required=True, scale=2), FieldRule("mode", "flag")))
    raw = F.create_map(F.lit("quantity"), F.col("l_quantity").cast("decimal(18,2)").cast("string"), F.lit("flag"), F.col("l_returnflag"))
    typed = normalize.to_typed(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.lit("lineitem").alias("archive"), raw.alias("raw")), contract)
    found = normalize.normalize(typed, contract, ["l_orderkey", "l_linenumber"], "1", "normalize")
    return found.select("provenance.l_orderkey", "provenance.l_linenumber", F.col("normalized.quantity").cast("double").alias("quantity"), F.col("normalized.mode").alias("mode"), F.size("quality.flags").cast("long").alias("n_flags"), F.col("provenance.interpretation_contract_id").alias("contract"), F.element_at("provenance.source_archives", 1).alias("archive"))


def shared_folder(spark: SparkSession) -> str:
    """A new folder on the shared file system, for what is written and read as plain files (see the README)."""
    path = fresh_table(spark, "files").removeprefix("file://")
    if not path.startswith("/"):
        raise ValueError(f"{path} is no mounted folder")
    os.makedirs(path)
    return path
