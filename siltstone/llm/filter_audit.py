"""How text filters interact: what each removes after the others, in every order of applying them.

Each document gets a mask of the filters that it fails.  Four look at its text alone.
The fifth, E, fails texts that a smaller doc_id has too, and is found by a sort:
documents are range-partitioned by the XXH64 of their text and doc_id, sorted by
fingerprint, whole text and doc_id, and each row is held against its predecessor.
A range of equal fingerprints can begin in an earlier partition; so rows of a
partition's first fingerprint wait for what earlier partitions hold of it, of
which there is one row for each partition and text (told by SHA-256).  Copies,
however many, lie in as many partitions as they need.

Masks are then counters: (part, mask) with documents, good and toxic ones.  All that
is asked for follows from them by addition, so that parts can be merged in any way.

Null text is the empty text.  A null doc_id is larger than any other; rows that
repeat a doc_id and text are not smaller than each other.  Null sources are the part of the
empty name.  A doc_id with several labels has the larger of each.  Very long texts are
read whole, one at a time.  No documents give no rows.  Only doc_id, text, source and
the labels' columns are read, so other columns may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import cut, maybe_broadcast

FILTERS = "ABCDE"
#: A fails texts of fewer words; B those of a smaller share of different words; C those of a larger share of capitals.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 50, 65, 5
#: D fails texts that hold any of these.
SYMBOLS = b"#$%&*|"
CAPITALS = bytes(range(65, 91))
DUPLICATE = 1 << FILTERS.index("E")
#: Stands for a null doc_id, which is larger than others.
LAST = (1 << 63) - 1


def text_mask(text: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words = text.split()  # of bytes: white space is the space and 9 to 13
    chars = len(text.decode("utf-8", "replace")) if not text.isascii() else len(text)
    capitals = len(text) - len(text.translate(None, CAPITALS))
    symbols = len(text.translate(None, SYMBOLS)) < len(text)
    return (len(words) < LEAST_WORDS) + 2 * (100 * len(set(words)) < LEAST_DISTINCT * len(words)) + 4 * (100 * capitals > MOST_CAPITALS * chars) + 8 * symbols


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one sorted partition with their masks; at its end what it holds of its last fingerprint.

    ``waits`` marks rows of the partition's first fingerprint without a predecessor in
    it; ``holds`` the rows at the end, with the smallest doc_id of each text.
    """
    names = ["doc_id", "part", "mask", "fp", "digest", "waits", "holds"]
    types = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.bool_(), pa.bool_()]
    first = last = text = mask = least = digest = None
    here: dict[bytes, int] = {}  # of the fingerprint at hand: smallest doc_id by text
    for batch in batches:
        rows = []
        fps, ids, parts, texts = (batch.column(c) for c in ("fp", "doc_id", "part", "text"))
        for k in range(batch.num_rows):
            fp, doc, now = fps[k].as_py(), ids[k].as_py(), texts[k].as_buffer()
            now = now.to_pybytes() if now is not None else b""
            new = fp != last
            if new:
                last, here = fp, {}
                first = fp if first is None else first
            if new or now != text:
                text, mask, least, digest = now, text_mask(now), LAST if doc is None else doc, hashlib.sha256(now).digest()
                here[digest] = least
            after = (LAST if doc is None else doc) > least
            waits = fp == first and not after
            rows.append((doc, parts[k].as_py(), mask | DUPLICATE * after, fp if waits else None, digest if waits else None, waits, False))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)] if rows else [pa.array([], t) for t in types], names)
    if here:
        yield pa.RecordBatch.from_arrays([pa.array(list(here.values()), types[0]), pa.nulls(len(here), types[1]), pa.array([0] * len(here), types[2]), pa.array([last] * len(here), types[3]), pa.array(list(here), types[4]), pa.array([False] * len(here)), pa.array([True] * len(here))], names)


def masked(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask): the filters that each document fails, cut."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lean = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"), F.xxhash64(text).alias("fp"))
    # Texts take no part in the ranges' bounds, of which samples are collected.
    ranged = lean.repartitionByRange("fp", F.col("doc_id").asc_nulls_last()).sortWithinPartitions("fp", "text", F.col("doc_id").asc_nulls_last())
    found = ranged.select("fp", "doc_id", "part", F.col("text").cast("binary").alias("text")).mapInArrow(_compared, "doc_id long, part string, mask int, fp long, digest binary, waits boolean, holds boolean")
    found = cut(found, "audit-masks")
    # A row or two for each partition.
    held = found.where("holds").groupBy("fp", "digest").agg(F.min("doc_id").alias("least"))
    after = F.coalesce(F.coalesce("doc_id", F.lit(LAST)) > F.col("least"), F.lit(False))
    rows = found.where("NOT holds").join(F.broadcast(held), ["fp", "digest"], "left")
    return rows.select("doc_id", "part", F.col("mask").bitwiseOR(F.when(after, DUPLICATE).otherwise(0)).alias("mask"))


def counters(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): additive counts of documents that fail just the mask's filters."""
    # Good and toxic documents alone are looked up, once each.
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("quality") == 1, F.lit(False)).alias("good"), F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("toxic"))
    marks = cut(marks.where("doc_id IS NOT NULL AND (good OR toxic)").groupBy("doc_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic")), "audit-labels")
    marked = rows.join(maybe_broadcast(marks), "doc_id", "left")
    return marked.groupBy("part", "mask").agg(F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))


def audit(found: DataFrame) -> DataFrame:
    """A row for each part, order of the filters and step, of ``counters``.

    What a filter does depends on the set of those before it alone; 80 pairs of a
    filter and such a set are counted, and dealt out to the orders.
    """
    spark, size = found.sparkSession, len(FILTERS)
    pairs = [(before, 1 << k) for k in range(size) for before in range(1 << size) if not before >> k & 1]
    pair = F.explode(F.array(*(F.struct(F.lit(b).alias("before"), F.lit(f).alias("bit")) for b, f in pairs))).alias("pair")
    each = found.select("part", "mask", "n", "good", "toxic", pair).select("*", "pair.before", "pair.bit")
    earlier, fails = F.col("mask").bitwiseAND(F.col("before")) != 0, F.col("mask").bitwiseAND(F.col("bit")) != 0
    # In 1 of k orders a filter stands before the others that a document of k failures fails.
    orders = len(list(permutations(FILTERS)))
    total = lambda when, what="n": F.sum(F.when(when, F.col(what)).otherwise(0)).alias
    share = F.expr(f"n * ({orders} div greatest(bit_count(mask), 1))")
    counted = each.groupBy("part", "before", "bit").agg(
        total(~earlier & ~fails)("kept"),
        total(~earlier & fails)("removed"),
        total(earlier & fails)("redundant"),
        total(F.col("mask") == F.col("bit"))("unique_fails"),
        total(~earlier & fails, "good")("good_lost"),
        total(~earlier & fails, "toxic")("toxic_lost"),
        F.sum(F.when(fails, share).otherwise(0)).alias("shapley"),
    )
    steps = []
    for order in map("".join, permutations(FILTERS)):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            steps.append((order, step, before, bit))
            before |= bit
    dealt = counted.join(F.broadcast(spark.createDataFrame(steps, "filter_order string, step int, before int, bit int")), ["before", "bit"])
    return dealt.select("part", "filter_order", "step", *(F.col(c).cast("long").alias(c) for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")))


def interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of ``docs``: see ``audit``."""
    return audit(cut(counters(masked(docs), labels), "audit-counters"))
