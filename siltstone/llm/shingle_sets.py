"""Near-copies by SimHash, verified and completed by an exact join of their shingle sets.

A text's set is the XXH64 of its different five-word shingles (of the whole text
where it has fewer words).  Two texts are linked if their sets' Jaccard similarity
is at least 0.8; ``keep_first`` keeps one document of each component of the links.

Documents of equal sets are one to the join, known by the XXH64 of the set; a document goes for an
equal set only if a second hash and the size are equal too.

First comes the trie self-join of operator 6: sets whose fingerprints differ in at most
``NEAR_BITS`` bits are held against each other, and those whose Jaccard similarity is verified are
joined.  Fingerprints miss some pairs near the bound, so an exact join follows for
the sets that are not yet one component; without it links would be lost.  Shingles
are ordered by rarity, by counts of hash buckets over all texts; any one order gives
the same links, a better one only fewer pairs.  Sets as similar as asked share a
shingle of their prefixes (the rarest shingles, one more than may be missing), so
each prefix shingle lists its sets, and pairs of one list pass the length and the
positional filter.  A list is read through once, in order, to drop what is in no other set; its pairs
are compared in blocks of it, so that no task compares all of a long one.  Each list is first held against its least set, but for sets that
the fingerprints joined; what the verified links join is not compared again, which in a large group of copies leaves few pairs.
Of the others all pairs are compared.  Pairs first pass a bound on their difference:
that of the counts of their shingles in 256 ranges, which none as similar as asked can
fail; those left are verified by their whole sets, read again from the texts.

Texts without words are equal to each other.  Null text is empty text.  Rows of one doc_id with
other texts are documents of their own: each goes or stays by its own text.  Of one
component all rows of the smallest doc_id are kept, repeated ones too, as is a null doc_id, which
never stands for others.  Ties of rarity go by the shingles' hashes.  Very long texts are sets of their
shingles like others, one text at a time.  No documents give no rows.  Extra columns are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm import simhash
from siltstone.llm.common import cut, cut_alone, is_few, maybe_broadcast, whole_row
from siltstone.llm.simhash import SEED, roots, spark_partitions

SHINGLE = 5
BUCKETS = 1 << 16
#: Fingerprints of near-copies may differ in so many bits.
NEAR_BITS = 6
#: Lists of more sets are compared in blocks of about as many.
HOT_LIST = 20_000


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The set of a text, ascending."""
    words = (text or "").encode("utf-8").lower().split()  # of bytes, as in fingerprints
    if not words:
        return np.zeros(0, np.uint64)
    grams = [b" ".join(words)] if len(words) < shingle else list(map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False)))
    return np.unique(np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), grams), np.uint64, len(grams)))


def identity(found: np.ndarray) -> tuple[int, int]:
    """Two hashes of a set."""
    body = found.astype("<u8").tobytes()
    return xxhash.xxh64_intdigest(body, seed=SEED), xxhash.xxh64_intdigest(body, seed=SEED + 1)


def bucket(found: np.ndarray) -> np.ndarray:
    return (found & np.uint64(BUCKETS - 1)).astype(np.int64)


def sketch(found: np.ndarray) -> bytes:
    """How many of the shingles lie in each of 256 ranges, a byte each (255 is 255 or more)."""
    return np.minimum(np.bincount((found >> np.uint64(56)).astype(np.int64), minlength=256), 255).astype(np.uint8).tobytes()


def version(text: Column) -> Column:
    """Tells the texts of one doc_id apart."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), version(F.col("text")).alias("version"))


def sets(docs: DataFrame, ranks: np.ndarray | None = None, whole: bool = False) -> DataFrame:
    """(doc_id, version, key, check, n, grams, sketch, fp): grams are the prefix by ``ranks``, the ``whole`` set, or none.

    Sketch and fp, the set's SimHash, are there if grams are not.
    """

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                keys, checks, sizes, grams, sketches, fps = [], [], [], [], [], []
                for text in part.column("text").to_pylist():
                    found = shingles(text)
                    n = len(found)
                    key, check = identity(found)
                    keys.append(key)
                    checks.append(check)
                    sizes.append(n)
                    lean = whole or ranks is not None
                    sketches.append(None if lean else sketch(found))
                    fps.append(None if lean else np.uint64(simhash.majority(found)).astype(np.int64).item())
                    if ranks is not None:
                        found = found[np.lexsort((found, ranks[bucket(found)]))[: n - (4 * n + 4) // 5 + 1]]
                    grams.append(found if whole or ranks is not None else found[:0])
                edges = np.concatenate([[0], np.cumsum([len(g) for g in grams])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(grams).view(np.int64)))
                columns = [part.column("doc_id"), part.column("version"), *(pa.array(np.array(c, np.uint64).view(np.int64)) for c in (keys, checks)), pa.array(sizes, pa.int32()), lists, pa.array(sketches, pa.binary()), pa.array(fps, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "version", "key", "check", "n", "grams", "sketch", "fp"])

    return _texts(docs).mapInArrow(made, "doc_id long, version long, key long, check long, n int, grams array<long>, sketch binary, fp long")


def rarity(docs: DataFrame) -> np.ndarray:
    """For each bucket of shingles twice the binary logarithm of its count in all texts: one row a bucket."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                found = [shingles(text) for text in batch.column("text").slice(low, 64).to_pylist()]
                total += np.bincount(bucket(np.concatenate(found)), minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["b", "c"])

    ranks = np.zeros(BUCKETS, np.int16)
    for b, c in _texts(docs).mapInArrow(counted, "b int, c long").groupBy("b").agg(F.sum("c")).collect():
        ranks[b] = int(2 * math.log2(c))
    return ranks


def may_match(a: str, b: str) -> Column:
    """Length and positional filters of two entries of one list."""
    n = lambda side: F.col(f"{side}.n")
    after = lambda side: n(side) - F.col(f"{side}.k")  # noqa: E731  shingles from this one on
    return (n(a) * 5 >= n(b) * 4) & (n(b) * 5 >= n(a) * 4) & (F.least(after(a), after(b)) * 9 >= (n(a) + n(b)) * 4)


def close(pairs: DataFrame, firsts: DataFrame) -> DataFrame:
    """Those (a, b) of ``pairs`` of keys whose sketches differ by no more than similar sets', cut."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, 256).astype(np.int16) for c in ("x", "y"))
                apart = np.abs(x - y).sum(axis=1, dtype=np.int64)
                total = batch.column("n").to_numpy() + batch.column("m").to_numpy()
                yield batch.select(["a", "b"]).filter(pa.array(apart * 9 <= total))

    of = lambda key, n, x: firsts.select(F.col("key").alias(key), F.col("n").alias(n), F.col("sketch").alias(x))
    both = pairs.join(of("a", "n", "x"), "a").join(of("b", "m", "y"), "b").select("a", "b", "n", "m", "x", "y")
    return cut(both.mapInArrow(kept, "a long, b long"), "close")


def verified(pairs: DataFrame, docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """Those (a, b) of ``pairs`` of keys whose sets' Jaccard similarity is at least 0.8, cut."""
    pairs = close(pairs, firsts)
    used = cut(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct().join(firsts, "key").select("key", "least"), "paired")
    ids = used.select(F.col("least").alias("_id")).distinct()
    few = is_few(used)
    texts = _texts(docs).alias("d").join(F.broadcast(ids) if few else ids, F.col("d.doc_id").eqNullSafe(F.col("_id")), "left_semi")
    found = sets(texts, whole=True).join(F.broadcast(used) if few else used, "key", "left_semi")
    found = cut(found.dropDuplicates(["key"]).select("key", "grams"), "paired-sets")
    both = pairs.join(found.select(F.col("key").alias("a"), F.col("grams").alias("x")), "a").join(found.select(F.col("key").alias("b"), F.col("grams").alias("y")), "b")
    return cut(both.where(F.size(F.array_intersect("x", "y")) * 9 >= (F.size("x") + F.size("y")) * 4).select("a", "b"), "similar")


def near_fingerprints(firsts: DataFrame, budget: int = NEAR_BITS) -> DataFrame:
    """(a, b) of keys that the trie self-join of their fingerprints puts together: a spanning forest of each task's, cut."""
    some = firsts.where("n > 0")  # of no words there is one set
    least = cut(some.groupBy("fp").agg(F.min("key").alias("of")), "set-fingerprints")
    equal = some.select("key", "fp").join(least, "fp").where("key <> of").select(F.col("key").alias("a"), F.col("of").alias("b"))
    near = simhash.links(least.select("fp"), budget)
    of = lambda x: least.select(F.col("fp").alias(f"{x}_fp"), F.col("of").alias(x))
    edges = near.toDF("a_fp", "b_fp").distinct()
    near = edges.join(of("a"), "a_fp").join(of("b"), "b_fp").select("a", "b")
    return cut(equal.unionByName(near), "near-fingerprints")


def labelled(lists: DataFrame, linked: DataFrame) -> DataFrame:
    """``lists`` with ``label``, the root of what ``linked`` joins."""
    joined = cut(roots(linked), "joined")
    return lists.join(maybe_broadcast(joined), F.col("key") == F.col("node"), "left").select("token", "key", "n", "k", F.coalesce("root", "key").alias("label"))


def links(docs: DataFrame, marked: DataFrame, firsts: DataFrame, hot_list: int = HOT_LIST) -> DataFrame:
    """Edges (a, b) of keys that join the same components as all pairs of similar sets do, cut."""
    alike = verified(near_fingerprints(firsts), docs, firsts)
    repeated = cut(firsts.where("copies > 1").select("key", "least"), "repeated-sets")
    again = cut(marked.join(maybe_broadcast(repeated), "key").where("doc_id <> least").select("doc_id", "key").distinct(), "repeats")
    prefixes = sets(docs, rarity(docs)).where("n > 0")
    prefixes = prefixes.join(maybe_broadcast(again), ["doc_id", "key"], "left_anti")
    listed = prefixes.select("key", "n", F.posexplode("grams").alias("k", "token")).repartition(spark_partitions(docs), "token")
    order = Window.partitionBy("token").orderBy("key")
    near = listed.select("*", F.lag("key").over(order).alias("_before"), F.lead("key").over(order).alias("_after"))
    # Lists of one set give no pair; rows of one set in a list are one.
    near = near.where("(_before IS NULL OR _before <> key) AND (_before IS NOT NULL OR _after IS NOT NULL)")
    lists = cut(near.select("token", "key", "n", "k"), "lists")
    entry = F.struct("key", "n", "k", "label")
    open_to = labelled(lists, alike)
    leads = open_to.groupBy("token").agg(F.min(entry).alias("y"))
    led = open_to.join(leads, "token").select(entry.alias("x"), "y").where((F.col("x.key") > F.col("y.key")) & (F.col("x.label") != F.col("y.label")) & may_match("x", "y"))
    led = verified(cut(led.select(F.col("x.key").alias("a"), F.col("y.key").alias("b")).distinct(), "led"), docs, firsts)
    first = alike.unionByName(led)
    left = labelled(lists, first)
    open_lists = left.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("length")).where("low < high").select("token", "length")
    rest = cut(left.join(open_lists, "token"), "open-lists")
    # Blocks of a list meet in pairs, each pair a group of its own; lists of usual length are one block.
    count = F.ceil(F.col("length") / hot_list).cast("int")
    own, other = F.pmod(F.xxhash64("key"), count).cast("int"), F.explode(F.sequence(F.lit(0), count - 1))
    x, y = rest.select("*", own.alias("i"), other.alias("j")).alias("x"), rest.select("*", own.alias("j"), other.alias("i")).alias("y")
    same = (F.col("x.token") == F.col("y.token")) & (F.col("x.i") == F.col("y.i")) & (F.col("x.j") == F.col("y.j"))
    pairs = x.join(y, same & (F.col("x.key") > F.col("y.key")) & (F.col("x.label") != F.col("y.label")) & may_match("x", "y"))
    pairs = pairs.select(F.col("x.key").alias("a"), F.col("y.key").alias("b")).distinct()
    return first.unionByName(verified(cut(pairs, "candidates"), docs, firsts))


def copies(docs: DataFrame, hot_list: int = HOT_LIST) -> DataFrame:
    """(doc_id, version, component_id) of the documents that are not the first of their component, cut."""
    marked = cut(sets(docs).select("doc_id", "version", "key", "check", "n", "sketch", "fp"), "sets")
    firsts = marked.groupBy("key").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"), F.min_by(F.struct("n", "sketch", "check", "fp"), F.coalesce("doc_id", F.lit((1 << 63) - 1))).alias("of"))
    firsts = cut(firsts.select("key", "least", "copies", "of.n", "of.sketch", "of.fp", F.col("of.check").alias("first_check"), F.col("of.n").alias("first_n")), "firsts")
    found = cut(roots(links(docs, marked, firsts, hot_list)), "components")
    rooted = firsts.join(maybe_broadcast(found), F.col("key") == F.col("node"), "left")
    rooted = rooted.select("key", "least", "copies", "first_check", "first_n", F.coalesce("root", "key").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labelled = cut(rooted.join(lowest, "root").where("copies > 1 OR least <> component_id").select("key", "first_check", "first_n", "component_id"), "labels")
    lone = marked.join(maybe_broadcast(labelled), "key").where("doc_id <> component_id AND check = first_check AND n = first_n")
    return cut(lone.select("doc_id", "version", "component_id").distinct(), "copies")


def keep_first(docs: DataFrame, hot_list: int = HOT_LIST) -> DataFrame:
    """``docs`` with one document of each component, that with the smallest doc_id."""
    gone = cut_alone("gone", lambda: copies(docs, hot_list).select(F.col("doc_id").alias("gone"), F.col("version").alias("gone_version")).distinct())
    rows = docs.select(whole_row(docs).alias("row"))
    # Beyond what may be broadcast, documents are shuffled to the ids that go.
    same = (F.col("row.doc_id").cast("long") == F.col("gone")) & (version(F.col("row.text")) == F.col("gone_version"))
    return rows.join(maybe_broadcast(gone), same, "left_anti").select(*(F.col(f"row.`{c}`") for c in docs.columns))
