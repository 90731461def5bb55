"""SimHash near-duplicates by a binary trie self-join.

``fingerprints`` gives each document's 64-bit fingerprint of word shingles;
``links`` joins the different fingerprints that differ in few bits;
``components`` labels each document with the smallest doc_id it is linked to,
directly or through others.

The join: fingerprints that differ in at most ``budget`` of 64 bits agree on at
least j whole blocks of budget + j equal ones.  For each choice of j blocks the
fingerprints are dealt out by those bits (j grows with the number of
fingerprints, so that groups stay small), and each group is joined with itself
as a binary trie: node pairs descend together, bits that differ are added up,
and pairs over the budget are pruned.  A group over ``group_rows`` is split in
sub-groups, of which each pair is a task of its own, so that no task holds more
than twice that.  Each task gives a spanning forest of the links it finds, not
all pairs: that joins the same components.

A document without words has fingerprint zero and is linked like any other.
Null text is empty text.  Equal texts share a fingerprint and are one trie leaf.
No documents give no rows; a null doc_id is carried but never labels others.
Extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import cut, maybe_broadcast, whole_row

BITS = 64
BUDGET = 4
#: Bits in which documents may differ that count as copies of each other.
NEAR_BUDGET = 8
SEED = 42
GROUP_ROWS = 8192
#: Fingerprints that agree on the chosen blocks are about so many at least, where there are as many.
GROUP_AIM = 512
#: Node pairs of so many pairs of fingerprints are leaves.
LEAF_PAIRS = 2
#: Node pairs handled at once; their arrays take about 100 MB.
FRONTIER = 1_000_000


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Each bit is 1 if it is set in over half the shingles' XXH64 values."""
    words = (text or "").encode("utf-8").lower().split()  # of bytes: A-Z alone, and white space 9 to 13 and 32
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False))
    n = max(1, len(words) - shingle + 1)
    return majority(np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), grams), np.uint64, n))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half the hashes; zero of none."""
    n = len(hashes)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 65536):
        block = hashes[at : at + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = np.array([fingerprint(x, shingle) for x in part.column("text").to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    lean = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return lean.mapInArrow(hashed, "doc_id long, fp long")


def block_masks(budget: int, agree: int, width: int = BITS) -> list[int]:
    """For each choice of ``agree`` of budget + agree blocks of the bits, its mask: ``width`` bits at most of each block."""
    edges = np.linspace(0, BITS, budget + agree + 1).round().astype(int)
    blocks = [((1 << int(min(b, a + width))) - 1) ^ ((1 << int(a)) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(blocks, agree)]


def dealing(n: int, budget: int, aim: int = GROUP_AIM) -> tuple[int, int]:
    """Blocks that must agree, and how many bits of each are compared, so that n even fingerprints lie in groups of about ``aim``.

    The fewest blocks that can part them so: each fingerprint is dealt out once for each
    choice of blocks.  Three are enough for any corpus, as they part 2**27 times as many.
    """
    bits = max(0, (n // aim).bit_length() - 1)
    for agree in (1, 2, 3):
        width = -(-bits // agree)
        if width <= BITS // (budget + agree):
            return agree, width
    return 3, BITS


class Forest:
    """Components of rows 0 to n - 1, by vectors of edges."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.root[a], self.root[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def trie_join(values: np.ndarray, left: np.ndarray, right: np.ndarray, budget: int, forest: Forest) -> None:
    """Join in ``forest`` the values that differ in at most ``budget`` bits.

    ``values``: unsigned 64-bit, ascending inside each range of rows.  ``left``
    and ``right``: (n, 2) ranges, the roots of the tries to descend in pairs; a
    range given as both sides is joined with itself.
    """
    shifts = np.uint64(BITS - 1) - np.arange(BITS, dtype=np.uint64)
    pairs = np.column_stack([left, right, np.zeros((len(left), 2), np.int64)])
    stack = [pairs] if len(pairs) else []  # columns: left range, right range, depth, bits that differ
    while stack:
        now = stack.pop()
        if len(now) > FRONTIER:
            stack += [now[at : at + FRONTIER // 2] for at in range(0, len(now), FRONTIER // 2)]
            continue
        na, nb = now[:, 1] - now[:, 0], now[:, 3] - now[:, 2]
        small = na * nb <= LEAF_PAIRS
        few = now[small]
        if len(few):
            size = (na * nb)[small]
            low = np.repeat(np.cumsum(size) - size, size)
            k = np.arange(size.sum()) - low
            wide = np.repeat(nb[small], size)
            i, j = np.repeat(few[:, 0], size) + k // wide, np.repeat(few[:, 2], size) + k % wide
            near = (i != j) & (np.bitwise_count(values[i] ^ values[j]) <= budget)
            forest.join(i[near], j[near])
        now = now[~small]
        if not len(now):
            continue
        depth = int(now[0, 4])  # the same in all of one frontier
        # A node's children part where the bit at this depth turns from 0 to 1.
        zeros = np.concatenate([[0], np.cumsum(1 - ((values >> shifts[depth]) & np.uint64(1)).astype(np.int64))])
        cut_a = now[:, 0] + zeros[now[:, 1]] - zeros[now[:, 0]]
        cut_b = now[:, 2] + zeros[now[:, 3]] - zeros[now[:, 2]]
        sides_a = ((now[:, 0], cut_a), (cut_a, now[:, 1]))
        sides_b = ((now[:, 2], cut_b), (cut_b, now[:, 3]))
        same = (now[:, 0] == now[:, 2]) & (now[:, 1] == now[:, 3])
        below = []
        for x in (0, 1):
            for y in (0, 1):
                (a0, a1), (b0, b1) = sides_a[x], sides_b[y]
                used = now[:, 5] + (x != y)
                keep = (a0 < a1) & (b0 < b1) & (used <= budget) & ~(same & (x > y))
                below.append(np.column_stack([a0, a1, b0, b1, np.full(len(now), depth + 1), used])[keep])
        after = np.concatenate(below)
        if len(after):
            stack.append(after)


def _join_groups(batches: Iterator[pa.RecordBatch], budget: int) -> Iterator[pa.RecordBatch]:
    """Rows (task, side, fp), sorted so, as (a, b) edges of a forest for each task."""
    held: list[pa.Table] = []

    def edges(rows: pa.Table) -> pa.RecordBatch:
        task, side = rows["task"].to_numpy(), rows["side"].to_numpy()
        fp = rows["fp"].to_numpy().view(np.uint64)
        # Sides of one task lie next to each other; inside each, values ascend.
        order = np.lexsort((fp, side, task))
        task, side, fp = task[order], side[order], fp[order]
        starts = np.flatnonzero(np.concatenate([[True], (task[1:] != task[:-1]) | (side[1:] != side[:-1])]))
        ranges = np.column_stack([starts, np.concatenate([starts[1:], [len(fp)]])])
        of = side[starts]
        forest = Forest(len(fp))
        own = ranges[of == 0]
        trie_join(fp, own, own, budget, forest)
        first = np.flatnonzero(of == 1)
        first = first[(first + 1 < len(starts))]
        first = first[(of[np.minimum(first + 1, len(of) - 1)] == 2) & (task[starts[first]] == task[starts[np.minimum(first + 1, len(of) - 1)]])]
        trie_join(fp, ranges[first], ranges[first + 1], budget, forest)
        linked = np.flatnonzero(forest.root != np.arange(len(fp)))
        signed = fp.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(signed[linked]), pa.array(signed[forest.root[linked]])], ["a", "b"])

    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        if sum(t.num_rows for t in held) < 200_000:
            continue
        rows = pa.concat_tables(held)
        task = rows["task"].to_numpy()
        whole = int(np.searchsorted(task, task[-1]))  # the last task may go on in the next batch
        held = [rows.slice(whole)]
        if whole:
            yield edges(rows.slice(0, whole))
    if held:
        yield edges(pa.concat_tables(held))


def links(distinct: DataFrame, budget: int = BUDGET, group_rows: int = GROUP_ROWS, agree: int | None = None) -> DataFrame:
    """Edges (a, b) that join the ``fp`` values within ``budget`` bits.

    ``distinct``: a cut table with different fp values.
    """
    agree, width = (agree, BITS) if agree else dealing(distinct.count(), budget)
    masks = block_masks(budget, agree, width)
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    table = F.explode(F.array(*(F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for k, m in enumerate(signed))))
    keyed = distinct.select("fp", table.alias("g")).select("fp", F.xxhash64("g.t", "g.key").alias("group"))
    sizes = keyed.groupBy("group").count().where("count > 1")
    big = cut(sizes.where(F.col("count") > group_rows), "hot-groups")
    # Groups of bounded size: one task each, all on side 0.
    parts = spark_partitions(distinct)
    plain = keyed.join(big, "group", "left_anti").select(F.col("group").alias("task"), F.lit(0).alias("side"), "fp")
    # Others: sub-groups by hash; a task for each (side 0) and for each pair of them (sides 1 and 2).
    split = keyed.join(big, "group").withColumn("n", F.ceil(F.col("count") / group_rows).cast("int")).withColumn("own", F.pmod(F.xxhash64(F.col("fp"), F.lit(1)), F.col("n")).cast("int"))
    split = split.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
    split = split.select(F.xxhash64("group", low, high).alias("task"), side.alias("side"), "fp")
    dealt = plain.unionByName(split).repartition(parts, "task").sortWithinPartitions("task")
    return dealt.mapInArrow(partial(_join_groups, budget=budget), "a long, b long")


def spark_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def roots(edges: DataFrame, name: str = "stars") -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b): the least node it is linked to.

    Alternates large-star and small-star steps, each one shuffle on the node,
    until nothing changes; every step is cut, so lost executors cost one step.
    """

    def star(pairs: DataFrame) -> DataFrame:
        """Each node with the least of itself and its neighbours."""
        least = pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        return pairs.join(least, "a")

    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = star(both).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = cut(large, name)
        small = star(large)  # a > b in every row
        small = small.select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").where("a <> b").distinct()
        now = cut(small, name)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state


def components(docs: DataFrame, shingle: int = 4, budget: int = BUDGET, group_rows: int = GROUP_ROWS) -> DataFrame:
    """doc_id, fp (signed) and component_id, the smallest doc_id reachable."""
    marked = cut(fingerprints(docs, shingle), "fingerprints")
    distinct = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    found = roots(links(distinct, budget, group_rows))
    rooted = distinct.join(found, distinct.fp == found.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labelled = cut(rooted.join(lowest, "root").select("fp", "component_id"), "labels")
    return marked.join(labelled, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, shingle: int = 5, budget: int = NEAR_BUDGET) -> DataFrame:
    """``docs`` with one document of each component, that with the smallest doc_id.

    The budget is wider than that of plain links: texts that share nine tenths of
    their five-word shingles differ in six bits on average, unrelated ones in 32.
    Repeated rows of the kept doc_id are all kept, as is a null doc_id.
    """
    lone = cut(components(docs, shingle, budget).where("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct(), "copies")
    rows = docs.select(whole_row(docs).alias("row"))
    # Beyond what may be broadcast, documents are shuffled to the ids that go.
    return rows.join(maybe_broadcast(lone), F.col("row.doc_id").cast("long") == F.col("gone"), "left_anti").select(*(F.col(f"row.`{c}`") for c in docs.columns))
