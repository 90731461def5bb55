"""Periodic runs of words, and texts without their repeats.

A run is a maximal stretch of words with smallest period q whose length is at least
``least`` words and ``times`` periods.  The suffix array of a text's words and the common
prefixes of neighbours in it give each position's longest previous factor (LPF),
from which the text is parsed in blocks: each is one new word or the longest
stretch that began before.  A run that holds a block's first word is found at
the last such block by Main's extensions: for each period, how far words equal
those a period away, to the left and right of the block's start.  A run inside
a block, after its first word, is a copy of one in the block's earlier occurrence,
and is taken from the bucket of that one's start.

Two facts save work without losing a run.  All of a run but its first period began
before, so a text with no stretch of ``least - least / times`` words twice has
none; and of the last block that begins in a run and the one before it, one is at
least half as long as that stretch.

Texts are worked on one by one, in tasks, in memory and time near their length: there is no
shuffle and nothing is gathered.  A row's text is never parted; it takes about 400
bytes a word.  Null and empty texts, and those of white space, have no words, no
runs, and collapse to the empty text.  Rows that repeat are given the same result each.  Ties
for the strongest run go to the smallest start, then the smallest period.  No
documents give no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST, TIMES = 24, 3


@dataclass(frozen=True)
class Limits:
    """A run has ``least`` words and ``times`` periods at least."""

    least: int = LEAST
    times: int = TIMES

    def __post_init__(self):
        if self.times < 2 or self.least < 1:
            raise ValueError("a run repeats its period at least twice")

    def length(self, period: int) -> int:
        return max(self.least, self.times * period)

    @property
    def echo(self) -> int:
        """So many words of any run, after its first period, began before."""
        return max(1, min(self.length(q) - q for q in range(1, self.least + 1)))


def numbers(words: list[bytes]) -> np.ndarray:
    """Each word as the number of its first occurrence's rank."""
    known: dict[bytes, int] = {}
    return np.array([known.setdefault(w, len(known)) for w in words], np.int64)


def repeats(ids: np.ndarray, size: int) -> bool:
    """Whether some stretch of ``size`` words may stand twice: certain if not, by 64-bit polynomials."""
    if len(ids) <= size:
        return False
    value, width, factor = ids.astype(np.uint64) + np.uint64(1), 1, np.uint64(0x9E3779B97F4A7C15)
    while width < size:
        step = min(width, size - width)  # at last, two that overlap cover it
        value = value[:-step] * factor + (value[step:] ^ (value[step:] >> np.uint64(29)))
        width += step
    value.sort()
    return bool((value[1:] == value[:-1]).any())


def suffix_array(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes in order, and each one's common prefix with the one before, by doubling."""
    n = len(ids)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    levels, width = [rank], 1
    while True:
        follows = np.zeros(n, np.int64)
        follows[: n - width] = rank[width:] + 1
        pair = rank * (n + 1) + follows
        order = np.argsort(pair, kind="stable")
        fresh = np.concatenate([[0], np.cumsum(pair[order][1:] != pair[order][:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1:
            break
        levels.append(rank)
        width *= 2
        if width >= n:
            break
    # Neighbours' common prefixes: by powers of two, from the largest, while both agree.
    a, b, common = order[:-1].copy(), order[1:].copy(), np.zeros(max(0, n - 1), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = np.flatnonzero((a + (1 << k) <= n) & (b + (1 << k) <= n))
        equal = inside[levels[k][a[inside]] == levels[k][b[inside]]]
        common[equal] += 1 << k
        a[equal] += 1 << k
        b[equal] += 1 << k
    # A stretch can agree twice in a power where it ended at the text's end before; what is left is under one.
    return order, np.concatenate([[0], common])


def previous_factors(order: np.ndarray, common: np.ndarray) -> tuple[list[int], list[int]]:
    """LPF: for each position the longest stretch from it that began before, and where."""
    n = len(order)
    longest, source = [0] * n, [-1] * n
    stack: list[tuple[int, int]] = []  # positions rising, each with its common prefix with the one below
    for at, shared in [*zip(order.tolist(), common.tolist(), strict=True), (-1, 0)]:
        while stack and stack[-1][0] > at:
            top, below = stack.pop()
            # Its nearest earlier positions in suffix order are the one below and this one.
            if below >= shared:
                longest[top], source[top] = below, stack[-1][0] if below else -1
            else:
                longest[top], source[top] = shared, at
            shared = min(shared, below)
        stack.append((at, shared if stack else 0))
    return longest, source


def blocks(longest: list[int]) -> list[int]:
    """Where the parse's blocks begin, and the end."""
    starts, at = [], 0
    while at < len(longest):
        starts.append(at)
        at += max(1, longest[at])
    return [*starts, len(longest)]


def prefixes(x: list[int]) -> list[int]:
    """Each position's common prefix with the whole (Z)."""
    n = len(x)
    z, low, high = [0] * n, 0, 0
    if n:
        z[0] = n
    for k in range(1, n):
        same = min(high - k, z[k - low]) if k < high else 0
        if k >= high or same == high - k:
            while k + same < n and x[same] == x[k + same]:
                same += 1
            low, high = k, k + same
        z[k] = same
    return z


def crossing(x: list[int], start: int, end: int, reach: int, limits: Limits) -> dict[tuple[int, int], int]:
    """Runs that hold ``start``, end before ``end`` and lie within ``reach`` words before: (first, last) -> period.

    ``end`` is that of the block from ``start``; a run that goes on beyond it is left to a later block.
    """
    left, right = x[max(0, start - reach) : start], x[start:end]
    m, t = len(right), len(left)
    found: dict[tuple[int, int], int] = {}

    def add(before: int, after: int, period: int, anchor: int) -> None:
        """Words equal those a period before: ``before`` of them up to ``anchor``, and ``after`` from it."""
        length = before + period + after
        if length < limits.length(period):
            return
        first, last = anchor - before - period, anchor + after - 1
        while first > 0 and x[first - 1] == x[first - 1 + period]:  # where the reach ended
            first -= 1
        if first <= start <= last < end and (last + 1 >= len(x) or x[last + 1] != x[last + 1 - period]):
            key = (first, last)
            found[key] = min(period, found.get(key, period))

    own = prefixes(right)
    back = left[::-1]
    from_left = prefixes([*right, -1, *left, *right])  # right against each suffix of left and right
    from_right = prefixes([*back, -1, *right[::-1], *back])  # left, backwards, against each prefix of both
    left_own = prefixes(back)
    for p in range(1, m):  # the anchor is start + p
        add(from_right[t + 1 + m - p] if t else 0, own[p], p, start + p)
    for p in range(1, t + 1):  # the anchor is start
        add(left_own[p] if p < t else 0, min(from_left[m + 1 + t - p], m), p, start)
    return found


def runs(ids: np.ndarray, limits: Limits = Limits()) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and then period."""
    if not repeats(ids, limits.echo):
        return []
    longest, source = previous_factors(*suffix_array(ids))
    if max(longest) < limits.echo:
        return []
    x, starts = ids.tolist(), blocks(longest)
    buckets: dict[int, list[tuple[int, int]]] = {}  # by first word: (last word, period)
    firsts: list[int] = []

    def keep(first: int, last: int, period: int) -> None:
        if first not in buckets:
            buckets[first] = []
            insort(firsts, first)
        if (last, period) not in buckets[first]:
            buckets[first].append((last, period))

    before = 0
    for start, end in zip(starts, starts[1:], strict=False):
        size = end - start
        if max(before, size) >= limits.echo // 2:
            for (first, last), period in crossing(x, start, end, 2 * before + size, limits).items():
                keep(first, last, period)
        if size >= limits.least and source[start] >= 0:
            step = start - source[start]
            at = bisect_right(firsts, source[start])
            while at < len(firsts) and firsts[at] + step < end:  # copies of copies come as they are made
                for last, period in buckets[firsts[at]]:
                    first, last = firsts[at] + step, min(last + step, end - 1)
                    if last - first + 1 >= limits.length(period) and (last + 1 >= len(x) or x[last + 1] != x[last + 1 - period]):
                        keep(first, last, period)
                at += 1
        before = size
    return sorted((first, last - first + 1, period) for first, ends in buckets.items() for last, period in ends)


def strongest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    best = None
    for run in found:  # by start, then period: the first of equals stays
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """``words`` without what any run repeats after its first period."""
    if not found:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in found:
        keep[start + period : start + length] = False
    return [words[k] for k in np.flatnonzero(keep)]


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words that runs are looked for in: in one of ten documents the tail repeats a period that the id gives."""
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


RESULT = "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"


def detected(docs: DataFrame, change=None, limits: Limits = Limits()) -> DataFrame:
    """Each document's words and runs, its strongest run (or nulls), and the text without repeats.

    ``change(words, doc_id)`` gives the words to look in, if they are not the text's own.
    """
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_words", "n_runs", "start", "length", "period", "exponent_milli")), ("runs", pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))), ("collapsed", pa.binary())])

    def row(doc: int | None, text: bytes) -> tuple:
        words = text.split()  # of bytes: white space is the space and 9 to 13
        if change is not None:
            words = change(words, doc)
        found = runs(numbers(words), limits)
        best = strongest(found)
        top = (*best, best[1] * 1000 // best[2]) if best else (None,) * 4
        return (doc, len(words), len(found), *top, [dict(zip(("start", "length", "period"), r, strict=True)) for r in found], b" ".join(collapsed(words, found)))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):  # texts without repeats are as long as they were
                ids, texts = batch.column("doc_id").slice(at, 64).to_pylist(), batch.column("text").slice(at, 64).to_pylist()
                rows = [row(i, t or b"") for i, t in zip(ids, texts, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    lean = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return lean.mapInArrow(made, RESULT)


def digests(found: DataFrame) -> DataFrame:
    """``detected`` with the runs and the collapsed text as SHA-256."""
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
