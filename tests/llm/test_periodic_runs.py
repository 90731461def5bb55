"""Runs of words against a comparison of all periods, and the parts they are found by."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltstone.llm import periodic_runs, queries
from siltstone.llm.periodic_runs import Limits
from tests.helpers import SF


def brute(x, limits=Limits()):
    """All runs by trying every period."""
    least = {}
    for q in range(1, len(x)):
        at = q
        while at < len(x):
            end = at
            while end < len(x) and x[end] == x[end - q]:
                end += 1
            if end > at and end - at + q >= limits.length(q):
                least.setdefault((at - q, end - 1), q)
            at = max(end, at + 1)
    return sorted((first, last - first + 1, q) for (first, last), q in least.items())


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**9), st.sampled_from([(24, 3), (1, 2), (4, 2), (6, 3), (3, 3), (20, 4)]))
def test_runs_equal_brute_force(seed, limits):
    rng, limits = random.Random(seed), Limits(*limits)
    x = [rng.randrange(rng.choice([1, 2, 3, 4, 20, 1000])) for _ in range(rng.randint(0, 120))]
    for _ in range(rng.randint(0, 4)):
        if len(x) > 4:
            a, e = sorted((rng.randrange(len(x)), rng.randint(1, len(x))))
            p = rng.randint(1, max(1, (e - a) // 2))
            for i in range(a, e):
                x[i] = x[a + (i - a) % p]
    if x and rng.random() < 0.4:  # runs inside copied stretches
        a = rng.randrange(len(x))
        x = x[:a] + x + x[a // 2 : a]
    assert periodic_runs.runs(np.array(x, np.int64), limits) == brute(x, limits)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60))
def test_suffix_array_and_previous_factors(x):
    order, common = periodic_runs.suffix_array(np.array(x))
    shared = lambda a, b: next((k for k in range(len(x)) if max(a, b) + k >= len(x) or x[a + k] != x[b + k]), len(x))
    assert order.tolist() == sorted(range(len(x)), key=lambda k: x[k:])
    assert common.tolist() == [0, *(shared(a, b) for a, b in zip(order, order[1:], strict=False))]
    longest, source = periodic_runs.previous_factors(order, common)
    assert longest == [max((shared(i, j) for j in range(i)), default=0) for i in range(len(x))]
    assert all(s < i and shared(i, s) == n for i, (n, s) in enumerate(zip(longest, source, strict=True)) if n)


def test_limits_are_exact():
    of = lambda n, q: periodic_runs.runs(np.arange(n) % q)
    assert of(23, 1) == of(23, 8) == of(26, 9) == []
    assert of(24, 8) == [(0, 24, 8)] and of(27, 9) == [(0, 27, 9)] and of(24, 1) == [(0, 24, 1)]
    with pytest.raises(ValueError):
        Limits(10, 1)


def expected(doc, text):
    """The contract's row, word by word."""
    words = [w for w in (text or "").translate({c: " " for c in range(9, 14)}).split(" ") if w]
    n, h = len(words), zlib.crc32(str(doc).encode())
    if doc is not None and n and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    found = brute(words)
    gone = {k for start, length, q in found for k in range(start + q, start + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc, len(found), *best, best[1] * 1000 // best[2] if found else None, digest("".join("%d,%d,%d\n" % r for r in found)), digest(" ".join(w for k, w in enumerate(words) if k not in gone)))


def test_query_equals_brute_force_on_whole_documents(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op13_periodic_runs(spark, SF).collect()
    assert len(rows) == len(docs) and sum(r["n_runs"] > 0 for r in rows) > len(docs) / 20
    short = [r for r in rows if len((docs[r["doc_id"]] or "").split()) < 1200]  # all periods take long in the others
    assert len(short) > len(rows) * 0.8
    for r in short:
        assert tuple(r) == expected(r["doc_id"], docs[r["doc_id"]])


def test_odd_rows(spark):
    long = " ".join(f"w{k % 7919}" for k in range(60_000))
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "a " * 24), (5, "a\x0bb\tc " * 8), (5, "a\x0bb\tc " * 8), (None, "x y " * 12), (6, "é é " * 30), (7, long), (8, "one"), (40, "w " * 100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("other") for c in ("runs", "start", "n_words", "length")})
    got = periodic_runs.digests(periodic_runs.detected(docs.repartition(3), periodic_runs.planted)).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(tuple(r))
    for doc, text in rows:
        if doc != 7:
            assert set(by[doc]) == {expected(doc, text)}
    assert len(by[5]) == 2 and by[7][0][1:6] == (1, 0, 60_000, 7919, 60_000 * 1000 // 7919)
    assert periodic_runs.detected(docs.where("false")).count() == 0
