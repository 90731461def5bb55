"""The filter audit against a plain walk over all orders."""

from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from siltstone.llm import filter_audit, queries
from tests.helpers import same


def test_equals_its_sql(spark):
    same(spark, queries.op11_filter_audit, queries.oracle_sql()["op11_filter_audit"])


def failures(text, doc, firsts):
    text = text or ""
    words = text.replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ")
    words = [w for w in words if w]
    last = filter_audit.LAST
    return "".join(
        name
        for name, fails in zip(
            "ABCDE",
            (
                len(words) < 50,
                100 * len(set(words)) < 65 * len(words),
                100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
                any(c in "#$%&*|" for c in text),
                (last if doc is None else doc) > firsts[text],
            ),
            strict=True,
        )
        if fails
    )


def walked(docs, labels):
    """Rows by brute force: each document through each order."""
    firsts, last = {}, filter_audit.LAST
    for doc, text, _ in docs:
        firsts[text or ""] = min(firsts.get(text or "", last), last if doc is None else doc)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    found = [(source or "", failures(text, doc, firsts), doc in good, doc in toxic) for doc, text, source in docs]
    parts, rows, values = {p for p, *_ in found}, {}, Counter()
    for part in parts:
        for order in map("".join, permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                before = set(order[: step - 1])
                own = [(set(m), g, t) for p, m, g, t in found if p == part]
                gone = [x for x in own if f in x[0] and not before & x[0]]
                values[part, f] += len(gone)
                rows[part, order, step] = [
                    sum(not (before | {f}) & m for m, _, _ in own),
                    len(gone),
                    sum(f in m and bool(before & m) for m, _, _ in own),
                    sum(m == {f} for m, _, _ in own),
                    sum(g for _, g, _ in gone),
                    sum(t for _, _, t in gone),
                ]
    return {k: (*v, values[k[0], k[1][k[2] - 1]]) for k, v in rows.items()}


@pytest.mark.parametrize("parts", [1, 7])
def test_copies_over_many_partitions_nulls_ties_and_clashing_columns(spark, parts):
    plain = " ".join(f"word{k}" for k in range(60))
    docs = [(k, plain, "hot") for k in range(200, 80, -1)]  # one text in most rows
    docs += [(5, "A B", None), (5, "A B", None), (5, "A B", "x"), (4, None, "x"), (9, "", "x"), (None, "", "x"), (None, "only", "x"), (None, "only", "x")]
    docs += [(300, "x " * 5000, "long"), (301, plain + " #", "long"), (302, "É" * 40 + "ABC", "long"), (303, "a\x0bb\x0cc\td\re", "long"), (7, "other", "hot"), (7, "another", "hot")]
    labels = [(5, 1, 0), (5, 0, 1), (100, 1, None), (None, 1, 1), (302, None, 1)]
    table = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumns({c: F.lit("other") for c in ("part", "mask", "fp", "good", "n", "waits")})
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumns({c: F.lit("other") for c in ("good", "part", "n")})
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = filter_audit.interactions(table.repartition(3), marks).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"], r["toxic_lost"], r["shapley"]) for r in rows}
    assert len(rows) == len(got) and got == walked(docs, labels)


def test_equal_fingerprints_of_other_texts_are_told_apart():
    """One partition's rows with one fingerprint: only equal texts are duplicates, in whatever batches they come."""
    import pyarrow as pa

    rows = [(1, 3, "s", b"a"), (1, 4, "s", b"a"), (1, 2, "s", b"b"), (1, 9, "s", b"b"), (2, 1, "s", b"a"), (2, 5, "s", b"a")]
    whole = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["fp", "doc_id", "part", "text"])
    for size in (1, 2, 6):
        out = [r for b in filter_audit._compared(iter([whole.slice(k, size) for k in range(0, 6, size)])) for r in b.to_pylist()]
        seen = [r for r in out if not r["holds"]]
        assert [bool(r["mask"] & filter_audit.DUPLICATE) for r in seen] == [False, True, False, True, False, True]
        assert [r["waits"] for r in seen] == [True, False, True, False, False, False]
        assert [(r["fp"], r["doc_id"]) for r in out if r["holds"]] == [(2, 1)]


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], "doc_id long, text string, source string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.interactions(docs, labels).count() == 0
    one = spark.createDataFrame([(1, "a", "s")], docs.schema)
    assert filter_audit.interactions(one, labels).count() == 600
