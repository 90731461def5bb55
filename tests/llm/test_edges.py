"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator and stage."""

from functools import reduce

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from siltstone.llm.common import is_few, shared_dir
from siltstone.llm import line_dedup, media, mixing, packing, pu_quality, quality_rules, queries, simhash, toxicity, transcripts, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{k % 977}" for k in range(60_000))
ROWS = [
    (1, "the cat of the house and the dog in the garden to be that it is for on as with them all and so on", "en", "a"),
    (1, "the cat of the house and the dog in the garden to be that it is for on as with them all and so on", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, LONG, "fr", "b"),
    (5, "  \t\n \x0b ", "xx", "b"),
    (None, "a row without an id but with some words in it", "en", "a"),
    (7, "same tie", "en", "a"),
    (8, "same tie", "en", "a"),
    (9, "naïve Ünï çödé \U0001f600 text", "de", "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, len(r[1] or "")) for r in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, k % 2, (k + 1) % 2) for k in range(20)], "doc_id long, quality int, toxic int")


def clashing(df):
    """``df`` with columns named like those that operators make."""
    for name in ("length", "slot", "block", "rank", "fp", "key", "token", "place", "n", "count", "_quality_x", "score", "held_out", "weight", "_id", "_doc", "_source", "_quality", "_bucket", "_rank", "_kept", "_gone", "_removed", "row", "doc", "version", "removed", "gone", "matched", "line", "first", "_digest", "_block", "_slot", "_measures", "sequence_id", "offset", "piece", "start"):
        df = df.withColumn(name, F.lit("clash"))
    return df


OPERATORS = {
    "media": lambda d, ls: media.read_media(media.store_media(d)),
    "toxicity": lambda d, ls: toxicity.classify(d, ls),
    "quality_rules": lambda d, ls: quality_rules.verdicts(d),
    "packing": lambda d, ls: packing.pack_documents(d, *queries.tokenizer_paths()).where("piece = 0"),
    "simhash": lambda d, ls: simhash.components(d),
    "pu_quality": lambda d, ls: pu_quality.classify(d, ls),
    "mixing": lambda d, ls: mixing.mix(d, queries.MIX_WEIGHTS),
    "kept": lambda d, ls: quality_rules.kept_documents(d),
    "dedup": lambda d, ls: line_dedup.dedup_lines(d),
}
ALL_ROWS = set(OPERATORS) - {"kept"}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows(docs, labels, name):
    plain = sorted(map(repr, OPERATORS[name](docs, labels).drop("n_chars").collect()))
    if name in ALL_ROWS:
        assert len(plain) == len(ROWS)
    wide = OPERATORS[name](clashing(docs), labels)
    assert wide.count() == len(plain)


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_tables(docs, labels, name):
    assert OPERATORS[name](docs.limit(0), labels.limit(0)).count() == 0
    assert OPERATORS[name](docs, labels.limit(0)).count() >= 0


@pytest.mark.parametrize("name", [s for s, _ in corpus_pipeline.STAGES])
def test_stages(spark, docs, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, docs, "")
    if name != corpus_pipeline.STAGES[-1][0]:
        assert out.columns == docs.columns
    assert out.count() >= 0
    assert stage(spark, docs.limit(0), "").count() == 0
    if name in ("lines", "mixture"):
        assert out.count() == docs.count()
    if name != corpus_pipeline.STAGES[-1][0]:
        assert stage(spark, clashing(docs), "").columns == clashing(docs).columns


def test_clashing_columns_keep_their_values(spark, docs):
    for name in ("quality", "lines", "near_copies", "mixture"):
        out = dict(corpus_pipeline.STAGES)[name](spark, clashing(docs), "")
        made = [c for c in out.columns if c not in docs.columns]
        assert made and out.where(" OR ".join(f"`{c}` <> 'clash'" for c in made)).count() == 0


def test_texts_of_one_id_are_kept_apart(spark):
    rows = [(0, "a b c d e f"), (1, "a b c d e f"), (1, "quite other words that stand nowhere else"), (None, "null one two three"), (None, "a b c d e f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = sorted(str(r["text"]) for r in line_dedup.dedup_lines(docs).collect())
    assert out == ["", "", "a b c d e f", "null one two three", "quite other words that stand nowhere else"]


def test_short_copies_go(spark):
    docs = spark.createDataFrame([(k, "Share on Facebook now\nown" + str(k)) for k in range(5)], "doc_id long, text string")
    assert sum("Share" in r["text"] for r in line_dedup.dedup_lines(docs).collect()) == 1


def test_lists_of_any_length_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT_LIST", 5)
    monkeypatch.setattr(line_dedup.matched_places, "__defaults__", (5,))
    from tests.llm.test_operators import check_lines

    by = {d: [f"common words of all {d % 9} {d % 7} {d % 5}", f"common words of all and {d}"] for d in range(60)}
    check_lines(spark.createDataFrame([(d, "\n".join(x)) for d, x in by.items()], "doc_id long, text string"), by)


def test_words_are_not_counted_before_lines_are_compared(spark, monkeypatch):
    split, calls = line_dedup.words_of, []
    monkeypatch.setattr(line_dedup, "words_of", lambda text: calls.append(text) or split(text))
    docs = spark.createDataFrame([(1, "a b c d extraordinary"), (2, "a b c d extraordinary\na b c e extraordinary f")], "doc_id long, text string")
    assert {r["doc"]: r["removed"] for r in line_dedup.removed_lines(docs).collect()} == {1: [], 2: [0]}
    assert len(calls) == 2  # for the tokens, and for sets too small to be joined


def test_crowded_tokens_come_last(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT_LIST", 5)
    by = {d: [" ".join(["extraordinarily", *(f"w{d % 11}{k}" for k in range(9)), f"v{d}"][: 6 + d % 5]), " ".join([*(f"long{d}{k}" for k in range(70)), "extraordinarily"])] for d in range(40)}
    by |= {d: [" ".join(w for k, w in enumerate(by[d - 40][1].split()) if k % (8 + d % 4))] for d in range(40, 80)}
    docs = spark.createDataFrame([(d, "\n".join(x)) for d, x in by.items()], "doc_id long, text string")
    seen, whole = [], line_dedup.uncrowded
    monkeypatch.setattr(line_dedup, "uncrowded", lambda different, *rest: seen.append((different, whole(different, *rest), rest[2])) or seen[-1][1])
    from tests.llm.test_operators import check_lines

    check_lines(docs, by)
    before, after, crowded = seen[0][0], *seen[-1][1:]
    bits = ["place", "n", "bits0", "bits1"]
    assert sorted(map(tuple, before.select(*bits).collect())) == sorted(map(tuple, after.select(*bits).collect()))
    held = lambda rows: sum(t & 65535 in crowded for r in rows.collect() for t in r["prefix"])
    assert held(after) * 2 < held(before) and {len(r["prefix"]) for r in after.collect()} == {len(r["prefix"]) for r in before.collect()}


def test_tokens_are_made_by_projections(spark, monkeypatch):
    """Generators are interpreted, projections are compiled; a table's rows are counted once."""
    plans, whole, counted, count = {}, line_dedup.cut, [], type(spark.range(1)).count
    monkeypatch.setattr(line_dedup, "cut", lambda df, name: plans.setdefault(name, df._jdf.queryExecution().optimizedPlan().toString()) and whole(df, name))
    docs = spark.createDataFrame([(1, "a b c d extraordinary"), (2, "a b c d extraordinary\na b c e extraordinary f")], "doc_id long, text string")
    assert {r["doc"]: r["removed"] for r in line_dedup.removed_lines(docs).collect()} == {1: [], 2: [0]}
    assert plans["different-lines"].count("Generate ") == 1  # the lines of texts
    rows = spark.range(3)
    monkeypatch.setattr(type(rows), "count", lambda df: counted.append(df) or count(df))
    assert is_few(rows) and is_few(rows) and len(counted) == 1


def test_parity_of_few_and_many_tokens(spark):
    sets = {n: sorted((8 if k % 3 else 3) << 56 | (k * k * 7919 + 31 * k) for k in range(n)) for n in (1, 2, 63, 64, 65, 130)}
    rows = spark.createDataFrame(list(sets.items()), "n int, tokens array<long>")
    found = {r["n"]: (r["bits0"], r["bits1"]) for r in rows.select("n", *line_dedup.parity(F.col("tokens"), F.col("n"))).collect()}
    bits = lambda some: reduce(lambda x, t: x ^ 1 << (t & 63), some, 0)
    signed = lambda x: x - (1 << 64) * (x >> 63)
    parts = {n: ([t for t in ts if n <= 64 or t >> 56 < 6], [t for t in ts if n > 64 and t >> 56 >= 6]) for n, ts in sets.items()}
    assert found == {n: tuple(signed(bits(x)) for x in both) for n, both in parts.items()}


def test_pairs_of_several_groups_in_one_list_are_few(spark, monkeypatch):
    """Groups of near copies that share their first tokens: neither list's first lines settle them all."""
    shared = [f"sharedbyallgroups{k}" for k in range(10)]
    by = {d: [" ".join([*shared, *(f"g{d % 6}w{k}" for k in range(29)), f"u{d}"])] for d in range(360)}
    docs = spark.createDataFrame([(d, x[0]) for d, x in by.items()], "doc_id long, text string")
    seen, whole = [], line_dedup.verified
    monkeypatch.setattr(line_dedup, "verified", lambda pairs, *rest: seen.append(pairs.distinct().count()) or whole(pairs, *rest))
    assert {r["doc"]: r["removed"] for r in line_dedup.removed_lines(docs).collect()} == {d: [0] * (d >= 6) for d in by}
    assert sum(seen) < 5000, seen  # 7198 with two leaders a list and no pivots


def test_stages_leave_only_what_their_rows_are_read_from(spark, docs):
    from pathlib import Path

    shared = Path(shared_dir(spark).removeprefix("file://"))
    for name, left in (("lines", "removed-lines"), ("near_copies", "gone")):
        before = set(shared.iterdir())
        out = dict(corpus_pipeline.STAGES)[name](spark, docs, "")
        assert [x.name.rsplit("-", 1)[0] for x in set(shared.iterdir()) - before if x.is_dir()] == [left]
        assert out.count()


def test_line_dedup_of_odd_rows(docs):
    found = {r["doc"]: r["removed"] for r in line_dedup.removed_lines(docs).collect()}
    assert found[1] == [] and found[2] == [] and set(found) == {1, 2, 3, 4, 5, 7, 8, 9, None}


def test_odd_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.example/x", "same"), (2, "http://a.example/x", "same"), (2, "http://a.example/x", "same"), (3, None, None), (4, "\r\nbad url [", ""), (None, "u", "same"), (5, "u", LONG)], "page_id long, url string, html string")
    rows = warc.archive_pages(pages.withColumn("offset", F.lit("clash")), archive_bytes=200)
    got = sorted((str(r["page_id"]), r["record_type"], r["refers_to"], r["payload_bytes"]) for r in rows.collect())
    assert got == sorted([("1", "response", None, 4), ("2", "revisit", 1, 4), ("2", "revisit", 1, 4), ("3", "response", None, 0), ("4", "revisit", 3, 0), ("None", "response", None, 4), ("5", "response", None, len(LONG))])
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_odd_transcripts(spark):
    turns = spark.createDataFrame([(1, 0, "user", "hi?"), (1, 0, "user", "hi?"), (1, None, None, None), (None, 3, "assistant", ""), (2, 1, "system", "x\n" * 5000)], "conv_id long, turn long, role string, text string")
    rows = transcripts.parse(transcripts.raw_transcripts(turns.withColumn("seq", F.lit(1))))
    assert rows.count() == 5 and rows.where("role IS NULL").count() == 0
    assert transcripts.parse(transcripts.raw_transcripts(turns.limit(0))).count() == 0
