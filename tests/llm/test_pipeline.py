"""Stages of the pipeline against plainer versions of the same."""

import random

import corpus_pipeline
from siltstone.llm import line_dedup, oracles, queries, shingle_sets
from tests.helpers import SF, connection
from tests.llm.test_operators import SF_MORE, layout


def plain_kept(rows):
    """Of (doc_id, text) rows with different ids, the first of each component, by all pairs."""
    grams = {}
    for d, text in rows:
        w = (text or "").encode().lower().split()
        grams[d] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {d: d for d in grams}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    of = {}
    for d, g in grams.items():
        for x in g or {None}:
            of.setdefault(x, []).append(d)
    near = {(a, b) for found in of.values() for a in found for b in found if a < b}
    for a, b in near:
        shared = len(grams[a] & grams[b])
        if shared * 9 >= 4 * (len(grams[a]) + len(grams[b])):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {d for d in root if find(d) == d}


def test_near_copies_equal_brute_force(spark):
    rng = random.Random(11)
    words = [f"w{k}" for k in range(3000)]
    texts = [None, "", " \n", "Same tie", "same  tie", "other tie", "a b c d e", "a b c d e f"]
    for n in (12, 40, 250):
        for _ in range(12):
            base = rng.choices(words, k=n)
            for c in range(8):  # from one changed word to under four fifths in common, and chains of them
                texts.append(" ".join(base))
                for _ in range(rng.randint(0, 1 + n // 60)):
                    base[rng.randrange(n)] = rng.choice(words)
                if c % 3 == 2:
                    base = base[rng.randint(0, n // 10) :] + rng.choices(words, k=rng.randint(0, n // 10))
                    n = len(base)
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = [r["doc_id"] for r in shingle_sets.keep_first(docs).collect()]
    assert set(out) == plain_kept(rows) and len(out) == len(set(out))


def test_texts_of_one_id_go_or_stay_by_themselves(spark):
    copy, other = "a text that stands in two documents and is all alike", "this text stands nowhere else at all so it must stay"
    rows = [(1, copy), (5, copy), (5, other), (5, other), (None, copy), (7, None), (7, "one text of seven that has no copy"), (3, ""), (9, " \n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = sorted(((r["doc_id"], r["text"]) for r in shingle_sets.keep_first(docs).collect()), key=repr)
    assert kept == sorted([(1, copy), (5, other), (5, other), (None, copy), (7, "one text of seven that has no copy"), (3, "")], key=repr)


def test_a_shingle_in_every_document(spark):
    """All documents share a passage that is rarest in none or all of them; lists are compared in blocks."""
    rng = random.Random(4)
    passage = " ".join(f"p{k}" for k in range(12))
    rows = []
    for k in range(150):
        own = [f"w{rng.randrange(10_000)}" for _ in range(rng.choice([0, 1, 2, 3, 8, 30]))]
        rows.append((k, " ".join([passage, *own])))
    for k in range(150, 200):  # near copies of some
        words = rows[rng.randrange(150)][1].split()
        words[-1] = "changed"
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for hot_list in (7, 10_000):
        assert {r["doc_id"] for r in shingle_sets.keep_first(docs, hot_list).collect()} == plain_kept(rows)


def test_near_copies_of_documents(spark):
    docs = spark.read.parquet(f"{SF_MORE}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert {r["doc_id"] for r in shingle_sets.keep_first(docs).collect()} == plain_kept(rows)


def test_near_copies_are_found_by_fingerprints_first(spark, monkeypatch):
    """The trie self-join has most of the links; the lists are left what it misses, and the same documents stay without it."""
    rng = random.Random(9)
    words = [f"w{k}" for k in range(3000)]
    rows = []
    for k in range(60):
        base = rng.choices(words, k=400)
        rows.append((2 * k, " ".join(base)))
        base[rng.randrange(400)] = "changed"
        rows.append((2 * k + 1, " ".join(base)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    compared, plain = [], shingle_sets.verified
    monkeypatch.setattr(shingle_sets, "verified", lambda pairs, *rest: compared.append(plain(pairs, *rest)) or compared[-1])
    assert {r["doc_id"] for r in shingle_sets.keep_first(docs).collect()} == set(range(0, 120, 2)) == plain_kept(rows)
    found = [x.count() for x in compared]
    assert found[0] >= 54 and sum(found) == 60  # the fingerprints' links, those of the lists' leaders, the rest
    none = spark.createDataFrame([], "a long, b long")
    monkeypatch.setattr(shingle_sets, "near_fingerprints", lambda firsts: none)
    assert {r["doc_id"] for r in shingle_sets.keep_first(docs).collect()} == set(range(0, 120, 2))


def test_sequences_follow_the_weights(spark, monkeypatch):
    docs = spark.createDataFrame([(k, "word " * 1200, "en", f"src{k % 2}", 1) for k in range(768)], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    source = lambda r: f"src{r['doc_id'] % 2}"
    seen = {}
    for weights, want in (({"src0": 8, "src1": 4}, 256), ({"src0": 1, "src1": 1}, 192)):
        monkeypatch.setattr(queries, "MIX_WEIGHTS", weights)
        rows = sorted(corpus_pipeline.sequences(spark, corpus_pipeline.mixture(spark, docs, ""), "").collect(), key=lambda r: r["sequence_id"])
        assert [r["sequence_id"] for r in rows] == list(range(768)) and {r["doc_id"] for r in rows} == set(range(768))
        assert sum(source(r) == "src0" for r in rows[:384]) == want
        seen[want] = [r["doc_id"] for r in rows]
    assert seen[256] != seen[192]


def test_short_lines_equal_brute_force(spark):
    rng = random.Random(2)
    lines = ["Les.", "Les.  Les.", "a b", "b a", "a b a", "a c", "x", "X", "", " \t", "plumless buckeroo", "a\tb c"]
    by = {d: [rng.choice(lines) if rng.random() < 0.4 else " ".join(rng.choices("pqrstuvw", k=rng.randint(1, 7))) for _ in range(6)] for d in range(60)}
    earlier, want = [], {}
    for d in sorted(by):
        want[d] = []
        for k, line in enumerate(by[d]):
            w = set(line.split())
            if w:
                if any(len(w & x) * 9 >= 4 * (len(w) + len(x)) for x in earlier):
                    want[d].append(k)
                earlier.append(w)
    docs = spark.createDataFrame([(d, "\n".join(x)) for d, x in by.items()], "doc_id long, text string").repartition(3)
    assert {r["doc"]: r["removed"] for r in line_dedup.removed_lines(docs).collect()} == want
    kept = {d: "\n".join(line for k, line in enumerate(x) if k not in want[d]) for d, x in by.items()}
    assert {r["doc_id"]: r["text"] for r in corpus_pipeline.lines(spark, docs, "").collect()} == kept


def test_run_equals_a_plain_chain(spark):
    """Rules by SQL, lines and near-copies by brute force, tokens by the JSON tokenizer; leaving a stage out changes the rows."""
    from tokenizers import Tokenizer

    con = connection(SF)
    good = {r[0] for r in con.execute(f"SELECT doc_id FROM ({oracles.quality()}) WHERE kept").fetchall()}
    texts = {d: t for d, t in con.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall()}
    earlier, kept = [], {}
    for d in sorted(good):
        lines = []
        for line in texts[d].split("\n"):
            w = set(line.encode().split())
            if not w or not any(len(w & x) * 9 >= 4 * (len(w) + len(x)) for x in earlier):
                lines.append(line)
            if w:
                earlier.append(w)
        kept[d] = "\n".join(lines)
    want = plain_kept(list(kept.items()))
    assert want < good < set(texts) and any(kept[d] != texts[d] for d in want)
    rows = corpus_pipeline.run(spark, SF).collect()
    tokenizer = Tokenizer.from_file(queries.tokenizer_paths()[1])
    lengths = {}
    for r in rows:
        lengths[r["doc_id"]] = lengths.get(r["doc_id"], 0) + r["length"]
    assert lengths == {d: len(tokenizer.encode(kept[d], add_special_tokens=False).ids) + 1 for d in want}
    layout(rows, 2048)
