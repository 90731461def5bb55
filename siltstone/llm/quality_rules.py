"""Quality rules: repetition and length rules, then distribution divergence.

Every document gets a histogram of character classes and one of its language's
common words.  Both are held against those of all of the language's documents that pass
the base rules and have few symbols and capitals, by Jensen-Shannon distance (base 2, 0 to 1).  A document
is rejected if a distance is over its threshold; the common words only count in
documents of ``min_words`` words or more, as a short text holds few of them.

All of it is SQL functions.  Null text is the empty text.  A document without
words has no histogram, and fails the base rules.  A null language is a language
of its own; one without a list of common words is judged by characters alone.
If no document of a language passes the base rules there is no reference and the
base rules alone decide.  Repeated rows are judged each; extra columns of the
input, of any name, are kept by ``kept_documents``; ``measure`` and ``judge`` keep
those that do not begin with an underscore.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import GAP, WORD, cut, let, whole_row

MIN_WORDS = 20
REPEAT_PERCENT = 30
#: References are of documents with at most such shares of symbols and capitals, in percent of characters.
SYMBOL_PERCENT = 1
UPPER_PERCENT = 20
WINDOW = 8
#: Largest distances of kept documents, and words from which common words count.
CHAR_DISTANCE = 0.19
COMMON_DISTANCE = 0.35
COMMON_MIN_WORDS = 60
#: References of up to so many languages are broadcast.
LANGUAGES = 4096

# Character classes, counted in this order; the rest is the last class.
CLASSES = {
    "symbol": r"[#*$%&|<>]",
    "upper": r"[A-ZÀ-ÖØ-Þ]",
    "exclaim": r"!",
    "mark": r"[.,;:?'()-]",
}
# Common words of each language.
COMMON = {
    "en": "the of and to in is that it for on as with",
    "fr": "de la le et les des en un du une que est",
    "de": "der die und in den von zu das mit des ist ein",
    "es": "de la que el en y los se del las un por",
}
COMMON_COUNT = 12

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
CHARS = [*CLASSES, "space", "other"]
COMMONS = [f"common_{k}" for k in range(COMMON_COUNT)] + ["common_other"]


def repeat_words(words: Column) -> Column:
    """How many words lie in windows of eight words that the text holds twice or more.

    Windows are compared by XXH64.  The starts of those that have an equal are
    sorted; each covers eight words, or as many as there are up to the next start.
    """
    starts = F.when(F.size(words) >= WINDOW, F.sequence(F.lit(1), F.size(words) - (WINDOW - 1))).otherwise(F.array().cast("array<int>"))
    keys = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, WINDOW)))

    def covered(at: Column) -> Column:
        """Of sorted starts: the words they cover."""
        following = F.concat(F.slice(at, 2, F.greatest(F.size(at) - 1, F.lit(0))), F.array(F.element_at(at, -1) + WINDOW))
        return F.when(F.size(at) == 0, F.lit(0)).otherwise(F.aggregate(F.zip_with(at, following, lambda a, b: F.least(b - a, F.lit(WINDOW))), F.lit(0), lambda x, y: x + y))

    def equal_starts(order: Column) -> Column:
        """Of (key, start) pairs in order: starts of those whose neighbour has the same key."""
        n = F.size(order)
        nothing = F.array(F.lit(None).cast("struct<key:bigint,at:int>"))
        before, after = F.concat(nothing, F.slice(order, 1, n - 1)), F.concat(F.slice(order, 2, n - 1), nothing)
        both = F.zip_with(F.zip_with(order, before, lambda x, y: F.struct(x["key"].alias("key"), x["at"].alias("at"), x["key"].eqNullSafe(y["key"]).alias("eq"))), after, lambda x, y: F.when(x["eq"] | x["key"].eqNullSafe(y["key"]), x["at"]))
        return F.array_sort(F.array_compact(both))

    def count(hashes: Column) -> Column:
        order = F.array_sort(F.zip_with(hashes, F.sequence(F.lit(1), F.size(hashes)), lambda h, i: F.struct(h.alias("key"), i.alias("at"))))
        found = let(order, lambda o: let(equal_starts(o), covered))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(found)

    return let(keys, count)


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` with their measures in a struct ``_quality``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    without = lambda pattern: F.length(F.regexp_replace(text, pattern, ""))
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(""))

    def only(words: Column, found: list[str]) -> Column:
        return F.filter(F.transform(words, F.lower), lambda w: w.isin(found))

    def of_words(words: Column) -> Column:
        lists = F.array().cast("array<string>")
        known = F.array().cast("array<string>")
        for name, found in COMMON.items():
            own = F.array(*map(F.lit, found.split()))
            lists = F.when(lang == name, own).otherwise(lists)
            known = F.when(lang == name, only(words, found.split())).otherwise(known)
        counts = let(known, lambda k: F.concat(F.transform(lists, lambda c: F.size(F.filter(k, lambda w: w == c))), F.array(F.size(k))))
        return F.struct(F.size(words).cast("long").alias("n_words"), repeat_words(words).cast("long").alias("n_repeat_words"), counts.alias("common"))

    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    words = F.filter(F.split(text, GAP), lambda w: w != "")
    measures = F.struct(
        lang.alias("lang"),
        let(words, of_words).alias("words"),
        without(GAP).cast("long").alias("word_chars"),
        (F.length(text) - without(CLASSES["symbol"])).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.length(text).cast("long").alias("n_chars"),
        *((F.length(text) - without(CLASSES[c])).cast("long").alias(c) for c in list(CLASSES)[1:]),
    )
    # A generator's output is evaluated once, however many expressions mention it.
    made = docs.select(*docs.columns, F.explode(F.array(measures)).alias("_measures"))
    kept = [c for c in BASE if c not in ("n_words", "n_repeat_words")]
    flat = [F.col("_measures.words.n_words").alias("n_words"), *(F.col(f"_measures.{c}").alias(c) for c in ["lang", "n_chars", *kept, *list(CLASSES)[1:]])]
    flat += [F.col("_measures.words.n_repeat_words").alias("n_repeat_words"), F.col("_measures.words.common").alias("common")]
    return made.select(*docs.columns, F.struct(*flat).alias("_quality"))


def base_failed(q: str = "_quality") -> Column:
    n = F.col(f"{q}.n_words")
    return (n < MIN_WORDS) | (F.col(f"{q}.n_repeat_words") * 100 > n * REPEAT_PERCENT)


def histograms(measured: DataFrame) -> DataFrame:
    """``measured`` with both histograms, arrays of counts in the order of CHARS and COMMONS."""
    q = lambda name: F.col(f"_quality.{name}")
    counted = [q("n_symbols"), *(q(c) for c in list(CLASSES)[1:])]
    chars = F.array(*counted, q("n_chars") - q("word_chars"), q("word_chars") - sum(counted[1:], counted[0]))
    # An unknown language's list is empty, and so is its histogram.
    common = F.transform(q("common"), lambda n, k: F.when(k < F.size(q("common")) - 1, n.cast("long")).when(F.size(q("common")) > 1, q("n_words") - n).otherwise(F.lit(0).cast("long")))
    common = F.concat(common, F.array_repeat(F.lit(0).cast("long"), F.greatest(F.lit(len(COMMONS)) - F.size(q("common")), F.lit(0))))
    return measured.withColumn("_chars", chars).withColumn("_commons", common)


def distance(own: str, ref: str) -> Column:
    """Jensen-Shannon distance of two histograms; null if one of them is empty or missing."""

    def shares(name: str) -> Column:
        total = F.aggregate(F.col(name), F.lit(0).cast("long"), lambda x, y: x + y)
        return let(F.when(total > 0, total), lambda n: F.transform(F.col(name), lambda x: x / n))

    def term(p: Column, q: Column) -> Column:
        m = (p + q) / 2
        return F.when(p > 0, p * F.log2(p / m) / 2).when(p.isNotNull(), 0.0) + F.when(q > 0, q * F.log2(q / m) / 2).when(q.isNotNull(), 0.0)

    total = F.aggregate(F.zip_with(shares(own), shares(ref), term), F.lit(0.0), lambda x, y: x + y)
    return F.sqrt(F.greatest(total, F.when(total.isNotNull(), F.lit(0.0))))


def references(histogram: DataFrame) -> DataFrame:
    """Sums of the histograms over each language's documents of prose: they pass the base rules with few symbols and capitals."""
    capitals, symbols, n = F.col("_quality.upper"), F.col("_quality.n_symbols"), F.col("_quality.n_chars")
    prose = (symbols * 100 <= n * SYMBOL_PERCENT) & (capitals * 100 <= n * UPPER_PERCENT)
    sums = lambda name, of: F.array(*(F.sum(F.get(name, F.lit(k))) for k in range(len(of))))
    return histogram.where(~base_failed() & prose).groupBy(F.col("_quality.lang").alias("_lang")).agg(sums("_chars", CHARS).alias("_ref_chars"), sums("_commons", COMMONS).alias("_ref_commons"))


def judge(measured: DataFrame, refs: DataFrame) -> DataFrame:
    """``measured`` with ``_base_failed``, ``_kept`` and both distances."""
    held = histograms(measured)
    small = refs.count() <= LANGUAGES
    joined = held.join(F.broadcast(refs) if small else refs, F.col("_quality.lang") == F.col("_lang"), "left")
    joined = joined.withColumn("_base_failed", base_failed()).withColumn("_char_distance", distance("_chars", "_ref_chars")).withColumn("_common_distance", distance("_commons", "_ref_commons"))
    odd_chars = F.coalesce(F.col("_char_distance") > CHAR_DISTANCE, F.lit(False))
    odd_words = F.coalesce((F.col("_common_distance") > COMMON_DISTANCE) & (F.col("_quality.n_words") >= COMMON_MIN_WORDS), F.lit(False))
    joined = joined.withColumn("_kept", ~F.col("_base_failed") & ~odd_chars & ~odd_words)
    return joined.drop("_chars", "_commons", "_ref_chars", "_ref_commons", "_lang")


def verdicts(docs: DataFrame) -> DataFrame:
    """doc_id, the base measures, base_failed, kept and both distances.

    Texts are measured once; their measures are kept as a table, without the texts.
    """
    measured = cut(measure(docs.select("doc_id", "text", "lang")).select("doc_id", "_quality"), "measures")
    judged = judge(measured, cut(references(histograms(measured)), "references"))
    base = [F.col(f"_quality.{c}").alias(c) for c in BASE]
    return judged.select("doc_id", *base, F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"), F.col("_char_distance").alias("char_distance"), F.col("_common_distance").alias("common_distance"))


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with columns of any name.

    Rows are written with their measures, so that texts are measured once.
    """
    rows = docs.select(whole_row(docs).alias("row"), "text", "lang")
    measured = cut(measure(rows).select("row", "_quality"), "measured-rows")
    kept = judge(measured, cut(references(histograms(measured.select("_quality"))), "references")).where("_kept")
    return kept.select(*(F.col(f"row.`{c}`") for c in docs.columns))
