"""Line deduplication by an exact set-similarity join.

A line's tokens are its different words.  A line is removed if an earlier line,
by doc_id and then line number, has a Jaccard similarity of at least 0.8 with it;
whether that one is itself removed does not matter.  Every line with a word takes
part.  Up to three different words only equal sets are as similar as asked; a
group-by on the set finds the first.

Equal lines are one to the join, represented by the first.  Tokens are ordered by
the length of their words, as longer words are rarer; tokens that crowd the prefixes
nevertheless come last.  Two lines as similar as asked share a token of their prefixes
(the first tokens, one more than may be missing), whatever the order.  Pairs with a shared prefix token pass the length filter, the
positional filter, and a bound on their difference from 64 or 128 parity bits of
each line's tokens, which none as similar as asked can fail; the Jaccard similarity
of those left is verified on their words.

The join asks which lines have an earlier match, not for all pairs.  So in each
token's list over ``LED_LIST`` every line is first held against the earliest one, then, in
long lists, against a few pivots of the list, and more of them while too many pairs are left; lines whose match is verified
are settled, which in a group of copies leaves few.  The others are joined with all
earlier lines of their lists.  The lists are a table bucketed by token, which all steps
read without another shuffle.  A list over ``HOT_LIST`` is then dealt out in blocks,
each pair of which is a group of its own.

All of it is SQL functions; a token is 56 bits of a word's XXH64, equal lines are told by
the XXH64, Murmur hash and length of their texts.

Null text is the empty text, whose one line is kept.  Very long lines and texts are
sets of words like others.  Rows of one doc_id with other texts are documents of their
own, in order of the texts' hashes; rows that repeat both doc_id and text are
one document, whose lines go in all of them or in none.  Null doc_ids come last.
No documents give no rows.  Extra columns of any name are kept by ``dedup_lines``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import FEW, GAP, cut, cut_alone, fresh_path, is_few, let, maybe_broadcast, numbered, whole_row
from siltstone.llm.simhash import spark_partitions

#: Sets of fewer tokens are as similar as asked only if they are equal.
JOINED_TOKENS = 4
#: Tokens of prefixes are counted in so many hash buckets.
BUCKETS = 1 << 16
#: Tokens come last whose bucket holds over so many times the mean, at first and in later rounds, and over ``LEAST_CROWD``.
FULL, CROWDED = 4, 64
LEAST_CROWD = 1000
#: So many tokens more than the prefix are kept with it, to take the places of those that come last.
SPARE = 4
#: The next words of the same lines can crowd in turn, so often at most.
CROWD_ROUNDS = 4
#: Lines of more tokens than this have 128 parity bits, others 64.
LANE_TOKENS = 64
BITS = ["bits0", "bits1"]
TOKENS = ["prefix", "spare"]
#: Lists over so many lines are dealt out in blocks of about as many.
HOT_LIST = 20_000
#: Lists up to so many lines are short enough to compare all their pairs at once.
LED_LIST = 16
#: Lines of lists of over ``PIVOTED`` times as many are held against so many of their list, round by round.
PIVOTS = (8, 64, 512, 4096)
PIVOTED = 8
SPACES = "\t\x0b\x0c\r"
HASH_BITS = 56
#: Of lines with two longs of parity bits, one is of the words of so many bytes, the other of shorter ones.
LONG_WORD = 6


def numbered_lines(docs: DataFrame) -> DataFrame:
    """(doc, version, line, text): each line of each document; ``version`` tells texts of one doc_id apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64(text).alias("version"), F.posexplode(F.split(text, "\n")).alias("line", "text"))


def keyed(lines: DataFrame) -> DataFrame:
    """``lines`` with what tells their texts: two hashes and the length, in (key, check)."""
    check = F.shiftleft(F.hash("text").cast("long"), 32).bitwiseOR(F.octet_length("text").cast("long"))
    return lines.withColumn("key", F.xxhash64("text")).withColumn("check", check)


@dataclass
class Order:
    """How documents are numbered: by doc_id less ``low``, or by the table ``ranks``."""

    low: int
    high: int
    width: int
    ranks: DataFrame | None

    def place(self, lines: DataFrame) -> DataFrame:
        """``lines`` with ``place``, which puts them in order in one long."""
        if self.ranks is None:
            rank = F.coalesce(F.col("doc") - F.lit(self.low), F.lit(self.high - self.low + 1))
            return lines.withColumn("place", F.shiftleft(rank, self.width).bitwiseOR(F.col("line").cast("long")))
        same = F.col("doc").eqNullSafe(F.col("of_doc")) & (F.col("version") == F.col("of_version"))
        return lines.join(self.ranks, same).withColumn("place", F.shiftleft("rank", self.width).bitwiseOR(F.col("line").cast("long"))).drop("of_doc", "of_version", "rank")

    def holding(self, docs: DataFrame, places: DataFrame) -> DataFrame:
        """``docs`` without those that hold none of ``places``, where that is known without their texts."""
        docs = docs.select("doc_id", "text")
        if self.ranks is not None or not is_few(places):
            return docs
        rank = F.coalesce(F.col("doc_id").cast("long") - F.lit(self.low), F.lit(self.high - self.low + 1))
        held = places.select(F.shiftright("place", self.width).alias("held")).distinct()
        return docs.join(F.broadcast(held), rank == F.col("held"), "left_semi")


def order_of(lines: DataFrame) -> Order:
    """Ids of real corpora fit in a place as they are.

    Where they lie too far apart, or one has several texts, documents are numbered first.
    """
    heads = lines.where("line = 0").groupBy("doc").agg(F.min("version").alias("a"), F.max("version").alias("b"))
    several = heads.where("a < b").limit(1).count() > 0
    low, high, most = lines.agg(F.min("doc"), F.max("doc"), F.max("line")).first()
    low, high, width = low or 0, high or 0, int(most or 0).bit_length()
    if not several and (high - low + 1).bit_length() + width <= 63:
        return Order(low, high, width, None)
    by = [F.col("doc").asc_nulls_last(), F.col("version")]
    ids = numbered(lines.where("line = 0").select("doc", "version").distinct(), by, "doc-order")
    ranks = ids.select(F.col("doc").alias("of_doc"), F.col("version").alias("of_version"), F.col("nth").alias("rank"))
    return Order(low, high, width, cut(ranks, "doc-ranks"))


def repeated_keys(places: DataFrame) -> DataFrame:
    """(key, check, first) of the texts that stand at more than one place, cut."""
    found = places.groupBy("key", "check").agg(F.min("place").alias("first"), F.max("place").alias("last")).where("first < last")
    return cut(found.select("key", "check", "first"), "repeated-keys")


def has_word(text: Column) -> Column:
    return F.ltrim(text, F.lit(" \n" + SPACES)) != ""


def split_at_spaces(text: Column) -> Column:
    """The words, and empty ones where spaces meet; most texts need no regular expression."""
    odd = F.lit(False)
    for c in SPACES:
        odd = odd | F.contains(text, F.lit(c))
    return F.when(odd, F.split(text, GAP)).otherwise(F.split(text, " "))


def words_of(text: Column) -> Column:
    return F.array_remove(split_at_spaces(text), "")


def tokens_of(text: Column) -> Column:
    """The different words' tokens, those of the longest words last: a byte of the word's length, 56 bits of its hash."""
    mask = F.lit((1 << HASH_BITS) - 1)
    length = lambda w: F.least(F.octet_length(w), F.lit(127)).cast("long")
    token = lambda w: F.shiftleft(length(w), HASH_BITS).bitwiseOR(F.xxhash64(w).bitwiseAND(mask))
    return F.sort_array(F.array_distinct(F.transform(words_of(text), token)))


def parity(tokens: Column, n: Column) -> list[Column]:
    """Two longs of bits, each the parity of how many tokens fall on it; lines of few tokens use one.

    Of few tokens each has a term of its own: compiled, where a lambda is interpreted for each token.
    """
    none = F.lit(0).cast("long")
    bit = lambda t: F.call_function("shiftleft", F.lit(1).cast("long"), t.bitwiseAND(F.lit(63)).cast("int"))
    of = lambda some: F.aggregate(some, none, lambda bits, t: bits.bitwiseXOR(bit(t)))
    few = reduce(Column.bitwiseXOR, [F.coalesce(bit(F.get(tokens, F.lit(k))), none) for k in range(LANE_TOKENS)])
    long, least = n > LANE_TOKENS, F.lit(LONG_WORD << HASH_BITS)
    shorter = F.array_position(F.sort_array(F.array_append(tokens, least)), least).cast("int") - 1
    second = F.when(long, of(F.slice(tokens, shorter + 1, n - shorter))).otherwise(none)
    return [F.when(long, of(F.slice(tokens, F.lit(1), shorter))).otherwise(few).alias("bits0"), second.alias("bits1")]


def prefix_length(n: Column) -> Column:
    return n - F.floor((n * 4 + 4) / 5).cast("int") + 1


def bucket(token: Column) -> Column:
    return token.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def crowded_buckets(different: DataFrame, least: int, times: int) -> tuple[set[int], bool]:
    """Hash buckets that hold over ``times`` as many of the prefixes' tokens as the mean; whether some hold over ``CROWDED`` times."""
    tokens = different.where(F.col("n") >= JOINED_TOKENS).select(F.explode("prefix").alias("t"))
    counts = tokens.groupBy(bucket(F.col("t")).alias("b")).count().collect()  # one row a bucket
    mean = sum(n for _, n in counts) / BUCKETS
    return {b for b, n in counts if n > max(least, times * mean)}, any(n > max(least, CROWDED * mean) for _, n in counts)


def uncrowded(different: DataFrame, docs: DataFrame, order: Order, crowded: set[int]) -> DataFrame:
    """``different`` with the tokens of crowded buckets after all others; prefixes without one are what they were.

    The texts are read again of lines whose spare tokens are too few.
    """
    signs = F.split(F.lit(",".join(str(-1 << 63) if b in crowded else "0" for b in range(BUCKETS))), ",").cast("array<bigint>")
    last = lambda t: t.bitwiseOR(F.get(signs, t.bitwiseAND(F.lit(BUCKETS - 1))))
    few, many = different.where(F.col("n") < JOINED_TOKENS), different.where(F.col("n") >= JOINED_TOKENS)
    ordered = F.reverse(F.sort_array(F.transform(F.concat("prefix", "spare"), last)))
    own = [c for c in different.columns if c not in TOKENS]
    parted = lambda rows: rows.select(*own, *prefix_and_spare(F.col("n"), F.col("first"))).select(*different.columns)
    moved = lambda rows: parted(rows.select(*own, ordered.alias("first")))
    # Of sorted tokens, those that come last are negative.
    short = (F.element_at(ordered, prefix_length(F.col("n"))) < 0) & (F.col("n") > F.size("prefix") + F.size("spare"))
    places = cut(many.where(short).select("place"), "crowded-places")
    if not places.limit(1).count():
        return few.unionByName(moved(many))
    lines = order.place(numbered_lines(order.holding(docs, places))).join(maybe_broadcast(places), "place", "left_semi").dropDuplicates(["place"])
    sets = lines.select("place", F.sort_array(F.transform(tokens_of(F.col("text")), last)).alias("tokens"))
    found = sets.select("place", first_tokens(F.col("tokens")).alias("first"))
    changed = moved(unsettled(many, places))
    again = parted(many.join(maybe_broadcast(places), "place", "left_semi").select(*own).join(found, "place"))
    return few.unionByName(changed).unionByName(again)


def first_tokens(tokens: Column) -> Column:
    """Of a line's ascending tokens the last, in descending order: its prefix and spare ones."""
    n = F.size(tokens)
    kept = F.least(n, prefix_length(n) + SPARE)
    return F.reverse(F.slice(tokens, n - kept + 1, kept))


def prefix_and_spare(n: Column, first: Column) -> list[Column]:
    size = prefix_length(n)
    return [F.slice(first, F.lit(1), size).alias("prefix"), F.slice(first, size + 1, F.lit(SPARE)).alias("spare")]


def different_lines(docs: DataFrame, order: Order, repeated: DataFrame) -> DataFrame:
    """(place, n, bits0, bits1, prefix, spare, same) of the first of each group of equal lines, cut.

    ``prefix``: the first tokens, in order; ``spare``: the next.  ``same`` is the XXH64 of the words' set
    where that is too small to be joined.
    """
    lines = order.place(keyed(numbered_lines(docs).where(has_word(F.col("text")))))
    lines = lines.join(maybe_broadcast(repeated), ["key", "check"], "left").where("first IS NULL OR first = place")
    # Costly columns that several expressions mention are evaluated once, in a projection of their own.
    sets = lines.select("place", "text", tokens_of(F.col("text")).alias("tokens"))
    n = F.size("tokens")
    same = F.when(n < JOINED_TOKENS, F.xxhash64(F.array_join(F.sort_array(F.array_distinct(words_of(F.col("text")))), " ")))
    return cut(sets.select("place", n.alias("n"), *parity(F.col("tokens"), n), *prefix_and_spare(n, first_tokens(F.col("tokens"))), same.alias("same")), "different-lines")


def postings(different: DataFrame) -> str:
    """Name of a table (token, place, nk, BITS), bucketed by token: each line's prefix.

    ``nk`` holds the line's number of tokens and, in its lower half, the token's
    position in order of rarity.
    """
    spark, parts = different.sparkSession, spark_partitions(different)
    rows = different.where(F.col("n") >= JOINED_TOKENS).select("place", "n", *BITS, F.posexplode("prefix").alias("k", "t"))
    # 32 bits of a token are enough to list lines by: those that share a list by chance fail the later filters.
    token = F.shiftright(F.shiftleft("t", 32), 32).cast("int")
    rows = rows.select(token.alias("token"), "place", F.shiftleft(F.col("n").cast("long"), 32).bitwiseOR(F.col("k").cast("long")).alias("nk"), *BITS)
    path = fresh_path(spark, "postings")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    dealt = rows.repartition(parts, "token").sortWithinPartitions("token")
    # Bits hardly repeat nor compress.
    dealt.write.bucketBy(parts, "token").option("path", path).option("compression", "lz4").option("parquet.enable.dictionary", "false").saveAsTable(name)
    return name


def may_match(a: str, b: str) -> Column:
    """Length, positional and parity filters of two postings of one token."""
    n = lambda side: F.shiftright(F.col(f"{side}.nk"), 32)
    after = lambda side: n(side) - F.col(f"{side}.nk").bitwiseAND(F.lit(0xFFFFFFFF))  # noqa: E731  tokens from this one on
    total = n(a) + n(b)
    differ = [F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}")) for c in BITS]
    alike = (n(a) > LANE_TOKENS) == (n(b) > LANE_TOKENS)
    # Of lines with other numbers of longs, all longs taken together compare.
    apart = F.when(alike, F.bit_count(differ[0]) + F.bit_count(differ[1])).otherwise(F.bit_count(differ[0].bitwiseXOR(differ[1])))
    # The two must share 4/9 of their tokens' number.
    near = (n(a) * 5 >= n(b) * 4) & (n(b) * 5 >= n(a) * 4)
    return near & (apart * 9 <= total) & (F.least(after(a), after(b)) * 9 >= total * 4)


def verified(pairs: DataFrame, docs: DataFrame, order: Order) -> DataFrame:
    """(place, cut) of those (later, earlier) pairs' later lines whose words' Jaccard similarity is at least 0.8."""
    pairs = cut(pairs.distinct(), "pairs")
    used = cut(pairs.select(F.explode(F.array("later", "earlier")).alias("place")).distinct(), "paired")
    lines = order.place(numbered_lines(order.holding(docs, used))).join(maybe_broadcast(used), "place", "left_semi")
    texts = cut(lines.select("place", "text").dropDuplicates(["place"]), "paired-lines")
    both = pairs.join(texts.select(F.col("place").alias("later"), F.col("text").alias("a")), "later").join(texts.select(F.col("place").alias("earlier"), F.col("text").alias("b")), "earlier")
    of = lambda c: F.array_distinct(F.array_remove(split_at_spaces(F.col(c)), ""))
    found = both.select("later", F.explode(F.array(F.struct(of("a").alias("a"), of("b").alias("b")))).alias("w"))
    shared = F.size(F.array_intersect("w.a", "w.b"))
    return cut(found.where(shared * 9 >= (F.size("w.a") + F.size("w.b")) * 4).select(F.col("later").alias("place")).distinct(), "verified")


def leaders(rows: DataFrame) -> DataFrame:
    """(token, length, place, nk, BITS): each list's number of lines and its earliest line."""
    return rows.groupBy("token").agg(F.count("*").alias("length"), F.min("place").alias("place"), *(F.min_by(c, "place").alias(c) for c in ("nk", *BITS)))


def unsettled(rows: DataFrame, settled: DataFrame) -> DataFrame:
    return rows.join(maybe_broadcast(settled), "place", "left_anti")


def held_against_pivots(rows: DataFrame, long: DataFrame, settled: DataFrame, most: int, docs: DataFrame, order: Order) -> DataFrame:
    """``settled`` with the lines that match one of their lists' pivots, which are about so many lines of each long list, by hash.

    A line that so many earlier ones of its list match, of those that may, is settled after about as many pairs as one match
    takes.  There are more pivots in a next round if the other lines are still left with over ``most`` pairs, as these ones' number says.
    """
    for pivots in PIVOTS:
        lists = cut(long.where(F.col("length") > PIVOTED * pivots).select("token", F.ceil(F.col("length") / pivots).alias("every")), "pivoted-lists")
        if not lists.limit(1).count():
            break
        some = rows.join(maybe_broadcast(lists), "token").where(F.pmod(F.xxhash64("place"), F.col("every")) == 0)
        pairs = earlier_pairs(unsettled(rows, settled), maybe_broadcast(cut(some, "pivots")), ["token"], F.col("y.every"))
        pairs = cut(pairs, "pivot-pairs")
        settled = cut(settled.unionByName(verified(pairs.select("later", "earlier"), docs, order)), "settled")
        left = pairs.join(maybe_broadcast(settled), F.col("later") == F.col("place"), "left_anti").agg(F.sum("every")).first()[0] or 0
        if left <= most:
            break
    return settled


def earlier_pairs(later: DataFrame, rows: DataFrame, by: list[str], *more: Column) -> DataFrame:
    """(later, earlier, more) of postings that share ``by`` and pass the filters."""
    same = (F.col("y.place") < F.col("x.place")) & may_match("x", "y")
    for c in by:
        same = (F.col(f"x.{c}") == F.col(f"y.{c}")) & same
    return later.alias("x").join(rows.alias("y"), same).select(F.col("x.place").alias("later"), F.col("y.place").alias("earlier"), *more)


def blocks(rows: DataFrame, hot: DataFrame, mine: str, other: str, size: int) -> DataFrame:
    """``rows`` of hot lists in their block ``mine``, once for each block ``other`` of the list."""
    n = F.ceil(F.col("length") / size).cast("int")
    dealt = rows.join(maybe_broadcast(hot), "token").withColumn(mine, F.pmod(F.xxhash64("place"), n))
    return dealt.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1))).drop("length")


def matched_places(different: DataFrame, docs: DataFrame, order: Order, hot_list: int = HOT_LIST) -> DataFrame:
    """Places of the different lines that have an earlier match, cut."""
    name = postings(different)
    rows = different.sparkSession.table(name)
    long = cut(leaders(rows).where(F.col("length") > min(LED_LIST, hot_list)), "long-lists")
    hot = long.where(F.col("length") > hot_list).select("token", "length")
    settled = verified(earlier_pairs(rows, maybe_broadcast(long), ["token"]), docs, order)
    listed = long.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    settled = held_against_pivots(rows, long, settled, listed // PIVOTED, docs, order)
    short, any_hot = rows, hot.limit(1).count() > 0
    if any_hot:
        short = rows.join(maybe_broadcast(hot), "token", "left_anti")
    pairs = earlier_pairs(unsettled(short, settled), short, ["token"])
    if any_hot:
        pairs = pairs.unionByName(earlier_pairs(blocks(unsettled(rows, settled), hot, "i", "j", hot_list), blocks(rows, hot, "j", "i", hot_list), ["token", "i", "j"]))
    found = cut(settled.unionByName(verified(pairs, docs, order)), "matched")
    different.sparkSession.sql(f"DROP TABLE {name}")
    return found


def equal_sets(different: DataFrame) -> DataFrame:
    """Places of the lines of few words whose set an earlier line has."""
    small = different.where("same IS NOT NULL").select("place", "same")
    firsts = small.groupBy("same").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1").select("same", "first")
    return small.join(maybe_broadcast(cut(firsts, "small-sets")), "same").where("place > first").select("place")


def ordered_lines(docs: DataFrame, order: Order, repeated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``different_lines``, as they are and with tokens that crowd the prefixes after all others."""
    first = different = different_lines(docs, order, repeated)
    crowded: set[int] = set()
    for times in [FULL, *[CROWDED] * (CROWD_ROUNDS - 1)]:
        more, worst = crowded_buckets(different, min(HOT_LIST, LEAST_CROWD), times)
        more -= crowded
        if not more:
            break
        crowded = crowded | more
        different = uncrowded(different, docs, order, crowded)
        if not worst:
            break
        different = cut(different, "different-lines")
    return first, different


def removed_lines(docs: DataFrame) -> DataFrame:
    """(doc, version, n_lines, removed): each document's removed line numbers, in order."""
    lines = cut(keyed(numbered_lines(docs)).select("doc", "version", "line", "key", "check", has_word(F.col("text")).alias("worded")), "lines")
    order = order_of(lines)
    places = order.place(lines)
    # Lines without a word are no repeats of each other.
    repeated = repeated_keys(places.where("worded"))
    # A text that came before goes, and a line that has an earlier match; of the
    # match's own repeats, all stand later.
    first, different = ordered_lines(docs, order, repeated)
    gone = cut_alone("gone", lambda: matched_places(different, docs, order).unionByName(equal_sets(first)).withColumn("matched", F.lit(True)))
    marked = places.join(maybe_broadcast(repeated), ["key", "check"], "left").join(maybe_broadcast(gone), "place", "left")
    out = F.coalesce("matched", F.lit(False)) | F.coalesce(F.col("place") > F.col("first"), F.lit(False))
    return marked.groupBy("doc", "version").agg((F.max("line") + 1).cast("long").alias("n_lines"), F.sort_array(F.collect_set(F.when(out, F.col("line")))).alias("removed"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` without the removed lines in ``text``; documents left without a line are kept, empty.

    Lines without a word are no repeats of each other.  A null text stays null.
    """
    found = cut_alone("removed-lines", lambda: removed_lines(docs).where(F.size("removed") > 0).select("doc", "version", "removed"))
    total = found.agg(F.coalesce(F.sum(F.size("removed")), F.lit(0))).first()[0]
    small = is_few(found) and total <= 4 * FEW  # else documents are shuffled to their removals
    whole = docs.select(whole_row(docs).alias("row"))
    same = F.col("row.doc_id").cast("long").eqNullSafe(F.col("doc")) & (F.xxhash64(F.col("row.text").cast("string")) == F.col("version"))
    joined = whole.join(F.broadcast(found) if small else found, same, "left")
    lines = F.split(F.col("row.text"), "\n")
    kept = let(F.col("removed"), lambda gone: F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(gone, i)), "\n"))
    text = F.when(F.col("removed").isNull() | F.col("row.text").isNull(), F.col("row.text")).otherwise(kept)
    return joined.select(*(text.alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns))
