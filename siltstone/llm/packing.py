"""Best-fit packing of tokenized documents into fixed-length sequences.

``tokenize`` turns documents into pieces of at most ``capacity`` tokens;
``pack`` places pieces by large-item matching.  Pieces over a third of the
capacity can share a sequence with one other such piece at most, so they are
matched greedily, each with the longest that still fits; shorter pieces then go,
longest first, where they leave the smallest gap.

Placement depends on lengths alone.  So the plan is made from the histogram of
lengths (at most ``capacity`` rows, whatever the corpus), and says for the r-th
piece of a length in which sequence and where it lies.  The pieces themselves
are numbered within their length by two-level counts over hashed buckets: a
length that a third of all pieces share is numbered by many tasks.

Null text is the empty text, which is the end token alone.  Repeated rows are
packed each.  Ties among equal lengths are broken by hash, doc_id and piece.
No documents give no rows.  Extra columns of ``pack``'s input, of any name, are kept;
those named sequence_id and offset are replaced.
"""

from __future__ import annotations

import base64
import bisect
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm import mixing
from siltstone.llm.common import cut, whole_row

CAPACITY = 2048
PIECES = "doc_id long, piece int, start long, length long, ids binary"
#: The plan is broadcast up to so many rows, of about 50 bytes each.
PLAN_ROWS = 400_000


@cache
def encoder(ranks_path: str, json_path: str):
    """The tokenizer of ``json_path``, run on its merge ranks.

    Both files hold one vocabulary; the ranks' library gives the same ids about
    four times as fast.  As with the other, the end token's string is one id.
    """
    import json

    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    with open(json_path, encoding="utf-8") as f:
        special = {x["content"]: x["id"] for x in json.load(f)["added_tokens"]}
    made = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return made, tuple(special)


def tokenize(docs: DataFrame, ranks_path: str, json_path: str, capacity: int = CAPACITY, end_id: int = 0, carry: tuple[str, ...] = ()) -> DataFrame:
    """Pieces of each document: its ids (little-endian unsigned 32-bit), then ``end_id``.

    Only documents over ``capacity`` are cut, so that all pieces but the first
    are full.  Columns named in ``carry`` go with each piece.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, special = encoder(ranks_path, json_path)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                out: list[tuple] = []
                of: list[int] = []
                for nth, (doc_id, text) in enumerate(zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True)):
                    text = text or ""
                    ids = made.encode(text, allowed_special="all") if any(s in text for s in special) else made.encode_ordinary(text)
                    ids.append(end_id)
                    flat = np.array(ids, "<u4")
                    first = len(flat) % capacity or capacity
                    edges = [0, *range(first, len(flat) + 1, capacity)]
                    out += [(doc_id, k, a, b - a, flat[a:b].tobytes()) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
                    of += [nth] * (len(edges) - 1)
                columns = list(zip(*out, strict=True))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                taken = [part.column(c).take(pa.array(of, pa.int64())) for c in carry]
                yield pa.RecordBatch.from_arrays([*(pa.array(x, k) for x, k in zip(columns, kinds, strict=True)), *taken], ["doc_id", "piece", "start", "length", "ids", *carry])

    lean = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *carry)
    return lean.mapInArrow(pieces, ", ".join([PIECES, *(f"{c} {docs.schema[c].dataType.simpleString()}" for c in carry)]))


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Where the pieces of each length go, from the number of pieces of each.

    Rows (length, low, high, sequence, offset, each): of that length, the pieces
    numbered low to high - 1 go, ``each`` to a sequence, to consecutive
    sequences from ``sequence`` on, the first of each at ``offset``.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    rank = dict.fromkeys(left, 0)
    out: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: runs of sequences (first, number) that have it
    made = 0

    def put(length: int, n: int, sequence: int, offset: int, each: int = 1) -> None:
        out.append((length, rank[length], rank[length] + n, sequence, offset, each))
        rank[length] += n
        left[length] -= n

    large = sorted(n for n in left if 3 * n > capacity)
    for long in reversed(large):
        while left[long]:
            at = bisect.bisect_right(large, min(long, capacity - long)) - 1
            while at >= 0 and left[large[at]] < 1 + (large[at] == long):
                at -= 1
            short = large[at] if at >= 0 else None
            n = left[long] if short is None else left[long] // 2 if short == long else min(left[long], left[short])
            put(long, n, made, 0)
            if short is not None:
                put(short, n, made, long)
            gaps.setdefault(capacity - long - (short or 0), []).append((made, n))
            made += n
    open_gaps = sorted(gaps)
    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[length]:
            at = bisect.bisect_left(open_gaps, length)
            if at == len(open_gaps):
                gap, first, n = capacity, made, -(-left[length] // (capacity // length))
                made += n
            else:
                gap = open_gaps[at]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], open_gaps[at]
            each = gap // length
            full, rest = divmod(min(left[length], n * each), each)
            runs = [(first, full, gap - each * length), (first + full, int(rest > 0), gap - rest * length), (first + full + (rest > 0), n - full - (rest > 0), gap)]
            put(length, full * each + rest, first, capacity - gap, each)
            for start, many, new in runs:
                if many:
                    if new not in gaps:
                        bisect.insort(open_gaps, new)
                    gaps.setdefault(new, []).append((start, many))
    return out


def place_bucket(rows: DataFrame, place: str, buckets: int) -> Column:
    """Ranges of ``place`` of one width, in its order."""
    most = rows.agg(F.max(place)).first()[0] or 0
    return F.floor(F.col(place) / F.lit(most // buckets + 1)).cast("long")


def pack(pieces: DataFrame, capacity: int = CAPACITY, buckets: int = 64, place: str | None = None) -> DataFrame:
    """``pieces`` (doc_id, piece, length and any more) with sequence_id and offset.

    ``pieces`` is read more than once; cut it first if it is dear to compute.
    Pieces of one length go by the column ``place`` (long, 0 or more), if it is named,
    and else by hash.
    """
    spark, columns = pieces.sparkSession, [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    used = ["doc_id", "piece", "length", *([place] if place else [])]
    pieces = pieces.select(whole_row(pieces).alias("row"), *used)
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # one row a length, capacity at most
    if any(n < 1 or n > capacity for n in counts):
        raise ValueError(f"pieces have 1 to {capacity} tokens")
    placed = plan(counts, capacity)
    # More buckets as pieces grow in number: about a million pieces at most in one of one length.
    buckets = max(buckets, sum(counts.values()) // 1_000_000)
    if place:
        keyed = pieces.withColumn("_bucket", place_bucket(pieces, place, buckets))
    else:
        keyed = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = keyed.groupBy("length", "_bucket").count().select("length", "_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("length", "_bucket").orderBy(*([place] if place else []), "doc_id", "piece")
    ranked = keyed.withColumn("_row", F.row_number().over(within)).join(bases.hint("shuffle_merge"), ["length", "_bucket"])
    ranked = ranked.withColumn("_rank", F.col("_base") + F.col("_row") - 1)
    rows = spark.createDataFrame(placed, "_length long, _low long, _high long, _sequence long, _offset long, _each long")
    rows = F.broadcast(rows) if len(placed) <= PLAN_ROWS else rows
    hit = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_low")) & (F.col("_rank") < F.col("_high"))
    nth = F.col("_rank") - F.col("_low")
    return (
        ranked.join(rows, hit)
        .withColumn("sequence_id", F.col("_sequence") + F.floor(nth / F.col("_each")).cast("long"))
        .withColumn("offset", F.col("_offset") + (nth % F.col("_each")) * F.col("length"))
        .select(*(F.col(f"row.`{c}`") for c in columns), "sequence_id", "offset")
    )


def pack_documents(docs: DataFrame, ranks_path: str, json_path: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of ``docs`` with their ids' CRC-32 in place of the ids, packed."""
    pieces = tokenize(docs, ranks_path, json_path, capacity)
    lean = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(cut(lean, "pieces"), capacity)


def numbered_by_place(packed: DataFrame, place: str, buckets: int = 1024) -> DataFrame:
    """``packed`` with its sequences numbered by the least ``place`` that each holds.

    ``packed`` is read more than once, and is a cut table.
    """
    firsts = cut(packed.groupBy("sequence_id").agg(F.min(place).alias("_first")), "sequence-places")
    keyed = firsts.withColumn("_bucket", place_bucket(firsts, "_first", buckets))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = keyed.groupBy("_bucket").count().select("_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base"))  # 1024 rows
    within = Window.partitionBy("_bucket").orderBy("_first", "sequence_id")
    numbers = keyed.withColumn("_row", F.row_number().over(within)).join(F.broadcast(bases), "_bucket")
    numbers = numbers.select("sequence_id", (F.col("_base") + F.col("_row") - 1).cast("long").alias("_number"))
    return packed.join(numbers, "sequence_id").withColumn("sequence_id", F.col("_number")).select(*packed.columns)


def pack_mixture(docs: DataFrame, ranks_path: str, json_path: str, weights: dict[str, int], capacity: int = CAPACITY) -> DataFrame:
    """As ``pack_documents``, in the order of the mixture of the documents' sources.

    Each document's place in the mixture ranks its pieces among those of their length,
    and sequences are numbered by the first place that they hold; no row is left out.
    """
    rows = docs.select("doc_id", "text", F.col("source").cast("string").alias("source")).withColumn("_doc", F.monotonically_increasing_id())
    pieces = tokenize(rows, ranks_path, json_path, capacity, carry=("source", "_doc"))
    lean = cut(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "source", "_doc"), "pieces")
    places = mixing.mix(lean.where("piece = 0").select("_doc", "doc_id", "source"), weights)
    places = places.select("_doc", (F.col("slot") * mixing.BLOCK + F.col("place_in_block")).alias("place"))
    placed = cut(lean.drop("source").join(places, "_doc").drop("_doc"), "placed-pieces")
    packed = cut(pack(placed, capacity, place="place"), "packed")
    return numbered_by_place(packed, "place").drop("place")
