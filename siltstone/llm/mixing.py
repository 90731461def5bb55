"""Mixing sources to target weights by Pfair scheduling.

A source of weight w of a total W is due w of every W slots.  Its k-th block
(from 0) is released at slot floor(k W / w) and due before slot ceil((k + 1) W / w).
Slot by slot, of the released blocks that with the earliest deadline goes next,
ties by source name.  On one resource that meets every deadline, so at every slot
each source has had less than one block more or less than its share.

The sources that ``weights`` does not name, however many, have one weight: to the
schedule they are one source of their weights' sum, whose turns go round them by
name.  Such a round adds (n - 1) / n of a block at most to a deviation of less than
1 / n, so theirs stays below one block too.

The schedule repeats after W slots.  One period is computed from the weights
alone, as one fold over its slots in chunks, and block k of a source goes to the
slot of its k-th turn.  Every document gets a slot: once a source has no blocks left its
turns stay empty, and the others go on in proportion.  ``in_mix`` marks the slots
before the first empty one, where the mixture is as targeted.

In a source, documents go by MD5 of their id, then id, in blocks of ``block``.
They are numbered by two-level counts over the digests' first digits, so that a
source with a third of all rows is numbered by many tasks.

A source that ``weights`` does not name has weight ``default``; a null source is
one of its own, the empty name.  A null id sorts as the empty text.  Repeated
rows are documents of their own.  No documents give no rows.  The schedule depends on
the weights and the number of sources, whatever the number of rows.  All of it
is SQL functions.  Extra columns of the input are kept, but for those named as in
``ADDED``, which are replaced; ``mixed_documents`` keeps columns of any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import cut, let, maybe_broadcast, numbered, whole_row

BLOCK = 32
#: Slots folded together: their picks are one array.
CHUNK = 1024
#: To the schedule: a named source's name after OWN, and all other sources, which sort last.
OWN, OTHERS = "=", "~"
#: Hexadecimal digits of the digest that deal out a source's documents: 256 buckets.
BUCKET_DIGITS = 2
#: What ``mix`` adds; columns of these names in its input are replaced.
ADDED = ["slot", "place_in_block", "block", "release", "deadline", "in_mix"]


def period(sources: DataFrame) -> DataFrame:
    """(source, turn, slot, release, deadline) of one period, from (source, weight) rows, which lie in one task."""
    entry = F.struct(F.col("source").alias("name"), F.col("weight").cast("long").alias("weight"))
    listed = sources.groupBy().agg(F.sort_array(F.collect_list(entry)).alias("all"), F.coalesce(F.sum("weight"), F.lit(0)).cast("long").alias("total"))
    pick_kind = "struct<due:bigint,at:int,turn:bigint>"
    empty = F.array().cast(f"array<{pick_kind}>")

    def step(state: Column, slot: Column) -> Column:
        """state: turns had so far by each source, and the sources picked so far in the chunk."""
        ready = F.transform(
            F.zip_with(F.col("all"), state["turns"], lambda s, k: F.struct(s["weight"].alias("w"), k.alias("k"))),
            lambda x, at: F.when(F.floor(x["k"] * F.col("total") / x["w"]) <= slot, F.struct(F.ceil((x["k"] + 1) * F.col("total") / x["w"]).alias("due"), at.alias("at"), x["k"].alias("turn"))),
        )
        return let(
            F.array_min(F.array_compact(ready)),  # ties go by name, as sources are sorted
            lambda p: F.struct(F.transform(state["turns"], lambda k, at: F.when(at == p["at"], k + 1).otherwise(k)).alias("turns"), F.concat(state["picked"], F.array(p)).alias("picked")),
        )

    def chunk(state: Column, low: Column) -> Column:
        slots = F.sequence(low, F.least(low + (CHUNK - 1), F.col("total") - 1))
        start = F.struct(state["turns"].alias("turns"), empty.alias("picked"))
        done = F.aggregate(slots, start, step)
        return let(done, lambda d: F.struct(d["turns"].alias("turns"), F.concat(state["chunks"], F.array(d["picked"])).alias("chunks")))

    start = F.struct(F.transform(F.col("all"), lambda s: F.lit(0).cast("long")).alias("turns"), F.array().cast(f"array<array<{pick_kind}>>").alias("chunks"))
    lows = F.when(F.col("total") > 0, F.sequence(F.lit(0).cast("long"), F.col("total") - 1, F.lit(CHUNK).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    chunks = listed.select("all", "total", F.posexplode(F.aggregate(lows, start, chunk)["chunks"]).alias("nth", "picks"))
    picked = chunks.select("all", "total", "nth", F.posexplode("picks").alias("pos", "p"))
    source = F.element_at("all", F.col("p.at") + 1)
    picked = picked.select(source.alias("s"), F.col("p.turn").alias("turn"), (F.col("nth").cast("long") * CHUNK + F.col("pos")).alias("slot"), "total")
    release = F.floor(F.col("turn") * F.col("total") / F.col("s.weight"))
    deadline = F.ceil((F.col("turn") + 1) * F.col("total") / F.col("s.weight"))
    return picked.select(F.col("s.name").alias("source"), "turn", "slot", release.alias("release"), deadline.alias("deadline"))


def weighed(counts: DataFrame, weights: dict[str, int], default: int = 1) -> DataFrame:
    """(source, n, weight, entity, step, at) of each source, from (_source, n) rows, cut.

    In the schedule it is a turn of ``entity``: its k-th turn there is number k x step + at.
    """
    if default < 1 or any(w < 1 for w in weights.values()):
        raise ValueError("weights are positive integers")
    weight = F.lit(default)
    for name, w in weights.items():
        weight = F.when(F.col("_source") == name, w).otherwise(weight)
    named = F.col("source").isin(list(weights)) if weights else F.lit(False)
    sources = counts.groupBy("_source").agg(F.sum("n").alias("n")).select(F.col("_source").alias("source"), "n", weight.cast("long").alias("weight"))
    others = numbered(sources.where(~named), [F.col("source")], "other-sources")
    n_others = others.count()
    one = sources.where(named).withColumns({"entity": F.concat(F.lit(OWN), F.col("source")), "step": F.lit(1).cast("long"), "at": F.lit(0).cast("long")})
    rest = others.withColumns({"entity": F.lit(OTHERS), "step": F.lit(n_others).cast("long"), "at": F.col("nth").cast("long")})
    return cut(one.unionByName(rest.select(one.columns)), "sources")


def mix(docs: DataFrame, weights: dict[str, int], default: int = 1, block: int = BLOCK) -> DataFrame:
    """``docs`` with their place: slot, place_in_block, block, release, deadline, in_mix.

    Ordered by slot, then place_in_block, they are the mixture.
    """
    own = [F.col(f"row.`{c}`") for c in docs.columns if c not in ADDED]
    return placed_rows(docs.select(whole_row(docs).alias("row"), "doc_id", "source"), weights, default, block).select(*own, *ADDED)


def placed_rows(docs: DataFrame, weights: dict[str, int], default: int, block: int) -> DataFrame:
    """(row, doc_id, source) with ADDED."""
    keyed = docs.withColumn("_source", F.coalesce(F.col("source").cast("string"), F.lit(""))).withColumn("_digest", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    keyed = keyed.withColumn("_bucket", F.substring("_digest", 1, BUCKET_DIGITS))
    counts = cut(keyed.groupBy("_source", "_bucket").agg(F.count("*").alias("n")), "source-counts")
    sources = weighed(counts, weights, default)
    total = sources.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    entities = sources.groupBy("entity").agg(F.sum("weight").alias("weight")).select(F.col("entity").alias("source"), "weight")  # one row more than weights has
    turns = cut(period(entities).select(F.col("source").alias("entity"), F.col("turn").alias("entity_turn"), "slot"), "period")  # as many rows as the weights' sum
    # The first turn for which a source has no block ends the mixture.
    blocks = F.ceil(F.col("n") / block).cast("long")
    ends = sources.withColumn("entity_turn", (blocks % F.col("weight")) * F.col("step") + F.col("at")).withColumn("round", F.floor(blocks / F.col("weight"))).join(turns, ["entity", "entity_turn"])
    end = ends.agg(F.min(F.col("round") * total + F.col("slot"))).first()[0] or 0
    before = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("_source", "_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("_source", "_bucket").orderBy("_digest", "doc_id")
    ranked = keyed.withColumn("_row", F.row_number().over(within)).join(bases.hint("shuffle_merge"), ["_source", "_bucket"])
    ranked = ranked.withColumn("_rank", F.col("_base") + F.col("_row") - 1).withColumn("_block", F.floor(F.col("_rank") / block).cast("long"))
    # Both tables grow with the number of sources, not of rows; broadcast while they are few.
    source_of = maybe_broadcast(sources.select(F.col("source").alias("_source"), *(F.col(c).alias(f"_{c}") for c in ("weight", "entity", "step", "at"))))
    slot_of = maybe_broadcast(turns.select(*(F.col(c).alias(f"_{c}") for c in turns.columns)))
    w, k = F.col("_weight"), F.col("_block")
    placed = ranked.join(source_of, "_source").withColumn("_entity_turn", (k % w) * F.col("_step") + F.col("_at"))
    placed = placed.withColumn("_round", F.floor(k / w).cast("long")).join(slot_of, ["_entity", "_entity_turn"])
    slot = F.col("_round") * F.lit(total) + F.col("_slot")
    return placed.select(
        "row",
        slot.alias("slot"),
        (F.col("_rank") % block).cast("long").alias("place_in_block"),
        k.alias("block"),
        F.floor(k * F.lit(total) / w).cast("long").alias("release"),
        F.ceil((k + 1) * F.lit(total) / w).cast("long").alias("deadline"),
        (slot < F.lit(end)).alias("in_mix"),
    )


def mixed_documents(docs: DataFrame, weights: dict[str, int], default: int = 1, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs``, dealt out and sorted in the mixture's order."""
    own = docs.columns
    placed = placed_rows(docs.select(whole_row(docs).alias("row"), "doc_id", "source"), weights, default, block)
    return placed.repartitionByRange("slot", "place_in_block").sortWithinPartitions("slot", "place_in_block").select(*(F.col(f"row.`{c}`") for c in own))
