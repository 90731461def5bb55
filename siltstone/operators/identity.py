"""Identities of games and events, and events that several archives hold as one.

An identity says on what it rests, and keeps the source's own identifier beside it.
Events are collapsed before anything is derived from their order: copies in one
archive or in several would else stand at one position and make each other ambiguous.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.contracts import IdentityContract
from siltstone.functions import canonical

NATIVE, LOCATED, UNKNOWN = "native", "archive_locator", "none"


def in_verified_scope(contract: IdentityContract) -> Column:
    """Whether a row's native identifier is unique by review."""
    if contract.native is None:
        return F.lit(False)
    scopes = [reduce(Column.__and__, (F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(contract.scope, values, strict=True)), F.lit(True)) for values in contract.verified]
    return F.col(contract.native).isNotNull() & reduce(Column.__or__, scopes, F.lit(False))


def identified(df: DataFrame, contract: IdentityContract, name: str, within: str | None = None) -> DataFrame:
    """``df`` with ``<name>_id``, ``<name>_id_basis`` and ``<name>_native_id``.

    ``within`` is the id of what holds it, as of an event's game, which then is part of the
    identity.  A row without any of what it would rest on has a null id and the basis none.
    """
    around = [within] if within else []
    encode = lambda basis, columns: F.concat(canonical.tagged("s", F.lit(basis)), canonical.canonical_encode(df.schema, [*around, *columns]))
    located = [contract.archive, *contract.locator]
    native = in_verified_scope(contract)
    known = reduce(Column.__and__, (F.col(c).isNotNull() for c in located))
    basis = F.when(native, NATIVE).when(known, LOCATED).otherwise(UNKNOWN)
    if within:
        basis = F.when(F.col(within).isNull(), UNKNOWN).otherwise(basis)
    by_native = canonical.make_id(contract.namespace, contract.version, encode(NATIVE, [*contract.scope, contract.native])) if contract.native else F.lit(None).cast("string")
    by_place = canonical.make_id(contract.namespace, contract.version, encode(LOCATED, located))
    return df.withColumns({
        f"{name}_id": F.when(basis == NATIVE, by_native).when(basis == LOCATED, by_place),
        f"{name}_id_basis": basis,
        f"{name}_native_id": F.col(contract.native).cast("string") if contract.native else F.lit(None).cast("string"),
    })


def game_ids(df: DataFrame, contract: IdentityContract) -> DataFrame:
    return identified(df, contract, "game")


def event_ids(df: DataFrame, contract: IdentityContract) -> DataFrame:
    """Events with the id of their game (see ``game_ids``) and their own."""
    return identified(df, contract, "event", "game_id")


def with_content(df: DataFrame, columns: list[str], scales: dict[str, int] | None = None) -> DataFrame:
    """``df`` with ``content_hash`` of what a record says, apart from where it was found."""
    return df.withColumn("content_hash", canonical.content_hash(df.schema, sorted(columns), scales))


HEX_DIGITS = 64
#: Partitions of gathered records for each usual one: several aggregates of a partition are in memory at once.
FINER = 4


def packed(df: DataFrame, column: str) -> list[Column]:
    """``column`` as (``_<column>_head``, ``_<column>_tail``): a SHA-256 at a string's end as its 32 bytes, half as wide where it is shuffled.

    The two tell values apart as the column does, and ``unpacked`` has them again; other types and texts stay as they are, in head.
    """
    x = F.col(f"`{column}`")
    head, tail = f"_{column}_head", f"_{column}_tail"
    if not isinstance(df.schema[column].dataType, T.StringType):
        return [x.alias(head), F.lit(None).cast("binary").alias(tail)]
    digits = F.right(x, F.lit(HEX_DIGITS))
    hashed = digits.rlike(f"^[0-9a-f]{{{HEX_DIGITS}}}$")
    rest = F.left(x, F.char_length(x) - HEX_DIGITS)
    return [F.when(hashed, rest).otherwise(x).alias(head), F.when(hashed, F.unhex(digits)).alias(tail)]


def unpacked(df: DataFrame, column: str) -> Column:
    head, tail = F.col(f"_{column}_head"), F.col(f"_{column}_tail")
    if not isinstance(df.schema[f"_{column}_head"].dataType, T.StringType):
        return head.alias(column)
    return F.when(tail.isNull(), head).otherwise(F.concat(head, F.lower(F.hex(tail)))).alias(column)


def gathered(df: DataFrame, identity: str, *others: str | Column) -> tuple[DataFrame, list[str]]:
    """(``df`` with identity and content packed, columns that tell an identity): all records of one identity in one partition.

    What follows by identity, or by identity and more, needs no other shuffle.  Records without
    identity, however many, need not meet: they are dealt out by their content.
    """
    told = [*packed(df, identity), *packed(df, "content_hash")]
    rows = df.select(*told, *others)
    key = [f"_{identity}_head", f"_{identity}_tail"]
    unknown = F.col(key[0]).isNull()
    at = F.when(unknown, F.xxhash64("_content_hash_head", "_content_hash_tail")).otherwise(F.xxhash64(*key))
    rows = rows.withColumn("_at", at)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(FINER * parts, "_at"), ["_at", *key]


CONTENT = ["_content_hash_head", "_content_hash_tail"]


def by_content(df: DataFrame, identity: str, archive: str, ordinal: str, held: list[str]) -> DataFrame:
    """Records of one identity and content as one, with ``quarantine_reason`` (null: none); see ``collapsed``."""
    own = F.struct(*(F.col(f"`{c}`") for c in held)).alias("_own")
    rows, key = gathered(df, identity, F.col(f"`{archive}`").alias("_archive"), F.col(f"`{ordinal}`").alias("_ordinal"), own)
    here = rows.groupBy(*key, *CONTENT, "_archive").agg(F.min("_ordinal").alias("_first"), F.count("*").alias("_n"), F.first("_own").alias("_row"))
    one = here.groupBy(*key, *CONTENT).agg(
        F.sort_array(F.collect_list("_archive")).alias("source_archives"), F.sum("_n").alias("copies"), F.min(F.struct("_archive", "_first")).alias("_place"), F.first("_row").alias("_row")
    )
    contents = F.count("*").over(Window.partitionBy(*key))
    reason = F.when(F.col(key[1]).isNull(), "no_identity").when(contents > 1, "identity_collision").alias("quarantine_reason")
    return one.select(unpacked(one, identity), unpacked(one, "content_hash"), F.col("_place._archive").alias(archive), F.col("_place._first").alias(ordinal), *(F.col(f"_row.`{c}`") for c in held), "source_archives", "copies", reason)


def collapsed(df: DataFrame, identity: str, archive: str, ordinal: str, held: list[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kept, quarantined, provenance) of records with ``identity`` and ``content_hash``.

    Records of one identity and content are one, with ``source_archives`` (each archive once, in
    order), ``copies`` and the first place; ``provenance`` has every place of every record, a row
    each, so that no identity's places are gathered.  All records of an identity with
    more than one content, and those without identity, are quarantined, with the reason.
    """
    held = held or [c for c in df.columns if c not in (identity, "content_hash", archive, ordinal)]
    rows = by_content(df, identity, archive, ordinal, held)
    kept = rows.where("quarantine_reason IS NULL").drop("quarantine_reason")
    return kept, rows.where("quarantine_reason IS NOT NULL"), df.select(identity, "content_hash", archive, ordinal)


def classes(df: DataFrame, identity: str, archive: str) -> DataFrame:
    """How many records and contents are unique, repeated in an archive or several, collided, or without identity."""
    rows, key = gathered(df, identity, F.col(f"`{archive}`").alias("_archive"))
    here = rows.groupBy(*key, *CONTENT, "_archive").agg(F.count("*").alias("n"))
    one = here.groupBy(*key, *CONTENT).agg(F.sum("n").alias("n"), F.count("*").alias("archives"))
    by_id = one.groupBy(*key).agg(F.count("*").alias("contents"), F.sum("n").alias("records"), F.max("archives").alias("archives"))
    kind = F.when(F.col(key[1]).isNull(), "no_identity").when(F.col("contents") > 1, "identity_collision").when(F.col("archives") > 1, "source_duplicate").when(F.col("records") > 1, "exact_duplicate").otherwise("unique")
    # Records without identity are one, wherever they lie.
    identities = F.count(F.when(F.col(key[1]).isNotNull(), 1)) + F.max(F.col(key[1]).isNull().cast("long"))
    return by_id.groupBy(kind.alias("dup_class")).agg(identities.alias("identities"), F.sum("contents").alias("contents"), F.sum("records").alias("records"))
