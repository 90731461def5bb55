"""Raw records to typed and normalized ones, with lineage, origin and quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.contracts import GROUPS, InterpretationContract
from siltstone.functions.canonical import strict_cast


def named_fields(rows: DataFrame, header: list[str]) -> DataFrame:
    """``rows`` of the archive reader with ``raw``, a map from header names to raw texts."""
    return rows.withColumn("raw", F.map_from_arrays(F.array(*map(F.lit, header)), F.col("fields"))).drop("fields")


def to_typed(rows: DataFrame, contract: InterpretationContract) -> DataFrame:
    """``rows`` (with the map ``raw``) with a typed column per rule, and ``errors``.

    A value without its type's lexical form is null, its raw text is kept, and
    ``errors`` names the field; nothing is coerced.
    """
    raw = lambda f: F.when(F.col("raw")[f.raw] != "", F.col("raw")[f.raw])
    typed = rows.withColumns({f.name: strict_cast(raw(f), f.kind, f.scale) for f in contract.fields})
    problems = []
    for f in contract.fields:
        problem = F.struct(F.lit(f.name).alias("field"), F.lit(f.raw).alias("raw"), F.lit("not_" + f.kind).alias("code"))
        lacking = F.struct(F.lit(f.name).alias("field"), F.lit(f.raw).alias("raw"), F.lit("missing").alias("code"))
        problems.append(F.when(raw(f).isNotNull() & F.col(f.name).isNull(), problem))
        if f.required:
            problems.append(F.when(raw(f).isNull(), lacking))
    kind = "array<struct<field:string,raw:string,code:string>>"
    return typed.withColumn("errors", F.array_compact(F.array(*problems)).cast(kind) if problems else F.array().cast(kind))


def split_accepted(typed: DataFrame, contract: InterpretationContract) -> tuple[DataFrame, DataFrame]:
    """Records whose required fields are sound, and the rejected rest."""
    required = F.array(*(F.lit(f.name) for f in contract.fields if f.required)).cast("array<string>")
    broken = F.exists("errors", lambda e: F.array_contains(required, e["field"]))
    return typed.where(~broken), typed.where(broken)


def normalize(typed: DataFrame, contract: InterpretationContract, locator: list[str], builder_version: str, stage: str) -> DataFrame:
    """Groups source, normalized, reconstructed and quality, and provenance.

    Field origin and raw column go in each field's metadata, which Parquet keeps;
    ``origin_exceptions`` is for records that differ from them.
    """

    def group(name: str) -> Column:
        fields = [F.col(f.name) for f in contract.fields if f.group == name]
        return F.struct(*fields) if fields else F.lit(None).cast("struct<>")

    flags = F.sort_array(F.array_distinct(F.transform("errors", lambda e: F.concat_ws(":", e["code"], e["field"]))))
    provenance = F.struct(
        F.array(F.col("archive")).alias("source_archives"),
        *(F.col(c) for c in locator),
        F.lit(contract.raw_fingerprint).alias("raw_schema_fingerprint"),
        F.lit(contract.contract_id).alias("interpretation_contract_id"),
        F.lit(contract.version).alias("contract_version"),
        F.lit(builder_version).alias("builder_version"),
        F.lit(stage).alias("stage"),
    )
    out = typed.select(
        F.col("raw"),
        *(group(g).alias(g) for g in GROUPS if g != "quality" and any(f.group == g for f in contract.fields)),
        F.struct(flags.alias("flags"), F.col("errors")).alias("quality"),
        F.array().cast("array<struct<field:string,origin:string>>").alias("origin_exceptions"),
        provenance.alias("provenance"),
    )
    return with_metadata(out, contract)


def with_metadata(df: DataFrame, *contracts: InterpretationContract) -> DataFrame:
    """``df`` whose groups' fields carry their origin, raw column and contracts as metadata."""
    notes: dict[tuple[str, str], dict] = {}
    for c in contracts:
        for f in c.fields:
            known = notes.setdefault((f.group, f.name), {"origin": f.origin, "raw": f.raw, "contract": c.contract_id})
            if c.contract_id not in known["contract"].split(","):
                known["contract"] += f",{c.contract_id}"
    fields = []
    for top in df.schema.fields:
        if top.name in GROUPS and isinstance(top.dataType, T.StructType):
            inner = [T.StructField(f.name, f.dataType, f.nullable, notes.get((top.name, f.name), {})) for f in top.dataType.fields]
            fields.append(T.StructField(top.name, T.StructType(inner), top.nullable))
        else:
            fields.append(top)
    return df.to(T.StructType(fields))


def released(records: DataFrame, contracts: list[InterpretationContract], identity: list[str], locator: list[str], builder_version: str, stage: str) -> DataFrame:
    """Collapsed records of any of ``contracts`` as a view: identity, groups, quality and provenance.

    Raw texts stay in the intermediate tables.  A field that a record's contract lacks is null.
    """
    fields = {f.name: f for c in contracts for f in c.fields}
    groups = [g for g in GROUPS if g != "quality" and any(f.group == g for f in fields.values())]
    flags = F.sort_array(F.array_distinct(F.transform("errors", lambda e: F.concat_ws(":", e["code"], e["field"]))))
    provenance = F.struct("source_archives", "copies", *locator, "raw_schema_fingerprint", F.col("contract_id").alias("interpretation_contract_id"), "contract_version", F.lit(builder_version).alias("builder_version"), F.lit(stage).alias("stage"))
    out = records.select(*identity, *(F.struct(*(n for n, f in fields.items() if f.group == g)).alias(g) for g in groups), F.struct(flags.alias("flags")).alias("quality"), provenance.alias("provenance"))
    return with_metadata(out, *contracts)


def lineage(contract: InterpretationContract) -> list[tuple[str, str, str, str, str]]:
    """(raw column, group, field, kind, origin) of each rule."""
    return [(f.raw, f.group, f.name, f.kind, f.origin) for f in contract.fields]


def default_view(df: DataFrame, usable: str = "usable_for_policy_imitation") -> DataFrame:
    """Only rows that are certainly usable: unknown counts as not."""
    return df.where(F.coalesce(F.col(usable), F.lit(False)))


def pseudonymise(value: Column, scope: str, key: str) -> Column:
    """A scoped pseudonym under a private key.

    Without the key, a small space of identifiers could be tried out.
    """
    if not key:
        raise ValueError("pseudonyms need a private key")
    return F.sha2(F.concat(F.lit(f"{len(key)}:{key}|{scope}|"), value.cast("string")), 256)


def migrate(df: DataFrame, steps: list, version: int) -> DataFrame:
    """``df`` taken through steps (from_version, function) to the latest; gaps raise."""
    for start, step in sorted(steps, key=lambda s: s[0]):
        if start < version:
            continue
        if start != version:
            raise ValueError(f"no migration from version {version}")
        df, version = step(df), version + 1
    return df
