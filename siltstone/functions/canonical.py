"""Canonical encoding of records, identities and stable buckets, as Column expressions.

A null is ``N;``; any other value a tag, its length in bytes, a colon, its text and
a semicolon.  The lengths make the encoding injective.  It depends on neither time
zone nor locale.  Floating-point values need a declared scale.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENCODING = "canonical-v1"


def tagged(tag: str, text: Column) -> Column:
    return F.coalesce(F.concat(F.lit(tag), F.octet_length(text).cast("string"), F.lit(":"), text, F.lit(";")), F.lit("N;"))


def encode_value(value: Column, kind: T.DataType, scale: int | None = None) -> Column:
    if isinstance(kind, T.StringType):
        return tagged("s", value)
    if isinstance(kind, T.BooleanType):
        return tagged("b", value.cast("int").cast("string"))
    if isinstance(kind, T.IntegralType):
        return tagged("i", value.cast("string"))
    if isinstance(kind, T.DecimalType):
        return tagged("d", value.cast(f"decimal(38,{kind.scale if scale is None else scale})").cast("string"))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        if scale is None:
            raise ValueError("a floating-point column is hashed only at a declared scale")
        return tagged("d", value.cast(f"decimal(38,{scale})").cast("string"))
    if isinstance(kind, T.DateType):
        return tagged("t", (F.unix_date(value).cast("long") * 86_400_000_000).cast("string"))
    if isinstance(kind, T.TimestampType):
        return tagged("t", F.unix_micros(value).cast("string"))
    if isinstance(kind, T.TimestampNTZType):
        return tagged("t", F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), value).cast("string"))
    if isinstance(kind, T.ArrayType):
        return tagged("l", F.array_join(F.transform(value, lambda x: encode_value(x, kind.elementType, scale)), ""))
    if isinstance(kind, T.StructType):
        inner = F.concat(*(encode_value(value[f.name], f.dataType, scale) for f in kind.fields))
        return tagged("r", F.when(value.isNotNull(), inner))
    if isinstance(kind, T.MapType):
        return encode_value(F.array_sort(F.map_entries(value)), T.ArrayType(T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])), scale)
    raise ValueError(f"{kind.simpleString()} has no canonical form")


def canonical_encode(schema: T.StructType, columns: list[str], scales: dict[str, int] | None = None) -> Column:
    """The columns, in the order given, as one string."""
    scales = scales or {}
    return F.concat(*(encode_value(F.col(c), schema[c].dataType, scales.get(c)) for c in columns))


def content_hash(schema: T.StructType, columns: list[str], scales: dict[str, int] | None = None) -> Column:
    return F.sha2(canonical_encode(schema, columns, scales), 256)


def make_id(namespace: str, version: str, encoded: Column) -> Column:
    """``namespace:version:hash`` of a canonical form, in which both are hashed too."""
    body = F.concat(tagged("s", F.lit(namespace)), tagged("s", F.lit(version)), encoded)
    return F.concat(F.lit(f"{namespace}:{version}:"), F.sha2(body, 256))


def bucket_of(group: Column, contract_id: str, salt: str, buckets: int = 10_000) -> Column:
    """A stable bucket: the first 60 bits of a SHA-256, modulo ``buckets``."""
    prefix = F.substring(F.sha2(F.concat(F.lit(f"{contract_id}|{salt}|"), group.cast("string")), 256), 1, 15)
    return F.conv(prefix, 16, 10).cast("long") % buckets


# The lexical forms that a typed field accepts.
LEXICAL = {
    "integer": r"^-?(0|[1-9][0-9]{0,18})$",
    "boolean": r"^(true|false)$",
    "decimal": r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?$",
    "timestamp": r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(\.\d{1,6})?$",
}


def strict_cast(raw: Column, kind: str, scale: int = 0) -> Column:
    """``raw`` as ``kind`` if it has that kind's one lexical form, else null."""
    if kind == "string":
        return raw
    target = {"integer": "bigint", "boolean": "boolean", "decimal": f"decimal(38,{scale})", "timestamp": "timestamp_ntz"}[kind]
    return F.when(raw.rlike(LEXICAL[kind]), raw.try_cast(target))
