"""Evidence about archives' physical schemas, and what contracts make of it."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.contracts import InterpretationContract
from siltstone.functions.canonical import LEXICAL, tagged
from siltstone.sources.gzcsv import Fatal, decompressed, open_stream, records, split_fields

HEADERS = "path string, header array<string>, delimiter string, quoted boolean, newline string, bom boolean, encoding string, problem string"
DELIMITERS = (b",", b"\t", b";", b"|")


def inspect_headers(paths: DataFrame, parallelism: int = 64, most: int = 4 << 20) -> DataFrame:
    """Each archive's header and dialect, from as many bytes as its first record takes."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(path, *header_of(path, most)) for path in batch.column("path").to_pylist()]
            kinds = (pa.string(), pa.list_(pa.string()), pa.string(), pa.bool_(), pa.string(), pa.bool_(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], [x.split()[0] for x in HEADERS.split(", ")])

    return paths.select("path").distinct().repartition(parallelism, "path").mapInArrow(scanned, HEADERS)


def header_of(path: str, most: int) -> tuple:
    nothing = (None, None, None, None, None, None)
    try:
        with open_stream(path) as source:
            chunks = decompressed(source, 1000, 1 << 32)
            first = next(chunks, b"")
            newline = "crlf" if b"\r\n" in first[: first.find(b"\n") + 1] else "lf"

            def rest() -> Iterator[bytes]:
                yield first
                yield from chunks

            line = next(records(rest(), b",", most), b"")
    except (Fatal, OSError) as error:
        return (*nothing, str(error) if isinstance(error, Fatal) else "unreadable")
    if not line:
        return (*nothing, "empty" if line == b"" else "record_limit")
    bom = line.startswith(b"\xef\xbb\xbf")
    line = line.removeprefix(b"\xef\xbb\xbf")
    delimiter = max(DELIMITERS, key=lambda d: (line.count(d), -DELIMITERS.index(d)))
    try:
        names = [x.decode("utf-8") for x in split_fields(line, delimiter) or []]
    except UnicodeDecodeError:
        return (None, delimiter.decode(), b'"' in line, newline, bom, None, "invalid_encoding")
    return (names, delimiter.decode(), b'"' in line, newline, bom, "utf-8", None if names else "misplaced_quote")


def raw_fingerprint(header: Column, *dialect: Column) -> Column:
    """Of the ordered header and the dialect: neither tool nor meaning enters it."""
    names = F.array_join(F.transform(header, lambda x: tagged("s", x)), "")
    return F.when(header.isNotNull(), F.concat(F.lit("raw:v1:"), F.sha2(F.concat(names, F.lit("|"), *(tagged("s", x.cast("string")) for x in dialect)), 256)))


def with_fingerprint(headers: DataFrame) -> DataFrame:
    return headers.withColumn("raw_schema_fingerprint", raw_fingerprint(F.col("header"), *(F.col(c) for c in ("delimiter", "newline", "bom", "encoding"))))


def inspection_id(*parts: Column) -> Column:
    """Of archive, method, scope and report; when and where it ran are left out."""
    return F.concat(F.lit("inspection:v1:"), F.sha2(F.concat(*(tagged("s", p.cast("string")) for p in parts)), 256))


def group_schemas(inspected: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Archives by kind, fingerprint, expansion and format."""
    by = by or ["source_kind", "raw_schema_fingerprint", "expansion", "format"]
    return inspected.groupBy(*by).agg(F.count("*").alias("archives"))


def reconcile_counts(inspected: DataFrame) -> DataFrame:
    """One row: candidates, inspected, unreadable, and whether they add up."""
    counts = inspected.agg(F.count("*").alias("candidates"), F.count_if(F.col("raw_schema_fingerprint").isNotNull()).alias("inspected"), F.count_if(F.col("problem").isNotNull()).alias("unreadable"))
    return counts.withColumn("reconciled", F.col("candidates") == F.col("inspected") + F.col("unreadable"))


def select_representatives(rows: DataFrame, group: list[str], order: list[str], k: int = 2) -> DataFrame:
    """The first ``k`` of every group, by a deterministic order."""
    window = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn("representative", F.row_number().over(window)).where(F.col("representative") <= k)


def blockers(groups: DataFrame, representatives: DataFrame, group: list[str]) -> DataFrame:
    """Groups that have no readable representative."""
    return groups.join(representatives.select(*group).distinct(), group, "left_anti").withColumn("blocker", F.lit("no_readable_representative"))


def profile(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Evidence on each text column: (column, rows, nulls, empty, integers, decimals, booleans, timestamps, longest)."""
    aggregates = []
    for k, c in enumerate(columns):
        x = F.col(c).cast("string")
        counts = [F.count_if(x.rlike(LEXICAL[kind])).alias(kind) for kind in ("integer", "decimal", "boolean", "timestamp")]
        aggregates.append(F.struct(F.lit(c).alias("column"), F.count("*").alias("rows"), F.count_if(x.isNull()).alias("nulls"), F.count_if(x == "").alias("empty"), *counts, F.coalesce(F.max(F.length(x)), F.lit(0)).cast("long").alias("longest")).alias(f"c{k}"))
    one = rows.agg(*aggregates)  # one pass for all columns
    return one.select(F.inline(F.array(*(F.col(f"c{k}") for k in range(len(columns))))))


def safe_summary(rows: DataFrame, column: str, ordinal: str, k: int = 5) -> DataFrame:
    """The first rows' lengths and letter patterns in place of their values."""
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.col(column), r"\p{L}", "a"), r"\p{N}", "9"), r"(.)\1{3,}", "$1$1$1+")
    return rows.orderBy(ordinal).limit(k).select(ordinal, F.length(column).alias("length"), shape.alias("shape"))


def classify_drift(old: Column, new: Column, renames: dict[str, str] | None = None) -> Column:
    """Struct of drift class, added, removed and renamed columns of two headers.

    Renames are declared, never guessed.  Classes: none, additive, reorder, rename, removal.
    """
    renames = renames or {}
    changed = F.transform(old, lambda c: F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in renames.items() for x in kv)), c) if renames else F.lit(None), c))
    added, removed = F.array_except(new, changed), F.array_except(changed, new)
    common = F.filter(new, lambda c: F.array_contains(changed, c))
    kind = (
        F.when(old == new, "none")
        .when(F.size(removed) > 0, "removal")
        .when(common != changed, "reorder")
        .when(F.size(added) > 0, "additive")
        .otherwise("rename" if renames else "none")
    )
    return F.struct(kind.alias("drift"), F.sort_array(added).alias("added"), F.sort_array(removed).alias("removed"))


def type_drift(old: DataFrame, new: DataFrame) -> DataFrame:
    """Columns whose evidence of type or nullability differs between two profiles."""

    def shape(p: DataFrame, name: str) -> DataFrame:
        full = F.col("rows") - F.col("nulls") - F.col("empty")
        kind = F.when(full == 0, "none")
        for c in ("integer", "boolean", "timestamp", "decimal"):
            kind = kind.when(F.col(c) == full, c)
        return p.select("column", kind.otherwise("string").alias(f"{name}_kind"), (F.col("nulls") > 0).alias(f"{name}_nullable"))

    both = shape(old, "old").join(shape(new, "new"), "column")
    return both.where("old_kind <> new_kind OR old_nullable <> new_nullable")


def evidence_kind(p: str) -> Column:
    """The narrowest kind that all of a profiled column's values have."""
    full = F.col(f"{p}.rows") - F.col(f"{p}.nulls") - F.col(f"{p}.empty")
    kind = F.when(full == 0, "none")
    for c in ("integer", "boolean", "timestamp", "decimal"):
        kind = kind.when(F.col(f"{p}.{c}") == full, c)
    return kind.otherwise("string")


def profile_drift(old: DataFrame, new: DataFrame, renames: dict[str, str] | None = None, meanings: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """(column, new_column, drift): how each column of two versions' profiles differs.

    ``renames`` are declared, and hold only if the evidence of both columns agrees: else the column counts as
    removed and the other as added.  ``meanings`` has the declared semantic class of a column in either version,
    by its old name.  Of several classes the first of: removed, added, semantic, type, nullability, renamed, none.
    """
    renames, meanings = renames or {}, meanings or {}
    named = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in renames.items() for x in kv)), F.col("column")), F.col("column")) if renames else F.col("column")
    changed = [c for c, (a, b) in meanings.items() if a != b]
    both = old.withColumn("_as", named).alias("o").join(new.alias("n"), F.col("o._as") == F.col("n.column"), "full_outer")
    kinds, nulls = (evidence_kind("o"), evidence_kind("n")), (F.col("o.nulls") > 0, F.col("n.nulls") > 0)
    moved = F.col("o.column") != F.col("n.column")
    false_name = F.coalesce(moved & (kinds[0] != kinds[1]), F.lit(False))
    drift = (
        F.when(F.col("n.column").isNull(), "removed").when(F.col("o.column").isNull(), "added")
        .when(F.col("o.column").isin(changed) if changed else F.lit(False), "semantic")
        .when(kinds[0] != kinds[1], "type").when(nulls[0] != nulls[1], "nullability").when(moved, "renamed").otherwise("none")
    )
    one = lambda a, b, d: F.struct(a.alias("column"), b.alias("new_column"), d.alias("drift"))
    null = F.lit(None).cast("string")
    apart = F.array(one(F.col("o.column"), null, F.lit("removed")), one(null, F.col("n.column"), F.lit("added")))
    rows = both.select(F.explode(F.when(false_name, apart).otherwise(F.array(one(F.col("o.column"), F.col("n.column"), drift)))).alias("r"))
    return rows.select("r.*")


class ContractError(ValueError):
    """No contract allows what was found."""


class Registry:
    """Interpretation contracts by physical schema; the highest version of one counts."""

    def __init__(self, contracts: list[InterpretationContract]):
        self.contracts = sorted(contracts, key=lambda c: (c.raw_fingerprint, c.version))

    def contract_for(self, fingerprint: str) -> InterpretationContract:
        found = [c for c in self.contracts if c.raw_fingerprint == fingerprint]
        if not found:
            raise ContractError(f"no contract for {fingerprint}")
        return found[-1]


def compatibility(contract: InterpretationContract, header: list[str]) -> dict:
    """Ignored and added columns with their disposition; raises where the contract does not allow the header."""
    missing = [f.raw for f in contract.fields if f.raw not in header]
    added = [c for c in header if c not in contract.header]
    if missing:
        raise ContractError(f"{contract.contract_id}: columns {missing} are missing")
    if added and not contract.additive_allowed:
        raise ContractError(f"{contract.contract_id}: columns {added} are not declared")
    kept = [c for c in header if c in contract.header]
    if kept != list(contract.header):
        raise ContractError(f"{contract.contract_id}: the columns' order differs")
    return {"added": added, "ignored": contract.ignored(), "disposition": "warning" if added else "none"}


# Patterns of fields that may identify people.
IDENTIFYING = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "ipv4": r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b",
    "phone": r"\+\d{1,3}[ (-]",
}


def privacy_scan(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(column, pattern, hits): a hit holds publication until someone has reviewed it."""
    counts = [F.struct(F.lit(c).alias("column"), F.lit(k).alias("pattern"), F.count_if(F.col(c).rlike(p)).alias("hits")) for c in columns for k, p in IDENTIFYING.items()]
    one = rows.agg(*(x.alias(f"c{k}") for k, x in enumerate(counts)))
    return one.select(F.inline(F.array(*(F.col(f"c{k}") for k in range(len(counts))))))


def text_fields(schema: T.StructType) -> dict[str, Column]:
    """Every string of a schema by its path: nested ones, and those in arrays joined to one text."""
    found: dict[str, Column] = {}

    def walk(kind: T.DataType, path: str, at: Column) -> None:
        if isinstance(kind, T.StringType):
            found[path] = at
        elif isinstance(kind, T.StructType):
            for f in kind.fields:
                walk(f.dataType, f"{path}.{f.name}" if path else f.name, at[f.name])
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
            found[path] = F.array_join(at, " ")
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            for f in kind.elementType.fields:
                inner = T.ArrayType(f.dataType)
                walk(inner, f"{path}.{f.name}", at.getField(f.name))
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.ArrayType):
            walk(kind.elementType, path, F.flatten(at))
        elif isinstance(kind, T.MapType):
            walk(T.ArrayType(kind.keyType), f"{path}.keys", F.map_keys(at))
            walk(T.ArrayType(kind.valueType), f"{path}.values", F.map_values(at))

    for f in schema.fields:
        walk(f.dataType, f.name, F.col(f"`{f.name}`"))
    return found


def privacy_scan_all(rows: DataFrame) -> DataFrame:
    """``privacy_scan`` of every string field of ``rows``, in one pass."""
    found = text_fields(rows.schema)
    if not found:
        return rows.sparkSession.createDataFrame([], "column string, pattern string, hits long")
    flat = rows.select(*(c.alias(f"c{k}") for k, c in enumerate(found.values())))
    names = F.create_map(*(F.lit(x) for k, name in enumerate(found) for x in (f"c{k}", name)))
    return privacy_scan(flat, flat.columns).select(F.element_at(names, F.col("column")).alias("column"), "pattern", "hits")


def privacy_holds(scan: DataFrame, reviews: DataFrame) -> DataFrame:
    """Hits without a review row (column, pattern, decision)."""
    return scan.where("hits > 0").join(reviews.where("decision = 'cleared'"), ["column", "pattern"], "left_anti")
