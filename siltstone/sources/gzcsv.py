"""Data source ``gzcsv``: gzip-compressed CSV archives as rows of raw text.

Each archive is one partition, read as a stream: memory is bounded by the limits,
whatever the archive's size.  Every record gets the next ordinal of its archive,
rejected ones too.  Rows are of three kinds: ``record`` with its fields,
``rejected`` with a reason, and ``fatal``, the archive's last, where reading ended.

Text is decoded strictly, record by record; nothing is replaced.  A quote that no
other ends would swallow what follows up to the record limit, and is fatal.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

SCHEMA = "archive string, record_ordinal long, record_kind string, reason string, fields array<string>"
CHUNK = 1 << 18


class Fatal(Exception):
    """The archive can't be read on."""


def decompressed(source, ratio: int, most: int) -> Iterator[bytes]:
    """Chunks of all members of a gzip stream, with limits on what they expand to."""
    member, taken, made = zlib.decompressobj(31), 0, 0
    begun = False
    while held := source.read(CHUNK):
        taken += len(held)
        while held:
            if member.eof:
                member = zlib.decompressobj(31)
            begun = True
            try:
                part = member.decompress(held, CHUNK)
            except zlib.error as error:
                raise Fatal(f"corrupt_gzip: {error}") from error
            made += len(part)
            if made > most or made > ratio * max(taken, 1024):
                raise Fatal("expansion_limit")
            if part:
                yield part
            held = member.unused_data if member.eof else member.unconsumed_tail
    if begun and not member.eof:
        raise Fatal("truncated_gzip")


def records(chunks: Iterator[bytes], delimiter: bytes, most: int) -> Iterator[bytes | None]:
    """Records' bytes, without their line ends; None for one that is over ``most`` bytes.

    Quotes are counted, not parsed: a record ends at a line end outside quotes.
    """
    held, over, quotes = [], 0, 0
    size = 0
    for chunk in chunks:
        lines = chunk.split(b"\n")
        for k, line in enumerate(lines):
            ended = k < len(lines) - 1
            quotes += line.count(b'"')
            size += len(line) + 1
            if size <= most:
                held.append(line)
                if ended and quotes % 2:
                    held.append(b"\n")
            elif quotes % 2 and size > 2 * most:
                raise Fatal("unterminated_quote")
            else:
                held, over = [], 1
            if ended and quotes % 2 == 0:
                yield None if over else b"".join(held).removesuffix(b"\r")
                held, over, quotes, size = [], 0, 0, 0
    if quotes % 2:
        raise Fatal("unterminated_quote")
    if size > 1 or over:
        rest = b"".join(held).removesuffix(b"\r")
        if over or rest:
            yield None if over else rest


def split_fields(record: bytes, delimiter: bytes) -> list[bytes] | None:
    """The record's fields; None if a quote stands where it can't."""
    if b'"' not in record:
        return record.split(delimiter)
    fields, at, n = [], 0, len(record)
    while True:
        if record[at : at + 1] == b'"':
            end, parts = at + 1, []
            while True:
                close = record.find(b'"', end)
                if close < 0:
                    return None
                parts.append(record[end:close])
                if record[close + 1 : close + 2] != b'"':
                    break
                parts.append(b'"')
                end = close + 2
            fields.append(b"".join(parts))
            at = close + 1
            if at < n and record[at : at + 1] != delimiter:
                return None
        else:
            stop = record.find(delimiter, at)
            stop = n if stop < 0 else stop
            if b'"' in record[at:stop]:
                return None
            fields.append(record[at:stop])
            at = stop
        if at >= n:
            return fields
        at += 1
        if at == n:
            return [*fields, b""]


class Archive(InputPartition):
    def __init__(self, path: str):
        self.path = path


class GzCsvReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = [p for p in options.get("paths", options.get("path", "")).split("\n") if p]
        self.delimiter = options.get("delimiter", ",").encode()
        self.header = options["header"].split("\n") if options.get("header") else None
        self.encoding = options.get("encoding", "utf-8")
        number = lambda name, other: int(options.get(name, other))
        self.batch_rows, self.batch_bytes = number("batchrows", 4096), number("batchbytes", 8 << 20)
        self.field_bytes, self.record_bytes = number("fieldbytes", 1 << 20), number("recordbytes", 4 << 20)
        self.ratio, self.most = number("expansionratio", 1000), number("decompressedbytes", 1 << 42)

    def partitions(self):
        return [Archive(p) for p in self.paths]

    def read(self, partition):
        rows: list[tuple] = []
        size = 0
        for row, n in self.rows(partition.path):
            rows.append(row)
            size += n
            if len(rows) >= self.batch_rows or size >= self.batch_bytes:
                yield self.batch(rows)
                rows, size = [], 0
        if rows:
            yield self.batch(rows)

    def batch(self, rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.string()))
        columns = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["archive", "record_ordinal", "record_kind", "reason", "fields"])

    def rows(self, path: str) -> Iterator[tuple[tuple, int]]:
        ordinal = 0
        try:
            with open_stream(path) as source:
                found = records(decompressed(source, self.ratio, self.most), self.delimiter, self.record_bytes)
                head = next(found, None)
                names = [x.decode(self.encoding) for x in split_fields(head.removeprefix(b"\xef\xbb\xbf"), self.delimiter) or []] if head else []
                if self.header is not None and names != self.header:
                    raise Fatal("header_mismatch")
                for raw in found:
                    reason, fields = self.fields(raw, len(names))
                    yield (path, ordinal, "rejected" if reason else "record", reason, fields), len(raw or b"") + 64
                    ordinal += 1
        except (Fatal, OSError, UnicodeDecodeError) as error:
            reason = str(error) if isinstance(error, Fatal) else f"unreadable: {type(error).__name__}"
            yield (path, ordinal, "fatal", reason, None), 64

    def fields(self, raw: bytes | None, arity: int) -> tuple[str | None, list[str] | None]:
        if raw is None:
            return "record_limit", None
        parts = split_fields(raw, self.delimiter)
        if parts is None:
            return "misplaced_quote", None
        if any(len(x) > self.field_bytes for x in parts):
            return "field_limit", None
        if len(parts) != arity:
            return "wrong_arity", None
        try:
            return None, [x.decode(self.encoding) for x in parts]
        except UnicodeDecodeError:
            return "invalid_encoding", None


def open_stream(path: str):
    fs, at = pa.fs.FileSystem.from_uri(path) if "://" in path else (pa.fs.LocalFileSystem(), path)
    return fs.open_input_stream(at, compression=None)


class GzCsvSource(DataSource):
    """Register with ``spark.dataSource.register(GzCsvSource)``; read with format ``gzcsv``."""

    @classmethod
    def name(cls):
        return "gzcsv"

    def schema(self):
        return SCHEMA

    def reader(self, schema: StructType):
        return GzCsvReader(self.options)


def read_archives(spark, paths: list[str], header: list[str] | None = None, limits=None, delimiter: str = ","):
    """Rows of ``SCHEMA`` of the archives; with ``header``, an archive that has another is fatal."""
    spark.dataSource.register(GzCsvSource)
    reader = spark.read.format("gzcsv").option("paths", "\n".join(paths)).option("delimiter", delimiter)
    if header:
        reader = reader.option("header", "\n".join(header))
    if limits is not None:
        for name, value in (("batchRows", limits.batch_rows), ("batchBytes", limits.batch_bytes), ("fieldBytes", limits.field_bytes), ("recordBytes", limits.record_bytes), ("expansionRatio", limits.expansion_ratio), ("decompressedBytes", limits.decompressed_bytes)):
            reader = reader.option(name, value)
    return reader.load()


def accepted(rows):
    """Records of archives without a fatal error; the others' are not to be trusted."""
    fatal = rows.where("record_kind = 'fatal'").select("archive").distinct()
    return rows.where("record_kind = 'record'").join(fatal, "archive", "left_anti")


def diagnostics(rows):
    """Rejected records and fatal errors, with archive, ordinal and reason."""
    return rows.where("record_kind <> 'record'").select("archive", "record_ordinal", "record_kind", "reason")
