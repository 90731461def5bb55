"""WARC archives of pages with revisits, and their index by external merge.

``write_archives`` writes a record per page into archives of bounded size in the
shared folder.  Each archive's index entries are sorted by URL key, time and page:
one capture run.  ``merge_runs`` deals the runs out by key ranges of bounded size and merges
those of each range with a loser tree, so that the ranges in order are one index of
capture histories; every capture gets its place in it and in its URL's history.  ``read_archives`` reads every record back.

Of records with equal payloads, the one with the smallest page_id is a response
and the others revisit it; ``min_revisit`` sets below how many bytes all are
responses.  An archive is written under a name of its own by each task attempt,
and only what finished tasks list is read, so a lost executor leaves at most a
file that nothing names.

Null html is the empty payload; a null URL has the empty key.  Rows that repeat
the smallest page_id are responses each.  A null page_id is always a response.
No pages give no archives and no rows.  A page is one record however long it is.
Extra columns are left out.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.llm.common import cut, fresh_path, maybe_broadcast, shared_dir
from siltstone.llm.simhash import spark_partitions

#: Archives end after so many bytes.
ARCHIVE_BYTES = 256 << 20
#: Revisits of up to so many pages are broadcast to the writers, 16 bytes each.
REVISITS = 1_000_000
#: Index entries merged in one task, about.
RANGE_ENTRIES = 250_000
#: Pages carry no time of capture; they are one second apart from here.
EPOCH = datetime(2024, 1, 1, tzinfo=UTC)

ENTRIES = "run string, seq long, urlkey string, timestamp string, page_id long, offset long, length long"
RECORDS = "run string, offset long, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def urlkey(url: str | None) -> str:
    """Host parts from the right, then path and query: com,example)/path?query."""
    try:
        parts = urlsplit((url or "").strip())
        host = (parts.hostname or "").removeprefix("www.")
        port = f":{parts.port}" if parts.port not in (None, 80, 443) else ""
    except ValueError:
        return (url or "").strip().lower()
    if not host:
        return (url or "").strip().lower()
    query = f"?{parts.query}" if parts.query else ""
    return ",".join(reversed(host.split("."))) + port + ")" + (parts.path or "/") + query


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, first: int | None) -> bytes:
    """A WARC record; with ``first``, a revisit of that page's payload."""
    when = EPOCH + timedelta(seconds=(page_id or 0) % 1_000_000_000)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~-._')}",
        f"WARC-Date: {when:%Y-%m-%dT%H:%M:%SZ}",
        f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
    ]
    if first is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{first}>"]
    block = http + (payload if first is None else b"")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[int | None, int, str, str, int | None]:
    """page_id, bytes and digest of the full payload, type, and the page revisited."""
    head, _, block = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = int(re.search(rb"Content-Length: (\d+)", http)[1])
    page = lambda name: int(fields[name][10:-1]) if len(fields.get(name, "")) > 11 else None  # noqa: E731  <urn:page:N>
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response":
        if len(payload) != stated or digest_of(payload) != digest:
            raise ValueError(f"the payload of {fields['WARC-Record-ID']} differs from its digest")
    return page("WARC-Record-ID"), stated, digest, fields["WARC-Type"], page("WARC-Refers-To")


def file_system(path: str) -> tuple[pa.fs.FileSystem, str]:
    """Arrow's file system and path of what Hadoop names; object stores' schemes differ there."""
    path = re.sub(r"^(s3a|s3n)://", "s3://", path)
    return pa.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path) if ":" in path else "file://" + path)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the file system that Spark takes it to be on."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()


def revisits(pages: DataFrame, min_revisit: int = 0) -> DataFrame:
    """(page_id, first) of each page whose payload a page of smaller id has."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    lean = pages.select(F.col("page_id").cast("long").alias("page_id"), F.sha1(payload).alias("sha"), F.octet_length(payload).alias("size")).where(F.col("size") >= min_revisit)
    lean = cut(lean.select("page_id", "sha"), "payloads")
    shared = cut(lean.groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("sha", "first"), "shared-payloads")
    few = shared.count() <= REVISITS
    return lean.join(F.broadcast(shared) if few else shared, "sha").where("page_id > first").select("page_id", "first").distinct()


def write_archives(pages: DataFrame, min_revisit: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the archives; their entries (``ENTRIES``), a sorted run for each archive."""
    spark = pages.sparkSession
    shared_dir(spark)
    top = qualified(spark, fresh_path(spark, "warc"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = file_system(top)
        fs.create_dir(at, recursive=True)
        out, path, entries, size = None, "", [], 0

        def finish() -> pa.RecordBatch:
            out.close()
            entries.sort(key=lambda e: (e[0], e[1], -1 if e[2] is None else e[2], e[3]))
            columns = [[path] * len(entries), range(len(entries)), *zip(*entries, strict=True)]
            kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], [x.split()[0] for x in ENTRIES.split(", ")])

        for batch in batches:
            for page_id, url, html, first in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "first")), strict=True):
                if out is None:
                    path = f"{top}/{uuid.uuid4().hex}.warc.gz"
                    out, entries, size = fs.open_output_stream(file_system(path)[1], compression=None), [], 0
                raw = record(page_id, url, (html or "").encode("utf-8", "replace"), first)
                member = gzip.compress(raw, 6, mtime=0)
                out.write(member)
                when = EPOCH + timedelta(seconds=(page_id or 0) % 1_000_000_000)
                entries.append((urlkey(url), f"{when:%Y%m%d%H%M%S}", page_id, size, len(member)))
                size += len(member)
                if size >= archive_bytes:
                    yield finish()
                    out = None
        if out is not None:
            yield finish()

    repeats = cut(revisits(pages, min_revisit), "revisits")
    lean = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    marked = lean.join(F.broadcast(repeats) if repeats.count() <= REVISITS else repeats, "page_id", "left")
    return cut(marked.mapInArrow(write, ENTRIES), "capture-runs")


class LoserTree:
    """Merges sorted lists: a tournament whose inner nodes keep the losers of their matches."""

    def __init__(self, lists: list[list]):
        self.lists, self.at = lists, [0] * len(lists)
        self.size = max(1, len(lists))
        self.losers = [-1] * self.size
        for k in range(len(lists)):
            self.play(k)

    def less(self, a: int, b: int) -> bool:
        """Whether list a's head goes before b's; an empty list goes last."""
        if self.at[a] >= len(self.lists[a]):
            return False
        if self.at[b] >= len(self.lists[b]):
            return True
        return (self.lists[a][self.at[a]], a) < (self.lists[b][self.at[b]], b)

    def play(self, k: int) -> None:
        """Play list k's head up to the root; the winner stands at losers[0]."""
        winner, node = k, (k + self.size) // 2
        while node > 0:
            other = self.losers[node]
            if other == -1:  # its opponent comes later
                self.losers[node] = winner
                return
            if self.less(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator:
        while self.lists:
            best = self.losers[0]
            if self.at[best] >= len(self.lists[best]):
                return
            yield self.lists[best][self.at[best]]
            self.at[best] += 1
            self.play(best)


def merge_runs(runs: DataFrame, range_entries: int = RANGE_ENTRIES) -> DataFrame:
    """The runs' entries with ``capture_place`` in the global order, and ``history_place`` in that of their URL.

    Entries are dealt out in ranges of (urlkey, timestamp, page_id) of about
    ``range_entries``, as many ranges as that takes, so that captures of one URL, however
    many, can lie in several ranges.  A task merges one range.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        part = TaskContext.get().partitionId()
        table = pa.Table.from_batches(rows)  # one range's entries; arrives sorted by run and seq
        urls, times = (table.column(c).to_pylist() for c in ("urlkey", "timestamp"))
        keys = list(zip(urls, times, (-1 if x is None else x for x in table.column("page_id").to_pylist()), range(len(urls)), strict=True))
        run = table.column("run").to_pylist()
        edges = [k for k in range(len(run)) if k == 0 or run[k] != run[k - 1]] + [len(run)]
        order = [key[3] for key in LoserTree([keys[a:b] for a, b in zip(edges, edges[1:], strict=False)])]
        nth, seen = [], 0
        for k, at in enumerate(order):  # in merged order a URL's captures follow each other
            seen = seen + 1 if k and urls[at] == urls[order[k - 1]] else 0
            nth.append(seen)
        merged = table.take(pa.array(order, pa.int64())).append_column("range", pa.array([part] * len(order), pa.int32()))
        merged = merged.append_column("place", pa.array(range(len(order)), pa.int64())).append_column("nth", pa.array(nth, pa.int64()))
        yield from merged.combine_chunks().to_batches()

    n = max(spark_partitions(runs), -(-runs.count() // range_entries))
    dealt = runs.repartitionByRange(n, "urlkey", "timestamp", "page_id").sortWithinPartitions("run", "seq")
    merged = cut(dealt.mapInArrow(merge, ENTRIES + ", range int, place long, nth long"), "merged-index")
    # What lies in the ranges before: of all captures, and of a URL that an earlier range ends with. A row for each range.
    sizes = merged.groupBy("range").agg(F.count("*").alias("size"), F.min_by("urlkey", "place").alias("opens"), F.max_by("urlkey", "place").alias("closes"), F.max_by("nth", "place").alias("last"))
    lower = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("before", F.coalesce(F.sum("size").over(lower), F.lit(0)))
    # A URL's captures in an earlier range are those at its end; ranges that it fills follow each other.
    same = Window.partitionBy("closes").orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = sizes.select(F.col("range").alias("of"), F.col("closes").alias("url"), F.sum(F.col("last") + 1).over(same).alias("had"))
    carried = sizes.join(ends, (F.col("url") == F.col("opens")) & (F.col("of") < F.col("range")), "left").groupBy("range", "before", "opens").agg(F.coalesce(F.max("had"), F.lit(0)).alias("carried"))
    carried = maybe_broadcast(cut(carried, "range-sizes"))
    place = (F.col("before") + F.col("place")).alias("capture_place")
    history = (F.col("nth") + F.when(F.col("urlkey") == F.col("opens"), F.col("carried")).otherwise(0)).alias("history_place")
    return merged.join(carried, "range").select(*(x.split()[0] for x in ENTRIES.split(", ")), place, history)


def read_archives(runs: DataFrame) -> DataFrame:
    """A row (``RECORDS``) for each record of the archives that ``runs`` lists, read in full."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("run").to_pylist():
                fs, at = file_system(path)
                with fs.open_input_stream(at, compression=None) as source:
                    yield from rows_of(path, records_of(source))

    def rows_of(path: str, found: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        names = [x.split()[0] for x in RECORDS.split(", ")]

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for offset, raw in found:
            rows.append((path, offset, *parse(raw)))
            if len(rows) >= 4096:
                yield batch()
                rows = []
        if rows:
            yield batch()

    files = cut(runs.select("run").distinct(), "archives")
    return files.repartition(max(1, files.count())).mapInArrow(read, RECORDS)  # an archive for each task


def records_of(source, chunk: int = 1 << 20) -> Iterator[tuple[int, bytes]]:
    """Offset and content of each gzip member of a stream."""
    held, base = source.read(chunk), 0
    while held:
        member, raw, used = zlib.decompressobj(31), [], 0
        while True:
            raw.append(member.decompress(held))
            if member.eof:
                used += len(held) - len(member.unused_data)
                held = member.unused_data
                break
            used += len(held)
            held = source.read(chunk)
            if not held:
                raise ValueError("the archive is cut short")
        yield base, b"".join(raw)
        base += used
        held = held or source.read(chunk)


def archive_pages(pages: DataFrame, min_revisit: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the pages, merge the index, read the archives back: a row per capture."""
    runs = write_archives(pages, min_revisit, archive_bytes)
    index = merge_runs(runs).select("run", "offset", "urlkey", "timestamp", "capture_place", "history_place")
    # Both sides grow with the pages: neither is broadcast.
    both = index.join(read_archives(runs).hint("merge"), ["run", "offset"])
    return both.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "timestamp", "capture_place", "history_place")
