"""Media columns: Netpbm and BMP images, area-resized tiles, difference hashes.

``store_media`` lays each text's bytes out as image samples and writes the
images as a table; ``read_media`` decodes stored images to arrays, resizes them
by integral images, and gives NPY tiles and difference hashes.

Null text counts as empty.  Every payload has at least one block, so the empty
text is a block of 255s.  Very long texts give tall images.  Equal texts, and
repeated rows, give equal values; null ids are carried.  Extra columns are left
out.  ``decode_image`` raises ``ValueError`` for a damaged image; ``read_media`` says so in
``status``, and leaves what it can't know null.  A clash of names can't arise, as only
doc_id and text are read; ties have no part in it.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import cut

#: Payloads are whole blocks of so many bytes, which is 24 x 24 grey or 24 x 8 RGB samples.
BLOCK = 576
WIDTH = 24
TILE = 8

STORED = "doc_id long, n_bytes long, media binary"
FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, tile binary, tile_sha256 string, status string"


def payload_of(text: str | None) -> tuple[int, bytes]:
    raw = (text or "").encode("utf-8")
    blocks = max(1, -(-len(raw) // BLOCK))
    return len(raw), raw.ljust(blocks * BLOCK, b"\xff")


def encode_image(payload: bytes) -> bytes:
    """A PGM, PPM or BMP file; which one follows from the number of blocks."""
    kind = len(payload) // BLOCK % 3
    if kind == 0:
        return b"P5\n%d %d\n255\n" % (WIDTH, len(payload) // WIDTH) + payload
    height = len(payload) // (3 * WIDTH)
    if kind == 1:
        return b"P6\n%d %d\n255\n" % (WIDTH, height) + payload
    rgb = np.frombuffer(payload, np.uint8).reshape(height, WIDTH, 3)
    pixels = rgb[::-1, :, ::-1].tobytes()  # bottom row first, blue before red
    head = struct.pack("<2sIHHI", b"BM", 54 + len(pixels), 0, 0, 54)
    info = struct.pack("<IiiHHIIiiII", 40, WIDTH, height, 1, 24, 0, len(pixels), 2835, 2835, 0, 0)
    return head + info + pixels


def netpbm_header(media: bytes) -> tuple[list[int], int]:
    """Width, height and largest sample, and where the samples begin; one pass over the header."""
    numbers: list[int] = []
    at = 2
    while len(numbers) < 3:
        token = HEADER_TOKEN.match(media, at)
        if not token:
            raise ValueError("the Netpbm header is damaged")
        at = token.end()
        if token[1] is not None:
            numbers.append(int(token[1]))
            if len(numbers) < 3 and not (media[at : at + 1].isspace() or media[at : at + 1] == b"#"):
                raise ValueError("the Netpbm header is damaged")
    if not media[at : at + 1].isspace():
        raise ValueError("the Netpbm header is damaged")
    return numbers, at + 1


#: A number of at most nine digits, one blank, or a comment line.
HEADER_TOKEN = re.compile(rb"(\d{1,9})(?!\d)|\s|#[^\n]*\n")


def decode_image(media: bytes) -> np.ndarray:
    """Height x width (grey) or height x width x 3 (RGB) samples of eight bits."""
    if media[:2] == b"BM":
        if len(media) < 54:
            raise ValueError("the BMP header is cut short")
        at, size = struct.unpack_from("<I", media, 10)[0], struct.unpack_from("<I", media, 14)[0]
        width, height = struct.unpack_from("<ii", media, 18)
        depth, packed = struct.unpack_from("<H", media, 28)[0], struct.unpack_from("<I", media, 30)[0]
        if size < 40 or depth != 24 or packed or width < 1 or not height:
            raise ValueError("only uncompressed 24-bit BMP with pixels is read")
        step = -(-width * 3 // 4) * 4  # rows end on a multiple of four bytes
        if len(media) < at + step * abs(height):
            raise ValueError("BMP pixels are cut short")
        rows = np.frombuffer(media, np.uint8, step * abs(height), at).reshape(abs(height), step)
        rgb = rows[:, : width * 3].reshape(abs(height), width, 3)[:, :, ::-1]
        return rgb[::-1] if height > 0 else rgb
    if media[:2] not in (b"P5", b"P6") or not (media[2:3].isspace() or media[2:3] == b"#"):
        raise ValueError("neither BMP nor binary Netpbm")
    (width, height, most), at = netpbm_header(media)
    if not 0 < most < 256 or not width or not height:
        raise ValueError("only eight-bit Netpbm with samples is read")
    depth = 3 if media[:2] == b"P6" else 1
    if len(media) < at + width * height * depth:
        raise ValueError("Netpbm samples are cut short")
    flat = np.frombuffer(media, np.uint8, width * height * depth, at)
    return flat.reshape((height, width, 3) if depth == 3 else (height, width))


def area_resize(grey: np.ndarray, height: int, width: int) -> np.ndarray:
    """Means over the areas of a height x width grid, from an integral image.

    An integral image is linear between samples, so its values at the grid's
    fractional edges are exact sums of fractions of samples.
    """
    total = np.zeros((grey.shape[0] + 1, grey.shape[1] + 1))
    np.cumsum(grey, axis=0, out=total[1:, 1:])
    np.cumsum(total[1:, 1:], axis=1, out=total[1:, 1:])

    def at_edges(values: np.ndarray, n: int) -> np.ndarray:
        edges = np.arange(n + 1) * ((len(values) - 1) / n)
        low = np.minimum(edges.astype(np.int64), len(values) - 2)
        part = (edges - low)[:, None]
        return values[low] * (1 - part) + values[low + 1] * part

    sums = at_edges(at_edges(total, height).T, width).T
    boxes = sums[1:, 1:] - sums[:-1, 1:] - sums[1:, :-1] + sums[:-1, :-1]
    return boxes * (height * width / grey.size)


def features_of(media: bytes) -> tuple[bytes, str, bytes]:
    """Payload, difference hash (16 hex digits) and NPY tile of a stored image."""
    image = decode_image(media)
    payload = image.tobytes()
    grey = image if image.ndim == 2 else image.sum(axis=2) / 3
    small = np.rint(area_resize(grey, 8, 9) * 256).astype(np.int64)
    bits = np.packbits(small[:, 1:] > small[:, :-1])
    out = io.BytesIO()
    np.save(out, np.rint(area_resize(grey, TILE, TILE)).astype(np.uint8))
    return payload, bits.tobytes().hex(), out.getvalue()


def row_of(media: bytes | None) -> tuple:
    """What ``read_media`` says of one stored image; of a damaged one, its size, digest and the fault."""
    whole = (None, None) if media is None else (len(media), hashlib.sha256(media).hexdigest())
    try:
        payload, feature, tile = features_of(media or b"")
    except ValueError as fault:
        return (None, None, None, *whole, None, None, None, str(fault))
    return (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), *whole, feature, tile, hashlib.sha256(tile).hexdigest(), "ok")


def store_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes (of the text) and its stored image, written as a table."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                made = [(n, encode_image(payload)) for n, payload in map(payload_of, part.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([n for n, _ in made], pa.int64()), pa.array([m for _, m in made], pa.binary())], ["doc_id", "n_bytes", "media"])

    lean = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return cut(lean.mapInArrow(encode, STORED), "media")


def read_media(stored: DataFrame) -> DataFrame:
    """The stored images' digests, difference hashes and NPY tiles."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = [row_of(media) for media in part.column("media").to_pylist()]
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.string(), pa.string())
                columns = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("n_bytes"), *columns], [x.split()[0] for x in FEATURES.split(", ")])

    return stored.select("doc_id", "n_bytes", "media").mapInArrow(decode, FEATURES)


def slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Parts of a batch, so that few decoded rows are held at a time."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
