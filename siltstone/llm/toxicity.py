"""Toxicity by compression distance under two zstandard dictionaries.

One dictionary is trained on windows of ordinary text, one on windows of toxic
text.  Most of a toxic document is ordinary, so its windows are first told apart by
compression itself (``toxic_windows``): of two halves of the toxic documents, each
is judged by a dictionary trained on the other, and those windows stay that it
shortens far more often than windows of ordinary text; each is then narrowed to that word
without which it loses most.  Both dictionaries end in a part of one size,
of toxic or of more ordinary content, and share what lies before, so that common
words cost the same under both; a window's gain is by how many bytes it gets shorter.  A document's score follows
from its windows' gains by a calibration that is fitted on labelled documents
that the dictionaries have not seen.

A bounded sample of labelled documents is fitted on (``SAMPLE``); every document
is scored by all its windows.  Null text is the empty text, which has no window
and scores lowest.  Very long texts are cut in windows like others.  Repeated
rows get equal scores.  If a class has no labelled documents there is nothing to
tell apart, and all score 0.  Extra columns are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.7
#: Labelled documents fitted on: so many of each class at most, of at most so many characters each.
SAMPLE = 2500
SAMPLE_CHARS = 20_000
#: Words in a window, and in those that the toxic dictionary is chosen from.
WINDOW, SPAN = 5, 3
ORDINARY_BYTES, TOXIC_BYTES = 8_192, 2_048
#: Sizes of the dictionaries by which windows are chosen, and of ordinary windows held against them.
BASE_BYTES, CHOICE_BYTES, CHOICE_WINDOWS = 65_536, 16_384, 60_000
#: Windows are candidates if they cost more, for their length, than this share of ordinary ones.
COSTLY = 0.8
#: A gain tells if it is so many times as frequent in toxic windows.  Rounds of choosing.
ENRICHED, ROUNDS = 8, 5
#: Bytes that a chosen word gains at least under the other half's dictionary.
LEAST_GAIN = 2
#: A clean document called toxic costs as much as so many toxic ones missed, in shares of either.
CLEAN_WEIGHT = 3
FEATURES = 3


def held_out(doc_id):
    """Whether the CRC-32 of the id's text leaves 1 when divided by 3."""
    return (F.crc32(doc_id.cast("string").cast("binary")) % 3) == 1


#: ASCII bytes that are neither letters nor digits part words.
PARTED = bytes(x if x > 127 or chr(x).isalnum() else 32 for x in range(256))
#: Stands before each window and at the start of each dictionary, so that every
#: window can be shortened: a block that cannot is stored as it is, and its length tells nothing.
LEAD = b"\n" * 64
#: Stands after each window: matches are not looked for in a block's last bytes.
TAIL = b"\n" * 12


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "replace").translate(PARTED).split()


def windows(text: str | None) -> list[bytes]:
    words = words_of(text)
    return [b" " + b" ".join(words[k : k + WINDOW]) + b" " for k in range(0, len(words), WINDOW)]


def trained(size: int, samples: list[bytes], segment: int = 32) -> bytes:
    """A dictionary's bytes, trained in segments of so many; of few different samples, those themselves."""
    distinct = b"".join(dict.fromkeys(samples))
    if len(distinct) > segment and len(samples) > 200:
        try:
            return zstandard.train_dictionary(size, samples, k=segment, d=6).as_bytes()[-size:]
        except zstandard.ZstdError:
            pass
    return distinct[-size:]


@dataclass
class Model:
    """Contents of the dictionaries, and the calibration's weights (the last is the constant)."""

    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...] | None = None

    def gains(self, parts: list[bytes]) -> np.ndarray:
        """By how many bytes each window is shorter under the toxic dictionary."""
        if not hasattr(self, "_tools"):
            self._tools = [compressor(self.ordinary), compressor(self.toxic)]
        plain, toxic = self._tools
        return np.array([len(plain.compress(LEAD + x + TAIL)) - len(toxic.compress(LEAD + x + TAIL)) for x in parts], np.float64)

    def features(self, text: str | None) -> np.ndarray:
        gains = np.sort(self.gains(windows(text)))[::-1]
        top = np.concatenate([gains[:2], np.zeros(2)])[:2]
        return np.array([top[0], top[1], np.log1p(len(gains)), 1.0])

    def score(self, text: str | None) -> float:
        if self.weights is None:
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(self.features(text) @ np.array(self.weights), -30, 30))))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_tools"}


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    kept = zstandard.ZstdCompressionDict(content or b" " * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    how = zstandard.ZstdCompressionParameters(window_log=18, chain_log=15, hash_log=16, search_log=4, min_match=6, target_length=32, strategy=zstandard.STRATEGY_LAZY, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0)
    kept.precompute_compress(compression_params=how)
    return zstandard.ZstdCompressor(dict_data=kept, compression_params=how)


def costs(content: bytes, parts: list[bytes]) -> np.ndarray:
    tool = compressor(content)
    return np.array([len(tool.compress(LEAD + x + TAIL)) for x in parts], np.float64)


def paired(plain: bytes, marked: bytes) -> Model:
    """Two dictionaries of one size: ``marked``, or as much ordinary content, after ``plain``.

    The same content lies equally far from a window under both.
    """
    return Model(plain + plain[len(LEAD) : len(LEAD) + len(marked)], plain + marked)


def enriched(found: np.ndarray, ordinary: np.ndarray) -> float:
    """The least gain that is ``ENRICHED`` times as frequent in ``found`` as in ``ordinary``, else the most telling one."""
    ratio = {c: np.mean(found >= c) / ((np.sum(ordinary >= c) + 1) / (len(ordinary) + 1)) for c in range(1, 12)}
    return next((c for c, r in ratio.items() if r >= ENRICHED), max(ratio, key=ratio.get))


def mixed_order(parts: list[bytes]) -> list[bytes]:
    """``parts`` in an order that does not depend on their contents' order: training takes segments from each stretch."""
    parts = sorted(parts)
    return [parts[k] for k in sorted(range(len(parts)), key=lambda k: zlib.crc32(str(k).encode()))]


def toxic_windows(toxic: list[str], ordinary: list[str]) -> list[bytes]:
    """The windows of toxic text that tell, narrowed to one word each, by compressed lengths alone.

    Each half of the documents is judged by what is trained on the other.  Windows
    that stand in both halves or in ordinary text are left out, so that copied texts do not vouch for themselves.
    """

    def spans(texts: list[str]) -> set[bytes]:
        found = (words_of(t) for t in texts)
        return {b" " + b" ".join(w[k : k + SPAN]) + b" " for w in found for k in range(max(len(w) - SPAN + 1, min(len(w), 1)))}

    plain = LEAD + trained(BASE_BYTES, [w for t in ordinary for w in windows(t)])
    halves = [spans([t for t in toxic if zlib.crc32(t.encode("utf-8", "replace")) // 3 % 2 == h]) for h in (0, 1)]
    known = spans(ordinary)
    halves = [sorted(x - halves[1 - h] - known) for h, x in enumerate(halves)]
    against = sorted(known)
    against = against[:: max(1, len(against) // CHOICE_WINDOWS)]
    if not against or not all(halves):
        return [w for t in toxic for w in windows(t)]

    # what ordinary content explains well is no candidate
    of_length = lambda parts: np.array([[len(x), 1.0] for x in parts])
    cost = costs(plain, against)
    line = np.linalg.lstsq(of_length(against), cost, rcond=None)[0]
    excess = lambda parts, cost: cost - of_length(parts) @ line
    least = np.quantile(excess(against, cost), COSTLY)
    costly = lambda parts: [w for w, x in zip(parts, excess(parts, costs(plain, parts)), strict=True) if x >= least]
    against, halves = costly(against), [costly(x) for x in halves]

    def judge(other: list[bytes], size: int, segment: int) -> Model:
        return paired(plain, trained(size, mixed_order(other), segment))

    chosen = halves
    for _ in range(ROUNDS):
        after = []
        for h in (0, 1):
            model = judge(chosen[1 - h], CHOICE_BYTES, 16)
            gains = model.gains(halves[h])
            least = enriched(gains, model.gains(against)) if len(gains) else 0
            after.append([w for w, g in zip(halves[h], gains, strict=True) if g >= least])
        chosen = after

    narrowed = []
    for h in (0, 1):
        model = judge(chosen[1 - h], CHOICE_BYTES, 16)
        words = [w.split() for w in chosen[h]]
        left = iter(model.gains([b" " + b" ".join(w[:k] + w[k + 1 :]) + b" " for w in words for k in range(len(w))]))
        narrowed.append([b" " + w[int(np.argmin([next(left) for _ in w]))] + b" " for w in words])
    kept = []
    for h in (0, 1):
        gains = judge(narrowed[1 - h], TOXIC_BYTES, 16).gains(narrowed[h])
        kept += [w for w, g in zip(narrowed[h], gains, strict=True) if g >= LEAST_GAIN]
    return kept or [w for t in toxic for w in windows(t)]


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 60, ridge: float = 1e-3) -> np.ndarray:
    """Weights by Newton's method, both classes weighing the same."""
    share = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (share * (p - y)) + ridge * w
        curve = (x * (share * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-9))
    return w


def fit(texts: list[str], labels: list[int]) -> Model:
    """Dictionaries from two thirds of the sample, the calibration from the rest."""
    part = np.array([zlib.crc32(t.encode("utf-8", "replace")) % 3 for t in texts])
    y = np.array(labels)
    toxic = [t for t, l, k in zip(texts, labels, part, strict=True) if l == 1 and k]
    ordinary = [t for t, l, k in zip(texts, labels, part, strict=True) if l == 0 and k]
    if not toxic or not ordinary:
        return Model(b"", b"")
    plain = LEAD + trained(ORDINARY_BYTES, [w for t in ordinary for w in windows(t)])
    model = paired(plain, trained(TOXIC_BYTES, mixed_order(toxic_windows(toxic, ordinary)), 64))
    rest = np.flatnonzero(part == 0)
    if len(set(y[rest])) < 2:
        rest = np.arange(len(y))
    x = np.array([model.features(texts[k]) for k in rest])
    w = logistic(x, y[rest])
    # Of the cuts between classes, the best by both shares of right ones, CLEAN_WEIGHT for clean ones, gets the score THRESHOLD.
    z = x @ w
    order = np.sort(np.unique(z))
    cuts = (order[1:] + order[:-1]) / 2 if len(order) > 1 else order
    # equally good cuts: the middle one
    good = np.array([np.mean(z[y[rest] == 1] >= c) + CLEAN_WEIGHT * np.mean(z[y[rest] == 0] < c) for c in cuts])
    best = cuts[np.flatnonzero(good >= good.max() - 1e-12)]
    model.weights = (*w[:-1], w[-1] - (best[0] + best[-1]) / 2 + np.log(THRESHOLD / (1 - THRESHOLD)))
    return model


def sample(docs: DataFrame, labels: DataFrame, label: str, most: int = SAMPLE, chars: int = SAMPLE_CHARS) -> DataFrame:
    """(doc_id, text, y): labelled documents that are not held out, ``most`` of each class at most.

    Those of lowest hash of doc_id are taken, so the sample does not depend on order.
    """
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where(~held_out(F.col("doc_id")) & F.col("y").isin(0, 1))
    chosen = None
    for y in (0, 1):
        some = usable.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        chosen = some if chosen is None else chosen.unionByName(some)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").where(F.length("text") <= chars).select("doc_id", "text", "y")  # 2 x most ids


def trained_model(docs: DataFrame, labels: DataFrame) -> Model:
    rows = sample(docs, labels, "toxic").orderBy("doc_id", "text").limit(2 * SAMPLE).collect()  # bounded by SAMPLE and SAMPLE_CHARS
    return fit([r["text"] for r in rows], [r["y"] for r in rows])


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and the score of each whole text."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.score(x) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"])

    lean = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return lean.mapInArrow(scored, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted."""
    found = scores(docs, trained_model(docs, labels))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
