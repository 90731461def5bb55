"""Quality classification by positive-unlabelled learning.

Trusted positives are labelled documents of quality 1; all other text is
unlabelled.  First a plain classifier of positives against unlabelled text gives
a ranking, from whose top the class prior is estimated: the share of unlabelled
over the share of positive documents above a cut, least over the cuts, with
confidence margins.  Then the non-negative unbiased risk
``prior R+(positives) + max(0, R-(unlabelled) - prior R-(positives))`` is minimised.

The model is linear in steps of shares of symbols, capitals, repetitions and the
like.  A bounded sample is fitted on (``SAMPLE``); every whole text is scored.
Null text is the empty text: all its shares are zero, and it scores as clean text
without evidence does.  Repeated rows get equal scores.  With no positives at all
every document scores the prior one half.  Extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.toxicity import held_out

THRESHOLD = 0.5
#: Documents fitted on: so many positives and unlabelled ones at most.
SAMPLE = 8000
#: Each share gives one step feature for each of these that it is over.
STEPS = (0.002, 0.01, 0.03, 0.06, 0.1, 0.2, 0.35, 0.6)
SHARES = ("symbols", "pipes", "exclaims", "capitals", "digits", "same_next", "four_again", "lines_again", "long_words")
N_FEATURES = len(SHARES) * len(STEPS) + 1

UPPER, SYMBOLS, DIGITS = bytes(range(65, 91)), b"#*$%&<>", bytes(range(48, 58))


def shares(text: str | None) -> list[float]:
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    n, chars = max(1, len(words)), max(1, sum(map(len, words)))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    fours = list(zip(words, words[1:], words[2:], words[3:], strict=False))
    return [
        (len(raw) - len(raw.translate(None, SYMBOLS))) / chars,
        raw.count(b"|") / n,
        raw.count(b"!") / n,
        (len(raw) - len(raw.translate(None, UPPER))) / chars,
        (len(raw) - len(raw.translate(None, DIGITS))) / chars,
        sum(map(eq, words, words[1:])) / n,
        1 - len(set(fours)) / len(fours) if fours else 0.0,
        1 - len(set(lines)) / len(lines) if lines else 0.0,
        sum(1 for w in words if len(w) > 30) / n,
    ]


def steps(found: np.ndarray) -> np.ndarray:
    """Step features of rows of shares, and a constant."""
    over = (found[:, :, None] > np.array(STEPS)).reshape(len(found), found.shape[1] * len(STEPS))
    return np.column_stack([over, np.ones(len(found))]).astype(np.float64)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def descend(slope, size: int, rounds: int = 600, rate: float = 0.05, decay: float = 1e-4) -> np.ndarray:
    """Adam on ``slope(weights)``."""
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for k in range(1, rounds + 1):
        g = slope(w) + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    return w


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled, from both rankings' tops."""

    def slope(w: np.ndarray) -> np.ndarray:
        return -positive.T @ (1 - sigmoid(positive @ w)) / len(positive) + unlabelled.T @ sigmoid(unlabelled @ w) / len(unlabelled)

    w = descend(slope, positive.shape[1], 300)
    p, u = np.sort(positive @ w), np.sort(unlabelled @ w)
    cuts = np.unique(np.quantile(p, np.linspace(0, 0.9, 91)))
    of_p = 1 - np.searchsorted(p, cuts) / len(p)
    of_u = 1 - np.searchsorted(u, cuts) / len(u)
    margin = np.sqrt(np.log(20) / (2 * len(p))) + np.sqrt(np.log(20) / (2 * len(u)))
    at = np.argmin((of_u + margin) / of_p)
    return float(np.clip(of_u[at] / of_p[at], 0.01, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights that minimise the non-negative unbiased risk, and the class prior."""
    prior = estimate_prior(positive, unlabelled)

    def slope(w: np.ndarray) -> np.ndarray:
        # Sigmoid loss: l(z) = 1 / (1 + exp(z)).
        sp, su = sigmoid(positive @ w), sigmoid(unlabelled @ w)
        dp, du = positive.T @ (sp * (1 - sp)) / len(sp), unlabelled.T @ (su * (1 - su)) / len(su)
        negative = su.mean() - prior * sp.mean()
        rest = du - prior * dp
        return rest * -1.0 if negative < 0 else rest - prior * dp

    return descend(slope, positive.shape[1]), prior


def sample_features(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Step features of the sampled positives and unlabelled documents.

    Held-out ids are in neither.  Those of lowest hash of doc_id are taken, by another hash for each.
    """
    spark = docs.sparkSession
    order = (F.xxhash64(F.col("doc_id"), F.lit(7)), F.col("doc_id"))
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y")).where(~held_out(F.col("doc_id")))
    positive = usable.where("y = 1").orderBy(*order).limit(SAMPLE).select("doc_id", F.lit(1).alias("y"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where(~held_out(F.col("doc_id")))
    # Known positives among them stay: the prior is that of all the text, at every size.
    web = ids.orderBy(F.xxhash64(F.col("doc_id"), F.lit(11)), "doc_id").limit(SAMPLE)
    chosen = positive.unionByName(web.select("doc_id", F.lit(0).alias("y"))).collect()  # 2 x SAMPLE ids
    chosen = spark.createDataFrame(chosen, "doc_id long, y int")

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shares(x) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(found, pa.list_(pa.float64()))], ["doc_id", "y", "shares"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = texts.mapInArrow(measured, "doc_id long, y int, shares array<double>").orderBy("doc_id", "y", "shares").limit(4 * SAMPLE).collect()
    parts = [np.array([r["shares"] for r in rows if r["y"] == y]).reshape(-1, len(SHARES)) for y in (1, 0)]
    return steps(parts[0]), steps(parts[1])


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted."""
    positive, unlabelled = sample_features(docs, labels)
    weights = fit(positive, unlabelled)[0] if len(positive) and len(unlabelled) else np.zeros(N_FEATURES)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([shares(x) for x in batch.column("text").to_pylist()]).reshape(-1, len(SHARES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sigmoid(steps(found) @ weights))], ["doc_id", "score"])

    lean = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = lean.mapInArrow(scored, "doc_id long, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
