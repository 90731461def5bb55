"""Roles of transcript lines by a hidden Markov model, and canonical turns.

Each line is observed as its speaker marker and a few features of the text after
it (whether it opens its row, a question, a small first letter, its length).  The
states are the roles, each at the first line of a turn or inside one; Viterbi's
path gives every line a role, and ``parse`` renders each row's lines with a header
where a turn begins.

The probabilities are fitted to the transcripts themselves, without labels:
Spark counts, over all lines, which observation follows which (a table of fixed
size, however long the input), and expectation-maximisation on those counts
starts from, and is held towards, stated beliefs (``model``).  Few or no
lines leave the beliefs as they are.

A conversation is a chain however long.  Its rows are range-partitioned by
conversation and position and cut in chunks; a chunk gives the best score from
each state before it to each state at its end (a max-plus product of its steps),
these are chained per conversation, and then each chunk is decoded between its
fixed ends.  That is the exact path, and no task holds more than one chunk of
rows, with all their lines (a row is never parted), and, per conversation, one small
matrix for each chunk.

Null text is one empty line.  A null conversation is one of its own; a null
position sorts first.  Rows that repeat or tie in position follow each other by
hash of their text.  No rows give no rows.  Extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import cut, let
from siltstone.llm.simhash import spark_partitions

CHUNK = 1024
ROLES = ("system", "user", "assistant")
#: States: the roles at a turn's first line, then inside a turn.
STATES = 2 * len(ROLES)

# Speaker markers at a line's start, by role.
MARKERS = {
    "system": r"(?i)^\s*(?:#{1,4}\s*|<\|)?\[?(?:system|sys|instructions?)\]?(?:\|>|\s*[:>])\s*",
    "user": r"(?i)^\s*(?:#{1,4}\s*|<\|)?\[?(?:user|human|customer|you|q)\]?(?:\|>|\s*[:>])\s*",
    "assistant": r"(?i)^\s*(?:#{1,4}\s*|<\|)?\[?(?:assistant|ai|bot|agent|a)\]?(?:\|>|\s*[:>])\s*",
}
# The beliefs that fitting starts from.
OWN_MARKER, NO_MARKER_FIRST, NO_MARKER_INSIDE = 0.75, 0.24, 0.985
OPENS_FIRST, OPENS_INSIDE = 0.9, 0.3
QUESTION = {"system": 0.03, "user": 0.35, "assistant": 0.08}
SMALL_FIRST, SMALL_INSIDE = 0.1, 0.4
LENGTHS = {"system": (0.4, 0.4, 0.2), "user": (0.6, 0.3, 0.1), "assistant": (0.3, 0.4, 0.3)}
START = {"system": 0.25, "user": 0.65, "assistant": 0.1}
GO_ON = 0.35
NEXT = {"system": (0.04, 0.86, 0.1), "user": (0.02, 0.08, 0.9), "assistant": (0.02, 0.92, 0.06)}
#: A belief weighs as much as so many observed lines.  Rounds of fitting.
BELIEF, ROUNDS = 20.0, 200
#: What is observed of a line: marker (none, or a role's), whether it goes on with a row, question, small first letter, length.
SHAPE = (1 + len(ROLES), 2, 2, 2, 3)
CODES = 96


def probabilities(log: np.ndarray) -> np.ndarray:
    return np.where(log > -1e8, np.exp(np.maximum(log, -1e8)), 0.0)


def logs(p: np.ndarray) -> np.ndarray:
    return np.where(p > 0, np.log(np.maximum(p, 1e-300)), -1e9)


def joint(factors: list[np.ndarray]) -> np.ndarray:
    """(states, CODES): a state's features are independent of each other."""
    found = np.ones((STATES, 1))
    for f in factors:
        found = (found[:, :, None] * f[:, None, :]).reshape(STATES, -1)
    return found


def beliefs() -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Probabilities of starting states, of steps, and of each feature by state."""
    n = len(ROLES)
    start, step = np.zeros(STATES), np.zeros((STATES, STATES))
    start[:n] = [START[r] for r in ROLES]
    rows: list[list] = [[] for _ in SHAPE]
    for k, r in enumerate(ROLES):
        for before in (k, k + n):
            step[before, k + n] = GO_ON
            step[before, :n] = (1 - GO_ON) * np.array(NEXT[r])
    for inside in (0, 1):
        for k, r in enumerate(ROLES):
            none = NO_MARKER_INSIDE if inside else NO_MARKER_FIRST
            own = (1 - none) / n if inside else OWN_MARKER
            marker = [none] + [(1 - none - own) / (n - 1)] * n
            marker[k + 1] = own
            opens, low = (OPENS_INSIDE, SMALL_INSIDE) if inside else (OPENS_FIRST, SMALL_FIRST)
            for row, p in zip(rows, (marker, [opens, 1 - opens], [1 - QUESTION[r], QUESTION[r]], [1 - low, low], LENGTHS[r]), strict=True):
                row.append(p)
    return start / start.sum(), step / step.sum(axis=1, keepdims=True), [np.array(x) / np.sum(x, axis=1, keepdims=True) for x in rows]


def model() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-probabilities by belief alone: of starting states, of steps, of observations by state."""
    start, step, factors = beliefs()
    return logs(start), logs(step), logs(joint(factors))


def fitted(starts: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The model of greatest likelihood for observations that start and that follow each other, held towards the beliefs.

    ``starts`` counts first lines by code, ``pairs`` adjacent lines by both codes.
    Each round spreads every count over the states, or pairs of states, by how
    probable they make it, and takes the shares as the next probabilities.
    """
    start0, step0, factors0 = beliefs()
    start, step, factors = start0, step0, factors0
    prior = np.full(STATES, 1 / STATES)  # of the first line of a pair
    for _ in range(ROUNDS):
        seen = joint(factors)
        first = start[:, None] * seen
        first *= np.divide(starts, first.sum(axis=0), out=np.zeros(CODES), where=starts > 0)
        left, right = prior[:, None] * seen, step @ seen
        ratio = np.divide(pairs, left.T @ right, out=np.zeros((CODES, CODES)), where=pairs > 0)
        steps = step * (left @ ratio @ seen.T)
        before, after = left * (right @ ratio.T), seen * (step.T @ (left @ ratio))
        lines = (first + before + after).reshape(STATES, *SHAPE)
        start = first.sum(axis=1) + BELIEF * start0
        start = start / start.sum()
        prior = (before.sum(axis=1) + BELIEF / STATES) / (before.sum() + BELIEF)
        step = steps + BELIEF * step0
        step = step / step.sum(axis=1, keepdims=True)
        counts = [lines.sum(axis=tuple(a + 1 for a in range(len(SHAPE)) if a != k)) + BELIEF * f for k, f in enumerate(factors0)]
        factors = [c / c.sum(axis=1, keepdims=True) for c in counts]
    return logs(start), logs(step), logs(joint(factors))


def counted(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Counts of codes that start a conversation, and of codes by the one before, over all lines of ``ordered``.

    Tasks count their own stretch of rows; what their first and last lines are is
    one row each, and joined here.  At most ``CODES`` times ``CODES`` counts come to the driver.
    """

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, pairs = np.zeros(CODES, np.int64), np.zeros((CODES, CODES), np.int64)
        head = last = None
        for batch in batches:
            for conv, obs in zip(batch["conv"].to_pylist(), batch["obs"], strict=True):
                codes = obs.values.to_numpy()
                if last is None:
                    head = (conv, int(codes[0]))
                elif last[0] == conv:
                    pairs[last[1], codes[0]] += 1
                else:
                    starts[codes[0]] += 1
                np.add.at(pairs, (codes[:-1], codes[1:]), 1)
                last = (conv, int(codes[-1]))
        if last is None:
            return
        task = TaskContext.get().partitionId()
        found = [("start", 0, "", 0, int(a), int(starts[a])) for a in np.flatnonzero(starts)]
        found += [("pair", 0, "", int(a), int(b), int(pairs[a, b])) for a, b in np.argwhere(pairs)]
        found += [("head", task, head[0], 0, head[1], 1), ("tail", task, last[0], 0, last[1], 1)]
        yield pa.RecordBatch.from_pydict(dict(zip(("kind", "task", "conv", "a", "b", "n"), (list(x) for x in zip(*found, strict=True)), strict=True)))

    lean = rows.select("seq", F.md5("conv").alias("conv"), "obs").repartitionByRange("seq").sortWithinPartitions("seq").select("conv", "obs")
    counts = lean.mapInArrow(tally, "kind string, task long, conv string, a long, b long, n long").groupBy("kind", "task", "conv", "a", "b").agg(F.sum("n").alias("n")).collect()
    starts, pairs = np.zeros(CODES), np.zeros((CODES, CODES))
    ends = {}
    for r in counts:
        if r["kind"] == "pair":
            pairs[r["a"], r["b"]] += r["n"]
        elif r["kind"] == "start":
            starts[r["b"]] += r["n"]
        else:
            ends[(r["task"], r["kind"])] = (r["conv"], r["b"])
    before = None
    for task in sorted({t for t, _ in ends}):
        conv, code = ends[(task, "head")]
        if before is not None and before[0] == conv:
            pairs[before[1], code] += 1
        else:
            starts[code] += 1
        before = ends[(task, "tail")]
    return starts, pairs


def observed(line: Column, place: Column) -> Column:
    """The code, 0 to 95, of a row's line at ``place`` (from 0): as ``SHAPE`` says, features being of the text after the marker."""
    marker = F.lit(0)
    for k, r in enumerate(ROLES):
        marker = F.when(line.rlike(MARKERS[r]), k + 1).otherwise(marker)
    goes_on = (place > 0).cast("int")

    def features(bare: Column) -> Column:
        length = F.when(F.length(bare) < 80, 0).when(F.length(bare) < 400, 1).otherwise(2)
        return F.rtrim(bare).endswith("?").cast("int") * 6 + bare.rlike(r"^\s*\p{Ll}").cast("int") * 3 + length

    return marker * 24 + goes_on * 12 + let(bare_text(line), features)


def bare_text(line: Column) -> Column:
    """The line without the marker that was observed; what follows it stays, like a marker or not."""
    found = line
    for pattern in MARKERS.values():  # as in ``observed``, the last that fits
        found = F.when(line.rlike(pattern), F.regexp_replace(line, pattern, "")).otherwise(found)
    return found


def product(codes: np.ndarray, first: bool, parts: tuple) -> np.ndarray:
    """Best scores from each state before the lines to each state at their end.

    For the ``first`` lines of a conversation all rows are the same: there is no state before.
    """
    start, step, seen = parts
    done = np.full((STATES, STATES), -np.inf)
    np.fill_diagonal(done, 0.0)
    for k, code in enumerate(codes):
        if first and k == 0:
            done = np.tile(start + seen[:, code], (STATES, 1))
        else:
            done = (done[:, :, None] + step[None]).max(axis=1) + seen[:, code]
    return done


def decode(codes: np.ndarray, before: int, last: int, parts: tuple) -> np.ndarray:
    """The best states of the lines after state ``before`` (-1: none) that end in ``last`` (-1: any)."""
    start, step, seen = parts
    score = start + seen[:, codes[0]] if before < 0 else step[before] + seen[:, codes[0]]
    back = np.zeros((len(codes), STATES), np.int8)
    for k in range(1, len(codes)):
        ways = score[:, None] + step
        back[k] = ways.argmax(axis=0)
        score = ways.max(axis=0) + seen[:, codes[k]]
    path = np.zeros(len(codes), np.int64)
    path[-1] = score.argmax() if last < 0 else last
    for k in range(len(codes) - 1, 0, -1):
        path[k - 1] = back[k, path[k]]
    return path


def segments(conv: list) -> list[tuple[int, int]]:
    edges = [k for k in range(len(conv)) if k == 0 or conv[k] != conv[k - 1]] + [len(conv)]
    return list(zip(edges, edges[1:], strict=False))


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole chunks of a partition that is sorted by chunk."""
    held: list[pa.Table] = []
    for batch in batches:
        table = pa.Table.from_batches([batch])
        while table.num_rows:
            key = table["chunk"][0].as_py()
            if held and held[0]["chunk"][0].as_py() != key:
                yield pa.concat_tables(held)
                held = []
            n = int(np.searchsorted(table["chunk"].to_numpy(), key, side="right"))
            held.append(table.slice(0, n))
            table = table.slice(n)
    if held:
        yield pa.concat_tables(held)


def chain(frame: pd.DataFrame) -> pd.DataFrame:
    """Of one conversation's chunks: the state before each and the state at its end."""
    frame = frame.sort_values("chunk", ignore_index=True)
    matrices = [np.array(m).reshape(STATES, STATES) for m in frame["matrix"]]
    scores = [matrices[0][0]]
    for m in matrices[1:]:
        scores.append((scores[-1][:, None] + m).max(axis=0))
    last = [int(scores[-1].argmax())]
    for k in range(len(matrices) - 1, 0, -1):
        last.insert(0, int((scores[k - 1] + matrices[k][:, last[0]]).argmax()))
    return pd.DataFrame({"chunk": frame["chunk"], "conv": frame["conv"], "before": [-1, *last[:-1]], "last": last})


def ordered(lines: DataFrame) -> DataFrame:
    """(seq, conv, position, text, obs): rows of (conv, position, text) in order, cut."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = lines.select(F.coalesce(F.col("conv").cast("string"), F.lit("")).alias("conv"), F.col("position").cast("long").alias("position"), text.alias("text")).withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange("conv", "position", "tie").sortWithinPartitions("conv", "position", "tie")
    return cut(rows.withColumn("seq", F.monotonically_increasing_id()).withColumn("obs", F.transform(F.split("text", "\n"), observed)).drop("tie"), "transcripts")


def roles(rows: DataFrame, chunk: int = CHUNK, parts: tuple | None = None) -> DataFrame:
    """(seq, states): the state of every line of each row of ``ordered``, by the model ``parts`` (none: fitted to the rows)."""
    lean = rows.select(F.floor(F.col("seq") / chunk).cast("long").alias("chunk"), "seq", "conv", "obs")
    dealt = lambda: lean.repartition(spark_partitions(rows), "chunk").sortWithinPartitions("chunk", "seq")
    parts = parts or fitted(*counted(rows))

    def flat(table: pa.Table, low: int, high: int) -> np.ndarray:
        return np.concatenate([np.asarray(x, np.int64) for x in table["obs"].slice(low, high - low).to_pylist()])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches):
            conv, key = table["conv"].to_pylist(), table["chunk"][0].as_py()
            found = segments(conv)
            # Only the first and last conversation of a chunk can go on in another.
            for k in sorted({0, len(found) - 1}):
                low, high = found[k]
                codes = flat(table, low, high)
                # Whether it is the conversation's first part is known when the parts meet: both are given.
                both = [product(codes, first, parts).ravel() for first in (True, False)]
                yield pa.RecordBatch.from_arrays([pa.array([conv[low]]), pa.array([key]), *(pa.array([m], pa.list_(pa.float64())) for m in both)], ["conv", "chunk", "opening", "inner"])

    ends = cut(dealt().mapInArrow(summed, "conv string, chunk long, opening array<double>, inner array<double>"), "chunk-ends")
    opening = ends.groupBy("conv").agg(F.min("chunk").alias("opens"))
    matrices = ends.join(opening, "conv").select("conv", "chunk", F.when(F.col("chunk") == F.col("opens"), F.col("opening")).otherwise(F.col("inner")).alias("matrix"))
    fixed = cut(matrices.groupBy("conv").applyInPandas(chain, "chunk long, conv string, before int, last int"), "chunk-states")

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches):
            conv, ends_of = table["conv"].to_pylist(), {}
            for before, last, at in zip(table["before"].to_pylist(), table["last"].to_pylist(), conv, strict=True):
                if last is not None:
                    ends_of[at] = (before, last)
            states: list[list[int]] = []
            for low, high in segments(conv):
                path = decode(flat(table, low, high), *ends_of.get(conv[low], (-1, -1)), parts).tolist()
                for obs in table["obs"].slice(low, high - low).to_pylist():
                    states.append(path[: len(obs)])
                    path = path[len(obs) :]
            yield pa.RecordBatch.from_arrays([table["seq"].combine_chunks(), pa.array(states, pa.list_(pa.int32()))], ["seq", "states"])

    bound = lean.join(fixed, ["chunk", "conv"], "left")
    return bound.repartition(spark_partitions(rows), "chunk").sortWithinPartitions("chunk", "seq").mapInArrow(decoded, "seq long, states array<int>")


def parse(lines: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Rows of (conv, position, text) with role, turns_begun, n_lines and rendered.

    ``role`` is that of a row's first line; ``rendered`` has a header line
    ``<|role|>`` before each line at which a turn begins, and no speaker markers.
    """
    rows = ordered(lines)
    n = len(ROLES)
    named = lambda s: F.element_at(F.array(*map(F.lit, ROLES)), s % n + 1)
    found = rows.join(roles(rows, chunk), "seq")
    line = F.zip_with(F.split("text", "\n"), F.col("states"), lambda x, s: F.when(s < n, F.concat(F.lit("<|"), named(s), F.lit("|>\n"), bare_text(x))).otherwise(x))
    return found.select("conv", "position", named(F.element_at("states", 1)).alias("role"), F.size(F.filter("states", lambda s: s < n)).alias("turns_begun"), F.size("states").alias("n_lines"), F.array_join(line, "\n").alias("rendered"))


# The ways in which raw transcripts mark their speakers.
STYLES = (
    {"system": "System: ", "user": "User: ", "assistant": "Assistant: "},
    {"system": "### Instruction: ", "user": "### Human: ", "assistant": "### Assistant: "},
    {"system": "[system]: ", "user": "Q: ", "assistant": "A: "},
    {"system": "SYSTEM> ", "user": "Customer> ", "assistant": "Agent> "},
)


def raw_transcripts(turns: DataFrame) -> DataFrame:
    """(conv, position, text): turns as raw transcripts have them, one in five without its marker."""
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(STYLES)))
    mark = F.lit("")
    for k, found in enumerate(STYLES):
        for role, text in found.items():
            mark = F.when((style == k) & (F.col("role") == role), text).otherwise(mark)
    bare = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(5)) == 0
    text = F.concat(F.when(bare, F.lit("")).otherwise(mark), F.coalesce(F.col("text").cast("string"), F.lit("")))
    return turns.select(F.col("conv_id").alias("conv"), F.col("turn").alias("position"), text.alias("text"))
