"""Packing whole documents into windows by non-negative least squares on the histogram of their lengths.

A document's whole windows stand alone; its remainder, shorter than a window, is one piece. Shallow combinations of
remainder lengths that fill a window exactly are the columns of a system whose right side is the histogram.
Its non-negative solution says how often each combination is used. Rounded down, then filled up greedily,
it places most remainders whole. What is left over is laid end to end and cut at window ends; the last,
unfilled window is cut into powers of two, which need no padding.

Only the histogram, at most one row per length, comes to the driver. A remainder finds its place from
its rank among those of its length, which is counted per input partition, so a length that a third of
all documents share is placed by many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tracewell.llm.encoding import encode_texts, encoder
from tracewell.llm.textbytes import text_buffer
from tracewell.llm.token_files import unpack
from tracewell.session import prepare, stage

WINDOW = 2048
DEPTH = 6
DRAWN = 1200  # combinations per depth above two, of those drawn at random by the lengths' shares
STEPS = 300
ROUNDS = 12
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def combinations(counts: np.ndarray, window: int, seed: int = 0) -> list[tuple[int, ...]]:
    """Different multisets of occurring lengths whose sum is ``window``: all pairs, and drawn ones of three to ``DEPTH``."""
    present = np.flatnonzero(counts)
    here = counts > 0
    found = {(int(a), window - int(a)) for a in present if 2 * a <= window and here[window - a]}
    found |= {(int(a),) * (window // int(a)) for a in present if 2 < window // a <= DEPTH and window % a == 0}
    rng = np.random.default_rng(41 + seed)
    cumulated = np.cumsum(counts[present]) / max(counts.sum(), 1)
    for depth in range(3, DEPTH + 1):
        drawn = present[np.searchsorted(cumulated, rng.random((8 * DRAWN, depth - 1))).clip(0, len(present) - 1)] if len(present) else np.zeros((0, depth - 1), int)
        rest = window - drawn.sum(axis=1)
        fits = (rest > 0) & here[np.clip(rest, 0, window - 1)] & (rest < window)
        chosen = np.sort(np.column_stack([drawn[fits], rest[fits]]), axis=1)
        # in the order drawn, so that no length is favoured
        _, order = np.unique(chosen, axis=0, return_index=True)
        found |= set(map(tuple, chosen[np.sort(order)[:DRAWN]].tolist())) if len(chosen) else set()
    return sorted(found)


def repeats(columns: list[tuple[int, ...]], counts: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """How often to use each combination: accelerated projected gradient on ||A x - counts||, x >= 0."""
    if not columns:
        return np.zeros(0)
    flat = np.concatenate([np.array(c) for c in columns])
    owner = np.repeat(np.arange(len(columns)), [len(c) for c in columns])
    scale = float(counts.max())
    goal = counts / scale
    use = lambda x: np.bincount(flat, weights=x[owner], minlength=len(counts))
    back = lambda r: np.bincount(owner, weights=r[flat], minlength=len(columns))
    probe = np.ones(len(columns))
    for _ in range(30):
        probe = back(use(probe))
        norm = np.linalg.norm(probe)
        probe /= norm
    x = y = np.zeros(len(columns))
    momentum = 1.0
    for _ in range(steps):
        new = np.maximum(y - back(use(y) - goal) / (1.05 * norm), 0)
        following = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        y = new + (momentum - 1) / following * (new - x)
        x, momentum = new, following
    return x * scale


class Plan:
    """Where the piece of a given length and rank goes. Its tables have at most a few entries per combination and length."""

    def __init__(self, counts: np.ndarray, whole: int, window: int = WINDOW):
        """``counts``: number of remainders by length 0..window-1; ``whole``: number of full windows."""
        self.window = window
        self.counts = counts = counts.astype(np.int64)
        left = counts.copy()
        shapes: list[tuple[np.ndarray, np.ndarray]] = []
        uses: list[int] = []
        for turn in range(ROUNDS):   # each turn combines the lengths that the turns before it left over
            columns = combinations(left, window, turn)
            solved = repeats(columns, left)
            mine = [np.unique(np.array(c), return_counts=True) for c in columns]
            used = np.zeros(len(columns), dtype=np.int64)
            before = int(left.sum())
            for wanted in (lambda p: int(solved[p]), lambda p: 1 << 62):   # the rounded solution, then whatever still fits
                for p in np.argsort(-solved, kind="stable").tolist():
                    lengths, times = mine[p]
                    n = min(wanted(p), int((left[lengths] // times).min()))
                    used[p] += n
                    left[lengths] -= n * times
            shapes += [mine[p] for p in np.flatnonzero(used)]
            uses += used[used > 0].tolist()
            if before - int(left.sum()) < 0.01 * before:
                break
        # intervals of ranks, per length; the ranks of all lengths stand on one line
        self.line = np.concatenate([[0], np.cumsum(counts)])
        taken = np.zeros(window, dtype=np.int64)
        rows, sequence = [], whole
        for p in range(len(uses)):
            at = 0
            for length, times in zip(*(v.tolist() for v in shapes[p])):
                rows.append((self.line[length] + taken[length], times, sequence, at, -1))
                taken[length] += times * uses[p]
                at += times * length
            sequence += uses[p]
        self.stream = sequence
        position = 0
        for length in range(window - 1, 0, -1):
            if left[length]:
                rows.append((self.line[length] + taken[length], 1, 0, 0, position))
                position += int(left[length]) * length
        table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
        self.low, self.times, self.sequence, self.at, self.position = table.T
        self.uncut = int(counts.sum() - left.sum())
        # ends of the stream's windows beyond the last full one: powers of two, largest first
        self.body = position // window * window
        rest, self.tail = position - self.body, [self.body]
        while rest:
            size = 1 << (rest.bit_length() - 1)
            self.tail.append(self.tail[-1] + size)
            rest -= size

    def places(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sequence, offset and, for remainders in the stream, position there (else -1)."""
        at = self.line[lengths] + ranks
        row = np.searchsorted(self.low, at, side="right") - 1
        k = at - self.low[row]
        times = self.times[row]
        position = self.position[row]
        streamed = np.where(position >= 0, position + k * lengths, -1)
        return self.sequence[row] + k // times, self.at[row] + k % times * lengths, streamed

    def cut(self, position: int, length: int) -> list[tuple[int, int, int, int]]:
        """Stretch of the stream as (start in the piece, length, sequence, offset)."""
        out, done = [], 0
        while done < length:
            here = position + done
            if here < self.body:
                number, low, high = here // self.window, here // self.window * self.window, (here // self.window + 1) * self.window
            else:
                i = int(np.searchsorted(self.tail, here, side="right")) - 1
                number, low, high = self.body // self.window + i, self.tail[i], self.tail[i + 1]
            size = min(length - done, high - here)
            out.append((done, size, self.stream + number, here - low))
            done += size
        return out


def _encoded(docs: DataFrame, tokenizer: str, end_id: int, spaced: bool, window: int) -> DataFrame:
    """Documents with their ids, the input partition, and counts of what came before them there."""
    schema = "doc_id long, part int, n long, rest int, rank long, whole_before long, wide boolean, ids binary"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, spaced)
        part = TaskContext.get().partitionId()
        seen, whole = [0] * window, 0
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            out: list[list] = [[] for _ in range(6)]
            for each in encode_texts(enc, data, offsets, end_id):
                n, rest = len(each), len(each) % window
                broad = int(each.max()) > 0xFFFF
                for values, v in zip(out, (n, rest, seen[rest], whole, broad, each.astype("<u4" if broad else "<u2").tobytes())):
                    values.append(v)
                seen[rest] += 1
                whole += n // window
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.full(len(batch), part, dtype=np.int32)), *(pa.array(v, k) for v, k in zip(out, kinds))],
                ["doc_id", "part", "n", "rest", "rank", "whole_before", "wide", "ids"])
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return base.mapInArrow(rows, schema)


def pack(docs: DataFrame, tokenizer: str, end_id: int, spaced: bool = True, window: int = WINDOW) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids (little-endian 32 bit), doc_tokens, sequence_id, offset.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. A document's ids are those of its whole text (null:
    empty) and ``end_id``; each lies in exactly one piece. Every row is a document of its own, repeated ids or not.
    An empty table gives no pieces. Sequences are gapless and hold ``window`` ids, or a power of two at the very end.
    """
    prepare(docs.sparkSession)
    table = stage(_encoded(docs, tokenizer, end_id, spaced, window), "encoded")
    rests = table.where("rest > 0").groupBy("part", F.col("rest").alias("length")).agg(F.count("*").alias("n"))
    fulls = table.groupBy("part").agg(F.sum(F.floor(F.col("n") / window)).cast("long").alias("n"))
    counts = stage(rests.unionByName(fulls.select("part", F.lit(window).alias("length"), "n")), "length-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = Plan(np.array([histogram.get(length, 0) for length in range(window)]), histogram.get(window, 0), window)
    lower = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.withColumn("base", F.coalesce(F.sum("n").over(lower), F.lit(0)))
    # one row per input partition, and one per partition and occurring length
    whole = bases.where(F.col("length") == window).select("part", F.col("base").alias("whole_base"))
    rest = bases.where(F.col("length") < window).select("part", F.col("length").alias("rest"), F.col("base").alias("rest_base"))
    placed = table.join(F.broadcast(whole), "part").join(rest, ["part", "rest"], "left").select(
        "doc_id", "n", "rest", (F.col("rank") + F.coalesce("rest_base", F.lit(0))).alias("rank"),
        (F.col("whole_base") + F.col("whole_before")).alias("first_whole"), "wide", "ids")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        for batch in batches:
            rest = batch.column("rest").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            if plan.counts.sum():
                sequence, offset, streamed = (v.tolist() for v in plan.places(rest, rank))
            out: list[list] = [[] for _ in names]
            for k, (doc, n, first, wide, ids) in enumerate(zip(*(batch.column(c).to_pylist() for c in (
                    "doc_id", "n", "first_whole", "wide", "ids")))):
                full = n // window
                pieces = [(i * window, window, first + i, 0) for i in range(full)]
                if rest[k]:
                    begin = full * window
                    pieces += ([(begin, int(rest[k]), sequence[k], offset[k])] if streamed[k] < 0 else
                               [(begin + a, size, s, o) for a, size, s, o in plan.cut(streamed[k], int(rest[k]))])
                raw = unpack(ids, wide).astype("<u4").tobytes()
                for start, size, s, o in pieces:
                    for values, v in zip(out, (doc, start, size, raw[4 * start:4 * (start + size)], n, s, o)):
                        values.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds)], names)
    return placed.mapInArrow(rows, PIECES)
