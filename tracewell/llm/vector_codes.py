"""Vector code compression: product codes whose nearest entries come from memoised grid cells.

1. A vector of integers is cut into ``PARTS`` equal parts; each part position has a codebook, which starts as that part of
   the vectors with the smallest ids.
2. A part falls into a coarse cell of a grid. For each cell a task sees, the entries that may be nearest to some point of the cell's box are
   kept in a memo: those whose least distance to the box is no more than the smallest of all greatest distances. Only these are measured
   exactly, so codes, ties included, are those of a full search.
3. A round replaces each entry by the floor of the mean of its parts. Tasks add up their parts first; one row per task, entry and component
   is shuffled, and only the codebooks reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tracewell.llm.textbytes import mix, spread
from tracewell.llm.vectors import matrix, same_width, whole_rows
from tracewell.session import prepare, stage

PARTS = 16
ENTRIES = 64
ROUNDS = 2
CELLS_AT_ONCE = 2048      # cells whose bounds are worked out together
MEMO_CELLS = 1 << 18      # cells a memo holds before it starts anew


@dataclass(frozen=True)
class Codebooks:
    """``entries``: parts x entries x components of a part, whole numbers."""

    entries: np.ndarray

    @property
    def width(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


class CellMemo:
    """Nearest entries of one part position's codebook, found through the grid cells seen so far."""

    def __init__(self, book: np.ndarray, most: int = MEMO_CELLS):
        self.book, self.most = book, most
        # cells about half as wide as the entries are spread along a component
        self.shift = max(int(np.std(book) / 2).bit_length() - 1, 0) if book.size else 0
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.cells = np.zeros((0, self.book.shape[1]), dtype=np.int64)
        self.bounds = np.zeros(1, dtype=np.int64)
        self.flat = np.zeros(0, dtype=np.int64)

    def _hash(self, cells: np.ndarray) -> np.ndarray:
        out = np.zeros(len(cells), dtype=np.uint64)
        for column in cells.T:
            out = mix(out * np.uint64(0xA0761D6478BD642F) + column.astype(np.uint64))
        return out

    def _not_dominated(self, cells: np.ndarray) -> np.ndarray:
        """cells x entries: whether an entry may be nearest, or tie, somewhere in the cell's box."""
        low = cells << self.shift
        high = low + (1 << self.shift) - 1
        near = np.zeros((len(cells), len(self.book)), dtype=np.int64)
        far = np.zeros_like(near)
        for d in range(self.book.shape[1]):
            under, over = low[:, d, None] - self.book[None, :, d], self.book[None, :, d] - high[:, d, None]
            gap = np.maximum(np.maximum(under, over), 0)
            near += gap * gap
            reach = np.maximum(-under, -over)      # to the further side of the box
            far += reach * reach
        return near <= far.min(axis=1, keepdims=True)

    def _learn(self, keys: np.ndarray, cells: np.ndarray) -> None:
        if len(self.keys) + len(keys) > self.most:
            self._clear()
        sizes, flat = [], []
        for a in range(0, len(cells), CELLS_AT_ONCE):
            row, entry = np.nonzero(self._not_dominated(cells[a:a + CELLS_AT_ONCE]))
            sizes.append(np.bincount(row, minlength=len(cells[a:a + CELLS_AT_ONCE])))
            flat.append(entry)
        starts = np.concatenate([self.bounds[:-1], len(self.flat) + np.cumsum(np.concatenate(sizes)) - np.concatenate(sizes)])
        lengths = np.concatenate([np.diff(self.bounds), np.concatenate(sizes)])
        all_keys, all_flat = np.concatenate([self.keys, keys]), np.concatenate([self.flat, *flat])
        order = np.argsort(all_keys, kind="stable")
        self.keys, self.cells = all_keys[order], np.concatenate([self.cells, cells])[order]
        self.flat = all_flat[spread(starts[order], lengths[order])]
        self.bounds = np.concatenate([[0], np.cumsum(lengths[order])])

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of and squared distance to the nearest entry of each part; the lower index of equals."""
        cells = parts >> self.shift
        keys = self._hash(cells)
        new, first = np.unique(keys, return_index=True)
        unseen = ~np.isin(new, self.keys, assume_unique=True)
        if unseen.any():
            if len(self.keys) + unseen.sum() > self.most:
                unseen[:] = True
                self._clear()
            self._learn(new[unseen], cells[first[unseen]])
        at = np.searchsorted(self.keys, keys)
        sizes = np.diff(self.bounds)[at]
        starts = self.bounds[at]
        candidates = self.flat[spread(starts, sizes)]
        clash = np.flatnonzero((self.cells[at] != cells).any(axis=1))      # another cell with the same 64-bit hash
        owner = np.repeat(np.arange(len(parts)), sizes)
        distance = ((parts[owner] - self.book[candidates]) ** 2).sum(axis=1)
        begin = np.cumsum(sizes) - sizes
        least = np.minimum.reduceat(distance, begin)
        # entries stand in ascending order: the first that reaches the least distance has the lowest index
        reached = np.flatnonzero(distance == least[owner])
        index = candidates[reached[np.searchsorted(reached, begin)]]
        for i in clash.tolist():
            every = ((parts[i] - self.book) ** 2).sum(axis=1)
            index[i], least[i] = every.argmin(), every.min()
        return index, least


def _memos(books: Codebooks) -> list[CellMemo]:
    return [CellMemo(book) for book in books.entries]


def _assign(values: np.ndarray, memos: list[CellMemo]) -> tuple[np.ndarray, np.ndarray]:
    """rows x parts: entry and squared distance."""
    parts = len(memos)
    split = values.reshape(len(values), parts, -1)
    found = [memo.nearest(np.ascontiguousarray(split[:, p])) for p, memo in enumerate(memos)]
    return np.stack([i for i, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def _sums(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """(part, entry, component, total, n) over all vectors, added up within tasks and then over them."""
    parts, entries, each = books.entries.shape

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memos = _memos(books)
        total, n = np.zeros((parts, entries, each), dtype=np.int64), np.zeros((parts, entries), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            values = matrix(batch.column("embedding"), books.width)
            index, _ = _assign(values, memos)
            split = values.reshape(len(values), parts, each)
            for p in range(parts):
                n[p] += np.bincount(index[:, p], minlength=entries)
                np.add.at(total[p], index[:, p], split[:, p])
        p, e, c = (x.ravel() for x in np.indices(total.shape))
        used = n[p, e] > 0
        columns = [p[used].astype(np.int32), e[used].astype(np.int32), c[used].astype(np.int32), total.ravel()[used], n[p, e][used]]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["part", "entry", "component", "total", "n"])
    made = vectors.select("embedding").mapInArrow(rows, "part int, entry int, component int, total long, n long")
    return made.groupBy("part", "entry", "component").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of whole vectors of one length (see ``usable``), which must be a multiple of ``parts``.

    They start as the vectors with the smallest ids; equal ids are ordered by their components, null ids come last. Each round looks at all vectors.
    """
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").toArrow().column("embedding").combine_chunks()
    width = len(first[0]) if len(first) else parts
    if width % parts:
        raise ValueError(f"vectors of {width} components cannot be cut into {parts} equal parts")
    start = matrix(first, width)
    books = Codebooks(np.ascontiguousarray(start.reshape(len(start), parts, width // parts).transpose(1, 0, 2)))
    for _ in range(rounds if len(start) else 0):
        following = books.entries.copy()
        for row in _sums(vectors, books).collect():      # as many rows as the codebooks have components
            following[row["part"], row["entry"], row["component"]] = row["total"] // row["n"]
        books = Codebooks(following)
    return books


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, embedding) of the rows that can be coded.

    Left out: null and empty vectors, vectors with a null or non-finite component, and vectors of another length than that of the smallest id. Rows with one
    id are rows of their own; null ids and labels stay. Other columns are ignored, whatever their names.
    """
    return same_width(whole_rows(vectors))[0]


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, label, code, error): one byte per part, and the sum of its squared distances."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memos = _memos(books)
        for batch in batches:
            if not batch.num_rows:
                continue
            index, distance = _assign(matrix(batch.column("embedding"), books.width), memos)
            codes = pa.array([r.tobytes() for r in index.astype(np.uint8)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), codes, pa.array(distance.sum(axis=1))],
                                             ["vec_id", "label", "code", "error"])
    if books.entries.shape[1] > 256:
        raise ValueError("a code has one byte for each part: at most 256 entries")
    label = vectors.schema["label"].dataType.simpleString()
    return vectors.select("vec_id", "label", "embedding").mapInArrow(rows, f"vec_id long, label {label}, code binary, error long")


def decode(codes: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, values): the whole numbers that each code stands for."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [books.entries[np.arange(len(code)), np.frombuffer(code, dtype=np.uint8)].ravel() for code in batch.column("code").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(made, pa.list_(pa.int64()))], ["vec_id", "values"])
    return codes.select("vec_id", "code").mapInArrow(rows, "vec_id long, values array<long>")


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """(rows, codebooks): vec_id, label, code, error, label_error of every usable row.

    ``vectors`` needs ``vec_id``, ``label`` and ``embedding``. label_error is the error summed over all rows of the row's label, null labels together.
    """
    prepare(vectors.sparkSession)
    given = usable(vectors)
    books = fit(given, parts, entries, rounds)
    coded = stage(encode(given, books), "codes")
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    joined = coded.alias("c").join(totals.alias("t"), F.col("c.label").eqNullSafe(F.col("t.label")), "left")
    return joined.select("c.*", "t.label_error"), books
