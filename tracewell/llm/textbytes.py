"""Vectorised work on UTF-8 texts inside Arrow batches: units, 64-bit hashes, a table of seen units.

A batch's string buffer is read as one byte array, so splitting and hashing cost a few numpy passes
instead of a Python step per word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_rng = np.random.default_rng(20240229)
BYTE_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser: every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE and its inverse modulo 2^64, raised to 0..n-1."""
    if not _powers or len(_powers["up"]) < n:
        size = max(n, CHUNK_BYTES + 1)
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        for name, base in (("up", BASE), ("down", inverse)):
            out = np.full(size, base, dtype=np.uint64)
            out[0] = 1
            _powers[name] = np.multiply.accumulate(out)
    return _powers["up"][:n], _powers["down"][:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each data[start:end]; equal bytes have equal hashes wherever they stand."""
    up, down = _power(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_CODE[data] * up[:len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column's bytes and its len+1 offsets; null counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    return data, offsets


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``limit`` bytes together; a longer text is a range of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def text_of_each(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Index of the text that each position lies in; empty texts hold no position."""
    return np.searchsorted(offsets, starts, side="right") - 1


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes with ``inside`` (a table of 256 flags), cut at text ends: starts, ends, text index."""
    flag = inside[data]
    if not len(flag):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    before = np.empty_like(flag)
    before[0] = False
    before[1:] = flag[:-1]
    head = offsets[:-1][offsets[:-1] < len(data)]
    before[head] = False
    starts = np.flatnonzero(flag & ~before)
    last = np.empty_like(flag)
    last[-1] = True
    last[:-1] = ~flag[1:]
    last[head[head > 0] - 1] = True
    ends = np.flatnonzero(flag & last) + 1
    return starts, ends, text_of_each(starts, offsets)


class SeenUnits:
    """What has been worked out for byte strings seen before, found by their 64-bit hash.

    ``work`` gets a list of new byte strings and returns one integer array for each. The table starts
    anew when it holds ``most`` strings, so a worker's memory is bounded whatever the vocabulary is.
    Two strings are mixed up if their hashes agree: a chance of about most²/2^65.
    """

    def __init__(self, work: Callable[[list[bytes]], list], most: int = 1_200_000, dtype=np.uint32):
        self.work, self.most, self.dtype = work, most, dtype
        self.size = 1 << (2 * most - 1).bit_length()
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(self.size, dtype=np.uint64)
        self.place = np.zeros(self.size, dtype=np.int32)
        self.count = 0
        self.bounds = np.zeros(1 << 16, dtype=np.int64)
        self.flat = np.zeros(1 << 18, dtype=self.dtype)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each hash, or -1."""
        mask = np.uint64(self.size - 1)
        out = np.full(len(hashes), -1, dtype=np.int64)
        slot = (hashes & mask).astype(np.int64)
        key = self.keys[slot]
        hit = key == hashes
        out[hit] = self.place[slot[hit]]
        todo = np.flatnonzero(~hit & (key != 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & int(mask)
            key, want = self.keys[slot[todo]], hashes[todo]
            hit = key == want
            out[todo[hit]] = self.place[slot[todo[hit]]]
            todo = todo[~hit & (key != 0)]
        return out

    def _insert(self, hashes: np.ndarray) -> None:
        """Different hashes, none of them in the table."""
        mask = self.size - 1
        number = np.arange(self.count, self.count + len(hashes), dtype=np.int32)
        slot = (hashes & np.uint64(mask)).astype(np.int64)
        todo = np.arange(len(hashes))
        while len(todo):
            free = todo[self.keys[slot[todo]] == 0]
            _, first = np.unique(slot[free], return_index=True)
            won = free[first]
            self.keys[slot[won]] = hashes[won]
            self.place[slot[won]] = number[won]
            lost = np.ones(len(hashes), dtype=bool)
            lost[won] = False
            todo = todo[lost[todo]]
            taken = self.keys[slot[todo]] != 0
            slot[todo[taken]] = (slot[todo[taken]] + 1) & mask
        self.count += len(hashes)

    def _store(self, results: list) -> None:
        lengths = np.fromiter(map(len, results), dtype=np.int64, count=len(results))
        used = int(self.bounds[self.count])
        need = self.count + len(results) + 1
        if need > len(self.bounds):
            self.bounds = np.concatenate([self.bounds, np.zeros(max(need, len(self.bounds)), dtype=np.int64)])
        self.bounds[self.count + 1:need] = used + np.cumsum(lengths)
        values = np.concatenate([np.asarray(r, dtype=self.dtype) for r in results])
        while used + len(values) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[used:used + len(values)] = values

    def numbers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each data[start:end]; new ones are worked out first. Numbers hold until the next call."""
        def bring(at: np.ndarray) -> list[bytes]:
            raw = data.tobytes()
            return [raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())]
        return self.numbers_of(span_hashes(data, starts, ends), bring)

    def numbers_of(self, hashes: np.ndarray, bring: Callable[[np.ndarray], list]) -> np.ndarray:
        """The same for any things told apart by their hashes; ``bring`` gives the things at some indices."""
        hashes[hashes == 0] = 1
        found = self._find(hashes)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new, first = np.unique(hashes[missing], return_index=True)
            if self.count + len(new) > self.most:
                self._clear()
                new, first = np.unique(hashes, return_index=True)
                missing = np.arange(len(hashes))
                while 2 * len(new) > self.size:
                    self.size *= 2
                    self._clear()
            self._store(self.work(bring(missing[first])))
            self._insert(new)
            found = self._find(hashes)
        return found

    def lengths(self, numbers: np.ndarray) -> np.ndarray:
        return self.bounds[numbers + 1] - self.bounds[numbers]

    def gather(self, numbers: np.ndarray) -> np.ndarray:
        """The results of the given numbers, one after another."""
        return self.flat[spread(self.bounds[numbers], self.lengths(numbers))]


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of each range, one range after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def totals(values: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """Sum of integer values per group."""
    return np.bincount(group, weights=values, minlength=groups).astype(np.int64)
