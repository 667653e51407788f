"""Token ids of whole texts by a BPE tokenizer file, each distinct unit encoded once per worker.

A unit is a stretch between two places where the tokenizer's own splitting certainly has a boundary,
so the ids of a text are those of its units, one after another. Where a boundary is in doubt
(apostrophes, characters beyond Latin-1) the stretch simply goes on: the library then splits it.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np

from tracewell.llm.textbytes import LOWER, SPACE, SeenUnits, chunks, spread, text_of_each

# byte classes: 0 in doubt, 1 letter, 2 punctuation, 3 digit, 4 white space
CLASS = np.zeros(256, dtype=np.uint8)
CLASS[[*range(65, 91), *range(97, 123)]] = 1
CLASS[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"]] = 2
CLASS[48:58] = 3
CLASS[SPACE] = 4

_encoders: dict[tuple, "UnitEncoder"] = {}


def byte_classes(data: np.ndarray) -> np.ndarray:
    """Classes of all bytes; the two-byte letters of Latin-1 are known, other multi-byte characters are in doubt."""
    out = CLASS[data]
    lead = np.flatnonzero(data == 0xC3)
    lead = lead[lead + 1 < len(data)]
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    out[lead] = 1
    out[lead + 1] = 1
    # a combining mark or other doubtful character after a letter keeps that letter in doubt too
    doubt = np.flatnonzero(out == 0)
    after = doubt[doubt > 0] - 1
    glue = after[data[doubt[doubt > 0]] >= 0x80]
    out[glue[out[glue] == 1]] = 0
    return out


def word_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units of a tokenizer that drops white space: runs without white space, cut between known classes."""
    kind = byte_classes(data)
    edge = np.zeros(len(data) + 1, dtype=bool)
    a, b = kind[:-1], kind[1:]
    edge[1:-1] = (a != b) & (a != 0) & (b != 0) | (a == 4) | (b == 4)
    edge[offsets] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    keep = kind[starts] != 4
    return starts[keep], ends[keep]


def spaced_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units of a tokenizer that keeps white space and joins one blank to what follows it."""
    n = len(data)
    kind = byte_classes(data)
    edge = np.zeros(n + 1, dtype=bool)
    a, b = kind[:-1], kind[1:]
    known = (a != 0) & (b != 0)
    # between two known classes, neither of them white space
    edge[1:-1] = known & (a != b) & (a != 4) & (b != 4)
    # a run of white space: it begins a unit, and so does its last byte if something known follows
    head = offsets[(offsets > 0) & (offsets < n)]
    first = known & (a != 4) & (b == 4)
    edge[1:-1] |= first
    last = (a == 4) & (b != 4) & (b != 0)
    at_end = np.zeros(n, dtype=bool)
    at_end[offsets[offsets > 0] - 1] = True
    last &= ~at_end[:-1]
    where = np.flatnonzero(last)          # position of the last white-space byte of each such run
    doubt_before = (where > 0) & (kind[np.maximum(where - 1, 0)] == 0)
    where = where[~doubt_before]
    edge[where] = True
    plain = where[data[where] != 32]      # not a blank: it stands alone
    edge[plain + 1] = True
    edge[0] = edge[n] = True
    edge[head] = True
    at = np.flatnonzero(edge)
    return at[:-1], at[1:]


class UnitEncoder:
    """A tokenizer and the ids of the units it has met."""

    def __init__(self, path: str, spaced: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.spaced = spaced
        self.seen = SeenUnits(self._work)

    def _work(self, units: list[bytes]) -> list:
        tokenize = self.tokenizer.encode_batch_fast
        return [e.ids for e in tokenize([u.decode("utf-8") for u in units], add_special_tokens=False)]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of consecutive texts, and how many each text has."""
        n = len(offsets) - 1
        if not len(data):
            return np.zeros(0, dtype=np.uint32), np.zeros(n, dtype=np.int64)
        if not self.spaced:
            data = LOWER[data]
        starts, ends = (spaced_starts if self.spaced else word_starts)(data, offsets)
        if not len(starts):
            return np.zeros(0, dtype=np.uint32), np.zeros(n, dtype=np.int64)
        number = self.seen.numbers(data, starts, ends)
        counts = np.bincount(text_of_each(starts, offsets), weights=self.seen.lengths(number), minlength=n)
        return self.seen.gather(number), counts.astype(np.int64)


def encoder(path: str, spaced: bool) -> UnitEncoder:
    """One encoder per worker process and file."""
    if (path, spaced) not in _encoders:
        _encoders[path, spaced] = UnitEncoder(path, spaced)
    return _encoders[path, spaced]


def encode_texts(enc: UnitEncoder, data: np.ndarray, offsets: np.ndarray, end_id: int) -> Iterator[np.ndarray]:
    """The ids of each text, the end id appended."""
    for i, j in chunks(offsets):
        ids, counts = enc.encode(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        ends = np.cumsum(counts)
        out = np.full(len(ids) + len(counts), end_id, dtype=np.uint32)
        out[spread(ends - counts + np.arange(len(counts)), counts)] = ids
        stops = ends + np.arange(1, len(counts) + 1)
        for a, b in zip((stops - counts - 1).tolist(), stops.tolist()):
            yield out[a:b]
