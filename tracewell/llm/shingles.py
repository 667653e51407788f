"""Word-shingle sets of whole texts as sorted 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tracewell.llm.textbytes import LOWER, SPACE, chunks, mix, span_hashes, words

STEP = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, shingle: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles of ``shingle`` words.

    Words are runs without ASCII white space, A-Z lower-cased. A text of fewer words is one shingle, one without words
    has none. Two shingles are mixed up if their 64-bit hashes agree: a chance of n²/2^65 within a text of n.
    """
    for i, j in chunks(offsets):
        part = LOWER[data[offsets[i]:offsets[j]]]
        at = offsets[i:j + 1] - offsets[i]
        starts, ends, text = words(part, at, ~SPACE)
        if not len(starts):
            for _ in range(i, j):
                yield np.zeros(0, dtype=np.uint64)
            continue
        hashed = span_hashes(part, starts, ends)
        count = np.bincount(text, minlength=j - i)
        first = np.cumsum(count) - count
        joined = hashed.copy()
        size = np.minimum(count, shingle)[text]       # words in the shingle beginning here
        index = np.arange(len(hashed)) - first[text]
        for k in range(1, shingle):
            follows = np.minimum(np.arange(len(hashed)) + k, len(hashed) - 1)
            joined = np.where(k < size, mix(joined * STEP + hashed[follows]), joined)
        whole = index <= count[text] - size           # not running over the text's end
        kept, owner = joined[whole], text[whole]
        bounds = np.searchsorted(owner, np.arange(j - i + 1))
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a < 2:
                yield kept[a:b]
                continue
            ordered = np.sort(kept[a:b])
            new = np.empty(b - a, dtype=bool)
            new[0] = True
            np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
            yield ordered[new]


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    both = np.concatenate([a, b])
    both.sort()
    return int(np.count_nonzero(both[1:] == both[:-1]))
