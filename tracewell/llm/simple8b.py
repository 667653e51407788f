"""Simple-8b word-aligned coding of token ids, encoded and decoded with numpy.

A block holds up to ``BLOCK`` ids. Each 64-bit word has a selector in its upper four bits and 60 bits of
payload: the selector says how many ids of which width the payload holds. An id too wide for the widest
escapable field is written as that field's largest value and stands in full in the block's escape list.
Blocks know where their words and escapes begin, so all blocks are decoded at once.
"""

from __future__ import annotations

import numpy as np

# Format, fixed: ids per word and bits per id, by selector.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3], dtype=np.int64)
WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20], dtype=np.int64)
ESCAPE = (1 << 20) - 1
BLOCK = 1024
MAGIC = b"TWS8B001"


def encode(ids: np.ndarray, block: int = BLOCK) -> bytes:
    """One payload: header, word and escape offset of each block, escapes, words."""
    ids = np.asarray(ids, dtype=np.uint32)
    n = len(ids)
    blocks = -(-n // block)
    wide = ids >= ESCAPE
    values = np.where(wide, ESCAPE, ids).astype(np.uint64)
    here = np.arange(n, dtype=np.int32)
    left = np.minimum((here // block + 1) * block, n) - here
    small = values.astype(np.int32)
    selector = np.full(n, len(COUNTS) - 1, dtype=np.int8)
    # from wide to narrow fields: the narrowest that holds the next ids wins, as it takes most of them
    for s in range(len(COUNTS) - 2, -1, -1):
        unfit = np.where(small < (1 << int(WIDTHS[s])), np.int32(n), here)
        following = np.minimum.accumulate(unfit[::-1])[::-1] if n else unfit
        selector[following - here >= np.minimum(left, np.int32(COUNTS[s]))] = s
    # all blocks step forward together, one word each
    at = np.arange(blocks, dtype=np.int64) * block
    end = np.minimum(at + block, n)
    live = np.arange(blocks)
    steps, owners = [], []
    while len(live):
        steps.append(at[live].copy())
        owners.append(live)
        at[live] += COUNTS[selector[at[live]]]
        live = live[at[live] < end[live]]
    begin = np.concatenate(steps) if steps else np.zeros(0, dtype=np.int64)
    owner = np.concatenate(owners) if owners else np.zeros(0, dtype=np.int64)
    order = np.lexsort((begin, owner))
    begin, owner = begin[order], owner[order]
    chosen = selector[begin]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s, (count, width) in enumerate(zip(COUNTS.tolist(), WIDTHS.tolist())):
        rows = np.flatnonzero(chosen == s)
        last = end[owner[rows]]
        for k in range(count):
            place = begin[rows] + k
            inside = place < last
            words[rows[inside]] |= values[place[inside]] << np.uint64(k * width)
    word_at = np.zeros(blocks + 1, dtype="<u4")
    word_at[1:] = np.cumsum(np.bincount(owner, minlength=blocks)) if blocks else 0
    escape_at = np.zeros(blocks + 1, dtype="<u4")
    escapes = np.flatnonzero(wide)
    escape_at[1:] = np.cumsum(np.bincount(escapes // block, minlength=blocks)) if blocks else 0
    head = np.array([n, block, blocks, len(escapes)], dtype="<u4")
    return b"".join([MAGIC, head.tobytes(), word_at.tobytes(), escape_at.tobytes(),
                     ids[escapes].astype("<u4").tobytes(), words.astype("<u8").tobytes()])


def decode(payload: bytes, first_block: int = 0, last_block: int | None = None) -> np.ndarray:
    """The ids of the given blocks, all by default; only those blocks' words are touched."""
    if payload[:8] != MAGIC:
        raise ValueError("not a token payload")
    n, block, blocks, escaped = np.frombuffer(payload, dtype="<u4", count=4, offset=8).astype(np.int64).tolist()
    place = 24
    word_at = np.frombuffer(payload, dtype="<u4", count=blocks + 1, offset=place).astype(np.int64)
    place += 4 * (blocks + 1)
    escape_at = np.frombuffer(payload, dtype="<u4", count=blocks + 1, offset=place).astype(np.int64)
    place += 4 * (blocks + 1)
    escapes = np.frombuffer(payload, dtype="<u4", count=escaped, offset=place)
    place += 4 * escaped
    last_block = blocks if last_block is None else min(last_block, blocks)
    if first_block >= last_block:
        return np.zeros(0, dtype=np.uint32)
    low, high = word_at[first_block], word_at[last_block]
    words = np.frombuffer(payload, dtype="<u8", count=high - low, offset=place + 8 * int(low))
    chosen = (words >> np.uint64(60)).astype(np.int64)
    sizes = COUNTS[chosen]
    # the last word of a block may hold fewer ids than its selector says
    size_of_block = np.minimum(n - np.arange(first_block, last_block) * block, block)
    before = np.cumsum(sizes) - sizes
    cut = word_at[first_block + 1:last_block + 1] - low - 1
    first_word = word_at[first_block:last_block] - low
    sizes[cut] = size_of_block - (before[cut] - before[first_word])
    begin = np.cumsum(sizes) - sizes
    out = np.zeros(int(size_of_block.sum()), dtype=np.uint32)
    for s, (count, width) in enumerate(zip(COUNTS.tolist(), WIDTHS.tolist())):
        rows = np.flatnonzero(chosen == s)
        if len(rows):
            field = (words[rows, None] >> (np.arange(count, dtype=np.uint64) * np.uint64(width))) & np.uint64((1 << width) - 1)
            used = np.arange(count) < sizes[rows, None]
            out[(begin[rows, None] + np.arange(count))[used]] = field[used]
    here = np.flatnonzero(out == ESCAPE)
    out[here] = escapes[escape_at[first_block]:escape_at[last_block]]
    return out
