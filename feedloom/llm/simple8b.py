"""Simple-8b: word-aligned packing of ids, coded and decoded with whole-array operations.

A 64-bit word holds a 4-bit selector and 60 bits of ids. Blocks of ``BLOCK`` ids start on a
word of their own; their first words are kept as offsets, so blocks decode independently and
all at once. Ids of more than 60 bits stand in a side array; their word has selector 0 and the
place in that array.
"""

from __future__ import annotations

import numpy as np

# Ids per word and bits per id, by selector (0 is the escape).
LAYOUT = ((1, 60), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7))
LAYOUT += ((7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
BLOCK = 256
STRIDE = BLOCK + 60  # a last word may run past its block, into zeros
COUNTS = np.array([count for count, _ in LAYOUT], dtype=np.int64)

# How the maximum over a window is put together: window, a smaller window, and its shift.
_WINDOWS = ((2, 1, 1), (3, 2, 1), (4, 2, 2), (5, 4, 1), (6, 4, 2), (7, 4, 3), (8, 4, 4))
_WINDOWS += ((10, 8, 2), (12, 8, 4), (15, 8, 7), (20, 12, 8), (30, 15, 15), (60, 30, 30))


_BITS_16 = np.maximum(1, np.frexp(np.arange(1 << 16))[1]).astype(np.uint8)


def _bits(ids: np.ndarray) -> np.ndarray:
    """Bits of each id, 1 at least; ids of 16 bits come from a table."""
    if not len(ids) or ids.max() < 1 << 16:
        return _BITS_16[ids]
    out = np.ones(len(ids), dtype=np.uint8)
    for bits in range(1, 64):
        out += ids >= np.uint64(1 << bits)
    return out


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, the first word of each block, and the ids that did not fit."""
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    blocks = -(-len(ids) // BLOCK)
    if not blocks:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint64)
    laid = np.zeros((blocks + 1, STRIDE), dtype=np.uint64)
    full = np.zeros(blocks * BLOCK, dtype=np.uint64)
    full[: len(ids)] = ids
    laid[:blocks, :BLOCK] = full.reshape(blocks, BLOCK)
    laid = laid.ravel()
    largest = {1: _bits(laid)}
    best = np.full(len(laid), len(LAYOUT) - 1, dtype=np.uint8)
    width = {count: bits for count, bits in LAYOUT[1:]}
    selector = {count: s for s, (count, _) in enumerate(LAYOUT) if s}
    for window, part, shift in _WINDOWS:
        low = largest[part].copy()
        np.maximum(low[:-shift], largest[part][shift:], out=low[:-shift])
        largest[window] = low
        np.putmask(best, low <= width[window], selector[window])
    best[largest[1] > 60] = 0

    at = np.arange(blocks, dtype=np.int64) * STRIDE
    end = at + BLOCK
    open_blocks = np.arange(blocks)
    filled = np.zeros(blocks, dtype=np.int64)
    places, starts, chosen = [], [], []
    while len(open_blocks):
        here = at[open_blocks]
        pick = best[here]
        places.append((open_blocks, filled[open_blocks]))
        starts.append(here)
        chosen.append(pick)
        filled[open_blocks] += 1
        at[open_blocks] = here + COUNTS[pick]
        open_blocks = open_blocks[at[open_blocks] < end[open_blocks]]
    offsets = np.cumsum(filled) - filled
    place = np.concatenate([offsets[block] + step for block, step in places])
    start, pick = np.concatenate(starts), np.concatenate(chosen)
    words = np.zeros(int(filled.sum()), dtype=np.uint64)
    for s, (count, bits) in enumerate(LAYOUT):
        rows = np.flatnonzero(pick == s)
        if s and len(rows):
            word = np.full(len(rows), s << 60, dtype=np.uint64)
            for k in range(count):
                word |= laid[start[rows] + k] << np.uint64(k * bits)
            words[place[rows]] = word
    rows = np.flatnonzero(pick == 0)
    rows = rows[np.argsort(place[rows], kind="stable")]
    words[place[rows]] = np.arange(len(rows), dtype=np.uint64)
    return words, offsets.astype(np.uint32), laid[start[rows]]


def decode(words: np.ndarray, offsets: np.ndarray, escaped: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids; any run of blocks decodes the same way."""
    blocks = len(offsets)
    if not blocks:
        return np.zeros(0, np.uint64)
    pick = (words >> np.uint64(60)).astype(np.int64)
    before = np.cumsum(COUNTS[pick]) - COUNTS[pick]
    per_block = np.diff(np.append(offsets.astype(np.int64), len(words)))
    start = before - np.repeat(before[offsets], per_block) + np.repeat(np.arange(blocks) * STRIDE, per_block)
    laid = np.zeros(blocks * STRIDE, dtype=np.uint64)
    for s, (count, bits) in enumerate(LAYOUT):
        rows = np.flatnonzero(pick == s)
        if not len(rows):
            continue
        if not s:
            laid[start[rows]] = escaped[words[rows].astype(np.int64)]
            continue
        mask = np.uint64((1 << bits) - 1)
        for k in range(count):
            laid[start[rows] + k] = (words[rows] >> np.uint64(k * bits)) & mask
    return laid.reshape(blocks, STRIDE)[:, :BLOCK].ravel()[:n]
