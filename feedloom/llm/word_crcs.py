"""CRC-32 of all words of many texts, and of words joined by a space, with whole-array operations."""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Fixed value: the reversed polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320
RUN = 1 << 20
LONG_WORD = 64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _byte_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, np.uint32(POLYNOMIAL) ^ (out >> np.uint32(1)), out >> np.uint32(1))
    return out


_TABLE = _byte_table()


def _through(tables: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Apply a linear map of 32 bits, given as four tables of 256."""
    out = tables[0][x & np.uint32(255)]
    for k in (1, 2, 3):
        out ^= tables[k][(x >> np.uint32(8 * k)) & np.uint32(255)]
    return out


def _zero_tables() -> list[np.ndarray]:
    """Tables that move a CRC past 1, 2, 4, ... zero bytes."""
    single = np.array([(np.arange(256, dtype=np.uint32) << np.uint32(8 * k)) for k in range(4)])
    tables = [_TABLE[single & np.uint32(255)] ^ (single >> np.uint32(8))]
    for _ in range(31):
        tables.append(np.array([_through(tables[-1], row) for row in tables[-1]]))
    return tables


_ZEROS = _zero_tables()


class Words(NamedTuple):
    crc: np.ndarray  # of each word's UTF-8 bytes
    n_bytes: np.ndarray
    owner: np.ndarray  # the text it stands in


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, one after the other, and where each ends. Null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    plain = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(plain):
        return np.zeros(0, dtype=np.uint8), np.zeros(0, dtype=np.int64)
    _, offsets, data = plain.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[plain.offset : plain.offset + len(plain) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[ends[0] : ends[-1]], ends[1:] - ends[0]


def _crcs(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC of each span. Spans are taken byte by byte, longest first, so that those left are a prefix."""
    order = np.argsort(-length, kind="stable")
    at, size = start[order], length[order]
    state = np.full(len(at), 0xFFFFFFFF, dtype=np.uint32)
    n_long = int(np.searchsorted(-size, -LONG_WORD, side="left"))
    for k in range(n_long):
        state[k] = zlib.crc32(data[at[k] : at[k] + size[k]].tobytes()) ^ 0xFFFFFFFF
    at, size, rest = at[n_long:], size[n_long:], state[n_long:]
    for p in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -p, side="left"))
        part = rest[:n]
        rest[:n] = _TABLE[(part ^ data[at[:n] + p]) & np.uint32(255)] ^ (part >> np.uint32(8))
    out = np.empty(len(state), dtype=np.uint32)
    out[order] = ~state
    return out


def word_crcs(data: np.ndarray, ends: np.ndarray, ends_word: np.ndarray) -> Words:
    """The words of texts that lie one after the other in ``data``, A-Z lower-cased.

    Works through ``RUN`` bytes at a time, cut where a word ends, so that memory beside the
    result stays small. A word never reaches into the next text.
    """
    breaks = np.zeros(len(data) + 1, dtype=bool)
    breaks[ends] = True
    gap = ends_word[_LOWER]  # by byte as it stands in the text
    found = []
    at = 0
    while at < len(data):
        end = min(len(data), at + RUN)
        while end < len(data) and not (gap[data[end]] or breaks[end]):
            step = data[end : end + RUN]
            stop = gap[step] | breaks[end : end + len(step)]
            end += int(stop.argmax()) if stop.any() else len(step)
        part = _LOWER[data[at:end]]
        inside = ~gap[data[at:end]]
        fresh = breaks[at:end].copy()
        fresh[0] = True
        first = inside & (fresh | ~np.append(False, inside[:-1]))
        last = inside & np.append(fresh[1:] | ~inside[1:], True)
        start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
        owner = np.searchsorted(ends, start + at, side="right")
        found.append((_crcs(part, start, stop - start), stop - start, owner))
        at = end
    if not found:
        none = np.zeros(0, dtype=np.int64)
        return Words(none.astype(np.uint32), none, none)
    return Words(*(np.concatenate(x) for x in zip(*found, strict=True)))


def pair_crcs(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """CRC of every two words that follow each other in a text, joined by a space, and their text.

    CRCs are linear: that of ``a + b`` is that of ``a`` moved past as many zero bytes as ``b``
    has, combined with that of ``b``.
    """
    if len(words.crc) < 2:
        return words.crc[:0], words.owner[:0]
    same = words.owner[1:] == words.owner[:-1]
    left, right, length = words.crc[:-1][same], words.crc[1:][same], words.n_bytes[1:][same]
    state = ~left
    spaced = ~(_TABLE[(state ^ np.uint32(0x20)) & np.uint32(255)] ^ (state >> np.uint32(8)))
    bit = 0
    while len(length) and length.max() >> bit:
        moved = (length >> bit) & 1 == 1
        spaced[moved] = _through(_ZEROS[bit], spaced[moved])
        bit += 1
    return spaced ^ right, words.owner[1:][same]
