"""64-bit hashes of all words of many texts at once, with whole-array operations."""

from __future__ import annotations

import numpy as np

_PRIME = 0x9E3779B97F4A7C15
RUN = 1 << 20
_INVERSE = pow(_PRIME, -1, 1 << 64)
_BYTES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)
_POWERS = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]
_UPPER = np.arange(256, dtype=np.uint8)
_UPPER[65:91] += 32


def separators(*ranges: tuple[int, int]) -> np.ndarray:
    """Which bytes end a word; each range includes its end."""
    out = np.zeros(256, dtype=bool)
    for low, high in ranges:
        out[low : high + 1] = True
    return out


# Words are [^\x20\x09-\x0D]+, or letters, digits and all signs beyond ASCII.
SPACED = separators((0x20, 0x20), (0x09, 0x0D))
PLAIN = separators((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


def mixed(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_PRIME, _INVERSE)):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0], _POWERS[1]


def word_hashes(texts: list[str | None], ends_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, A-Z lower-cased, and the number of words per text.

    A word's hash is a polynomial over its bytes: the difference of two prefix sums, moved to
    the word's own start. The sums run over ``RUN`` bytes at a time, cut where a word ends, so
    memory beside the result stays small. Null has no words. Hashes are never 0.
    """
    coded = [(text or "").encode("utf-8", "surrogatepass") for text in texts]
    text_ends = np.cumsum(np.array([len(c) for c in coded], dtype=np.int64) + 1)
    data = _UPPER[np.frombuffer(b" ".join(coded) + b" ", dtype=np.uint8)]
    stop = ends_word[data]
    stop[text_ends - 1] = True
    found, starts = [], []
    at = 0
    while at < len(data):
        end = at + RUN
        if end < len(data):
            back = stop[at:end][::-1].argmax()
            if not stop[end - 1 - back]:  # one word longer than a run
                end += int(stop[end:].argmax()) + 1
            else:
                end -= int(back)
        part, gap = data[at:end], stop[at:end]
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        if not gap[0]:
            edge = np.append(0, edge)
        start, last = edge[::2], edge[1::2]
        power, inverse = _powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_BYTES[part] * power[: len(part)], out=sums[1:])
        hashes = (sums[last] - sums[start]) * inverse[start]
        found.append(mixed(hashes + (last - start).astype(np.uint64)) | np.uint64(1))
        starts.append(start + at)
        at += len(part)
    if not texts:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    counts = np.diff(np.searchsorted(np.concatenate(starts), text_ends), prepend=0)
    return np.concatenate(found), counts
