"""Vector expressions: hashed text embedding, normalization, nearest-neighbour score."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.hashing import bucket, direction, java_string_hash
from feedloom.functions.text import col_of, tokens

# Scores that agree to this many digits are equal, so that the summation order of an
# engine or a CPU never decides a rank; the document id does.
SCORE_DIGITS = 9


def check_dimension(dim: int) -> int:
    if dim is None or dim <= 0:
        raise ValueError("embedding dimension must be greater than zero")
    return dim


def has_embedding(vector: str | Column) -> Column:
    return F.coalesce(F.size(col_of(vector)) > 0, F.lit(False))


def l2_normalize(vector: str | Column) -> Column:
    """Unit-length copy of a vector; the zero vector stays as it is."""
    vector = col_of(vector)
    length = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x * x))
    return F.when(length == 0.0, vector).otherwise(F.transform(vector, lambda x: x / length))


def l2_score(left: str | Column, right: str | Column) -> Column:
    """``1 / (1 + squared distance)``, 1 for identical vectors."""
    squares = F.zip_with(col_of(left), col_of(right), lambda x, y: (x - y) * (x - y))
    distance = F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x)
    return F.round(1.0 / (1.0 + distance), SCORE_DIGITS)


def hashed_vector_expr(text: str | Column, dim: int) -> Column:
    """Hashed embedding from built-in expressions alone.

    Costs tokens x dim steps per row: meant for query strings and as the
    yardstick for ``hashed_vector``.
    """
    check_dimension(dim)
    hashes = F.transform(tokens(text), java_string_hash)
    signed = F.transform(hashes, lambda h: F.struct(bucket(h, dim).alias("b"), direction(h).alias("d")))
    counts = F.aggregate(
        signed,
        F.array_repeat(F.lit(0.0), dim),
        lambda acc, s: F.transform(acc, lambda x, slot: x + F.when(slot == s["b"], s["d"]).otherwise(0)),
    )
    return l2_normalize(counts)


def hashed_vector(text: str | Column, dim: int) -> Column:
    """Hashed embedding of lower-case text: signed token counts per bucket, unit length.

    Row-local, so nothing is shuffled and no key is needed. Texts go through Arrow
    batches; token hashes are computed once per distinct token of a slice.
    """
    check_dimension(dim)
    return _hashed_vector_udf(dim)(F.coalesce(col_of(text), F.lit("")))


def _hashed_vector_udf(dim: int) -> Callable[[Column], Column]:
    # Everything the workers need is nested here, so the function travels by value.
    slice_rows, slice_bytes = 256, 1 << 20

    def hash_tokens(distinct: pa.Array) -> np.ndarray:
        words = distinct.cast(pa.large_string())
        offsets = np.frombuffer(words.buffers()[1], dtype=np.int64)[words.offset : words.offset + len(words) + 1]
        data = np.frombuffer(words.buffers()[2] or b"", dtype=np.uint8)
        lengths = np.diff(offsets)
        longest_first = np.argsort(-lengths, kind="stable")
        starts, sizes = offsets[:-1][longest_first], lengths[longest_first]
        hashes = np.zeros(len(words), dtype=np.int32)
        with np.errstate(over="ignore"):
            for position in range(int(sizes[0]) if len(sizes) else 0):
                live = int(np.searchsorted(-sizes, -position, side="left"))
                hashes[:live] = hashes[:live] * np.int32(31) + data[starts[:live] + position]
        result = np.empty_like(hashes)
        result[longest_first] = hashes
        return result

    def embed_slice(texts: pa.Array) -> np.ndarray:
        parts = pc.split_pattern_regex(texts, "[^a-z0-9]+")
        rows = pc.list_parent_indices(parts).to_numpy(zero_copy_only=False)
        encoded = parts.flatten().dictionary_encode()
        codes = encoded.indices.to_numpy(zero_copy_only=False)
        hashes = hash_tokens(encoded.dictionary)
        weights = np.where(hashes % 2 == 0, 1.0, -1.0)
        weights[pc.equal(encoded.dictionary, "").to_numpy(zero_copy_only=False)] = 0.0
        buckets = hashes.astype(np.int64) % dim
        flat = np.bincount(rows * dim + buckets[codes], weights=weights[codes], minlength=len(texts) * dim)
        vectors = flat.reshape(len(texts), dim)
        norms = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
        norms[norms == 0.0] = 1.0
        return vectors / norms

    def embed(texts: pa.Array) -> pa.Array:
        # Tokens take many times their text: a slice ends after so many bytes, however few its rows.
        run = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64) // slice_bytes
        row = np.arange(len(texts))
        starts = np.flatnonzero((row % slice_rows == 0) | (np.diff(run, prepend=0) > 0)).tolist()
        slices = [embed_slice(texts.slice(i, j - i)) for i, j in zip(starts, [*starts[1:], len(texts)])]
        values = np.concatenate(slices).ravel() if slices else np.zeros(0)
        # What a batch of long texts took goes back, as the worker lives on.
        pa.default_memory_pool().release_unused()
        offsets = np.arange(len(texts) + 1, dtype=np.int32) * dim
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))

    embed.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    # Marked non-deterministic only to be computed once: a filter on the vector would
    # otherwise be pushed below it together with a second copy of the call.
    return F.arrow_udf(embed, "array<double>").asNondeterministic()


def vector_literal(vector: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(x)) for x in vector])
