"""Short codes of vectors: product quantization in whole numbers, searched with LAESA pivots.

Components become ``floor(1024 x)`` and vectors are cut into ``PARTS`` parts. Every part
position has a codebook, which starts as that part of the vectors of smallest id and is moved
``ROUNDS`` times to the floored means of the parts assigned to it.

The distances of every part to ``PIVOTS`` fixed points, chosen far apart among the first
codebook, are computed once and stored beside the parts. In each round only the distances of
the pivots to the entries are new: by the triangle inequality the largest difference of the two
is a lower bound of the distance of part and entry. The entry of the lowest bound is evaluated
first; then those whose bounds are not above that distance, and no others, so the result is that
of comparing with every entry. Distances are exact whole numbers. Bounds are single floats and
the limit is raised by more than their rounding. A block of parts evaluates what one of them
needs by one matrix product.

A round is one pass over the stored parts: a task sums the parts of each entry, and the sums
(one number per component of the codebooks) are added by Spark. Codebooks, of fixed size,
travel to the tasks.

Defined cases: a vector that is null or holds null, NaN or infinity is dropped; so is one
whose length is not the most frequent one (the longer of two as frequent), since it has no part
to compare with; a length that is no multiple of ``PARTS`` is filled up with zeros at its end;
fewer vectors than ``ENTRIES`` make a codebook of their number; a null id comes after all others;
rows of one id follow each other by their components; equal rows all stay; a null label is a label
like others; an empty table gives an empty result; components of a size at which squared
distances leave 64 bits raise; further columns are ignored, or carried along inside one struct.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.inputs import table
from feedloom.operators.joins import join_small
from feedloom.session import materialize

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
PIVOTS = 8
ROWS = 512
STAGED = "parts array<int>, near array<float>"


class Codebooks(NamedTuple):
    """Entries of all part positions, and the distances of the pivots to them."""

    entries: np.ndarray  # (PARTS, entries, width), whole numbers
    gaps: np.ndarray  # (PARTS, pivots, entries)


def largest_component(dim: int) -> int:
    """Components up to this size leave ``distance * ENTRIES`` and the sum of all parts in 64 bits."""
    return min(int((2**61 / (ENTRIES * max(dim, 1))) ** 0.5) // 2, 2**31 - 1)


def whole_parts(vectors: pa.Array, dim: int) -> np.ndarray:
    """``floor(SCALE * x)`` as (rows, PARTS, width); the last part may end in zeros."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    scaled = np.floor(flat.reshape(len(vectors), dim) * SCALE)
    if scaled.size and np.abs(scaled).max() > largest_component(dim):
        raise ValueError(f"vector components beyond {largest_component(dim) / SCALE:.0f} are not supported")
    width = -(-dim // PARTS)
    out = np.zeros((len(vectors), PARTS * width), dtype=np.int64)
    out[:, :dim] = scaled
    return out.reshape(len(vectors), PARTS, width)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` to all of ``b``, exact."""
    gap = a[:, None, :] - b[None, :, :]
    return np.einsum("ijk,ijk->ij", gap, gap)


def choose_pivots(entries: np.ndarray) -> np.ndarray:
    """Points of one codebook that are far apart: each the farthest from those before it."""
    nearest = squared(entries, entries.sum(axis=0, keepdims=True) // len(entries))[:, 0]
    chosen = []
    for _ in range(min(PIVOTS, len(entries))):
        chosen.append(int(nearest.argmax()))
        gap = squared(entries, entries[chosen[-1:]])[:, 0]
        nearest = np.minimum(nearest, gap) if len(chosen) > 1 else gap
    return entries[chosen]


def exact_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """As ``squared``, by a matrix product where whole numbers of that size are exact in doubles."""
    largest = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if 4 * a.shape[1] * int(largest) ** 2 >= 1 << 53:
        return squared(a, b)
    a, b = a.astype(np.float64), b.astype(np.float64)
    lengths = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)
    return (lengths - 2 * (a @ b.T)).astype(np.int64)


def assign(parts: np.ndarray, near: np.ndarray, entries: np.ndarray, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of every part (the lower index of two as near) and its squared distance.

    Parts that are nearest to the same pivot are taken together, so that those of a block leave
    the same entries open.
    """
    size = len(entries)
    best = np.zeros(len(parts), dtype=np.int64)
    slack = np.float32(1e-6) * (near.max(initial=0) + gaps.max(initial=0))
    order = np.lexsort((near.min(axis=1), near.argmin(axis=1)))
    for at in range(0, len(parts), ROWS):
        rows = order[at : at + ROWS]
        own = parts[rows]
        bounds = np.zeros((len(rows), size), dtype=np.float32)
        for from_pivot, to_entries in zip(near[rows].T, gaps, strict=True):
            np.maximum(bounds, np.abs(from_pivot[:, None] - to_entries[None, :]), out=bounds)
        entry = bounds.argmin(axis=1)
        gap = own - entries[entry]
        key = np.einsum("ij,ij->i", gap, gap) * size + entry
        limit = (np.sqrt((key // size).astype(np.float64)) * (1 + 1e-6)).astype(np.float32) + slack
        is_open = bounds <= limit[:, None]
        left, wanted = np.flatnonzero(is_open.sum(axis=1) > 1), np.flatnonzero(is_open.any(axis=0))
        if len(left):
            found = (exact_squares(own[left], entries[wanted]) * size + wanted).min(axis=1)
            key[left] = np.minimum(key[left], found)
        best[rows] = key
    return best % size, best // size


def _read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Parts (rows, PARTS, width) and distances to pivots (rows, PARTS, pivots) of stored rows."""
    n = batch.num_rows
    return tuple(
        batch.column(name).flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(n, PARTS, -1)
        for name, kind in (("parts", np.int64), ("near", np.float32))
    )


def _closest(batch: pa.RecordBatch, books: Codebooks) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per part position: the parts, their entries and their squared distances."""
    parts, near = _read(batch)
    for k in range(PARTS):
        own = np.ascontiguousarray(parts[:, k])
        yield own, *assign(own, near[:, k], books.entries[k], books.gaps[k])


def _books(entries: np.ndarray, pivots: np.ndarray) -> Codebooks:
    gaps = [np.sqrt(squared(p, e)).astype(np.float32) for p, e in zip(pivots, entries, strict=True)]
    return Codebooks(entries, np.array(gaps))


def _moved(staged: DataFrame, books: Codebooks) -> np.ndarray:
    """The entries after a round: floored means of their parts; an unused entry stays."""
    shape = books.entries.shape
    shared = staged.sparkSession.sparkContext.broadcast(books)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((*shape[:2], shape[2] + 1), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            for k, (own, entry, _) in enumerate(_closest(batch, shared.value)):
                order = np.argsort(entry, kind="stable")
                used, first, n = np.unique(entry[order], return_index=True, return_counts=True)
                total[k, used, :-1] += np.add.reduceat(own[order], first, axis=0)
                total[k, used, -1] += n
        flat = total.reshape(-1)
        cells = np.flatnonzero(np.broadcast_to(total[:, :, -1:] > 0, total.shape).reshape(-1))
        yield pa.RecordBatch.from_pydict({"cell": pa.array(cells, pa.int64()), "value": pa.array(flat[cells])})

    sums = staged.select("parts", "near").mapInArrow(summed, "cell long, value long").groupBy("cell")
    found = sums.agg(F.sum("value").alias("value")).toArrow()  # at most a row per component of the codebooks
    shared.unpersist()
    total = np.zeros(shape[0] * shape[1] * (shape[2] + 1), dtype=np.int64)
    total[found.column("cell").to_numpy()] = found.column("value").to_numpy()
    total = total.reshape(shape[0], shape[1], shape[2] + 1)
    n = total[:, :, -1:]
    return np.where(n > 0, total[:, :, :-1] // np.maximum(n, 1), books.entries)


def encode(vectors: DataFrame, keep: list[str], id_column: str, label: str) -> tuple[DataFrame, np.ndarray]:
    """``own`` (a struct of the ``keep`` columns), ``code``, ``error`` and ``label_error`` of every kept
    row of ``vectors`` (with ``embedding``), and the final codebooks (part, entry, position)."""
    spark = vectors.sparkSession
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    named = F.concat(F.when(F.col(label).isNull(), "-").otherwise("+"), F.coalesce(F.col(label).cast("string"), F.lit("")))
    carried = vectors.where(F.col("embedding").isNotNull() & finite).select(
        F.struct(*keep).alias("own"), F.col(id_column).alias("id"), named.alias("of_label"), "embedding"
    )
    result = f"own {carried.schema['own'].dataType.simpleString()}, of_label string, code string, error long"
    length = F.size("embedding").alias("dim")
    common = carried.groupBy(length).count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    if not common:
        empty = spark.createDataFrame([], f"{result}, label_error long").drop("of_label")
        return empty, np.zeros((PARTS, 0, 0), dtype=np.int64)
    dim = common[0]["dim"]
    usable = carried.where(F.size("embedding") == dim)

    start = usable.orderBy(F.asc_nulls_last("id"), "embedding").limit(ENTRIES).select("embedding").toArrow()
    entries = whole_parts(start.column("embedding").combine_chunks(), dim).transpose(1, 0, 2).copy()
    pivots = np.array([choose_pivots(e) for e in entries])

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = whole_parts(batch.column(2), dim)
            gaps = [
                np.concatenate([squared(parts[at : at + ROWS, k], pivots[k]) for at in range(0, max(1, len(parts)), ROWS)])
                for k in range(PARTS)
            ]
            near = np.sqrt(np.stack(gaps, axis=1)).astype(np.float32)
            lists = [
                pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x[:1].size, pa.int32()), pa.array(x.reshape(-1), kind))
                for x, kind in ((parts, pa.int32()), (near, pa.float32()))
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *lists], names=["own", "of_label", "parts", "near"])

    schema = f"own {carried.schema['own'].dataType.simpleString()}, of_label string, {STAGED}"
    staged = usable.select("own", "of_label", "embedding").mapInArrow(stage, schema)
    staged = materialize(staged, "vector-parts")
    for _ in range(ROUNDS):
        entries = _moved(staged, _books(entries, pivots))
    shared = spark.sparkContext.broadcast(_books(entries, pivots))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = [(entry, gap) for _, entry, gap in _closest(batch, shared.value)]
            digits = np.stack([entry for entry, _ in found], axis=1).astype(np.uint8).tobytes().hex()
            codes = [digits[k : k + 2 * PARTS] for k in range(0, len(digits), 2 * PARTS)]
            error = np.sum([gap for _, gap in found], axis=0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(codes, pa.string()), pa.array(error, pa.int64())],
                names=["own", "of_label", "code", "error"],
            )

    rows = materialize(staged.mapInArrow(coded, result), "vector-codes")
    per_label = rows.groupBy("of_label").agg(F.sum("error").alias("label_error"))
    joined = join_small(rows, per_label, "of_label")
    return joined.select("own", "code", "error", "label_error"), entries


def codebook_digest(entries: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, entries.reshape(-1).tolist())).encode()).hexdigest()


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, entries = encode(table(spark, sf_dir, "embeddings"), ["vec_id"], "vec_id", "label")
    digest = F.lit(codebook_digest(entries)).alias("codebooks_sha256")
    return coded.select("own.vec_id", "code", "error", "label_error", digest)


def _sql() -> str:
    """The rounds written out, every part compared with every entry."""
    steps = [
        f"""kept AS (
  SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT rid, p, e[p * (len(e) // {PARTS}) + 1 : (p + 1) * (len(e) // {PARTS})] AS x FROM kept, range({PARTS}) AS r(p)
), book0 AS (
  SELECT p, k - 1 AS entry, x FROM parts JOIN (
    SELECT rid, row_number() OVER (ORDER BY vec_id, e) AS k FROM kept
  ) USING (rid) WHERE k <= {ENTRIES}
)"""
    ]
    for k in range(ROUNDS + 1):
        steps.append(
            f"""near{k} AS (
  SELECT rid, p, min_by(entry, d * {ENTRIES} + entry) AS entry, min(d) AS d FROM (
    SELECT rid, p, entry, list_inner_product(a.x, a.x) - 2 * list_inner_product(a.x, b.x) + list_inner_product(b.x, b.x) AS d
    FROM parts a JOIN book{k} b USING (p)
  ) GROUP BY rid, p
)"""
        )
        if k < ROUNDS:
            steps.append(
                f"""book{k + 1} AS (
  SELECT p, entry, coalesce(m.x, b.x) AS x FROM book{k} b LEFT JOIN (
    SELECT p, entry, list(v ORDER BY i) AS x FROM (
      SELECT p, entry, i, floor(sum(v) / count(*)) AS v
      FROM (SELECT p, entry, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM near{k} JOIN parts USING (rid, p))
      GROUP BY p, entry, i
    ) GROUP BY p, entry
  ) m USING (p, entry)
)"""
            )
    return f"""WITH {", ".join(steps)}, coded AS (
  SELECT rid, string_agg(lower(printf('%02x', entry::INTEGER)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near{ROUNDS} GROUP BY rid
), digest AS (
  SELECT sha256(string_agg(CAST(CAST(v AS BIGINT) AS VARCHAR), ',' ORDER BY p, entry, i)) AS codebooks_sha256
  FROM (SELECT p, entry, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM book{ROUNDS})
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (rid), digest
"""


OP12_SQL = _sql()
