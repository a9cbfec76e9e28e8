"""Exact nearest neighbours of large query tables over Voronoi cells.

A bounded sample of the index rows are pivots; every row belongs to the cell of its nearest
pivot. A first pass notes each cell's rows, its radius and its ``k`` smallest distances to the
pivot. By the triangle inequality these bound, for every query, the distance of its ``k``-th
neighbour from above and the distance of any row of a cell from below, so a query is sent only
to cells that can still hold a neighbour. Cells are cut into blocks by their size and by the
number of queries that ask them. Rows of the index cross the network once, to their block;
a task holds one block and streams the block's queries through it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.session import materialize

# Pivots are this many rows at most; they travel to every task.
MAX_CELLS = 256
# A block of the index that a task holds.
BLOCK_BYTES = 128 * 1024 * 1024
# Scores of one task: a cell that many queries ask is cut finer.
SCORES_PER_TASK = 20_000_000_000
# Distances are compared with this relative room for rounding.
ROUNDING = 1e-6
ROWS = 4096

Best = Callable[[np.ndarray, Iterator[tuple[pa.Array, np.ndarray]]], tuple[np.ndarray, np.ndarray, np.ndarray]]


class Cells(NamedTuple):
    pivots: np.ndarray  # (cells, dim)
    rows: np.ndarray
    radius: np.ndarray
    near: np.ndarray  # (cells, k) smallest distances to the pivot, ascending, filled up with infinity


def matrix(vectors: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    return values.astype(np.float64, copy=False).reshape(len(vectors), dim)


def distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    squares = (rows * rows).sum(axis=1)[:, None] + (points * points).sum(axis=1) - 2.0 * (rows @ points.T)
    return np.sqrt(np.maximum(squares, 0.0))


def choose_pivots(index: DataFrame, key: str, dim: int, cells: int) -> np.ndarray:
    """Different vectors among the ``cells`` rows of smallest hash."""
    chosen = index.select(key, "embedding").orderBy(F.xxhash64(key), key).limit(min(cells, MAX_CELLS))
    return np.unique(matrix(chosen.toArrow().column("embedding"), dim), axis=0)


def with_cell(rows: DataFrame, pivots: np.ndarray, *, name: str = "cell", others: tuple[str, ...] = ()) -> DataFrame:
    """``others``, ``embedding`` and the number of the nearest pivot (the first of several as near)."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)
    dim = pivots.shape[1]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = matrix(batch.column(len(others)), dim)
            nearest = [distances(vectors[at : at + ROWS], shared.value).argmin(axis=1) for at in range(0, len(vectors), ROWS)]
            cell = pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *nearest]), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, cell], names=[*others, "embedding", name])

    wanted = rows.select(*others, "embedding")
    schema = T.StructType([*wanted.schema.fields, T.StructField(name, T.IntegerType())])
    return wanted.mapInArrow(placed, schema)


def survey(index: DataFrame, pivots: np.ndarray, k: int) -> Cells:
    """The first pass: size, radius and ``k`` smallest distances of every cell. Nothing but
    those crosses the network."""
    shared = index.sparkSession.sparkContext.broadcast(pivots)
    n_cells, dim = pivots.shape

    def surveyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, radius = np.zeros(n_cells, dtype=np.int64), np.zeros(n_cells)
        near = np.full((n_cells, k), np.inf)
        for batch in batches:
            vectors = matrix(batch.column(0), dim)
            for at in range(0, len(vectors), ROWS):
                gaps = distances(vectors[at : at + ROWS], shared.value)
                cell = gaps.argmin(axis=1)
                gap = gaps[np.arange(len(cell)), cell]
                order = np.lexsort((gap, cell))
                used, first, n = np.unique(cell[order], return_index=True, return_counts=True)
                rows[used] += n
                for c, start, length in zip(used, first, n, strict=True):
                    own = gap[order[start : start + length]]
                    radius[c] = max(radius[c], own[-1])
                    near[c] = np.sort(np.append(near[c], own[:k]))[:k]
        used = np.flatnonzero(rows)
        yield pa.RecordBatch.from_pydict(
            {
                "cell": pa.array(used, pa.int32()),
                "rows": pa.array(rows[used]),
                "radius": pa.array(radius[used]),
                "near": pa.array([x[np.isfinite(x)] for x in near[used]], pa.list_(pa.float64())),
            }
        )

    schema = "cell int, rows long, radius double, near array<double>"
    parts = materialize(index.select("embedding").mapInArrow(surveyed, schema), "cells")
    rows, radius = np.zeros(n_cells, dtype=np.int64), np.zeros(n_cells)
    for r in parts.groupBy("cell").agg(F.sum("rows").alias("rows"), F.max("radius").alias("radius")).collect():
        rows[r["cell"]], radius[r["cell"]] = r["rows"], r["radius"]
    near = np.full((n_cells, k), np.inf)
    smallest = parts.select("cell", F.explode("near").alias("gap")).selectExpr(
        "*", "row_number() OVER (PARTITION BY cell ORDER BY gap) AS place"
    )
    for r in smallest.where(F.col("place") <= k).collect():  # k numbers a cell
        near[r["cell"], r["place"] - 1] = r["gap"]
    return Cells(pivots, rows, radius, near)


def open_cells(queries: np.ndarray, cells: Cells) -> np.ndarray:
    """Which cells may hold one of the ``k`` nearest rows of each query, as (queries, cells)."""
    k = cells.near.shape[1]
    between = distances(cells.pivots, cells.pivots)
    np.fill_diagonal(between, np.inf)
    used = cells.rows > 0
    out = np.zeros((len(queries), len(cells.pivots)), dtype=bool)
    for at in range(0, len(queries), 32):
        gap = distances(queries[at : at + 32], cells.pivots)
        upper = np.partition((gap[:, :, None] + cells.near).reshape(len(gap), -1), k - 1, axis=1)[:, k - 1]
        # Beyond the radius, and beyond the plane half way to any other pivot.
        plane = ((gap * gap)[:, :, None] - (gap * gap)[:, None, :]) / (2.0 * between)
        lower = np.maximum(gap - cells.radius, plane.max(axis=2)) - ROUNDING * (1.0 + gap)
        # Scores equal in their digits count as ties, so a little more than the bound stays open.
        with np.errstate(invalid="ignore"):
            limit = upper * upper * (1.0 + ROUNDING) + 4e-9 * (1.0 + upper * upper) ** 2
        out[at : at + 32] = used & (np.maximum(lower, 0.0) ** 2 <= limit[:, None])
    return out


def route(queries: DataFrame, cells: Cells, query_key: str) -> DataFrame:
    """``queries`` with the list of ``cells`` that each has to ask."""
    shared = queries.sparkSession.sparkContext.broadcast(cells)
    dim = cells.pivots.shape[1]

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            is_open = open_cells(matrix(batch.column(1), dim), shared.value)
            row, cell = np.nonzero(is_open)
            ends = np.append(0, np.cumsum(is_open.sum(axis=1)))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(cell, pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[query_key, "embedding", "cells"])

    wanted = queries.select(query_key, "embedding")
    schema = T.StructType([*wanted.schema.fields, T.StructField("cells", T.ArrayType(T.IntegerType()))])
    return wanted.mapInArrow(routed, schema)


def blocks_of_cells(rows: np.ndarray, asked: np.ndarray, dim: int, block_bytes: int, scores: int) -> np.ndarray:
    """Number of blocks of each cell: by its size, and by the scores that its queries need."""
    by_size = -(-rows * 8 * dim // block_bytes)
    by_work = -(-rows * asked // scores)
    return np.clip(np.maximum(by_size, by_work), 1, np.maximum(rows, 1))


def score_in_cells(
    index: DataFrame,
    routed: DataFrame,
    rows: np.ndarray,
    best: Best,
    dim: int,
    key: str,
    query_key: str,
    out: T.StructType,
    *,
    block_bytes: int = BLOCK_BYTES,
    scores: int = SCORES_PER_TASK,
) -> DataFrame:
    """The best rows of every block for each query sent to it.

    ``index`` has ``key``, ``embedding`` and ``cell`` (with ``rows`` per cell), ``routed`` has
    ``query_key``, ``embedding`` and ``cells``. The one exchange of vectors deals both by block.
    """
    spark = index.sparkSession
    asked = np.zeros(len(rows), dtype=np.int64)
    for r in routed.select(F.explode("cells").alias("cell")).groupBy("cell").count().collect():  # a row a cell
        asked[r["cell"]] = r["count"]
    per_cell = blocks_of_cells(rows, asked, dim, block_bytes, scores)
    first = np.cumsum(per_cell) - per_cell
    start, n = (F.lit([int(x) for x in values]) for values in (first, per_cell))
    hashed = F.pmod(F.xxhash64(key), F.get(n, F.col("cell")).cast("long"))
    vector = F.col("embedding").cast("array<double>").alias("embedding")
    wanted = F.get(F.lit([bool(x) for x in asked]), F.col("cell"))
    stored = index.where(wanted).select(
        (F.get(start, F.col("cell")) + hashed).cast("int").alias("block"),
        F.lit(0).alias("kind"),
        F.col(key).alias("key"),
        F.lit(None).cast(routed.schema[query_key].dataType).alias("query"),
        vector,
    )
    blocks = F.flatten(
        F.transform("cells", lambda c: F.sequence(F.get(start, c), F.get(start, c) + F.get(n, c) - 1))
    )
    sent = routed.select(
        F.explode(blocks).alias("block"),
        F.lit(1).alias("kind"),
        F.lit(None).cast(index.schema[key].dataType).alias("key"),
        F.col(query_key).alias("query"),
        vector,
    )
    dealt = stored.unionByName(sent).repartition("block").sortWithinPartitions("block", "kind")
    names = out.names
    out_arrow = spark.createDataFrame([], out).toArrow().schema

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current, joined = [], None, None
        for batch in batches:
            block = batch.column(0).to_numpy(zero_copy_only=False)
            kind = batch.column(1).to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((block[1:] != block[:-1]) | (kind[1:] != kind[:-1])) + 1
            for low, high in zip([0, *edges], [*edges, len(block)], strict=True):
                if low == high:
                    continue
                part = batch.slice(int(low), int(high - low))
                if block[low] != current:
                    held, current, joined = [], block[low], None
                vectors = matrix(part.column(4), dim)
                if kind[low] == 0:
                    held.append((part.column(2), vectors))
                    continue
                if not held:
                    continue
                if joined is None:
                    joined = (pa.concat_arrays([ids for ids, _ in held]), np.concatenate([v for _, v in held]))
                    held = [joined]
                found_q, found_id, found_score = best(vectors, iter([joined]))
                asking = part.column(3).to_pylist()
                columns = {names[0]: [asking[q] for q in found_q], names[1]: found_id.tolist(), names[2]: found_score}
                yield pa.RecordBatch.from_pydict(columns, schema=out_arrow)

    return dealt.mapInArrow(score, out)
