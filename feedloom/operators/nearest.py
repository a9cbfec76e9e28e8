"""Exact nearest neighbours, for one query vector or a table of them.

Scoring is a matrix product inside Arrow batches. Each task keeps only the best ``k``
per query of what it has seen, so no pair of query and document is ever emitted
beyond those, and the ranking shuffle is small.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.vectors import SCORE_DIGITS
from feedloom.operators.cells import BLOCK_BYTES, MAX_CELLS, choose_pivots, matrix, route, score_in_cells, survey, with_cell
from feedloom.session import materialize

# Query vectors up to this size travel to every executor; more go through the cells.
QUERY_BLOCK_BYTES = 64 * 1024 * 1024
# A worker holds k entries (place, score, id as text, copies while merging) for every query it got.
HELD_BYTES = 512 * 1024 * 1024
ENTRY_BYTES = 1024


def score_against(embedding: str | Column, vector: Sequence[float]) -> Column:
    """Score of every row against one literal vector."""
    query = np.asarray(vector, dtype=np.float64)
    digits = SCORE_DIGITS

    def score(vectors: pa.Array) -> pa.Array:
        rows = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
        gap = rows.reshape(len(vectors), len(query)) - query
        return pa.array(np.round(1.0 / (1.0 + (gap * gap).sum(axis=1)), digits))

    score.__annotations__ = {"vectors": pa.Array, "return": pa.Array}
    return F.arrow_udf(score, "double")(embedding)


def knn(index: DataFrame, vector: Sequence[float], k: int, key: str = "doc_id") -> DataFrame:
    """The ``k`` nearest documents, best first; equal scores go by id.

    One scan of the columns in use, a per-task heap of ``k`` rows
    (TakeOrderedAndProject), no exchange of documents.
    """
    usable = index.filter(F.size("embedding") == len(vector))
    scored = usable.withColumn("score", score_against("embedding", vector)).drop("embedding")
    return scored.orderBy(F.desc("score"), F.asc(key)).limit(k)


def min_score_filter(hits: DataFrame, min_score: float | None) -> DataFrame:
    """Drop weak hits, after the top k were taken; no threshold keeps all."""
    return hits if min_score is None else hits.filter(F.col("score") >= F.lit(float(min_score)))


def _best_per_query(k: int, digits: int = SCORE_DIGITS) -> Callable:
    # Nested so that the workers receive it by value.
    def best(
        queries: np.ndarray, blocks: Iterator[tuple[pa.Array, np.ndarray]]
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query positions, document ids and scores of the best ``k`` per query."""
        n_queries = len(queries)
        rows_at_once = max(64, min(4096, 4_000_000 // max(1, n_queries)))
        query_norms = (queries * queries).sum(axis=1)
        limits = np.full(n_queries, np.inf)
        held_q, held_score, held_id = np.zeros(0, dtype=np.int64), np.zeros(0), None

        for ids, vectors in blocks:
            for start in range(0, len(vectors), rows_at_once):
                part = vectors[start : start + rows_at_once]
                norms = (part * part).sum(axis=1)
                rough = norms[:, None] + query_norms[None, :] - 2.0 * (part @ queries.T)
                if len(part) > k:
                    limits = np.minimum(limits, np.partition(rough, k - 1, axis=0)[k - 1])
                slack = 4e-9 * (1.0 + np.maximum(limits, 0.0)) ** 2 + 1e-11 * (norms.max() + query_norms)
                rows, cols = np.nonzero(rough <= (limits + slack)[None, :])
                exact = np.empty(len(rows))
                for at in range(0, len(rows), 16384):
                    pick = slice(at, at + 16384)
                    gap = part[rows[pick]] - queries[cols[pick]]
                    exact[pick] = np.round(1.0 / (1.0 + (gap * gap).sum(axis=1)), digits)
                new_ids = np.array(ids.take(pa.array(rows + start)).to_pylist())
                if len(new_ids) == 0:
                    continue
                all_q = np.concatenate([held_q, cols])
                all_score = np.concatenate([held_score, exact])
                all_id = new_ids if held_id is None else np.concatenate([held_id, new_ids])
                order = np.lexsort((all_id, -all_score, all_q))
                sorted_q = all_q[order]
                rank = np.arange(len(order)) - np.searchsorted(sorted_q, sorted_q, side="left")
                order = order[rank < k]
                held_q, held_score, held_id = all_q[order], all_score[order], all_id[order]
                counts = np.bincount(held_q, minlength=n_queries)
                last = np.cumsum(counts) - 1
                full = counts == k
                limits[full] = np.minimum(limits[full], 1.0 / held_score[last[full]] - 1.0)
        return held_q, (np.zeros(0) if held_id is None else held_id), held_score

    return best


def knn_batch(
    index: DataFrame,
    queries: DataFrame,
    k: int,
    dim: int,
    *,
    key: str = "doc_id",
    query_key: str = "query_id",
    query_block_bytes: int = QUERY_BLOCK_BYTES,
    index_block_bytes: int = BLOCK_BYTES,
    held_bytes: int = HELD_BYTES,
    cells: int = MAX_CELLS,
) -> DataFrame:
    """The ``k`` nearest documents of every query: query key, document key, score, rank.

    Queries that fit ``query_block_bytes``, and whose best ``k`` fit ``held_bytes``, are sent to
    the executors and the index is scanned once, without an exchange. Larger query tables go
    through Voronoi cells (see ``cells``): bounds from a first pass tell which cells a query has
    to ask, and the rows of the index cross the network once.
    """
    index = index.select(key, "embedding").filter(F.size("embedding") == dim)
    queries = queries.select(query_key, "embedding").filter(F.size("embedding") == dim)
    max_queries = max(1, min(query_block_bytes // (8 * dim), held_bytes // (ENTRY_BYTES * max(1, k))))
    block = queries.limit(max_queries + 1).toArrow()
    out = T.StructType(
        [
            T.StructField(query_key, queries.schema[query_key].dataType),
            T.StructField(key, index.schema[key].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )
    out_arrow = index.sparkSession.createDataFrame([], out).toArrow().schema
    if block.num_rows <= max_queries:
        scored = _scan_with_queries(index, block, k, dim, out, out_arrow)
    else:
        scored = _in_cells(index, queries, k, dim, out, index_block_bytes, cells)
    return _ranked(scored, query_key, key, k)


def _scan_with_queries(
    index: DataFrame, block: pa.Table, k: int, dim: int, out: T.StructType, out_arrow: pa.Schema
) -> DataFrame:
    best = _best_per_query(k)
    query_key, key, _ = out.names
    query_ids = block.column(query_key).to_pylist()
    flat = block.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    matrix = flat.astype(np.float64).reshape(block.num_rows, dim)
    shared = index.sparkSession.sparkContext.broadcast((query_ids, matrix))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries = shared.value

        def blocks():
            for batch in batches:
                values = batch.column(1).flatten().to_numpy(zero_copy_only=False)
                yield batch.column(0), values.astype(np.float64, copy=False).reshape(batch.num_rows, dim)

        found_q, found_id, found_score = best(queries, blocks())
        columns = {query_key: [ids[q] for q in found_q], key: found_id.tolist(), "score": found_score}
        yield pa.RecordBatch.from_pydict(columns, schema=out_arrow)

    return index.mapInArrow(score, out)


def _in_cells(
    index: DataFrame, queries: DataFrame, k: int, dim: int, out: T.StructType, block_bytes: int, cells: int
) -> DataFrame:
    query_key, key, _ = out.names
    pivots = choose_pivots(index, key, dim, cells)
    if not len(pivots):
        return index.sparkSession.createDataFrame([], out)
    known = survey(index, pivots, k)
    routed = materialize(route(queries, known, query_key), "routed-queries")
    placed = with_cell(index, pivots, others=(key,))
    best = _best_per_query(k)
    return score_in_cells(placed, routed, known.rows, best, dim, key, query_key, out, block_bytes=block_bytes)


def batch_in_lists(
    index: DataFrame,
    routed: DataFrame,
    rows: np.ndarray,
    k: int,
    dim: int,
    *,
    key: str,
    query_key: str,
    query_block_bytes: int = QUERY_BLOCK_BYTES,
    held_bytes: int = HELD_BYTES,
) -> DataFrame:
    """The ``k`` best rows among the lists of each query: query key, key, score, rank.

    ``index`` has ``key``, ``embedding`` and its partition column ``cell`` (``rows`` of each
    known), ``routed`` has ``query_key``, ``embedding`` and the ``cells`` to read. A small query
    table travels to the scan of those partitions, which is not shuffled.
    """
    out = T.StructType(
        [
            T.StructField(query_key, routed.schema[query_key].dataType),
            T.StructField(key, index.schema[key].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )
    max_queries = max(1, min(query_block_bytes // (8 * dim), held_bytes // (ENTRY_BYTES * max(1, k))))
    block = routed.limit(max_queries + 1).toArrow()
    if block.num_rows <= max_queries:
        wanted = sorted({c for cells in block.column("cells").to_pylist() for c in cells})
        pruned = index.where(F.col("cell").isin(wanted)) if wanted else index.limit(0)
        scored = _scan_lists(pruned.select(key, "embedding", "cell"), block, k, dim, out)
    else:
        kept = materialize(routed, "routed-queries")
        scored = score_in_cells(index, kept, rows, _best_per_query(k), dim, key, query_key, out)
    return _ranked(scored, query_key, key, k)


def _scan_lists(index: DataFrame, block: pa.Table, k: int, dim: int, out: T.StructType) -> DataFrame:
    """Score the rows of each list against the queries that ask for it."""
    best = _best_per_query(k)
    query_key, key, _ = out.names
    out_arrow = index.sparkSession.createDataFrame([], out).toArrow().schema
    asking: dict[int, list[int]] = {}
    for row, cells in enumerate(block.column("cells").to_pylist()):
        for cell in cells:
            asking.setdefault(cell, []).append(row)
    held = (block.column(query_key).to_pylist(), matrix(block.column("embedding"), dim), asking)
    shared = index.sparkSession.sparkContext.broadcast(held)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries, by_cell = shared.value
        for batch in batches:
            cells = batch.column(2).to_numpy(zero_copy_only=False)
            for cell in np.unique(cells):
                rows = np.flatnonzero(cells == cell)
                part, asked = batch.take(pa.array(rows)), np.array(by_cell.get(int(cell), []), dtype=np.int64)
                if not len(asked):
                    continue
                found_q, found_id, found_score = best(queries[asked], iter([(part.column(0), matrix(part.column(1), dim))]))
                columns = {query_key: [ids[q] for q in asked[found_q]], key: found_id.tolist(), "score": found_score}
                yield pa.RecordBatch.from_pydict(columns, schema=out_arrow)

    return index.mapInArrow(score, out)


def _ranked(scored: DataFrame, query_key: str, key: str, k: int) -> DataFrame:
    ranked = Window.partitionBy(query_key).orderBy(F.desc("score"), F.asc(key))
    return scored.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
