"""Nearest neighbours against brute force."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.functions.vectors import SCORE_DIGITS, l2_score, vector_literal
from feedloom.operators.cells import Cells, blocks_of_cells, distances, open_cells
from feedloom.operators.nearest import knn, knn_batch, min_score_filter
from feedloom.session import scratch_dir
from feedloom.sources.vector_lists import VectorLists

DIM = 64


@pytest.fixture(scope="module")
def vectors(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    return rows.select(F.col("vec_id").alias("doc_id"), F.col("embedding").cast("array<double>"))


@pytest.fixture(scope="module")
def brute(vectors):
    rows = sorted(vectors.collect(), key=lambda r: r.doc_id)
    ids = np.array([r.doc_id for r in rows])
    matrix = np.array([r.embedding for r in rows])

    def best(query, k, ids=ids, matrix=matrix):
        scores = np.round(1 / (1 + ((matrix - np.asarray(query)) ** 2).sum(1)), SCORE_DIGITS)
        order = np.lexsort((ids, -scores))[:k]
        return [(int(ids[i]), float(scores[i])) for i in order]

    best.matrix = matrix
    best.ids = ids
    return best


def test_knn_equals_brute_force(vectors, brute):
    for query in brute.matrix[:3]:
        got = [(r.doc_id, r.score) for r in knn(vectors, query.tolist(), 5).collect()]
        assert got == brute(query, 5)


def test_first_hit_of_a_stored_vector_is_itself(vectors, brute):
    hit = knn(vectors, brute.matrix[7].tolist(), 1).first()
    assert (hit.doc_id, hit.score) == (int(brute.ids[7]), 1.0)


def test_builtin_score_agrees(vectors, brute):
    query = brute.matrix[3].tolist()
    slow = vectors.select("doc_id", l2_score("embedding", vector_literal(query)).alias("score"))
    top = slow.orderBy(F.desc("score"), "doc_id").limit(9).collect()
    assert [(r.doc_id, r.score) for r in top] == brute(query, 9)


@pytest.mark.parametrize(
    ("block_bytes", "held_bytes"), [(1 << 26, 1 << 29), (40 * 8 * DIM, 1 << 29), (1 << 26, 4 * 30 * 1024)]
)
def test_batch_equals_brute_force_on_both_paths(vectors, brute, block_bytes, held_bytes):
    queries = vectors.withColumnRenamed("doc_id", "query_id")
    hits = knn_batch(
        vectors.repartition(7),
        queries,
        4,
        DIM,
        query_block_bytes=block_bytes,
        index_block_bytes=60 * 8 * DIM,
        held_bytes=held_bytes,
    ).collect()
    got = {}
    for r in sorted(hits, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.doc_id, r.score))
    assert len(got) == len(brute.ids)
    for query_id, vector in zip(brute.ids, brute.matrix, strict=True):
        assert got[int(query_id)] == brute(vector, 4)


@pytest.mark.parametrize("block_bytes", [64 * 1024 * 1024, 8 * DIM])
def test_many_copies_of_one_vector_are_ranked_by_id(spark, vectors, brute, block_bytes):
    hot = brute.matrix[0].tolist()
    copies = spark.range(5000, 15000).select(
        F.format_string("c%05d", "id").alias("doc_id"), vector_literal(hot).alias("embedding")
    )
    index = copies.unionByName(vectors.withColumn("doc_id", F.format_string("v%05d", "doc_id")))
    queries = vectors.filter("doc_id < 2").withColumnRenamed("doc_id", "query_id")
    hits = knn_batch(index, queries, 3, DIM, query_block_bytes=block_bytes, index_block_bytes=8 * DIM * 4000)
    first = hits.filter("query_id = 0").orderBy("rank").collect()
    assert [(r.doc_id, r.score) for r in first] == [(f"c0500{i}", 1.0) for i in range(3)]
    second = hits.filter("query_id = 1").orderBy("rank").collect()
    assert second[0].doc_id == "v00001" and second[0].score == 1.0


def test_threshold_applies_after_the_top_k(vectors, brute):
    hits = knn(vectors, brute.matrix[0].tolist(), 5)
    weak = min_score_filter(hits, 0.43).collect()
    assert [(r.doc_id, r.score) for r in weak] == [h for h in brute(brute.matrix[0], 5) if h[1] >= 0.43]
    assert min_score_filter(hits, None).count() == 5


def test_rows_without_a_usable_vector_are_not_searched(spark, vectors, brute):
    odd = spark.createDataFrame([(900001, [1.0]), (900002, []), (900003, None)], vectors.schema)
    hits = knn(vectors.unionByName(odd), brute.matrix[0].tolist(), 1000).collect()
    assert len(hits) == len(brute.ids)
    queries = odd.unionByName(vectors.filter("doc_id = 1")).withColumnRenamed("doc_id", "query_id")
    batch = knn_batch(vectors.unionByName(odd), queries, 1, DIM).collect()
    assert [(r.query_id, r.doc_id) for r in batch] == [(1, 1)]


def _exchanges(frame):
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    return [line for line in plan.splitlines() if "Repartition" in line]


def test_rows_of_the_index_cross_the_network_once(vectors):
    queries = vectors.withColumnRenamed("doc_id", "query_id")
    hits = knn_batch(vectors, queries, 4, DIM, query_block_bytes=0, cells=16)
    physical = hits._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in physical.splitlines() if "Exchange" in line and "Reused" not in line]
    assert len(_exchanges(hits)) == 1  # vectors of index and queries to their block
    assert len(moved) == 2 and any("query_id" in line for line in moved)  # and the best rows to their query


def test_cells_far_away_are_not_asked():
    draw = np.random.default_rng(5)
    centres = draw.normal(0, 10, (20, 8))
    rows = centres[draw.integers(0, 20, 2000)] + draw.normal(0, 0.1, (2000, 8))
    pivots = rows[:40]
    gaps = distances(rows, pivots)
    cell = gaps.argmin(axis=1)
    own = gaps[np.arange(len(rows)), cell]
    near = np.full((40, 5), np.inf)
    for c in range(40):
        found = np.sort(own[cell == c])[:5]
        near[c, : len(found)] = found
    radius = np.array([own[cell == c].max(initial=0) for c in range(40)])
    cells = Cells(pivots, np.bincount(cell, minlength=40), radius, near)
    queries = rows[::50] + draw.normal(0, 0.05, (40, 8))
    is_open = open_cells(queries, cells)
    exact = np.argsort(((rows[None] - queries[:, None]) ** 2).sum(axis=2), axis=1)[:, :5]
    assert all(is_open[q, cell[i]] for q in range(len(queries)) for i in exact[q])
    assert is_open.mean() < 0.15


def test_hot_cells_are_cut_by_size_and_by_work():
    rows, asked = np.array([0, 10, 1000, 1000]), np.array([5, 5, 5, 5000])
    assert blocks_of_cells(rows, asked, 4, 32 * 100, 10**6).tolist() == [1, 1, 10, 10]
    assert blocks_of_cells(rows, asked, 4, 32 * 100, 10**5).tolist() == [1, 1, 10, 50]
    assert blocks_of_cells(rows, asked, 4, 1, 1).tolist() == [1, 10, 1000, 1000]


@pytest.fixture(scope="module")
def lists(spark):
    """500 stored vectors at the parameters of the registered query."""
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    stored = rows.select(F.col("vec_id").alias("doc_id"), "embedding")
    return VectorLists.build(stored, scratch_dir(spark, "lists-test"))


def test_recall_of_the_lists(spark, lists):
    asked = lists.read().select(F.col("doc_id").alias("query_id"), "embedding")
    found = {(r.query_id, r.doc_id): r.score for r in lists.search_batch(asked, 10).collect()}
    exact = {(r.query_id, r.doc_id): r.score for r in knn_batch(lists.read(), asked, 10, DIM).collect()}
    shared = found.keys() & exact.keys()
    assert len(found) == len(exact) == 5000
    assert len(shared) >= 0.9 * len(exact)
    assert all(found[pair] == exact[pair] for pair in shared)
    through_blocks = lists.search_batch(asked, 10, query_block_bytes=0).collect()
    assert {(r.query_id, r.doc_id): r.score for r in through_blocks} == found


def test_all_lists_give_the_exact_result(lists):
    asked = lists.read().where("doc_id < 9").select(F.col("doc_id").alias("query_id"), "embedding")
    all_lists = lists.search_batch(asked, 5, probes=len(lists.centroids)).orderBy("query_id", "rank").collect()
    assert all_lists == knn_batch(lists.read(), asked, 5, DIM).orderBy("query_id", "rank").collect()
    assert lists.read().count() == lists.rows.sum() == 500


def test_a_search_reads_the_probed_lists_only(lists):
    vector = list(lists.read().where("doc_id = 7").first()["embedding"])
    hits = lists.search(vector, 3, probes=2)
    assert hits.first()["doc_id"] == 7
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[list#\d+ IN \(\d+,\d+\)\]", plan), plan


def test_lists_of_odd_rows(spark):
    schema = "doc_id long, embedding array<double>"
    rows = [(1, [0.0, 1.0]), (2, None), (3, []), (4, [1.0]), (5, [1.0, 0.0])] + [(k, [0.5, 0.5]) for k in range(6, 60)]
    lists = VectorLists.build(spark.createDataFrame(rows, schema), scratch_dir(spark, "lists-test"))
    assert lists.rows.sum() == 56
    assert [r.doc_id for r in lists.search([0.5, 0.5], 3).collect()] == [6, 7, 8]
    with pytest.raises(ValueError, match="no vectors"):
        VectorLists.build(spark.createDataFrame(rows[1:3], schema), scratch_dir(spark, "lists-test"))
    none = spark.createDataFrame([(1, None)], "query_id long, embedding array<double>")
    assert lists.search_batch(none, 3).collect() == []
