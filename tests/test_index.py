"""The stored index: creation, merging, layers, versions and the plan of a read."""

import itertools
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from feedloom import schemas
from feedloom.functions.vectors import hashed_vector
from feedloom.operators.search import search
from feedloom.operators.upsert import ORDER, without_heavy_copies
from feedloom.session import scratch_dir
from feedloom.sources.article_index import ArticleIndex
from feedloom.sources.run_log import append_metrics, metrics_history, read_metrics


@pytest.fixture
def path(spark):
    return scratch_dir(spark, "index-test")


def docs(spark, keys, title):
    return spark.createDataFrame(
        [(k, title, "c", "s", "u", None, "neutral", [0.0, 1.0]) for k in keys], schemas.INDEX_DOCUMENT
    )


def contents(index, version=None):
    return {r.doc_id: r.title for r in index.read(version).select("doc_id", "title").collect()}


def test_create_is_repeatable_and_recreate_empties(spark, path):
    index = ArticleIndex(spark, path)
    with pytest.raises(ValueError):
        index.create(0)
    with pytest.raises(ValueError):
        index.read()
    first = index.create(2, buckets=4)
    assert index.create(3) == first and first.dim == 2
    index.upsert(docs(spark, "ab", "one"))
    assert index.count() == 2
    again = index.create(3, recreate=True, buckets=4)
    assert again.dim == 3 and index.count() == 0
    assert ArticleIndex(spark, scratch_dir(spark, "index-test")).create(buckets=2).dim == 384


def test_layers_give_the_same_documents_as_a_plain_merge(spark, path):
    index = ArticleIndex(spark, path, rewrite_share=0.5)
    index.create(2, buckets=4)
    keys = [f"k{i:02d}" for i in range(20)]
    expected = {}
    versions = {}
    for round_no, part in enumerate([keys, keys[:3], keys[2:6] + ["new"], keys[5:19], ["new"]]):
        commit = index.upsert(docs(spark, part, f"r{round_no}"))
        expected.update(dict.fromkeys(part, f"r{round_no}"))
        versions[commit.version] = (dict(expected), commit.delta is None)
        assert contents(index) == expected and index.count() == len(expected)
    assert [whole for _, whole in versions.values()] == [True, False, False, True, False]
    for version, (state, _) in versions.items():
        assert contents(index, version) == state


def test_a_new_session_catalog_finds_the_tables(spark, path):
    index = ArticleIndex(spark, path, rewrite_share=10)
    index.create(2, buckets=4)
    index.upsert(docs(spark, "abc", "one"))
    index.upsert(docs(spark, "cd", "two"))
    for table in spark.catalog.listTables():
        if table.name.startswith("feedloom_"):
            spark.sql(f"DROP TABLE {table.name}")
    assert contents(ArticleIndex(spark, path)) == {"a": "one", "b": "one", "c": "two", "d": "two"}


def test_reading_layers_needs_no_exchange(spark, path):
    index = ArticleIndex(spark, path, rewrite_share=10)
    index.create(2, buckets=4)
    index.upsert(docs(spark, "abc", "one"))
    index.upsert(docs(spark, "cd", "two"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = index.read().select("doc_id", "embedding")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_wrong_dimension_is_refused_and_nothing_is_committed(spark, path):
    index = ArticleIndex(spark, path)
    index.create(3, buckets=4)
    with pytest.raises(PySparkException, match="embedding dimension differs from 3"):
        index.upsert(docs(spark, "a", "one"))
    assert index.count() == 0 and index.commit().version == 1


def test_a_batch_is_taken_once(spark, path):
    index = ArticleIndex(spark, path)
    index.create(2, buckets=4)
    first = index.upsert(docs(spark, "a", "one"), "batch-1")
    assert index.upsert(docs(spark, "a", "other"), "batch-1") == first
    assert contents(index) == {"a": "one"}


def written(spark, rows):
    """Rows of (id, title, time, run, position)."""
    at = [(k, t, "c", "s", "u", None, "neutral", [0.0, 1.0], w, r, 0, 0, p) for k, t, w, r, p in rows]
    schema = StructType([*schemas.STORED_DOCUMENT.fields, *(StructField(c, IntegerType()) for c in ORDER)])
    return spark.createDataFrame(at, schema)


DAYS = [datetime(2026, 5, day) for day in range(1, 9)]


def test_batches_may_land_in_any_order(spark, path):
    batches = [
        [("a", "a1", DAYS[1], "r1", 0), ("b", "b1", DAYS[1], "r1", 1), ("a", "a1 again", DAYS[1], "r1", 2)],
        [("a", "a0", DAYS[0], "r0", 9), ("c", "c0", DAYS[0], "r0", 0)],
        [("b", "b2", DAYS[2], "r2", 0), ("b", "b1 late", DAYS[1], "r2", 5)],
    ]
    for number, order in enumerate(itertools.permutations(range(3))):
        index = ArticleIndex(spark, f"{path}/{number}", rewrite_share=(0.4, 10)[number % 2])
        index.create(2, buckets=2)
        for k in order:
            index.upsert(written(spark, batches[k]))
        assert contents(index) == {"a": "a1 again", "b": "b2", "c": "c0"}, order


def test_writes_without_a_time_replace_and_are_replaced(spark, path):
    index = ArticleIndex(spark, path, rewrite_share=10)
    index.create(2, buckets=2)
    index.upsert(written(spark, [("a", "timed", DAYS[5], "r5", 0)]))
    index.upsert(docs(spark, "a", "plain"))
    assert contents(index) == {"a": "plain"}
    index.upsert(written(spark, [("a", "older", DAYS[0], "r0", 0)]))
    assert contents(index) == {"a": "older"}


def test_a_batch_is_read_once_and_moved_once(spark, path):
    index = ArticleIndex(spark, path, rewrite_share=10)
    index.create(2, buckets=4)
    index.upsert(written(spark, [(f"k{n}", "one", DAYS[0], "r0", n) for n in range(20)]))
    index.upsert(written(spark, [("k1", "two", DAYS[1], "r1", 0)]))
    batch = written(spark, [("k1", "three", DAYS[2], "r2", 0), ("k2", "three", DAYS[2], "r2", 1)])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = index.changed(batch, index.commit())._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan.splitlines()
    assert sum("Exchange" in line for line in lines) == 1
    assert sum("/batch-" in line for line in lines) == 1
    assert sum("SortMergeJoin" in line for line in lines) == 2  # the base's places, the delta


def _scanned(frame):
    """Rows that the scans of a plan gave out, after it ran without adaptive changes."""
    plan = frame._jdf.queryExecution().executedPlan()
    leaves, total = plan.collectLeaves(), 0
    for k in range(leaves.size()):
        leaf = leaves.apply(k)
        if "parquet" in leaf.toString().lower() and leaf.metrics().contains("numOutputRows"):
            total += leaf.metrics().apply("numOutputRows").value()
    return total


def test_a_search_reads_row_groups_of_its_hits_only(spark, path):
    index = ArticleIndex(spark, path, rewrite_share=10)
    index.create(16, buckets=16)
    rows = spark.range(8000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("doc_id"), F.concat(F.lit("word"), "id").alias("title"),
        F.lit("c").alias("content"), F.lit("s").alias("source"), F.lit("u").alias("url"), F.lit(None).cast("timestamp").alias("timestamp"),
        F.lit("neutral").alias("sentiment"), hashed_vector(F.concat(F.lit("word"), "id"), 16).alias("embedding"),
    )
    index.upsert(rows)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = search(index.read(), "word77", 3, dim=16)
        assert len(found.collect()) == 3
        assert 3 <= _scanned(found) <= 3 * 8000 / 16 * 1.3
        ids = [r.doc_id for r in index.read().limit(2).collect()]
        absent = index.read().where(F.col("doc_id").isin([i[:-1] + "x" for i in ids]))
        assert absent.collect() == [] and _scanned(absent) == 0  # by the Bloom filters
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_many_copies_of_one_id_are_cut_down_first(spark):
    rows = written(spark, [("hot", f"t{n}", DAYS[n % 8], "r", n) for n in range(50)] + [("x", "t", DAYS[0], "r", 0)] * 3)
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    left = without_heavy_copies(numbered, heavy_copies=10).select("doc_id", "title").collect()
    assert sorted(map(tuple, left)) == [("hot", "t47"), ("x", "t"), ("x", "t"), ("x", "t")]
    assert without_heavy_copies(numbered, heavy_copies=60).count() == 53


def test_a_rewrite_may_change_the_number_of_buckets(spark, path):
    index = ArticleIndex(spark, path, rewrite_share=10)
    index.create(2, buckets=2)
    index.upsert(docs(spark, "abc", "one"))
    index.upsert(docs(spark, "cd", "two"))
    commit = index.rewrite(buckets=5)
    assert (commit.buckets, commit.delta, commit.base_rows) == (5, None, 4)
    index.upsert(docs(spark, "de", "three"))
    assert contents(index) == {"a": "one", "b": "one", "c": "two", "d": "three", "e": "three"}
    assert contents(index, commit.version - 1) == {"a": "one", "b": "one", "c": "two", "d": "two"}


def test_metrics_log_survives_missing_and_unreadable_files(spark, path, tmp_path):
    log = f"{path}/metrics"
    assert read_metrics(spark, log).count() == 0
    row = spark.createDataFrame([(None,) * len(schemas.RUN_METRICS)], schemas.RUN_METRICS)
    rows = row.drop("batch_id").withColumn("run_at", F.lit("2026-05-09T08:00:00Z").cast("timestamp"))
    assert append_metrics(rows, log, "b1")
    broken = tmp_path / "log"
    broken.mkdir()
    (broken / "part-0.parquet").write_text("not parquet")
    assert append_metrics(rows, str(broken), "b2")
    assert read_metrics(spark, str(broken)).count() == 1
    # A replay replaces the batch's own rows, even where they cannot be read any more.
    for folder in broken.glob("batch-*"):
        for file in folder.glob("*.parquet"):
            file.write_text("damaged")
    assert read_metrics(spark, str(broken)).count() == 0
    assert append_metrics(rows, str(broken), "b2") and append_metrics(rows, str(broken), "b2")
    assert read_metrics(spark, str(broken)).count() == 1
    history = metrics_history(read_metrics(spark, log)).first()
    assert history.runs == 1 and history.last_run_at is not None


def test_failed_metrics_write_is_not_raised(spark, tmp_path):
    blocked = tmp_path / "file"
    blocked.write_text("x")
    row = spark.createDataFrame([(None,) * len(schemas.RUN_METRICS)], schemas.RUN_METRICS).drop("batch_id")
    assert append_metrics(row, f"{blocked}/metrics") is False
