"""Whole runs over small literal responses: isolation of failing sources, merge, metrics, replay."""

import json
import os
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.operators.config import source_config
from feedloom.operators.fetch import fetch_failures, fetch_outcomes
from feedloom.plans.ingest import ingest, parse_generic, parse_typed
from feedloom.session import scratch_dir
from feedloom.sources.article_index import ArticleIndex
from feedloom.sources.responses import raw_responses
from feedloom.sources.run_log import batch_recorded, metrics_history, read_metrics
from feedloom.streaming.dead_letters import DeadLetters
from feedloom.streaming.ingest_stream import ingest_stream

RUN_AT = datetime(2026, 5, 9, 8, tzinfo=UTC)
MAPPING = ("$.articles", "$.title", "$.description", "$.url", "$.source.name", "$.publishedAt")


def config_of(spark, *names):
    rows = [(n, None, None, "http://x", None, None, None, None, MAPPING) for n in names]
    return source_config(spark.createDataFrame(rows, schemas.SOURCE_CONFIG))


def body(*articles):
    return json.dumps({"articles": list(articles)})


def article(n, **more):
    return {
        "title": f"Title {n}",
        "description": "Plain words about a harbour",
        "url": f"https://x/{n}",
        "source": {"name": "Wire"},
        "publishedAt": "2026-05-09T00:00:00Z",
        **more,
    }


def raw_of(spark, *rows, run="r1"):
    data = [(run, source, i, 0, text, RUN_AT) for i, (source, text) in enumerate(rows)]
    return spark.createDataFrame(data, schemas.RAW_RESPONSE)


@pytest.fixture
def store(spark):
    root = scratch_dir(spark, "ingest-test")
    index = ArticleIndex(spark, f"{root}/index")
    index.create(16, buckets=4)
    return index, f"{root}/metrics"


def test_broken_source_does_not_stop_the_others(spark, store):
    index, metrics = store
    raw = raw_of(spark, ("broken", "{bad"), ("working", body(article(1))))
    result = ingest(raw, config_of(spark, "broken", "working"), index, metrics, run_at=RUN_AT)
    total = result.summary.first()
    assert (total.status, total.source_count, total.fetched_count, total.indexed_count) == ("partial", 2, 1, 1)
    rows = {r.source: r for r in result.sources.collect()}
    assert rows["broken"].failed_requests == 1
    assert rows["broken"].error_message == "Could not parse JSON response for source broken"
    assert rows["working"].status == "ok" and rows["working"].failed_requests is None
    assert index.count() == 1


def test_all_sources_broken(spark, store):
    index, metrics = store
    raw = raw_of(spark, ("b1", "{}"), ("b2", '{"articles":{"a":1}}'))
    total = ingest(raw, config_of(spark, "b1", "b2"), index, metrics, run_at=RUN_AT).summary.first()
    assert (total.status, total.source_count, total.processed_count, total.indexed_count) == ("failed", 2, 0, 0)


def test_fetch_failure_is_reported_for_its_source(spark, store):
    index, metrics = store
    log = spark.createDataFrame(
        [("r1", "down", 1, 400, None, "Bad Request"), ("r1", "up", 1, 200, None, None)], schemas.ATTEMPT_LOG
    )
    failed = fetch_failures(fetch_outcomes(log))
    result = ingest(
        raw_of(spark, ("up", body())),
        config_of(spark, "up", "down"),
        index,
        metrics,
        run_at=RUN_AT,
        fetch_failures=failed,
    )
    rows = {r.source: r for r in result.metrics.collect()}
    assert rows["up"].status == "SUCCESS" and rows["up"].fetched_count == 0
    assert rows["down"].status == "FAILED" and rows["down"].upstream_status is None
    assert rows["down"].error_message == "HTTP fetch failed for source down: HTTP 400 Bad Request"
    assert result.summary.first().status == "partial"


def test_second_run_updates_instead_of_duplicating(spark, store):
    index, metrics = store
    config = config_of(spark, "a", "b")
    raw = raw_of(spark, ("a", body(article(1), article(2))), ("b", body(article(2, title="Later"), {"title": " "})))
    first = ingest(raw, config, index, metrics, run_at=RUN_AT)
    rows = {r.source: r for r in first.metrics.collect()}
    assert (rows["a"].created_count, rows["a"].updated_count) == (2, 0)
    assert (rows["b"].created_count, rows["b"].updated_count) == (0, 1)
    assert (rows["b"].fetched_count, rows["b"].normalized_count, rows["b"].discarded_count) == (2, 1, 1)
    assert index.count() == 2
    assert index.read().filter("url = 'https://x/2'").first().title == "Later"

    again = ingest(raw, config, index, metrics, run_at=RUN_AT).summary.first()
    assert (again.created_count, again.updated_count, again.indexed_count) == (0, 3, 3)
    assert index.count() == 2
    history = metrics_history(read_metrics(spark, metrics)).first()
    assert history.runs == 4 and history.last_run_at is not None


def test_a_replayed_batch_changes_nothing(spark, store):
    index, metrics = store
    config, raw = config_of(spark, "a"), raw_of(spark, ("a", body(article(1))))
    first = ingest(raw, config, index, metrics, run_at=RUN_AT, batch_id="b-0")
    again = ingest(raw, config, index, metrics, run_at=RUN_AT, batch_id="b-0")
    assert again.commit == first.commit
    assert again.metrics.first().created_count == 1
    assert read_metrics(spark, metrics).count() == 1
    assert batch_recorded(spark, metrics, "b-0") and not batch_recorded(spark, metrics, "b-1")


def test_no_enabled_source_is_an_error(spark, store):
    index, metrics = store
    config = config_of(spark, "a").withColumn("enabled", F.lit(False))
    with pytest.raises(ValueError, match="No enabled generic-json sources are configured"):
        ingest(raw_of(spark, ("a", body())), config, index, metrics, run_at=RUN_AT)


def test_one_bad_vector_holds_back_its_source(spark, store):
    index, metrics = store

    def embedder(title, content):
        good = F.array_repeat(F.lit(0.25), 16)
        return F.when(F.col(title) == "Title 2", F.array(F.lit(1.0))).otherwise(good)

    raw = raw_of(spark, ("a", body(article(1), article(2))), ("b", body(article(3))))
    result = ingest(raw, config_of(spark, "a", "b"), index, metrics, run_at=RUN_AT, embedder=embedder)
    rows = {r.source: r for r in result.metrics.collect()}
    assert rows["a"].status == "FAILED" and "is 1 but 16" in rows["a"].error_message
    assert rows["a"].indexed_count == 0 and rows["b"].indexed_count == 1
    assert [r.url for r in index.read().collect()] == ["https://x/3"]


def test_own_sink_receives_the_documents(spark, store):
    index, metrics = store
    seen = []
    raw = raw_of(spark, ("a", body(article(1), article(1, title="Again"))))
    result = ingest(
        raw,
        config_of(spark, "a"),
        index,
        metrics,
        run_at=RUN_AT,
        sink=lambda docs: seen.extend(r.title for r in docs.collect()),
    )
    assert seen == ["Again"] and result.commit is None and index.count() == 0


def test_stream_takes_each_file_once(spark, store):
    index, metrics = store
    root = scratch_dir(spark, "stream-test")
    config = config_of(spark, "a", "b")

    def land(*rows, run):
        raw_of(spark, *rows, run=run).coalesce(1).write.mode("append").json(f"{root}/landing")

    def run():
        ingest_stream(
            spark, f"{root}/landing", config, index, metrics, f"{root}/checkpoint", stop_on_error=True
        ).awaitTermination()

    land(("a", body(article(1), article(2, publishedAt="2026-05-09"))), run="r1")
    landed = raw_responses(spark, f"{root}/landing")
    assert landed.schema == schemas.RAW_RESPONSE and landed.count() == 1
    run()
    # Without an instant of its own, an article gets the time of its response.
    assert index.read().filter("url = 'https://x/2'").first().timestamp == RUN_AT.replace(tzinfo=None)
    run()
    assert index.count() == 2 and read_metrics(spark, metrics).count() == 1
    land(("a", body(article(2, title="New"))), ("b", body(article(3))), run="r2")
    run()
    assert index.count() == 3 and read_metrics(spark, metrics).count() == 3
    assert index.read().filter("url = 'https://x/2'").first().title == "New"


def test_failed_stream_run_is_logged_and_the_next_one_goes_on(spark, store):
    index, metrics = store
    root = scratch_dir(spark, "stream-test")
    off = config_of(spark, "a").withColumn("enabled", F.lit(False))
    raw_of(spark, ("a", body(article(1)))).write.json(f"{root}/landing")
    ingest_stream(
        spark, f"{root}/landing", off, index, metrics, f"{root}/cp", stop_on_error=False
    ).awaitTermination()
    raw_of(spark, ("a", body(article(2)))).write.mode("append").json(f"{root}/landing")
    ingest_stream(
        spark, f"{root}/landing", config_of(spark, "a"), index, metrics, f"{root}/cp"
    ).awaitTermination()
    assert sorted(r.url for r in index.read().collect()) == ["https://x/1", "https://x/2"]


def test_one_poisoned_file_keeps_no_other_out(spark, store):
    index, metrics = store
    root = scratch_dir(spark, "poison 1+1 %")
    for n in range(5):
        raw_of(spark, (f"s{n}", body(article(n)))).coalesce(1).write.mode("append").json(f"{root}/landing")
    args = (spark, f"{root}/landing", config_of(spark, *(f"s{n}" for n in range(6))), index, metrics, f"{root}/cp")

    def picky(raw, config, run_at):
        if not raw.where("source = 's3' AND body NOT LIKE '%repaired%'").isEmpty():
            raise RuntimeError("cannot read this one")
        return parse_generic(raw, config, run_at)

    ingest_stream(*args, stop_on_error=False, parser=picky).awaitTermination()
    assert index.count() == 0
    raw_of(spark, ("s5", body(article(5)))).coalesce(1).write.mode("append").json(f"{root}/landing")
    ingest_stream(*args, stop_on_error=False, parser=picky).awaitTermination()
    assert sorted(r.url[-1] for r in index.read().collect()) == ["0", "1", "2", "4", "5"]
    letters = DeadLetters(spark, f"{root}/cp-retry")
    bad = letters.waiting()[0].removeprefix("file:")
    with open(bad, "w") as file:
        good = {"run_id": "r1", "source": "s3", "source_ord": 0, "response_no": 0, "body": body(article(3, title="repaired"))}
        file.write(json.dumps(good) + "\n")
    os.remove(os.path.join(os.path.dirname(bad), f".{os.path.basename(bad)}.crc"))
    ingest_stream(*args, stop_on_error=False, parser=picky).awaitTermination()
    assert index.count() == 6 and letters.waiting() == []
    ingest_stream(*args, stop_on_error=False, parser=picky).awaitTermination()
    assert read_metrics(spark, metrics).count() == 6


def test_an_unreadable_typed_body_fails_its_source(spark, store):
    index, metrics = store
    good = json.dumps({"status": "ok", "articles": [article(1), article(2, url=" "), article(3, title=None)]})
    bodies = [
        ("good", good), ("empty", "{}"), ("none", "null"), ("cut", good[:-9]), ("typed", '{"articles": {"a": 1}}'),
        ("array", "[]"), ("missing", None), ("mixed", good), ("mixed", "{"),
    ]
    names = sorted({n for n, _ in bodies})
    rows = [(n, None, None, "http://x", "POST" if n == "posts" else None, None, None, None, None) for n in [*names, "posts"]]
    config = source_config(spark.createDataFrame(rows, schemas.SOURCE_CONFIG))
    result = ingest(raw_of(spark, *bodies), config, index, metrics, run_at=RUN_AT, parser=parse_typed)
    found = {r.source: (r.status, r.fetched_count, r.indexed_count) for r in result.metrics.collect()}
    assert found.pop("good") == ("SUCCESS", 3, 1)
    assert found.pop("empty") == found.pop("none") == ("SUCCESS", 0, 0)
    assert found.keys() == {"cut", "typed", "array", "missing", "mixed", "posts"} and set(found.values()) == {("FAILED", 0, 0)}
    stored = index.read().collect()
    assert [(r.url, r.title, r.content) for r in stored] == [("https://x/1", "Title 1", "Plain words about a harbour")]


def test_the_later_run_wins_whatever_its_positions(spark, store):
    index, metrics = store
    later = datetime(2026, 5, 10, 8, tzinfo=UTC)
    old = ("r1", "a", 5, 1, body(article(9), article(1, title="OLD")), RUN_AT)
    new = ("r0", "a", 0, 0, body(article(1, title="NEW")), later)
    raw = spark.createDataFrame([old, new], schemas.RAW_RESPONSE)
    result = ingest(raw, config_of(spark, "a"), index, metrics, run_at=RUN_AT)
    assert index.read().filter("url = 'https://x/1'").first().title == "NEW"
    totals = {r.run_id: (r.created_count, r.updated_count, r.source_count) for r in result.summary.collect()}
    assert totals == {"r1": (2, 0, 1), "r0": (0, 1, 1)}


def test_responses_without_a_run_are_counted(spark, store):
    index, metrics = store
    raw = raw_of(spark, ("good", body(article(1), article(2))), ("broken", "{"), run=None)
    result = ingest(raw, config_of(spark, "good", "broken"), index, metrics, run_at=RUN_AT, batch_id="b7")
    rows = {r.source: r for r in result.metrics.collect()}
    assert len(rows) == 2 and {r.run_id for r in rows.values()} == {"b7"}
    assert (rows["good"].indexed_count, rows["good"].created_count, rows["good"].failed_requests) == (2, 2, 0)
    assert (rows["broken"].status, rows["broken"].failed_requests) == ("FAILED", 1)
    total = result.summary.first()
    assert (total.status, total.source_count) == ("partial", 2)


def test_a_wrongly_configured_source_fails_without_a_response(spark, store):
    index, metrics = store
    rows = [
        ("good", None, None, "http://x", None, None, None, None, MAPPING),
        ("posts", None, None, "http://x", "POST", None, None, None, MAPPING),
    ]
    config = source_config(spark.createDataFrame(rows, schemas.SOURCE_CONFIG))
    result = ingest(raw_of(spark, ("good", body(article(1)))), config, index, metrics, run_at=RUN_AT)
    found = {r.source: r.status for r in result.metrics.collect()}
    assert found == {"good": "SUCCESS", "posts": "FAILED"}
    total = result.summary.first()
    assert (total.status, total.source_count) == ("partial", 2)


def test_a_failed_batch_comes_in_with_the_next_call(spark, store):
    index, metrics = store
    root = scratch_dir(spark, "retry")
    raw_of(spark, ("a", body(article(1)))).write.json(f"{root}/landing")
    config = config_of(spark, "a")
    args = (spark, f"{root}/landing", config, index, metrics, f"{root}/checkpoint")

    def fails(*_):
        raise RuntimeError("no parser today")

    with pytest.raises(Exception, match="no parser today"):
        ingest_stream(*args, parser=fails).awaitTermination()
    assert index.count() == 0
    ingest_stream(*args).awaitTermination()
    assert index.count() == 1
