"""DataFrame operators on small literal tables."""

import json

import pytest
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.operators.config import (
    check_config,
    enabled_sources,
    source_config,
    source_config_from_json,
)
from feedloom.operators.embedding import (
    apply_embedding_responses,
    embedding_requests,
    query_embedding_requests,
    with_query_embedding,
)
from feedloom.operators.enrich import enrich, source_atomic_gate, source_failures
from feedloom.operators.fetch import fetch_outcomes
from feedloom.operators.joins import fits, heavy_keys, join_skewed, join_small
from feedloom.operators.metrics import failed_requests, run_summary
from feedloom.operators.normalize import (
    articles_of,
    flatten_responses,
    normalize_generic,
    normalize_typed,
    response_errors,
    typed_responses,
)
from feedloom.operators.search import (
    accepted,
    check_page_args,
    check_search_args,
    display_fields,
    envelope_json,
    rejected,
    response_envelope,
    search,
    search_batch,
)
from feedloom.operators.sentiment import apply_sentiment_responses, sentiment_requests
from feedloom.operators.upsert import indexing_summary, latest_per_key, to_document, upsert

RUN_AT = "2026-05-09T08:00:00Z"


# -- configuration ---------------------------------------------------------------------


def test_config_defaults_and_selection(spark):
    rows = [
        ("a", None, None, None),
        ("b", "TRUE", "GENERIC-JSON", "get"),
        ("c", "yes", " ", " "),
        ("d", " ", "other", "POST"),
        ("e", "false", "generic-json", "GET"),
    ]
    config = source_config(spark.createDataFrame(rows, "name string, enabled string, type string, method string"))
    got = {r.name: (r.enabled, r.type, r.method, r.headers, r.params) for r in config.collect()}
    assert got["a"] == (True, "generic-json", "GET", {}, {})
    assert got["b"] == (True, "GENERIC-JSON", "get", {}, {})
    assert got["c"] == (False, "generic-json", "GET", {}, {})
    assert got["d"][0] is True and got["e"][0] is False
    assert sorted(r.name for r in enabled_sources(config).collect()) == ["a", "b"]
    errors = {r.name: r.error_message for r in check_config(config).collect()}
    assert errors["b"] == "Missing responseMapping for source b"
    assert errors["d"] == "Unsupported HTTP method for source d: POST. Only GET is supported for now."


def test_config_from_json_entries(spark):
    entries = [
        {"name": "a", "enabled": True, "params": {"n": 10, "none": None}, "headers": [1],
         "responseMapping": {"articlesPath": "$.x", "title": "$.t"}},
        {"name": "b", "enabled": "no", "responseMapping": "text"},
        {"name": "c", "enabled": 1, "responseMapping": {"articlesPath": " "}},
    ]
    raw = spark.createDataFrame([(json.dumps(e),) for e in entries], "entry string")
    got = {r.name: r for r in source_config_from_json(raw).collect()}
    assert got["a"].params == {"n": "10", "none": None} and got["a"].headers == {}
    assert got["a"].response_mapping.title == "$.t" and got["a"].response_mapping.url is None
    assert (got["b"].enabled, got["b"].response_mapping) == (False, None)
    assert got["c"].enabled is False
    errors = {r.name: r.error_message for r in check_config(source_config_from_json(raw)).collect()}
    assert errors == {
        "a": None,
        "b": "Missing responseMapping for source b",
        "c": "Missing responseMapping.articlesPath for source c",
    }


# -- fetching --------------------------------------------------------------------------


def outcomes(spark, rows, max_retries):
    log = spark.createDataFrame([("r", *row) for row in rows], schemas.ATTEMPT_LOG)
    return {r.source: (r.ok, r.attempts, r.error_message) for r in fetch_outcomes(log, max_retries).collect()}


def test_transient_failures_are_retried(spark):
    rows = [("n", 1, None, "IOException", "down"), ("n", 2, None, "IOException", "down"), ("n", 3, 200, None, None)]
    assert outcomes(spark, rows, 2) == {"n": (True, 3, None)}
    assert outcomes(spark, rows, 1) == {"n": (False, 2, "HTTP fetch failed for source n: down")}
    assert outcomes(spark, rows, -5) == {"n": (False, 1, "HTTP fetch failed for source n: down")}


def test_permanent_failure_ends_the_loop(spark):
    rows = [("Wire", 1, 400, None, "Bad Request"), ("Wire", 2, 200, None, None)]
    message = "HTTP fetch failed for source Wire: HTTP 400 Bad Request"
    assert outcomes(spark, rows, 3) == {"Wire": (False, 1, message)}


def test_blank_reason_gives_the_error_kind(spark):
    rows = [("s", 1, 503, None, "Service Unavailable"), ("s", 2, None, "ReadTimeoutException", " ")]
    assert outcomes(spark, rows, 1)["s"][2] == "HTTP fetch failed for source s: ReadTimeoutException"


# -- normalizing -----------------------------------------------------------------------

MAPPING = ("$.articles", "$.title", "$.description", "$.url", "$.source.name", "$.publishedAt")


def config_rows(spark, *names, mapping=MAPPING, method="GET"):
    rows = [(n, True, "generic-json", "http://x", method, {}, {}, None, mapping) for n in names]
    return spark.createDataFrame(rows, schemas.SOURCE_CONFIG)


def raw_rows(spark, *pairs):
    rows = [("r", source, i, 0, body, None) for i, (source, body) in enumerate(pairs)]
    return spark.createDataFrame(rows, schemas.RAW_RESPONSE)


def normalized(spark, config, *pairs):
    return normalize_generic(flatten_responses(raw_rows(spark, *pairs), config), RUN_AT)


def test_article_fallbacks(spark):
    items = [
        {"title": None, "url": "u0"},
        {"title": " ", "url": "u1"},
        {"title": "\t", "url": "u2"},
        {"title": "\u00a0", "url": "u3"},
        {"title": "T4", "description": " ", "source": {"name": ""}},
        {"title": 1.5, "description": True, "url": "u5", "source": {"name": "W"}, "publishedAt": "2026-05-09"},
        {"title": "T6", "description": "C", "url": "u6", "source": "W", "publishedAt": "2026-05-09T10:00:00+02:00"},
        "not an object",
    ]
    got = normalized(spark, config_rows(spark, "feed"), ("feed", json.dumps({"articles": items})))
    rows = {r.pos: r for r in articles_of(got).withColumn("at", F.unix_micros("published_at")).collect()}
    assert sorted(rows) == [3, 4, 5, 6]
    assert (rows[4].content, rows[4].source, rows[4].url, rows[4].external_id) == ("T4", "feed", None, None)
    assert (rows[5].title, rows[5].content, rows[5].source) == ("1.5", "true", "W")
    assert rows[6].source == "feed" and rows[6].author is None and rows[6].external_id == "u6"
    assert rows[6].at - rows[5].at == 0
    assert got.count() == 8 and got.filter("kept").count() == 4


def test_every_kind_of_response_error(spark):
    config = (
        config_rows(spark, "ok", "empty", "none", "object", "cut")
        .unionByName(config_rows(spark, "nomap", mapping=None))
        .unionByName(config_rows(spark, "nopath", mapping=(" ", *MAPPING[1:])))
        .unionByName(config_rows(spark, "post", method="POST"))
    )
    got = normalized(
        spark,
        config,
        ("ok", '{"articles":[{"title":"T"}]}'),
        ("empty", '{"articles":[]}'),
        ("none", "{}"),
        ("object", '{"articles":{"a":1}}'),
        ("cut", "{bad"),
        ("nomap", '{"articles":[{"title":"T"}]}'),
        ("nopath", '{"articles":[{"title":"T"}]}'),
        ("post", '{"articles":[{"title":"T"}]}'),
        ("unknown", '{"articles":[{"title":"T"}]}'),
    )
    not_array = "Configured articlesPath for source {} did not resolve to a JSON array: $.articles"
    assert {r.source_name: r.error_message for r in response_errors(got).collect()} == {
        "none": not_array.format("none"),
        "object": not_array.format("object"),
        "cut": "Could not parse JSON response for source cut",
        "nomap": "Missing responseMapping for source nomap",
        "nopath": "Missing responseMapping.articlesPath for source nopath",
        "post": "Unsupported HTTP method for source post: POST. Only GET is supported for now.",
    }
    assert [r.source_name for r in articles_of(got).collect()] == ["ok"]
    assert got.filter("source_name = 'empty'").first().pos is None


def test_typed_payloads(spark):
    payload = {
        "status": "ok",
        "totalResults": 4,
        "articles": [
            {"title": "A", "url": "u1", "content": "C", "description": "D", "author": "x", "source": {"name": "S"}},
            {"title": "B", "url": "u2", "content": " ", "description": "D", "publishedAt": "2026-05-09T00:00:00Z"},
            {"title": "E", "url": " "},
            {"title": None, "url": "u4"},
            {"title": "F", "url": "u5", "source": {"name": " "}},
        ],
    }
    raw = raw_rows(spark, ("t", json.dumps(payload)), ("t", "{}"), ("t", "{bad"))
    typed = typed_responses(raw)
    got = {r.url: r for r in normalize_typed(typed, RUN_AT, "Wire").collect()}
    assert sorted(got) == ["u1", "u2", "u5"]
    assert (got["u1"].content, got["u1"].source, got["u1"].author) == ("C", "S", "x")
    assert (got["u2"].content, got["u2"].source, got["u5"].content) == ("D", "Wire", "")
    assert {r.source for r in normalize_typed(typed, RUN_AT, " ").collect()} == {"S", "Unknown"}
    assert {r.source for r in normalize_typed(typed, RUN_AT).collect()} == {"S", "Unknown"}


# -- enrichment ------------------------------------------------------------------------


def reply(content):
    return json.dumps({"choices": [{"message": {"content": content}}]})


def test_sentiment_replies_and_fallbacks(spark):
    good = {w: ("The harbour opens at nine", 200, reply(json.dumps({"sentiment": w})), w) for w in ("positive", "negative", "neutral")}
    up, down = "Bakery posts record gains this spring", "Losses deepen as risks mount"
    cases = {
        **good,
        "upper": (down, 200, reply('{"sentiment":"POSITIVE"}'), "positive"),
        "notjson": (up, 200, reply("not-json"), "positive"),
        "status": (down, 500, reply('{"sentiment":"positive"}'), "negative"),
        "empty": (down, 200, '{"choices":[]}', "negative"),
        "number": (down, 200, '{"choices":[{"message":{"content":5}}]}', "negative"),
        "mixed": (down, 200, reply('{"sentiment":"mixed"}'), "negative"),
        "padded": (down, 200, reply('{"sentiment":" positive"}'), "negative"),
        "array": (down, 200, reply('["positive"]'), "negative"),
        "labelnum": (down, 200, reply('{"sentiment":1}'), "negative"),
        "outer": (down, 200, "{bad", "negative"),
        "nobody": (down, 200, None, "negative"),
        "noreply": (down, None, None, "negative"),
    }
    articles = spark.createDataFrame([(k, v[0], "") for k, v in cases.items()], "doc_id string, title string, content string")
    replies = spark.createDataFrame(
        [(k, v[1], v[2]) for k, v in cases.items() if k != "noreply"], schemas.MODEL_RESPONSE
    )
    got = {r.doc_id: r.sentiment for r in apply_sentiment_responses(articles, replies).collect()}
    assert got == {k: v[3] for k, v in cases.items()}


def test_embedding_replies(spark):
    bodies = {
        "ok": (200, '{"data":[{"embedding":[0.1,2,-3e0]}]}', None),
        "short": (200, '{"data":[{"embedding":[0.1]}]}', "Embedding dimension is 1 but 3 is expected"),
        "nodata": (200, '{"data":[]}', "Embedding reply did not contain any embedding data"),
        "nokey": (200, "{}", "Embedding reply did not contain any embedding data"),
        "noembedding": (200, '{"data":[{}]}', "Embedding dimension is 0 but 3 is expected"),
        "word": (200, '{"data":[{"embedding":[0.1,"x",1]}]}', "Embedding reply contained a non-numeric vector value"),
        "text": (200, '{"data":[{"embedding":["1.0"]}]}', "Embedding reply contained a non-numeric vector value"),
        "busy": (429, "slow down", "Embedding request failed with status 429: slow down"),
        "bad": (200, "{bad", "Could not read embedding reply"),
        "missing": (None, None, "Embedding reply is missing"),
    }
    articles = spark.createDataFrame([(k,) for k in bodies], "doc_id string")
    replies = spark.createDataFrame(
        [(k, s, b) for k, (s, b, _) in bodies.items() if s is not None], schemas.MODEL_RESPONSE
    )
    got = {r.doc_id: r for r in apply_embedding_responses(articles, replies, 3).collect()}
    assert {k: r.embedding_error for k, r in got.items()} == {k: v[2] for k, v in bodies.items()}
    assert got["ok"].embedding == [0.1, 2.0, -3.0]
    assert all(r.embedding is None for k, r in got.items() if k != "ok")


def test_model_requests(spark):
    articles = spark.createDataFrame([("d", 'T "q"', "x" * 5000), ("e", None, " ")], "doc_id string, title string, content string")
    got = {r.doc_id: json.loads(r.request) for r in sentiment_requests(articles, "m", 10).collect()}
    assert list(got["d"]) == ["model", "temperature", "max_tokens", "response_format", "messages"]
    assert (got["d"]["model"], got["d"]["temperature"], got["d"]["max_tokens"]) == ("m", 0, 20)
    assert got["d"]["messages"][1]["content"].endswith('\n\nT "q"\n\nxxx')
    assert got["e"]["messages"][1]["content"].endswith("untitled n")
    vectors = {r.doc_id: json.loads(r.request) for r in embedding_requests(articles, "m", 7).collect()}
    assert vectors["e"] == {"model": "m", "input": "untitled news article", "dimensions": 7, "encoding_format": "float"}
    queries = spark.createDataFrame([("1", " a "), ("2", " "), ("3", None)], "request_id string, q string")
    asked = {r.request_id: json.loads(r.request)["input"] for r in query_embedding_requests(queries).collect()}
    assert asked == {"1": "a"}
    for build, rows in ((embedding_requests, articles), (query_embedding_requests, queries)):
        with pytest.raises(ValueError):
            build(rows, "m", 0)


def test_providers_are_chosen_by_argument(spark):
    rows = [("r", "s", 0, 0, 0, "http://x", "s", "Strong growth", "", None)]
    articles = spark.createDataFrame(
        rows,
        "run_id string, source_name string, source_ord int, response_no int, pos int, url string,"
        " source string, title string, content string, published_at timestamp",
    )
    default = enrich(articles, 4).first()
    assert default.sentiment == "positive" and len(default.embedding) == 4 and default.embedding_error is None
    replies = spark.createDataFrame([(default.doc_id, 200, reply('{"sentiment":"negative"}'))], schemas.MODEL_RESPONSE)
    vectors = spark.createDataFrame([(default.doc_id, 200, '{"data":[{"embedding":[1,0]}]}')], schemas.MODEL_RESPONSE)
    model = enrich(articles, 2, sentiment_responses=replies, embedding_responses=vectors).first()
    assert (model.sentiment, model.embedding) == ("negative", [1.0, 0.0])

    @F.pandas_udf("array<double>")
    def ones(title):
        return title.map(lambda _: [1.0, 1.0, 1.0])

    own = enrich(articles, 4, labeller=lambda t, c: F.lit("neutral"), embedder=lambda t, c: ones(t)).first()
    assert (own.sentiment, own.embedding_error) == ("neutral", "Embedding dimension is 3 but 4 is expected")


def test_gate_keeps_sources_without_errors(spark):
    rows = [
        ("r", "a", 0, 0, 1, "late"),
        ("r", "a", 0, 0, 0, "early"),
        ("r", "a", 0, 1, 0, None),
        ("r", "b", 1, 0, 0, None),
        ("q", "a", 0, 0, 0, None),
    ]
    articles = spark.createDataFrame(
        rows, "run_id string, source_name string, source_ord int, response_no int, pos int, embedding_error string"
    )
    failures = source_failures(articles)
    assert [(r.run_id, r.source_name, r.error_message) for r in failures.collect()] == [("r", "a", "early")]
    left = source_atomic_gate(articles, failures).collect()
    assert sorted((r.run_id, r.source_name) for r in left) == [("q", "a"), ("r", "b")]


# -- joins under skew ------------------------------------------------------------------


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skewed_join_equals_the_plain_join(spark, how):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("k"), "id"
    )
    left = left.unionByName(spark.createDataFrame([(None, -1)], "k string, id bigint"))
    right = spark.createDataFrame([("hot", 1), ("7", 2), ("8", 3), ("zzz", 4)], "k string, v int")
    plain = left.join(right, "k", how)
    salted = join_skewed(left, right, "k", how, heavy_keys(left, "k", 100), salts=5)
    assert sorted(salted.columns) == sorted(plain.columns)
    names = plain.columns
    assert sorted(map(repr, salted.select(names).collect())) == sorted(map(repr, plain.collect()))


def test_hot_key_is_spread_over_tasks(spark):
    left = spark.range(20000).select(F.lit("hot").alias("k"), "id")
    right = spark.createDataFrame([("hot", 1)], "k string, v int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = join_skewed(left, right, "k", "inner", heavy_keys(left, "k", 100), salts=16)
        parts = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in parts) == 20000
    assert len(parts) > 2 and max(r["count"] for r in parts) < 12000


def test_sketch_finds_all_heavy_keys_among_a_million(spark):
    rows = spark.range(0, 1_200_000, numPartitions=6).select(
        F.when(F.col("id") % 12 == 0, F.lit(-1)).when(F.col("id") % 60 == 1, F.lit(-2)).when(F.col("id") == 5, F.lit(-3))
        .when(F.col("id") % 40 == 2, None).otherwise(F.col("id")).alias("k"), "id"
    )
    found = heavy_keys(rows, "k", 15_000, tracked=512)
    assert sorted(r.k for r in found.collect()) == [-2, -1]
    # By bytes: one row may be as heavy as a hundred thousand others.
    size = F.when(F.col("id") == 5, 50_000).otherwise(1)
    assert sorted(r.k for r in heavy_keys(rows, "k", 30_000, weight=size, tracked=512).collect()) == [-3, -1]
    assert heavy_keys(rows.limit(0), "k", 1).count() == 0
    names = rows.limit(1000).select(F.concat(F.lit("n"), (F.col("id") % 2).cast("string")).alias("k"))
    assert sorted(r.k for r in heavy_keys(names, "k", 400).collect()) == ["n0", "n1"]


@pytest.mark.parametrize("kind", ["string", "bigint"])
def test_a_task_whose_keys_are_all_as_light_leaves_an_empty_sketch(spark, kind):
    rows = spark.range(0, 30, numPartitions=1).select(F.col("id").cast(kind).alias("k"))
    assert heavy_keys(rows, "k", 100, tracked=8).count() == 0
    more = rows.union(spark.range(500).select(F.lit(7).cast(kind)))
    assert [r.k for r in heavy_keys(more, "k", 100, tracked=8).collect()] == ["7" if kind == "string" else 7]
    joined = join_skewed(rows, rows.withColumn("v", F.lit(1)), "k", heavy=heavy_keys(rows, "k", 100, tracked=8))
    assert joined.count() == 30


def test_contents_move_once_when_both_replies_are_joined(spark):
    def reply(*numbers):
        return json.dumps({"data": [{"embedding": list(numbers)}]})

    def label(word):
        return json.dumps({"choices": [{"message": {"content": json.dumps({"sentiment": word})}}]})

    articles = spark.createDataFrame(
        [("r", "s", 0, 0, k, f"t{k}", "gains" if k % 2 else "war", "src", f"u{k}") for k in range(6)],
        "run_id string, source_name string, source_ord int, response_no int, pos int, title string, content string, source string, url string",
    ).withColumn("published_at", F.lit(None).cast("timestamp"))
    ids = {r.url: r.doc_id for r in enrich(articles, 2).collect()}
    schema = "doc_id string, status int, body string"
    labels = spark.createDataFrame([(ids["u0"], 200, label("positive")), (ids["u1"], 500, label("neutral")), ("zz", 200, label("neutral"))], schema)
    vectors = spark.createDataFrame([(ids["u1"], 200, reply(1, 2)), (ids["u2"], 200, reply(1))], schema)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = enrich(articles, 2, sentiment_responses=labels, embedding_responses=vectors)
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    rows = {r.url: r for r in got.collect()}
    assert [rows[f"u{k}"].sentiment for k in range(6)] == ["positive", "positive", "negative", "positive", "negative", "positive"]
    assert rows["u1"].embedding == [1.0, 2.0] and rows["u1"].embedding_error is None
    assert all(rows[f"u{k}"].embedding is None and rows[f"u{k}"].embedding_error for k in (0, 2, 3, 4, 5))
    assert sum("SortMergeJoin" in line and "LeftOuter" in line for line in plan.splitlines()) == 1
    assert len(rows) == 6


def test_small_side_is_broadcast_only_when_it_is_small(spark):
    left, right = spark.range(100).withColumnRenamed("id", "k"), spark.range(50).withColumnRenamed("id", "k")
    assert fits(right, 50) and not fits(right, 49)
    assert join_small(left, right, "k").count() == join_small(left, right, "k", max_rows=10).count() == 50


# -- merge -----------------------------------------------------------------------------


def writes(spark, *rows):
    data = [("r", source, order, 0, pos, key, title) for source, order, pos, key, title in rows]
    return spark.createDataFrame(
        data,
        "run_id string, source_name string, source_ord int, response_no int, pos int, doc_id string, title string",
    )


def test_last_write_wins_and_counts_add_up(spark):
    batch = writes(
        spark,
        ("a", 0, 0, "k1", "one"),
        ("a", 0, 1, "k2", "two"),
        ("a", 0, 2, "k1", "three"),
        ("b", 1, 0, "k2", "four"),
        ("b", 1, 1, "k3", "five"),
    )
    last = {r.doc_id: r.title for r in latest_per_key(batch).collect()}
    assert last == {"k1": "three", "k2": "four", "k3": "five"}
    index = spark.createDataFrame([("k3", "old"), ("k9", "kept")], "doc_id string, title string")
    summary = {r.source_name: r for r in indexing_summary(index, batch).collect()}
    assert (summary["a"].indexed_count, summary["a"].created_count, summary["a"].updated_count) == (3, 2, 1)
    assert (summary["b"].indexed_count, summary["b"].created_count, summary["b"].updated_count) == (2, 0, 2)
    merged = upsert(index, latest_per_key(batch).select("doc_id", "title"))
    once = {r.doc_id: r.title for r in merged.collect()}
    assert once == {**last, "k9": "kept"}
    again = upsert(merged, latest_per_key(batch).select("doc_id", "title"))
    assert {r.doc_id: r.title for r in again.collect()} == once and again.count() == 4


def test_latest_per_key_reduces_before_the_shuffle(spark):
    batch = writes(spark, ("a", 0, 0, "k1", "one"))
    plan = latest_per_key(batch)._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan.split("Exchange")[-1]


def test_to_document_drops_author_and_external_id(spark):
    row = spark.createDataFrame(
        [("d", "e", "t", "c", "s", "x", "u", None, "POSITIVE", [1.0])],
        "doc_id string, external_id string, title string, content string, source string, author string, url string,"
        " published_at timestamp, sentiment string, embedding array<double>",
    )
    document = to_document(row)
    assert document.columns == schemas.INDEX_DOCUMENT.names
    assert document.first().sentiment == "positive"


# -- metrics ---------------------------------------------------------------------------


def test_failed_requests_never_negative(spark):
    rows = spark.createDataFrame([(5, 3), (3, 5)], "p bigint, i bigint")
    assert [r.f for r in rows.select(failed_requests("p", "i").alias("f")).collect()] == [2, 0]


def test_summary_of_no_sources(spark):
    from feedloom.operators.metrics import SUMMED

    empty = spark.createDataFrame([], ", ".join(["status string", *[f"{c} bigint" for c in SUMMED]]))
    row = run_summary(empty).first()
    assert (row.status, row.source_count, row.fetched_count) == ("ok", 0, 0)


# -- search ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def index(spark):
    texts = ["healthcare reform", "market crash", "healthcare costs rise", "football results"]
    rows = [(f"d{i}", t, "body", None if i == 3 else "Wire", f"u{i}", t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id string, title string, content string, source string, url string, q string")
    return with_query_embedding(docs, 16).select(
        "doc_id",
        "title",
        "content",
        "source",
        "url",
        F.lit("2026-05-09T00:00:00Z").cast("timestamp").alias("timestamp"),
        F.lit("neutral").alias("sentiment"),
        "embedding",
    )


def test_search_returns_result_fields_best_first(index):
    rows = search(index, "Healthcare REFORM", 3, dim=16).collect()
    assert list(rows[0].asDict()) == ["title", "source", "url", "sentiment", "timestamp", "score"]
    assert rows[0].title == "healthcare reform" and rows[0].score == 1.0
    assert rows[0].timestamp == "2026-05-09T00:00:00Z"
    assert [r.score for r in rows] == sorted((r.score for r in rows), reverse=True) and len(rows) == 3
    strong = search(index, "healthcare reform", 3, 0.9, dim=16).collect()
    assert [r.title for r in strong] == ["healthcare reform"]


@pytest.mark.parametrize(
    ("q", "size", "min_score", "message"),
    [
        (None, 5, None, "'q' is required"),
        (" ", 5, None, "'q' is required"),
        ("x", 21, None, "between 1 and 20"),
        ("x", 0, None, "between 1 and 20"),
        ("x", 5, -0.1, "greater than or equal to 0"),
    ],
)
def test_search_rejects_wrong_arguments(index, q, size, min_score, message):
    with pytest.raises(ValueError, match=message):
        search(index, q, size, min_score, dim=16)


def test_request_table_is_checked_row_by_row(spark):
    rows = [
        ("1", "healthcare", 10, None),
        ("2", "healthcare", 10, 0.39),
        ("3", "healthcare", 10, -0.1),
        ("4", "healthcare", 21, None),
        ("5", None, 5, None),
        ("6", " ", 5, None),
        ("7", "x", None, 0.0),
        ("8", "x", 0, None),
        ("9", "x", 1, 1.5),
        ("10", "x", 20, None),
    ]
    checked = check_search_args(spark.createDataFrame(rows, schemas.SEARCH_REQUEST))
    good = {r.request_id: r["size"] for r in accepted(checked).collect()}
    assert good == {"1": 10, "2": 10, "7": 5, "9": 1, "10": 20}
    bad = {r.request_id: r.message for r in rejected(checked).collect()}
    assert bad["3"] == "Query parameter 'minScore' must be greater than or equal to 0"
    assert bad["4"] == bad["8"] == "Query parameter 'size' must be between 1 and 20"
    assert bad["5"] == bad["6"] == "Query parameter 'q' is required"
    page = {r.request_id: r.message for r in check_page_args(spark.createDataFrame(rows, schemas.SEARCH_REQUEST)).collect()}
    assert page["9"] == "Min score must be empty or between 0 and 1."
    assert page["7"] == "Size must be a whole number between 1 and 20." and page["2"] is None


def test_batch_search_and_envelope(spark, index):
    rows = [("a", "healthcare reform", 2, None), ("b", "healthcare reform", 3, 0.9), ("c", "—", 1, 0.99)]
    requests = spark.createDataFrame(rows, schemas.SEARCH_REQUEST)
    hits = search_batch(index, requests, dim=16)
    single = [r.title for r in search(index, "healthcare reform", 2, dim=16).collect()]
    assert [r.title for r in hits.filter("request_id = 'a'").orderBy("rank").collect()] == single
    envelope = {r.request_id: r for r in response_envelope(requests, hits).collect()}
    assert (envelope["a"].result_count, envelope["b"].result_count, envelope["c"].result_count) == (2, 1, 0)
    texts = {r.request_id: json.loads(r.reply) for r in envelope_json(response_envelope(requests, hits)).collect()}
    assert texts["c"] == {"query": "—", "resultCount": 0, "minScore": 0.99, "results": []}
    assert "minScore" not in texts["a"] and texts["a"]["results"][0]["score"] == 1.0


def test_display_fields(spark):
    rows = [
        ("T", "S", "u", "Positive", "2026", 0.42),
        (None, None, None, None, None, None),
        ("", "", None, "mixed", "", float("nan")),
    ]
    shown = display_fields(
        spark.createDataFrame(
            rows, "title string, source string, url string, sentiment string, timestamp string, score double"
        )
    ).collect()
    empty = ("Untitled article", "Unknown source", None, "neutral", "No timestamp", "Score n/a")
    assert [tuple(r) for r in shown] == [("T", "S", "u", "positive", "2026", "Score 0.420"), empty, empty]


def test_failures_of_other_kinds_end_the_loop(spark):
    rows = [
        ("io", 1, None, "IOException", "reset"), ("io", 2, 200, None, None),
        ("own", 1, None, "IllegalStateException", "bad"), ("own", 2, 200, None, None),
        ("none", 1, None, None, "?"), ("none", 2, 200, None, None),
    ]
    got = outcomes(spark, rows, 3)
    assert got["io"][:2] == (True, 2)
    assert got["own"][:2] == (False, 1) and got["none"][:2] == (False, 1)


def test_repeated_embedding_replies_do_not_repeat_articles(spark):
    from feedloom.operators.embedding import apply_embedding_responses

    good, bad = '{"data":[{"embedding":[1.0,2.0]}]}', '{"data":[]}'
    replies = spark.createDataFrame(
        [("d1", 500, bad), ("d1", 200, good), ("d1", 200, good), ("d2", 500, bad), ("d2", 200, bad)],
        "doc_id string, status int, body string",
    )
    articles = spark.createDataFrame([("d1",), ("d2",), ("d3",)], "doc_id string")
    got = {r.doc_id: r for r in apply_embedding_responses(articles, replies, 2).collect()}
    assert len(got) == apply_embedding_responses(articles, replies, 2).count() == 3
    assert got["d1"].embedding == [1.0, 2.0] and got["d1"].embedding_error is None
    assert got["d2"].embedding is None and got["d2"].embedding_error


def test_salted_join_spreads_copies_and_missing_keys(spark):
    from feedloom.operators.joins import join_skewed

    left = spark.createDataFrame([("hot", "same")] * 200 + [(None, "same")] * 200 + [("b", "x")], "k string, v string")
    right = spark.createDataFrame([("hot", 1), ("b", 2), (None, 3)], "k string, w int")
    for how, rows in (("inner", 201), ("left", 401), ("left_semi", 201), ("left_anti", 200)):
        joined = join_skewed(left, right, "k", how, salts=8, heavy_rows=100)
        assert joined.count() == rows, how
