"""Document ids, keyed merge, the stored index and run metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.functions.hashing import document_id
from feedloom.functions.lexicon import keyword_sentiment
from feedloom.functions.vectors import has_embedding
from feedloom.operators.embedding import with_hash_embedding
from feedloom.operators.enrich import source_atomic_gate
from feedloom.operators.metrics import (
    embedded_count,
    failed_source_metrics,
    parse_counts,
    run_summary,
    sentiment_counts,
    source_metrics,
    source_summary,
)
from feedloom.operators.sentiment import with_keyword_sentiment
from feedloom.operators.upsert import (
    indexing_summary,
    latest_per_key,
    summarize_write_results,
    to_document,
    upsert,
)
from feedloom.plans.catalogue import inputs as I
from feedloom.plans.catalogue import sql as S
from feedloom.plans.catalogue.registry import query
from feedloom.plans.ingest import failures_of, process
from feedloom.session import materialize, scratch_dir
from feedloom.sources.article_index import ArticleIndex
from feedloom.sources.run_log import append_metrics, metrics_history, read_metrics
from feedloom.streaming.ingest_stream import ingest_stream

# -- ids and merge -----------------------------------------------------------------------

_EVENT_KEY = f"'events|' || event_type || '|' || ({S.iso('ts')})"


@query(
    f"""
SELECT 'page-' || page_id AS item,
       CASE WHEN contains(url, '#') THEN sha256('pages|' || html || '|null') ELSE sha256(url) END AS doc_id
FROM pages
UNION ALL
SELECT 'event-' || event_id, sha256({_EVENT_KEY}) FROM events
"""
)
def document_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys from padded urls, and from source, title and instant where the url is blank."""
    url = F.when(F.contains("url", F.lit("#")), F.lit(" \t")).otherwise(
        F.concat(F.lit(" "), "url", F.lit("\r\n"))
    )
    pages = I.read(spark, sf_dir, "pages").select(
        F.concat(F.lit("page-"), "page_id").alias("item"),
        url.alias("url"),
        F.lit("pages").alias("source"),
        F.col("html").alias("title"),
        F.lit(None).cast("timestamp").alias("at"),
    )
    events = I.read(spark, sf_dir, "events").select(
        F.concat(F.lit("event-"), "event_id").alias("item"),
        F.lit(None).cast("string").alias("url"),
        F.lit("events").alias("source"),
        F.col("event_type").alias("title"),
        I.utc("ts").alias("at"),
    )
    return pages.unionByName(events).select("item", document_id("url", "source", "title", "at").alias("doc_id"))


@query(
    """
SELECT user_id, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id DESC) AS rn FROM events
) WHERE rn = 1
"""
)
def latest_write_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = I.read(spark, sf_dir, "events")
    return latest_per_key(events, "user_id", ("value", "event_id")).select("user_id", "event_id", "event_type")


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index before the batch: every document, labelled with the custom lexicon."""
    articles = I.keyed_articles(spark, sf_dir)
    labelled = with_keyword_sentiment(articles, I.POSITIVE_FRAGMENTS, I.NEGATIVE_FRAGMENTS)
    return to_document(with_hash_embedding(labelled, 16))


def _writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of writes: all labelled documents twice, the second time corrected, and all pages."""
    articles = I.keyed_articles(spark, sf_dir)
    labels = I.read(spark, sf_dir, "labels").withColumnRenamed("doc_id", "n")
    again = articles.join(labels, "n").withColumn("times", F.explode(F.array(F.lit(0), F.lit(1))))
    changed = again.select(
        F.lit("relabel").alias("source_name"),
        F.col("times").alias("response_no"),
        "n",
        "doc_id",
        F.when(F.col("times") == 1, F.concat(F.lit("Corrected: "), "title")).otherwise(F.col("title")).alias("title"),
        "content",
        "source",
        "url",
        "published_at",
        F.when(F.col("toxic") == 1, F.lit("NEGATIVE")).otherwise(F.lit("Positive")).alias("sentiment"),
    )
    pages = I.read(spark, sf_dir, "pages").select(
        F.lit("pages").alias("source_name"),
        F.lit(0).alias("response_no"),
        F.col("page_id").alias("n"),
        document_id("url", F.lit("pages"), F.lit(None).cast("string"), F.lit(None).cast("timestamp")).alias("doc_id"),
        F.col("url").alias("title"),
        F.col("html").alias("content"),
        F.lit("pages").alias("source"),
        "url",
        F.lit(I.RUN_AT).cast("timestamp").alias("published_at"),
        F.lit("neutral").alias("sentiment"),
    )
    rows = changed.unionByName(pages).select(
        F.lit("run-2").alias("run_id"), F.lit(0).alias("source_ord"), F.col("n").alias("pos"), "*"
    )
    return with_hash_embedding(rows, 16)


@query(
    f"""
WITH {S.ARTICLES},
stored AS (
  SELECT a.doc_id AS n, url,
         CASE WHEN l.doc_id IS NULL THEN title ELSE 'Corrected: ' || title END AS title, content, source,
         CASE WHEN l.doc_id IS NULL THEN
           {S.lexicon("lower(title || ' ' || content)", I.POSITIVE_FRAGMENTS, I.NEGATIVE_FRAGMENTS)}
           WHEN toxic = 1 THEN 'negative' ELSE 'positive' END AS sentiment,
         ({I.EPOCH_2024} + a.doc_id * 61) * 1000000 AS published_us
  FROM articles a LEFT JOIN labels l ON l.doc_id = a.doc_id
)
SELECT sha256(url) AS doc_id, title, content, source, url, published_us, sentiment, TRUE AS embedded FROM stored
UNION ALL
SELECT sha256(url), url, html, 'pages', url, {I.RUN_AT_MICROS}, 'neutral', TRUE FROM pages
"""
)
def upsert_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = to_document(latest_per_key(_writes(spark, sf_dir)))
    merged = upsert(_stored(spark, sf_dir), batch)
    return merged.select(
        "doc_id",
        "title",
        "content",
        "source",
        "url",
        F.unix_micros("timestamp").alias("published_us"),
        "sentiment",
        has_embedding("embedding").alias("embedded"),
    )


@query(
    """
SELECT 'relabel' AS source_name, 2 * count(*) AS indexed_count, 0 AS created_count, 2 * count(*) AS updated_count
FROM labels JOIN documents USING (doc_id)
UNION ALL SELECT 'pages', count(*), count(*), 0 FROM pages
"""
)
def upsert_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = indexing_summary(I.article_keys(spark, sf_dir), _writes(spark, sf_dir))
    return summary.drop("run_id")


@query(
    """
SELECT 'user-' || user_id AS source, count(*) FILTER (WHERE event_type <> 'error') AS indexed_count,
       count(*) FILTER (WHERE event_type = 'signup') AS created_count,
       count(*) FILTER (WHERE event_type = 'purchase') AS updated_count
FROM events GROUP BY user_id
"""
)
def write_result_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of write results; unexpected successes count as indexed only."""
    result = F.expr(
        "CASE event_type WHEN 'signup' THEN 'created' WHEN 'purchase' THEN 'updated'"
        " WHEN 'view' THEN 'noop' WHEN 'click' THEN 'unknown' END"
    )
    log = I.read(spark, sf_dir, "events").select(
        F.concat(F.lit("user-"), "user_id").alias("source"), result.alias("result")
    )
    return summarize_write_results(log)


@query(
    """
SELECT source, count(*) AS documents, count(*) AS total_vectors FROM documents GROUP BY source
UNION ALL SELECT 'pages', count(*), count(*) FROM pages
"""
)
def index_count_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents are stored, a batch is merged on top, and the result is read back."""
    index = ArticleIndex(spark, scratch_dir(spark, "index"), rewrite_share=0.9)
    index.create(16, buckets=8)
    index.upsert(_stored(spark, sf_dir))
    index.upsert(to_document(latest_per_key(_writes(spark, sf_dir))))
    return (
        index.read()
        .groupBy("source")
        .agg(
            F.count(F.lit(1)).alias("documents"),
            F.count_if(has_embedding("embedding")).alias("total_vectors"),
        )
    )


# -- run metrics -------------------------------------------------------------------------


def _labeller(title: str, content: str):
    return keyword_sentiment(title, content, I.POSITIVE_FRAGMENTS, I.NEGATIVE_FRAGMENTS)


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched rows of a run whose source src3 sends cut bodies."""
    raw = I.wire_responses(spark, sf_dir).withColumn(
        "body",
        F.when(F.col("source") == "src3", F.expr("substring(body, 1, length(body) div 2)")).otherwise(
            F.col("body")
        ),
    )
    return process(raw, I.wire_config(spark, sf_dir), F.lit(I.RUN_AT).cast("timestamp"), 16, labeller=_labeller)


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of that run against an index that holds the labelled documents already."""
    items = materialize(_items(spark, sf_dir), "items")
    failures = failures_of(items)
    writes = source_atomic_gate(items.filter("kept"), failures)
    labels = I.read(spark, sf_dir, "labels").select(F.col("doc_id").alias("n"))
    known = I.article_keys(spark, sf_dir).join(labels, "n", "left_semi")
    summary = indexing_summary(known, writes)
    return source_metrics(items, summary, failures, I.RUN_AT)


_PER_SOURCE = f"""
{S.ARTICLES},
items AS (
  SELECT a.source, a.source <> 'src3' AS ok, n_chars >= 300 AS kept, l.doc_id IS NOT NULL AS known,
         CASE WHEN n_chars >= 300 THEN
           {S.lexicon("lower(title || ' ' || content_or_title)", I.POSITIVE_FRAGMENTS, I.NEGATIVE_FRAGMENTS)}
         END AS sentiment
  FROM (SELECT *, CASE WHEN trim(content, chr(9) || chr(10) || ' ') = '' THEN title ELSE content END
                  AS content_or_title FROM articles) a
  LEFT JOIN labels l ON l.doc_id = a.doc_id
),
per_source AS (
  SELECT source, ok, count(*) FILTER (WHERE ok) AS fetched_count,
         count(*) FILTER (WHERE ok AND kept) AS normalized_count,
         count(*) FILTER (WHERE ok AND NOT kept) AS discarded_count,
         count(*) FILTER (WHERE ok AND kept AND NOT known) AS created_count,
         count(*) FILTER (WHERE ok AND kept AND known) AS updated_count,
         count(*) FILTER (WHERE ok AND sentiment = 'positive') AS positive_count,
         count(*) FILTER (WHERE ok AND sentiment = 'negative') AS negative_count,
         count(*) FILTER (WHERE ok AND sentiment = 'neutral') AS neutral_count,
         CASE WHEN NOT ok THEN 'Could not parse JSON response for source ' || source END AS error_message
  FROM items GROUP BY source, ok
)"""


@query(
    f"""
WITH {_PER_SOURCE}
SELECT source, CASE WHEN ok THEN 'SUCCESS' ELSE 'FAILED' END AS status, {I.RUN_AT_MICROS} AS run_at_us,
       CASE WHEN ok THEN 'ok' END AS upstream_status, normalized_count AS total_results, fetched_count,
       normalized_count, discarded_count, CASE WHEN ok THEN 0 ELSE 1 END::BIGINT AS failed_requests,
       normalized_count AS embedded_count, normalized_count AS indexed_count, created_count, updated_count,
       positive_count, negative_count, neutral_count, error_message
FROM per_source
"""
)
def source_run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = _metrics(spark, sf_dir).drop("run_id")
    return metrics.withColumn("run_at_us", F.unix_micros("run_at")).drop("run_at")


@query(
    f"""
WITH {_PER_SOURCE}
SELECT source, CASE WHEN ok THEN 'ok' ELSE 'failed' END AS status, fetched_count, normalized_count,
       normalized_count AS processed_count, normalized_count AS embedded_count,
       normalized_count AS indexed_count, created_count, updated_count, normalized_count AS total_results,
       positive_count, negative_count, neutral_count, CASE WHEN NOT ok THEN 1 END::BIGINT AS failed_requests,
       error_message
FROM per_source
"""
)
def source_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_summary(_metrics(spark, sf_dir))


@query(
    f"""
WITH {_PER_SOURCE}
SELECT 'partial' AS status, count(*) AS source_count, sum(fetched_count)::BIGINT AS fetched_count,
       sum(normalized_count)::BIGINT AS normalized_count, sum(normalized_count)::BIGINT AS processed_count,
       sum(normalized_count)::BIGINT AS embedded_count, sum(normalized_count)::BIGINT AS indexed_count,
       sum(created_count)::BIGINT AS created_count, sum(updated_count)::BIGINT AS updated_count,
       sum(normalized_count)::BIGINT AS total_results, sum(positive_count)::BIGINT AS positive_count,
       sum(negative_count)::BIGINT AS negative_count, sum(neutral_count)::BIGINT AS neutral_count
FROM per_source
"""
)
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_summary(source_summary(_metrics(spark, sf_dir)))


@query(
    """
SELECT user_id, CASE WHEN count(*) FILTER (WHERE event_type <> 'error') = count(*) THEN 'ok'
                     WHEN count(*) FILTER (WHERE event_type <> 'error') = 0 THEN 'failed'
                     ELSE 'partial' END AS status,
       count(*) AS source_count, count(*) FILTER (WHERE event_type = 'error') AS fetched_count
FROM (SELECT strftime(ts, '%Y-%m-%d') || '/' || user_id AS user_id, event_type FROM events) GROUP BY user_id
"""
)
def run_status_by_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's day is a run, each event a source of it."""
    failed = F.col("event_type") == "error"
    counters = [c for c in schemas.RUN_METRICS.names if c.endswith("_count") or c == "total_results"]
    rows = I.read(spark, sf_dir, "events").select(
        F.concat_ws("/", F.date_format("ts", "yyyy-MM-dd"), "user_id").alias("user_id"),
        F.when(failed, "failed").otherwise("ok").alias("status"),
        *[failed.cast("long").alias(c) for c in counters],
        failed.cast("long").alias("processed_count"),
    )
    return run_summary(rows, "user_id").select("user_id", "status", "source_count", "fetched_count")


@query(
    f"""
WITH {_PER_SOURCE}
SELECT a.source AS source_name, count(*) AS fetched_count, count(*) FILTER (WHERE kept) AS normalized_count,
       count(*) FILTER (WHERE NOT kept) AS discarded_count, count(*) FILTER (WHERE kept) AS embedded_count,
       count(*) FILTER (WHERE sentiment = 'positive') AS positive_count,
       count(*) FILTER (WHERE sentiment = 'negative') AS negative_count,
       count(*) FILTER (WHERE sentiment = 'neutral') AS neutral_count
FROM items a WHERE a.source <> 'src3' GROUP BY a.source
"""
)
def parse_and_label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The single counters next to each other, of the sources that could be read."""
    items = materialize(_items(spark, sf_dir), "items")
    counts = (
        parse_counts(items, "source_name")
        .join(embedded_count(items, "source_name"), "source_name")
        .join(sentiment_counts(items, "source_name"), "source_name")
    )
    return counts.filter("fetched_count > 0")


@query(
    """
SELECT 'user-' || user_id AS source, 'FAILED' AS status, 1::BIGINT AS failed_requests, 0::BIGINT AS fetched_count,
       event_type || ' ' || event_id AS error_message
FROM events WHERE event_type = 'error'
"""
)
def failed_source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    failures = I.read(spark, sf_dir, "events").filter("event_type = 'error'").select(
        F.date_format("ts", "yyyy-MM-dd").alias("run_id"),
        F.concat(F.lit("user-"), "user_id").alias("source_name"),
        F.concat_ws(" ", "event_type", "event_id").alias("error_message"),
    )
    return failed_source_metrics(failures, I.RUN_AT).select(
        "source", "status", "failed_requests", "fetched_count", "error_message"
    )


@query(
    """
SELECT event_type AS source, max(epoch_us(ts)) AS last_run_us, count(*) AS runs FROM events GROUP BY 1
"""
)
def metrics_log_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as metrics rows, appended in two runs and read back."""
    path = scratch_dir(spark, "metrics")
    counters = [f.name for f in schemas.RUN_METRICS.fields if f.dataType == schemas.LONG]
    rows = I.read(spark, sf_dir, "events").select(
        I.utc("ts").alias("run_at"),
        F.col("event_type").alias("source"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("status"),
        F.lit("ok").alias("upstream_status"),
        *[F.lit(0).cast("long").alias(c) for c in counters],
        F.lit(None).cast("string").alias("error_message"),
    )
    append_metrics(rows.filter("status = 'SUCCESS'"), path, "run-1")
    append_metrics(rows.filter("status = 'FAILED'"), path, "run-2")
    history = metrics_history(read_metrics(spark, path), "source")
    return history.select("source", F.unix_micros("last_run_at").alias("last_run_us"), "runs")


# -- stream ------------------------------------------------------------------------------


@query(
    f"""
WITH {_PER_SOURCE}
SELECT source, sentiment, count(*) AS documents FROM (
  SELECT CASE lang WHEN 'fr' THEN source ELSE lang END AS source,
         {S.lexicon("lower(title || ' ' || content_or_title)", I.POSITIVE_FRAGMENTS, I.NEGATIVE_FRAGMENTS)} AS sentiment
  FROM (SELECT *, CASE WHEN trim(content, chr(9) || chr(10) || ' ') = '' THEN title ELSE content END
                  AS content_or_title FROM articles)
  WHERE n_chars >= 300
) GROUP BY 1, 2
"""
)
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses land as JSON lines, a stream ingests them in two runs, the index is read back."""
    root = scratch_dir(spark, "stream")
    raw = I.wire_responses(spark, sf_dir)
    config = I.wire_config(spark, sf_dir)
    index = ArticleIndex(spark, f"{root}/index")
    index.create(16, buckets=8)
    for landed in (raw.filter("source_ord < 10"), raw.filter("source_ord >= 10")):
        landed.write.mode("append").json(f"{root}/landing")
        ingest_stream(
            spark,
            f"{root}/landing",
            config,
            index,
            f"{root}/metrics",
            f"{root}/checkpoint",
            stop_on_error=True,
            labeller=_labeller,
        ).awaitTermination()
    return index.read().groupBy("source", "sentiment").agg(F.count(F.lit(1)).alias("documents"))
