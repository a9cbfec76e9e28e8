"""Whole runs: merges in any order, replays, failed batches, and the caller's own parts."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.fixed_values import BAD_JSON_MESSAGE, BAD_METHOD_MESSAGE
from feedloom.functions.lexicon import keyword_sentiment
from feedloom.operators.embedding import with_hash_embedding
from feedloom.operators.upsert import to_document
from feedloom.plans.catalogue import inputs as I
from feedloom.plans.catalogue import sql as S
from feedloom.plans.catalogue.registry import query
from feedloom.plans.ingest import RunResult, ingest, parse_typed
from feedloom.session import scratch_dir
from feedloom.sources.article_index import ArticleIndex
from feedloom.sources.run_log import read_metrics
from feedloom.streaming.ingest_stream import ingest_stream

LATER = I.RUN_AT + timedelta(days=1)


def _text(template: str, *args: str) -> str:
    """SQL text of a message; ``args`` are SQL expressions."""
    text = "'" + template.replace("'", "''") + "'"
    for i, arg in enumerate(args, 1):
        text = text.replace(f"%{i}$s", f"' || {arg} || '")
    return text


def _labeller(title: str, content: str):
    return keyword_sentiment(title, content, I.POSITIVE_FRAGMENTS, I.NEGATIVE_FRAGMENTS)


def _index(spark: SparkSession, dim: int = 16) -> tuple[ArticleIndex, str]:
    root = scratch_dir(spark, "run")
    index = ArticleIndex(spark, f"{root}/index", rewrite_share=0.9)
    index.create(dim, buckets=8)
    return index, f"{root}/metrics"


def _run(spark: SparkSession, sf_dir: str, index: ArticleIndex, metrics: str, **options) -> RunResult:
    settings = {"config": I.wire_config(spark, sf_dir), "raw": I.wire_responses(spark, sf_dir), "labeller": _labeller}
    settings |= options
    return ingest(index=index, metrics_path=metrics, run_at=I.RUN_AT, **settings)


# Documents with a title, as the generic mapping reads them.
_KEPT = f"""{S.ARTICLES},
kept AS (
  SELECT *, CASE lang WHEN 'fr' THEN source ELSE lang END AS shown_source,
         CASE WHEN trim(content, chr(9) || chr(10) || ' ') = '' THEN title ELSE content END AS body
  FROM articles WHERE n_chars >= 300
)"""


@query(
    f"""
WITH {S.ARTICLES}
SELECT sha256(url) AS doc_id, CASE WHEN lang <> 'en' THEN 'Corrected: ' || title ELSE title END AS title,
       coalesce(lang <> 'en', FALSE) AS late
FROM articles
"""
)
def merge_of_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, and corrections of those that are not English, fetched a day later, in one index:
    corrections of some sources land after their documents, those of all others before."""
    articles = I.keyed_articles(spark, sf_dir).withColumn("sentiment", F.lit("neutral"))
    first = articles.withColumns({"written_at": F.lit(I.RUN_AT), "written_run": F.lit("run-1")})
    second = articles.where("lang <> 'en'").withColumns(
        {
            "written_at": F.lit(LATER),
            "written_run": F.lit("run-2"),
            "title": F.concat(F.lit("Corrected: "), "title"),
        }
    )
    in_order = F.coalesce(F.col("source") < "src15", F.lit(False))
    index, _ = _index(spark)
    batches = (
        first.where(in_order).unionByName(second.where(~in_order)),
        second.where(in_order).unionByName(first.where(~in_order)),
    )
    for batch in batches:
        documents = to_document(with_hash_embedding(batch, 16), "written_at", "written_run", F.col("n").alias("row"))
        index.upsert(documents, stored=True)
    late = index.read_writes().select("doc_id", (F.col("written_run") == "run-2").alias("late"))
    return index.read().select("doc_id", "title").join(late, "doc_id")


@query(
    f"""
WITH {_KEPT}
SELECT 'documents' AS counted, shown_source AS source, count(*) AS n FROM kept GROUP BY 2
UNION ALL SELECT 'runs', source, 1 FROM articles GROUP BY 2
UNION ALL SELECT 'commits', '', 2
"""
)
def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of a stream is handed in twice; index, run log and commits are as after the first."""
    index, metrics = _index(spark)
    for _ in range(2):
        _run(spark, sf_dir, index, metrics, batch_id="ingest-0")
    count = F.count(F.lit(1)).alias("n")
    documents = index.read().groupBy("source").agg(count).select(F.lit("documents").alias("counted"), "source", "n")
    runs = read_metrics(spark, metrics).groupBy("source").agg(count).select(F.lit("runs"), "source", "n")
    commits = index.commits().agg(count).select(F.lit("commits"), F.lit(""), "n")
    return documents.union(runs).union(commits)


@query(
    f"""
WITH {_KEPT}
SELECT source, CASE source WHEN 'src3' THEN 'failed' ELSE 'ok' END AS status,
       CASE source WHEN 'src3' THEN 0 ELSE count(*) FILTER (WHERE n_chars >= 300) END AS indexed_count,
       CASE source WHEN 'src3' THEN {_text(BAD_METHOD_MESSAGE, "source", "'POST'")} END AS error_message
FROM articles GROUP BY source
UNION ALL SELECT 'silent', 'failed', 0, {_text(BAD_METHOD_MESSAGE, "'silent'", "'POST'")}
"""
)
def run_with_misconfigured_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources are configured to post; one of them never answered. Both fail alone."""
    method = F.when(F.col("name").isin("src3", "silent"), F.lit("POST")).otherwise(F.lit("GET"))
    sources = I.read(spark, sf_dir, "documents").select("source")
    silent = spark.createDataFrame([("silent",)], "source string")
    config = I.config_for(sources.unionByName(silent), I.mapping(*I.WIRE_MAPPING), method)
    index, metrics = _index(spark)
    result = _run(spark, sf_dir, index, metrics, config=config)
    return result.sources.select("source", "status", "indexed_count", "error_message")


# -- the caller's own parts ----------------------------------------------------------------


def _typed_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed bodies: Spanish items have no url, source src3 sends cut bodies."""
    item = F.struct(
        F.struct(F.lit(None).cast("string").alias("id"), F.when(F.col("lang") != "fr", F.upper("lang")).alias("name")).alias(
            "source"
        ),
        F.when(F.col("n_chars") >= 300, F.col("title")).otherwise(F.lit("")).alias("title"),
        F.when(F.col("lang") != "es", F.col("url")).alias("url"),
        I.published_text().alias("publishedAt"),
        "content",
    )
    raw = I.responses(I.articles(spark, sf_dir), item, lambda items: F.struct(F.lit("ok").alias("status"), items.alias("articles")))
    cut = F.expr("substring(body, 1, length(body) div 2)")
    return raw.withColumn("body", F.when(F.col("source") == "src3", cut).otherwise(F.col("body")))


@query(
    f"""
WITH {S.ARTICLES}
SELECT source, CASE source WHEN 'src3' THEN 'failed' ELSE 'ok' END AS status,
       CASE source WHEN 'src3' THEN 0 ELSE count(*) END AS fetched_count,
       CASE source WHEN 'src3' THEN 0 ELSE count(*) FILTER (WHERE n_chars >= 300 AND lang <> 'es') END AS indexed_count,
       CASE source WHEN 'src3' THEN {_text(BAD_JSON_MESSAGE, "source")} END AS error_message
FROM articles GROUP BY source
"""
)
def ingest_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run with the typed parser, whose sources have no mapping; an unreadable body fails its source."""
    none = F.lit(None).cast("struct<articles_path:string,title:string,content:string,url:string,source:string,timestamp:string>")
    config = I.config_for(I.read(spark, sf_dir, "documents"), none)
    index, metrics = _index(spark)
    raw = _typed_responses(spark, sf_dir)
    result = _run(spark, sf_dir, index, metrics, raw=raw, config=config, parser=parse_typed)
    return result.sources.select("source", "status", "fetched_count", "indexed_count", "error_message")


@query(
    f"""
WITH {_KEPT}
SELECT sha256(url) AS doc_id, length(title)::DOUBLE AS title_chars, length(body)::DOUBLE AS content_chars FROM kept
WHERE source <> 'src3'
"""
)
def ingest_own_embedder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of the caller's own function; one source's are too short, which holds it back."""

    def embedder(title: str, content: str):
        pair = F.array(F.length(title).cast("double"), F.length(content).cast("double"))
        return F.when(F.col("source_name") == "src3", F.slice(pair, 1, 1)).otherwise(pair)

    index, metrics = _index(spark, dim=2)
    _run(spark, sf_dir, index, metrics, embedder=embedder)
    return index.read().select(
        "doc_id", F.col("embedding")[0].alias("title_chars"), F.col("embedding")[1].alias("content_chars")
    )


@query(
    f"""
WITH {_KEPT}
SELECT sha256(url) AS doc_id, title, shown_source AS source,
       {S.lexicon("lower(title || ' ' || body)", I.POSITIVE_FRAGMENTS, I.NEGATIVE_FRAGMENTS)} AS sentiment, 0::BIGINT AS in_index
FROM kept
"""
)
def ingest_own_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged documents go to a table of the caller's own; the index stays empty."""
    index, metrics = _index(spark)
    path = scratch_dir(spark, "own-sink")
    _run(spark, sf_dir, index, metrics, sink=lambda documents: documents.write.parquet(path))
    return spark.read.parquet(path).select("doc_id", "title", "source", "sentiment", F.lit(index.count()).alias("in_index"))


@query(
    f"""
WITH {_KEPT}
SELECT sha256(url) AS doc_id, CASE WHEN l.doc_id IS NULL THEN
         {S.lexicon("lower(title || ' ' || body)", I.POSITIVE_FRAGMENTS, I.NEGATIVE_FRAGMENTS)}
         WHEN quality = 1 THEN 'positive' ELSE 'negative' END AS sentiment,
       k.doc_id::DOUBLE AS first, n_chars::DOUBLE AS second
FROM kept k LEFT JOIN labels l ON l.doc_id = k.doc_id WHERE source <> 'src3'
"""
)
def ingest_model_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run with tables of model replies: labels of labelled documents, the lexicon for others, a vector of
    every document. One source has vectors that are too short, which holds it back."""
    documents = I.read(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("n"), "source", F.col("n_chars").cast("double").alias("n_chars")
    )
    keyed = I.article_keys(spark, sf_dir).join(documents, "n")
    pair = F.array(F.col("n").cast("double"), F.col("n_chars"))
    vector = F.when(F.col("source") == "src3", F.slice(pair, 1, 1)).otherwise(pair)
    vectors = keyed.select(
        "doc_id", F.lit(200).alias("status"), F.to_json(F.struct(F.array(F.struct(vector.alias("embedding"))).alias("data"))).alias("body")
    )
    word = F.when(F.col("quality") == 1, F.lit("Positive")).otherwise(F.lit("NEGATIVE"))
    content = F.to_json(F.struct(word.alias("sentiment")))
    choices = F.array(F.struct(F.struct(content.alias("content")).alias("message")))
    labels = I.read(spark, sf_dir, "labels").withColumnRenamed("doc_id", "n").join(keyed.select("n", "doc_id"), "n")
    labels = labels.select("doc_id", F.lit(200).alias("status"), F.to_json(F.struct(choices.alias("choices"))).alias("body"))
    index, metrics = _index(spark, dim=2)
    _run(spark, sf_dir, index, metrics, sentiment_responses=labels, embedding_responses=vectors)
    return index.read().select(
        "doc_id", "sentiment", F.col("embedding")[0].alias("first"), F.col("embedding")[1].alias("second")
    )


# -- stream ----------------------------------------------------------------------------------


@query(
    f"""
WITH {_KEPT}
SELECT shown_source AS source, {S.lexicon("lower(title || ' ' || body)", I.POSITIVE_FRAGMENTS, I.NEGATIVE_FRAGMENTS)}
         AS sentiment, count(*) AS documents
FROM kept GROUP BY 1, 2
"""
)
def stream_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """While the parser is out of order the stream goes on; the next call takes what it missed first."""
    root = scratch_dir(spark, "stream")
    raw, config = I.wire_responses(spark, sf_dir), I.wire_config(spark, sf_dir)
    index = ArticleIndex(spark, f"{root}/index")
    index.create(16, buckets=8)

    def out_of_order(*_):
        raise RuntimeError("the parser is out of order")

    args = (spark, f"{root}/landing", config, index, f"{root}/metrics", f"{root}/checkpoint")
    raw.filter("source_ord < 10").write.json(f"{root}/landing", compression="gzip")
    ingest_stream(*args, stop_on_error=False, labeller=_labeller, parser=out_of_order).awaitTermination()
    raw.filter("source_ord >= 10").write.mode("append").json(f"{root}/landing", compression="gzip")
    ingest_stream(*args, stop_on_error=False, labeller=_labeller).awaitTermination()
    return index.read().groupBy("source", "sentiment").agg(F.count(F.lit(1)).alias("documents"))
