"""Sentiment, embedding, model requests and replies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.fixed_values import (
    DEFAULT_DIMENSION,
    DEFAULT_MAX_TEXT_CHARS,
    EMBEDDING_DIM_MESSAGE,
    EMBEDDING_EMPTY_MESSAGE,
    EMBEDDING_MISSING_MESSAGE,
    EMBEDDING_MODEL,
    EMBEDDING_NUMBER_MESSAGE,
    EMPTY_ARTICLE_TEXT,
    SENTIMENT_MODEL,
    SENTIMENT_SYSTEM_TEXT,
    SENTIMENT_USER_TEXT,
)
from feedloom.functions.hashing import bucket, direction, java_string_hash
from feedloom.functions.text import article_text, tokens
from feedloom.operators.embedding import (
    apply_embedding_responses,
    embedding_requests,
    query_embedding_requests,
    with_hash_embedding,
    with_query_embedding,
)
from feedloom.operators.enrich import source_atomic_gate, source_failures
from feedloom.operators.sentiment import (
    apply_sentiment_responses,
    sentiment_requests,
    with_keyword_sentiment,
)
from feedloom.plans.catalogue import inputs as I
from feedloom.plans.catalogue import sql as S
from feedloom.plans.catalogue.registry import query

# -- sentiment -------------------------------------------------------------------------

_HEADLINE = (
    "CASE event_type WHEN 'click' THEN 'Shares rise as profit grows' WHEN 'view' THEN 'The harbour opens at nine'"
    " WHEN 'purchase' THEN 'Award for a surprise' WHEN 'signup' THEN 'Inflation FEARS cut growth'"
    " ELSE 'Company fails after record losses' END"
)
_FOLLOW_UP = "CASE WHEN value < 5 THEN 'Recovery is strong' WHEN value > 40 THEN 'Crisis deepens' ELSE props END"


@query(
    f"""
SELECT event_id, {S.lexicon("t")} AS sentiment
FROM (SELECT event_id, lower({_HEADLINE} || ' ' || {_FOLLOW_UP}) AS t FROM events)
"""
)
def lexicon_sentiment_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headlines with lexicon words; "award" holds "war", "surprise" holds "rise"."""
    headlines = I.read(spark, sf_dir, "events").select(
        "event_id", F.expr(_HEADLINE).alias("title"), F.expr(_FOLLOW_UP).alias("content")
    )
    return with_keyword_sentiment(headlines).select("event_id", "sentiment")


_CUSTOM = S.lexicon("lower(title || ' ' || content)", I.POSITIVE_FRAGMENTS, I.NEGATIVE_FRAGMENTS)


@query(f"WITH {S.ARTICLES} SELECT doc_id AS n, {_CUSTOM} AS sentiment FROM articles")
def lexicon_sentiment_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = with_keyword_sentiment(
        I.articles(spark, sf_dir), I.POSITIVE_FRAGMENTS, I.NEGATIVE_FRAGMENTS
    )
    return labelled.select("n", "sentiment")


# A lexicon too large for an expression: every second pair of syllables is positive.
_SYLLABLES = ("th", "an", "er", "on", "re", "en", "ti", "ou", "sch", "eau", "ión", "ung", "ing", "ment", "ly", "ado")
_PAIRS = [a + b for a in _SYLLABLES for b in _SYLLABLES]
_LARGE_POSITIVE, _LARGE_NEGATIVE = _PAIRS[::2], _PAIRS[1::2]


def _large_hits(words: list[str]) -> str:
    return f"len(list_filter([{', '.join(map(repr, words))}], lambda k: contains(t, k)))"


@query(
    f"""
WITH {S.ARTICLES}, texts AS (SELECT doc_id, lower(title || ' ' || content) AS t FROM articles)
SELECT doc_id AS n, CASE WHEN {_large_hits(_LARGE_POSITIVE)} > {_large_hits(_LARGE_NEGATIVE)} THEN 'positive'
  WHEN {_large_hits(_LARGE_POSITIVE)} < {_large_hits(_LARGE_NEGATIVE)} THEN 'negative' ELSE 'neutral' END AS sentiment
FROM texts
"""
)
def lexicon_sentiment_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = with_keyword_sentiment(I.articles(spark, sf_dir), _LARGE_POSITIVE, _LARGE_NEGATIVE)
    return labelled.select("n", "sentiment")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_MODEL_TEXT = f"""coalesce(nullif({S.trimmed("title || chr(10) || chr(10) || content")}, ''), '{EMPTY_ARTICLE_TEXT}')"""


@query(
    f"""
WITH {S.ARTICLES}
SELECT sha256(url) AS doc_id, '{SENTIMENT_MODEL}' AS model, 0::BIGINT AS temperature, 20::BIGINT AS max_tokens,
       'json_object' AS reply_format, {_quoted(SENTIMENT_SYSTEM_TEXT)} AS system_text,
       replace({_quoted(SENTIMENT_USER_TEXT.replace(chr(10), "~~"))}, '~~', chr(10))
         || substr({_MODEL_TEXT}, 1, 3000) AS user_text
FROM articles
"""
)
def sentiment_model_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = sentiment_requests(I.keyed_articles(spark, sf_dir), max_chars=DEFAULT_MAX_TEXT_CHARS)
    payload = F.from_json(
        "request",
        "model string, temperature bigint, max_tokens bigint, response_format struct<type: string>,"
        " messages array<struct<role: string, content: string>>",
    )
    return requests.select("doc_id", payload.alias("p")).select(
        "doc_id",
        "p.model",
        "p.temperature",
        "p.max_tokens",
        F.col("p.response_format.type").alias("reply_format"),
        F.col("p.messages")[0]["content"].alias("system_text"),
        F.col("p.messages")[1]["content"].alias("user_text"),
    )


def _sentiment_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reply per labelled document: usable, failed, or with unusable content."""
    word = F.when(F.col("toxic") == 1, F.lit("NEGATIVE")).otherwise(F.lit("positive"))
    content = F.when(
        F.col("quality") == 1, F.to_json(F.struct(word.alias("sentiment")))
    ).otherwise(F.lit("not-json"))
    body = F.to_json(F.struct(F.array(F.struct(F.struct(content.alias("content")).alias("message"))).alias("choices")))
    status = F.when((F.col("quality") == 0) & (F.col("toxic") == 1), F.lit(500)).otherwise(F.lit(200))
    keys = I.article_keys(spark, sf_dir)
    labels = I.read(spark, sf_dir, "labels").withColumnRenamed("doc_id", "n")
    return labels.join(keys, "n").select("doc_id", status.alias("status"), body.alias("body"))


@query(
    f"""
WITH {S.ARTICLES}
SELECT doc_id AS n, CASE WHEN quality = 1 AND toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive'
                         ELSE {_CUSTOM} END AS sentiment
FROM articles LEFT JOIN labels USING (doc_id)
"""
)
def sentiment_responses_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usable replies win; failed, unreadable and missing ones fall back to the lexicon."""
    labelled = apply_sentiment_responses(
        I.keyed_articles(spark, sf_dir),
        _sentiment_replies(spark, sf_dir),
        I.POSITIVE_FRAGMENTS,
        I.NEGATIVE_FRAGMENTS,
    )
    return labelled.select("n", "sentiment")


# -- embedding requests and replies ------------------------------------------------------


@query(
    f"""
WITH {S.ARTICLES}
SELECT sha256(url) AS doc_id, '{EMBEDDING_MODEL}' AS model, {DEFAULT_DIMENSION}::BIGINT AS dimensions,
       'float' AS encoding_format,
       coalesce(nullif({S.trimmed("title || ' ' || content")}, ''), '{EMPTY_ARTICLE_TEXT}') AS input
FROM articles
"""
)
def embedding_model_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = embedding_requests(I.keyed_articles(spark, sf_dir))
    payload = F.from_json("request", "model string, input string, dimensions bigint, encoding_format string")
    return requests.select("doc_id", payload.alias("p")).select("doc_id", "p.*")


@query(
    f"""
SELECT conv_id || '/' || turn AS request_id, {S.trimmed("' ' || text || chr(10)")} AS input
FROM conversations WHERE role <> 'system'
"""
)
def embedding_query_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """System texts are blanked: a blank query has no request."""
    q = F.when(F.col("role") == "system", F.lit(" \n")).otherwise(F.concat(F.lit(" "), "text", F.lit("\n")))
    queries = I.read(spark, sf_dir, "conversations").select(
        F.concat_ws("/", "conv_id", "turn").alias("request_id"), q.alias("q")
    )
    return query_embedding_requests(queries).select(
        "request_id", F.get_json_object("request", "$.input").alias("input")
    )


def _dim_message(size: int) -> str:
    return EMBEDDING_DIM_MESSAGE.replace("%1$s", str(size)).replace("%2$s", "64")


@query(
    f"""
SELECT vec_id, CASE WHEN label > 5 THEN 64::BIGINT END AS size,
       CASE WHEN label > 5 THEN round(list_sum(embedding::DOUBLE[]), 5) END AS total,
       CASE label WHEN 0 THEN '{_dim_message(63)}'
                  WHEN 1 THEN 'Embedding request failed with status 429: {{"error":"slow down"}}'
                  WHEN 2 THEN '{EMBEDDING_EMPTY_MESSAGE}' WHEN 3 THEN '{EMBEDDING_NUMBER_MESSAGE}'
                  WHEN 4 THEN '{EMBEDDING_MISSING_MESSAGE}' WHEN 5 THEN '{EMBEDDING_NUMBER_MESSAGE}' END AS error
FROM embeddings
"""
)
def embedding_responses_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wrong size, refused, empty, text numbers, missing and JSON null each give their own error."""
    rows = I.read(spark, sf_dir, "embeddings").withColumn("doc_id", F.format_string("v%d", "vec_id"))
    label = F.col("label")

    def reply(items):
        return F.to_json(F.struct(F.array(F.struct(items.alias("embedding"))).alias("data")))

    numbers = F.col("embedding").cast("array<double>")
    body = (
        F.when(label == 0, reply(F.slice(numbers, 1, 63)))
        .when(label == 1, F.lit('{"error":"slow down"}'))
        .when(label == 2, F.lit('{"data":[]}'))
        .when(label == 3, reply(numbers.cast("array<string>")))
        .when(label == 5, reply(F.transform(numbers, lambda x: F.when(x > 0, x))))
        .otherwise(reply(numbers))
    )
    status = F.when(label == 1, F.lit(429)).otherwise(F.lit(200))
    replies = rows.filter(label != 4).select("doc_id", status.alias("status"), body.alias("body"))
    checked = apply_embedding_responses(rows.select("doc_id", "vec_id"), replies, 64)
    total = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x)
    return checked.select(
        "vec_id",
        F.when(F.col("embedding").isNotNull(), F.size("embedding")).cast("long").alias("size"),
        F.round(total, 5).alias("total"),
        F.col("embedding_error").alias("error"),
    )


@query(
    """
WITH bad AS (
  SELECT source, min_by(doc_id, doc_id) AS first_bad FROM documents WHERE n_chars > 15000 GROUP BY source
)
SELECT source AS source_name, CASE WHEN first_bad IS NULL THEN count(*) ELSE 0 END AS articles,
       CASE WHEN first_bad IS NOT NULL THEN 'no vector for ' || first_bad END AS error_message
FROM documents LEFT JOIN bad USING (source) GROUP BY source, first_bad
"""
)
def source_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One article without a vector (here: a very long one) holds back its source."""
    rows = I.articles(spark, sf_dir).select(
        F.lit("run-1").alias("run_id"),
        F.col("source").alias("source_name"),
        F.lit(0).alias("source_ord"),
        F.expr("CAST(n div 200 AS INT)").alias("response_no"),
        F.col("n").alias("pos"),
        F.when(F.col("n_chars") > 15000, F.concat(F.lit("no vector for "), "n")).alias("embedding_error"),
    )
    failures = source_failures(rows)
    passed = source_atomic_gate(rows, failures).groupBy("source_name").agg(F.count("pos").alias("articles"))
    return passed.join(failures, "source_name", "full").select(
        "source_name", F.coalesce("articles", F.lit(0)).cast("long").alias("articles"), "error_message"
    )


# -- hashed embedding --------------------------------------------------------------------


@query(
    f"""
WITH tokens AS (
  SELECT unnest(string_split_regex(lower(text), '[^a-z0-9]+')) AS token FROM documents
),
counted AS (SELECT token, count(*) AS n FROM tokens WHERE token <> '' GROUP BY token)
SELECT token, n, h AS hash, ((h % 16) + 16) % 16 AS bucket, CASE WHEN h % 2 = 0 THEN 1 ELSE -1 END::BIGINT AS direction
FROM (SELECT token, n, {S.token_hash("token")} AS h FROM counted)
"""
)
def hash_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted per distinct token before hashing; the count combines before the shuffle."""
    text = article_text("title", "content")
    counted = (
        I.articles(spark, sf_dir)
        .select(F.explode(tokens(text)).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("hash", java_string_hash("token"))
    )
    return counted.select(
        "token",
        "n",
        F.col("hash").cast("long").alias("hash"),
        bucket("hash", 16).cast("long").alias("bucket"),
        direction("hash").cast("long").alias("direction"),
    )


def _long_form(rows: DataFrame, key: str) -> DataFrame:
    entries = rows.select(key, F.posexplode("embedding").alias("bucket", "weight")).filter("weight <> 0")
    return entries.select(key, F.col("bucket").cast("long").alias("bucket"), F.round("weight", 6).alias("weight"))


def _weights_sql(table: str, key: str, dim: int) -> str:
    return f"""
WITH texts AS (SELECT {key} AS id, text FROM {table}), {S.weights("v", "texts", dim)}
SELECT id AS {key}, b AS bucket, round(w, 6) AS weight FROM v
"""


def _document_vectors(spark: SparkSession, sf_dir: str, dim: int) -> DataFrame:
    rows = I.articles(spark, sf_dir).withColumnRenamed("n", "doc_id")
    return _long_form(with_hash_embedding(rows, dim), "doc_id")


@query(_weights_sql("documents", "doc_id", 16))
def hash_embedding_16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _document_vectors(spark, sf_dir, 16)


@query(_weights_sql("documents", "doc_id", 384))
def hash_embedding_384(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _document_vectors(spark, sf_dir, 384)


@query(_weights_sql("benchmark", "item_id", 384))
def hash_query_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries = I.read(spark, sf_dir, "benchmark").withColumnRenamed("text", "q")
    return _long_form(with_query_embedding(queries, 384), "item_id")
