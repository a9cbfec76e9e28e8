"""Nearest neighbours, search requests and replies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.fixed_values import (
    BAD_MIN_SCORE_MESSAGE,
    BAD_QUERY_MESSAGE,
    BAD_SIZE_MESSAGE,
    PAGE_MIN_SCORE_MESSAGE,
    PAGE_QUERY_MESSAGE,
    PAGE_SIZE_MESSAGE,
)
from feedloom.functions.instants import iso_instant
from feedloom.functions.vectors import l2_normalize, l2_score
from feedloom.operators.embedding import with_hash_embedding, with_query_embedding
from feedloom.operators.nearest import knn, knn_batch, min_score_filter
from feedloom.operators.search import (
    accepted,
    check_page_args,
    check_search_args,
    display_fields,
    query_vector,
    rejected,
    response_envelope,
    search,
    search_batch,
)
from feedloom.operators.sentiment import with_keyword_sentiment
from feedloom.operators.upsert import to_document
from feedloom.plans.catalogue import inputs as I
from feedloom.plans.catalogue import sql as S
from feedloom.plans.catalogue.registry import query
from feedloom.session import materialize, scratch_dir
from feedloom.sources.vector_lists import VectorLists

# The query text of the single-query searches.
QUESTION = "the strength of the markets and the men"


def _literal_weights(dim: int) -> str:
    return (
        f"question AS (SELECT 0 AS id, '{QUESTION}' AS text), {S.weights('asked', 'question', dim)},"
        f" dense AS (SELECT list(coalesce(w, 0.0) ORDER BY i) AS q"
        f" FROM range({dim}) r(i) LEFT JOIN asked ON asked.b = r.i)"
    )


_VECTOR_SCORES = f"""
{_literal_weights(64)},
scored AS (
  SELECT vec_id, label, round(1 / (1 + list_distance(embedding::DOUBLE[], q) ** 2), 9) AS score
  FROM embeddings, dense
)"""


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.read(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "doc_id")


@query(
    f"""
WITH {_VECTOR_SCORES}
SELECT vec_id, label::BIGINT AS label, round(score, 6) AS score FROM scored ORDER BY scored.score DESC, vec_id LIMIT 5
"""
)
def knn_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = knn(_vectors(spark, sf_dir), query_vector(spark, QUESTION, 64), 5)
    return hits.select(
        F.col("doc_id").alias("vec_id"), F.col("label").cast("long").alias("label"), F.round("score", 6).alias("score")
    )


@query(
    f"""
WITH {_VECTOR_SCORES}
SELECT vec_id, round(score, 6) AS score FROM (SELECT * FROM scored ORDER BY score DESC, vec_id LIMIT 20)
WHERE score >= 0.42
"""
)
def knn_min_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = knn(_vectors(spark, sf_dir), query_vector(spark, QUESTION, 64), 20)
    return min_score_filter(hits, 0.42).select(F.col("doc_id").alias("vec_id"), F.round("score", 6).alias("score"))


@query(
    f"""
WITH queries AS (SELECT item_id AS id, text FROM benchmark), {S.weights("q", "queries", 64)},
slots AS (SELECT queries.id, r.i FROM queries CROSS JOIN range(64) r(i)),
dense AS (
  SELECT slots.id, list(coalesce(q.w, 0.0) ORDER BY slots.i) AS v
  FROM slots LEFT JOIN q ON q.id = slots.id AND q.b = slots.i GROUP BY slots.id
),
scored AS (
  SELECT id, vec_id, round(1 / (1 + list_distance(embedding::DOUBLE[], v) ** 2), 9) AS score
  FROM dense CROSS JOIN embeddings
)
SELECT item_id, rank, vec_id, round(score, 6) AS score FROM (
  SELECT id AS item_id, vec_id, score, row_number() OVER (PARTITION BY id ORDER BY score DESC, vec_id) AS rank
  FROM scored
) WHERE rank <= 5
"""
)
def knn_of_many_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries = I.read(spark, sf_dir, "benchmark").withColumnRenamed("text", "q")
    hits = knn_batch(
        _vectors(spark, sf_dir), with_query_embedding(queries, 64), 5, 64, query_key="item_id"
    )
    return hits.select(
        "item_id",
        F.col("rank").cast("long").alias("rank"),
        F.col("doc_id").alias("vec_id"),
        F.round("score", 6).alias("score"),
    )


# Every hundredth vector asks all others.
_ASKED = "vec_id % 100 = 0"


def _asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vectors(spark, sf_dir).where("doc_id % 100 = 0").select(F.col("doc_id").alias("query_id"), "embedding")


@query(
    f"""
SELECT query_id, rank, vec_id, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM (
    SELECT q.vec_id AS query_id, e.vec_id,
           round(1 / (1 + list_distance(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) ** 2), 9) AS score
    FROM (SELECT * FROM embeddings WHERE {_ASKED}) q CROSS JOIN embeddings e
  )
) WHERE rank <= 10
"""
)
def knn_in_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact neighbours by the way that large query tables take."""
    hits = knn_batch(_vectors(spark, sf_dir), _asked(spark, sf_dir), 10, 64, query_block_bytes=0)
    return hits.select(
        "query_id",
        F.col("rank").cast("long").alias("rank"),
        F.col("doc_id").alias("vec_id"),
        F.round("score", 6).alias("score"),
    )


@query(
    f"""
SELECT count(*) AS queries, 10 * count(*) AS hits, TRUE AS recall_reached, TRUE AS scores_exact
FROM embeddings WHERE {_ASKED}
"""
)
def knn_approximate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten neighbours from the probed lists of an inverted-file index, held against the exact ones."""
    vectors, asked = _vectors(spark, sf_dir), _asked(spark, sf_dir)
    lists = VectorLists.build(vectors, scratch_dir(spark, "vector-lists"))
    found = materialize(lists.search_batch(asked, 10), "approximate-hits")
    exact = materialize(knn_batch(vectors, asked, 10, 64), "exact-hits")
    shared = found.join(exact.select("query_id", "doc_id", F.col("score").alias("exact")), ["query_id", "doc_id"])
    stored = vectors.select("doc_id", F.col("embedding").cast("array<double>").alias("stored"))
    scores = (
        found.join(stored, "doc_id")
        .join(asked.select("query_id", F.col("embedding").cast("array<double>").alias("asked")), "query_id")
        .select((F.abs(F.col("score") - l2_score("stored", "asked")) < 1e-8).alias("right"))
    )
    counts = asked.agg(F.count(F.lit(1)).alias("queries"))
    hits = found.agg(F.count(F.lit(1)).alias("hits"))
    right = scores.agg(F.coalesce(F.bool_and("right"), F.lit(True)).alias("scores_exact"))
    return (
        counts.join(hits)
        .join(shared.agg(F.count(F.lit(1)).alias("shared")))
        .join(exact.agg(F.count(F.lit(1)).alias("expected")))
        .join(right)
        .select("queries", "hits", (F.col("shared") >= 0.9 * F.col("expected")).alias("recall_reached"), "scores_exact")
    )


@query(
    """
SELECT vec_id, round(1 / (1 + list_distance(embedding::DOUBLE[], list_transform(embedding::DOUBLE[], lambda x: 2 * x)) ** 2), 6)
         AS double_score,
       round(1 / (1 + list_sum(list_transform(embedding::DOUBLE[], lambda x: (2 * x - 2 * x / n) ** 2))), 6) AS unit_score
FROM (SELECT vec_id, embedding, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: 4 * x * x))) AS n FROM embeddings)
"""
)
def vector_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and normalization as plain column expressions."""
    rows = I.read(spark, sf_dir, "embeddings").withColumn("embedding", F.col("embedding").cast("array<double>"))
    doubled = rows.withColumn("twice", F.transform("embedding", lambda x: x * 2))
    return doubled.select(
        "vec_id",
        F.round(l2_score("embedding", "twice"), 6).alias("double_score"),
        F.round(l2_score("twice", l2_normalize("twice")), 6).alias("unit_score"),
    )


# -- search over documents ---------------------------------------------------------------


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    articles = I.keyed_articles(spark, sf_dir)
    labelled = with_keyword_sentiment(articles, I.POSITIVE_FRAGMENTS, I.NEGATIVE_FRAGMENTS)
    return to_document(with_hash_embedding(labelled, 16))


_SENTIMENT = S.lexicon("lower(title || ' ' || content)", I.POSITIVE_FRAGMENTS, I.NEGATIVE_FRAGMENTS)
_DOCUMENT_WEIGHTS = f"""
{S.ARTICLES},
texts AS (SELECT sha256(a.url) AS id, d.text FROM articles a JOIN documents d USING (doc_id)),
{S.weights("v", "texts", 16)},
stored AS (
  SELECT sha256(url) AS id, title, source, url, {_SENTIMENT} AS sentiment,
         {S.iso(f"make_timestamp(({I.EPOCH_2024} + doc_id * 61) * 1000000)")} AS timestamp
  FROM articles
)"""


@query(
    f"""
WITH {_DOCUMENT_WEIGHTS},
question AS (SELECT 0 AS id, '{QUESTION}' AS text), {S.weights("q", "question", 16)},
{S.scores("question", "q", "texts", "v")}
SELECT title, source, url, sentiment, timestamp, round(score, 6) AS score FROM (
  SELECT id, score FROM scored ORDER BY score DESC, id LIMIT 10
) JOIN stored USING (id) WHERE score >= 0.69
"""
)
def search_one_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = search(_index(spark, sf_dir), QUESTION, 10, 0.69, dim=16)
    return hits.withColumn("score", F.round("score", 6))


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark texts as requests with sizes 1 to 20, a third of them without a threshold."""
    size = F.least(F.lit(20), F.length("text") / 15).cast("int")
    threshold = F.when(F.length("text") > 150, F.lit(0.6)).when(F.length("text") > 120, F.lit(0.0))
    return I.read(spark, sf_dir, "benchmark").select(
        F.format_string("b%05d", "item_id").alias("request_id"),
        F.col("text").alias("q"),
        size.alias("size"),
        threshold.alias("min_score"),
    )


_BATCH = f"""
{_DOCUMENT_WEIGHTS},
queries AS (
  SELECT 'b' || lpad(item_id::VARCHAR, 5, '0') AS id, text, least(20, length(text) // 15) AS size,
         CASE WHEN length(text) > 150 THEN 0.6 WHEN length(text) > 120 THEN 0.0 END::DOUBLE AS min_score
  FROM benchmark
),
{S.weights("q", "queries", 16)},
{S.scores("queries", "q", "texts", "v")},
ranked AS (
  SELECT query, id, score, row_number() OVER (PARTITION BY query ORDER BY score DESC, id) AS rank FROM scored
),
results AS (
  SELECT r.query AS request_id, rank, title, source, url, sentiment, timestamp, score
  FROM ranked r JOIN queries q ON q.id = r.query JOIN stored s ON s.id = r.id
  WHERE rank <= size AND size >= 1 AND (min_score IS NULL OR score >= min_score)
)"""


@query(
    f"""
WITH {_BATCH}
SELECT request_id, rank, title, source, url, sentiment, timestamp, round(score, 6) AS score FROM results
"""
)
def search_many_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = accepted(check_search_args(_requests(spark, sf_dir)))
    hits = search_batch(_index(spark, sf_dir), requests, dim=16)
    return hits.withColumn("score", F.round("score", 6)).withColumn("rank", F.col("rank").cast("long"))


@query(
    f"""
WITH {_BATCH}
SELECT q.id AS request_id, q.text AS query, count(r.rank) AS result_count, q.min_score,
       coalesce(string_agg(r.url, ' ' ORDER BY r.rank), '') AS urls, round(max(r.score), 6) AS best_score
FROM queries q LEFT JOIN results r ON r.request_id = q.id WHERE size >= 1 GROUP BY 1, 2, 4
"""
)
def search_reply_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = accepted(check_search_args(_requests(spark, sf_dir)))
    hits = search_batch(_index(spark, sf_dir), requests, dim=16)
    replies = response_envelope(requests, hits)
    best = F.array_max(F.transform("results", lambda r: r["score"]))
    return replies.select(
        "request_id",
        "query",
        "result_count",
        "min_score",
        F.array_join(F.transform("results", lambda r: r["url"]), " ").alias("urls"),
        F.round(best, 6).alias("best_score"),
    )


_ARGS = """
SELECT conv_id, turn, CASE WHEN role = 'system' THEN ' ' ELSE text END AS q,
       CASE WHEN turn <> 3 THEN turn * 4 + 1 END AS given_size,
       CASE WHEN turn <> 1 THEN (length(text) - 100) / 1000.0 END::DOUBLE AS min_score
FROM conversations
"""


def _arguments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.read(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.when(F.col("role") == "system", F.lit(" ")).otherwise(F.col("text")).alias("q"),
        F.when(F.col("turn") != 3, F.col("turn") * 4 + 1).cast("int").alias("size"),
        F.when(F.col("turn") != 1, (F.length("text") - 100) / 1000.0).alias("min_score"),
    )


@query(
    f"""
SELECT conv_id, turn, size, message FROM (
  SELECT conv_id, turn, coalesce(given_size, 5) AS size,
         CASE WHEN trim(q) = '' THEN '{BAD_QUERY_MESSAGE.replace("'", "''")}'
              WHEN coalesce(given_size, 5) NOT BETWEEN 1 AND 20 THEN '{BAD_SIZE_MESSAGE.replace("'", "''")}'
              WHEN min_score < 0 THEN '{BAD_MIN_SCORE_MESSAGE.replace("'", "''")}' END AS message
  FROM ({_ARGS})
)
"""
)
def search_args_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = check_search_args(_arguments(spark, sf_dir))
    both = accepted(checked).withColumn("message", F.lit(None).cast("string")).unionByName(rejected(checked))
    return both.select("conv_id", "turn", F.col("size").cast("long").alias("size"), "message")


@query(
    f"""
SELECT conv_id, turn,
       CASE WHEN trim(q) = '' THEN '{PAGE_QUERY_MESSAGE}'
            WHEN given_size IS NULL OR given_size NOT BETWEEN 1 AND 20 THEN '{PAGE_SIZE_MESSAGE}'
            WHEN min_score NOT BETWEEN 0 AND 1 THEN '{PAGE_MIN_SCORE_MESSAGE}' END AS message
FROM ({_ARGS})
"""
)
def search_page_args_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_page_args(_arguments(spark, sf_dir)).select("conv_id", "turn", "message")


@query(
    f"""
WITH {S.ARTICLES}
SELECT doc_id AS n, CASE WHEN lang = 'de' THEN 'Untitled article' ELSE title END AS title,
       CASE WHEN lang = 'es' THEN 'Unknown source' ELSE source END AS source,
       CASE lang WHEN 'en' THEN 'positive' WHEN 'fr' THEN 'negative' ELSE 'neutral' END AS sentiment,
       CASE WHEN lang = 'fr' THEN 'No timestamp'
            ELSE {S.iso(f"make_timestamp(({I.EPOCH_2024} + doc_id * 61) * 1000000)")} END AS timestamp,
       CASE WHEN lang = 'de' THEN 'Score n/a' ELSE 'Score ' || printf('%.3f', n_chars / 8.0) END AS score
FROM articles
"""
)
def search_display_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    lang = F.col("lang")
    results = I.articles(spark, sf_dir).select(
        "n",
        F.when(lang != "de", F.col("title")).alias("title"),
        F.when(lang == "es", F.lit("")).otherwise(F.col("source")).alias("source"),
        F.when(lang == "en", F.lit("POSITIVE"))
        .when(lang == "fr", F.lit("Negative"))
        .when(lang == "de", F.lit("mixed"))
        .alias("sentiment"),
        F.when(lang != "fr", iso_instant("published_at")).alias("timestamp"),
        F.when(lang != "de", F.col("n_chars") / 8.0).otherwise(F.lit(float("nan"))).alias("score"),
    )
    return display_fields(results)
