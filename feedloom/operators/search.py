"""Search requests, results and the reply envelope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.fixed_values import (
    BAD_MIN_SCORE_MESSAGE,
    BAD_QUERY_MESSAGE,
    BAD_SIZE_MESSAGE,
    DEFAULT_SIZE,
    LABELS,
    MAX_SIZE,
    MIN_SIZE,
    NEUTRAL,
    NO_SCORE_TEXT,
    NO_SOURCE_TEXT,
    NO_TIMESTAMP_TEXT,
    NO_TITLE_TEXT,
    PAGE_MIN_SCORE_MESSAGE,
    PAGE_QUERY_MESSAGE,
    PAGE_SIZE_MESSAGE,
)
from feedloom.functions.instants import iso_instant
from feedloom.functions.text import has_text, is_blank
from feedloom.functions.vectors import hashed_vector
from feedloom.operators.embedding import with_query_embedding
from feedloom.operators.joins import BROADCAST_ROWS, fits, join_skewed
from feedloom.operators.nearest import knn, knn_batch, min_score_filter

RESULT_COLUMNS = ("title", "source", "url", "sentiment", "timestamp", "score")
METADATA = ("title", "source", "url", "sentiment", "timestamp")


def check_search_args(requests: DataFrame) -> DataFrame:
    """Fill the default size and add ``message``: why a request is rejected, or NULL."""
    size = F.coalesce("size", F.lit(DEFAULT_SIZE))
    return requests.withColumn("size", size).withColumn(
        "message",
        F.when(~has_text("q"), BAD_QUERY_MESSAGE)
        .when(~F.col("size").between(MIN_SIZE, MAX_SIZE), BAD_SIZE_MESSAGE)
        .when(F.col("min_score") < 0, BAD_MIN_SCORE_MESSAGE),
    )


def check_page_args(requests: DataFrame) -> DataFrame:
    """The search page's own rules: size is required and the threshold is at most 1."""
    size_ok = F.coalesce(F.col("size").between(MIN_SIZE, MAX_SIZE), F.lit(False))
    return requests.withColumn(
        "message",
        F.when(~has_text("q"), PAGE_QUERY_MESSAGE)
        .when(~size_ok, PAGE_SIZE_MESSAGE)
        .when(~F.col("min_score").between(0.0, 1.0), PAGE_MIN_SCORE_MESSAGE),
    )


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("message").isNull()).drop("message")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("message").isNotNull())


def search_projection(hits: DataFrame, *keys: str) -> DataFrame:
    """Result fields only: never the content or the vector; a missing score is 0."""
    return hits.select(
        *keys,
        "title",
        "source",
        "url",
        "sentiment",
        iso_instant("timestamp").alias("timestamp"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def query_vector(spark: SparkSession, q: str, dim: int) -> list[float]:
    """Hashed embedding of one query string."""
    row = spark.range(1).select(hashed_vector(F.lower(F.lit(q)), dim).alias("v")).first()
    return list(row["v"])


def search(
    index: DataFrame, q: str | None, size: int = DEFAULT_SIZE, min_score: float | None = None, *, dim: int
) -> DataFrame:
    """Ranked results of one query string; wrong arguments raise ``ValueError``."""
    if is_blank(q):
        raise ValueError(BAD_QUERY_MESSAGE)
    if not MIN_SIZE <= size <= MAX_SIZE:
        raise ValueError(BAD_SIZE_MESSAGE)
    if min_score is not None and min_score < 0:
        raise ValueError(BAD_MIN_SCORE_MESSAGE)
    vector = query_vector(index.sparkSession, q, dim)
    spark = index.sparkSession
    best = min_score_filter(knn(index.select("doc_id", "embedding"), vector, size), min_score)
    best = best.select("doc_id", "score")
    hits = best.collect()  # MAX_SIZE rows at most
    # Their ids stand in the scan's filter: an index that is bucketed and sorted by id, with Bloom
    # filters, reads the row groups of the hits and no others.
    stored = index.select("doc_id", *METADATA).where(F.col("doc_id").isin([r["doc_id"] for r in hits]))
    found = stored.join(F.broadcast(spark.createDataFrame(hits, best.schema)), "doc_id")
    # With a limit the order needs no sample of the rows, which would read them twice.
    return search_projection(found.orderBy(F.desc("score"), "doc_id").limit(MAX_SIZE))


def search_batch(index: DataFrame, requests: DataFrame, *, dim: int) -> DataFrame:
    """Results of the requests that ``check_search_args`` accepts: ``request_id``, ``rank`` and the
    result fields. Rejected requests have no results; ``rejected`` lists them."""
    asked = accepted(check_search_args(requests.select("request_id", "q", "size", "min_score")))
    vectors = with_query_embedding(asked.select("request_id", "q"), dim)
    best = knn_batch(index, vectors, MAX_SIZE, dim, query_key="request_id")
    few = fits(asked, BROADCAST_ROWS // MAX_SIZE)
    limits = asked.select("request_id", "size", "min_score")
    hits = (
        best.join(F.broadcast(limits) if few else limits, "request_id")
        .filter(F.col("rank") <= F.col("size"))
        .filter(F.col("min_score").isNull() | (F.col("score") >= F.col("min_score")))
    )
    stored = index.select("doc_id", *METADATA)
    # At most MAX_SIZE hits per request, so the check on the requests bounds the hits.
    found = stored.join(F.broadcast(hits), "doc_id") if few else join_skewed(hits, stored, "doc_id")
    return search_projection(found, "request_id", "rank")


def response_envelope(requests: DataFrame, results: DataFrame) -> DataFrame:
    """One reply per request: query, result count, threshold and the ranked results.

    A request has at most ``MAX_SIZE`` results, so the collected lists are short.
    """
    ranked = F.array_sort(F.collect_list(F.struct("rank", *RESULT_COLUMNS)))
    lists = results.groupBy("request_id").agg(ranked.alias("ranked"))
    empty = F.array().cast(
        "array<struct<title:string,source:string,url:string,sentiment:string,timestamp:string,score:double>>"
    )
    plain = F.transform("ranked", lambda r: F.struct(*[r[c].alias(c) for c in RESULT_COLUMNS]))
    return requests.join(lists, "request_id", "left").select(
        "request_id",
        F.col("q").alias("query"),
        F.coalesce(F.size("ranked"), F.lit(0)).cast("long").alias("result_count"),
        "min_score",
        F.coalesce(plain, empty).alias("results"),
    )


def envelope_json(envelope: DataFrame) -> DataFrame:
    """The reply as JSON text; an absent threshold is left out, an empty list stays."""
    reply = F.struct(
        "query",
        F.col("result_count").alias("resultCount"),
        F.col("min_score").alias("minScore"),
        "results",
    )
    return envelope.select("request_id", F.to_json(reply).alias("reply"))


def display_fields(results: DataFrame) -> DataFrame:
    """Texts to show: stand-ins for missing fields and the score with three digits."""

    def shown(name: str, stand_in: str) -> Column:
        return F.when(F.length(name) > 0, F.col(name)).otherwise(F.lit(stand_in)).alias(name)

    label = F.lower("sentiment")
    number = F.col("score").isNotNull() & ~F.isnan("score") & (F.abs("score") != float("inf"))
    return results.withColumns(
        {
            "title": shown("title", NO_TITLE_TEXT),
            "source": shown("source", NO_SOURCE_TEXT),
            "sentiment": F.when(label.isin(*LABELS), label).otherwise(NEUTRAL),
            "timestamp": shown("timestamp", NO_TIMESTAMP_TEXT),
            "score": F.when(number, F.format_string("Score %.3f", "score")).otherwise(NO_SCORE_TEXT),
        }
    )
