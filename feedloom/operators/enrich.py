"""Enrichment of articles and the all-or-nothing rule per source."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.hashing import document_id
from feedloom.functions.lexicon import keyword_sentiment
from feedloom.functions.text import article_text
from feedloom.functions.vectors import check_dimension, hashed_vector
from feedloom.operators.embedding import embedding_vectors, vector_columns
from feedloom.operators.joins import heavy_keys, join_skewed, join_small
from feedloom.operators.sentiment import sentiment_labels

# A labeller or embedder is a user's ``(title, content) -> Column``.
TextFunction = Callable[[str, str], Column]
# Ids whose copies hold more text than this are spread over tasks when replies are joined.
HEAVY_BYTES = 1 << 28


def with_document_id(articles: DataFrame) -> DataFrame:
    return articles.withColumn("doc_id", document_id("url", "source", "title", "published_at"))


def enrich(
    articles: DataFrame,
    dim: int,
    *,
    labeller: TextFunction = keyword_sentiment,
    embedder: TextFunction | None = None,
    sentiment_responses: DataFrame | None = None,
    embedding_responses: DataFrame | None = None,
) -> DataFrame:
    """Add ``doc_id``, ``sentiment``, ``embedding`` and ``embedding_error``.

    Defaults are the keyword lexicon and the hashed embedding. A reply table switches
    that part to the model; a function switches it to the caller's own expression or
    pandas UDF. A vector of any other length than ``dim`` is an embedding error.
    """
    check_dimension(dim)
    result = with_document_id(articles)
    labels = None if sentiment_responses is None else sentiment_labels(sentiment_responses)
    vectors = None if embedding_responses is None else embedding_vectors(embedding_responses, dim)
    replies = vectors if labels is None else labels if vectors is None else labels.join(vectors, "doc_id", "full")
    if replies is not None:
        # Both kinds of replies meet first, by id alone, so whole articles move once. Copies of one
        # article share an id: heavy ones, by the size of their texts, are spread over tasks.
        size = F.octet_length(F.coalesce("title", F.lit(""))) + F.octet_length(F.coalesce("content", F.lit("")))
        heavy = heavy_keys(result, "doc_id", HEAVY_BYTES, weight=size)
        own = result.columns
        result = join_skewed(result, replies, "doc_id", "left", heavy)
    sentiment = labeller("title", "content")
    sentiment = (sentiment if labels is None else F.coalesce("_label", sentiment)).alias("sentiment")
    if vectors is not None:
        return result.select(*own, sentiment, *vector_columns())
    result = result.select(*(own if replies is not None else result.columns), sentiment)
    if embedder is None:
        vector = hashed_vector(article_text("title", "content"), dim)
        return result.withColumn("embedding", vector).withColumn(
            "embedding_error", F.lit(None).cast("string")
        )
    return check_vectors(result.withColumn("embedding", embedder("title", "content")), dim)


def check_vectors(articles: DataFrame, dim: int) -> DataFrame:
    size = F.coalesce(F.size("embedding"), F.lit(-1))
    wrong = F.format_string("Embedding dimension is %d but %d is expected", size, F.lit(dim))
    return articles.withColumn("embedding_error", F.when(size != dim, wrong))


def source_failures(articles: DataFrame, error: str = "embedding_error") -> DataFrame:
    """The first error, in article order, of every (run_id, source_name) that has one.

    An aggregate with map-side combine: a source with a third of all rows still sends
    one row per task.
    """
    order = F.struct("source_ord", "response_no", "pos")
    return (
        articles.filter(F.col(error).isNotNull())
        .groupBy("run_id", "source_name")
        .agg(F.min_by(error, order).alias("error_message"))
    )


def source_atomic_gate(articles: DataFrame, failures: DataFrame) -> DataFrame:
    """Articles of the sources without a failure: one bad article holds back its whole source."""
    key = F.concat_ws("\u0001", F.coalesce("run_id", F.lit("")), "source_name")
    failed = failures.select(key.alias("_run_source")).distinct()
    return join_small(articles.withColumn("_run_source", key), failed, "_run_source", "left_anti").drop(
        "_run_source"
    )
