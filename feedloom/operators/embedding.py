"""Embedding vectors: hashed tokens, or replies of an offline model run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.fixed_values import (
    DEFAULT_DIMENSION,
    EMBEDDING_DIM_MESSAGE,
    EMBEDDING_EMPTY_MESSAGE,
    EMBEDDING_JSON_MESSAGE,
    EMBEDDING_MISSING_MESSAGE,
    EMBEDDING_MODEL,
    EMBEDDING_NUMBER_MESSAGE,
    EMBEDDING_STATUS_MESSAGE,
)
from feedloom.functions.text import article_text, has_text, java_trim, model_embedding_text
from feedloom.functions.vectors import check_dimension, hashed_vector
from feedloom.operators.joins import join_skewed


def with_hash_embedding(articles: DataFrame, dim: int) -> DataFrame:
    return articles.withColumn("embedding", hashed_vector(article_text("title", "content"), dim))


def with_query_embedding(queries: DataFrame, dim: int, q: str = "q") -> DataFrame:
    """The same embedding for query strings, so that both sides can never drift apart."""
    return queries.withColumn("embedding", hashed_vector(F.lower(F.col(q)), dim))


def _embedding_payload(text: Column, model: str, dim: int) -> Column:
    return F.to_json(
        F.struct(
            F.lit(model).alias("model"),
            text.alias("input"),
            F.lit(check_dimension(dim)).alias("dimensions"),
            F.lit("float").alias("encoding_format"),
        )
    )


def embedding_requests(
    articles: DataFrame, model: str = EMBEDDING_MODEL, dim: int = DEFAULT_DIMENSION
) -> DataFrame:
    text = model_embedding_text("title", "content")
    return articles.select("doc_id", _embedding_payload(text, model, dim).alias("request"))


def query_embedding_requests(
    queries: DataFrame, model: str = EMBEDDING_MODEL, dim: int = DEFAULT_DIMENSION
) -> DataFrame:
    """Requests for query strings; a blank query has no request."""
    return queries.filter(has_text("q")).select(
        "request_id", _embedding_payload(java_trim("q"), model, dim).alias("request")
    )


def read_embedding_replies(responses: DataFrame, dim: int) -> DataFrame:
    """``(doc_id, embedding, embedding_error)``: exactly one of the last two is set."""
    check_dimension(dim)

    def at(document: str, path: str, kind: str) -> Column:
        return F.try_variant_get(F.col(document), F.lit(path), kind)

    numbers = F.transform(
        F.coalesce("_items", F.array().cast("array<variant>")),
        lambda v: F.when(
            F.schema_of_variant(v).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"),
            F.try_variant_get(v, F.lit("$"), "double"),
        ),
    )
    parsed = (
        responses.withColumn("_root", F.try_parse_json("body"))
        .withColumn("_data", at("_root", "$.data", "array<variant>"))
        .withColumn("_items", at("_root", "$.data[0].embedding", "array<variant>"))
        .withColumn("_numbers", numbers)
    )
    size = F.size("_numbers")
    error = (
        F.when(
            F.col("status").isNull() | ~F.col("status").between(200, 299),
            F.format_string(EMBEDDING_STATUS_MESSAGE, "status", F.coalesce("body", F.lit(""))),
        )
        .when(F.col("_root").isNull(), F.lit(EMBEDDING_JSON_MESSAGE))
        .when(F.coalesce(F.size("_data"), F.lit(0)) <= 0, F.lit(EMBEDDING_EMPTY_MESSAGE))
        .when(F.exists("_numbers", lambda x: x.isNull()), F.lit(EMBEDDING_NUMBER_MESSAGE))
        .when(size != dim, F.format_string(EMBEDDING_DIM_MESSAGE, size, F.lit(dim)))
    )
    return parsed.select("doc_id", "_numbers", error.alias("embedding_error")).select(
        "doc_id",
        F.when(F.col("embedding_error").isNull(), F.col("_numbers")).alias("embedding"),
        "embedding_error",
    )


def embedding_vectors(responses: DataFrame, dim: int) -> DataFrame:
    """``doc_id``, ``_vector``, ``_vector_error`` and ``_found`` of every document with a reply.

    Should one have several, a usable one comes first and of those the one with the smallest
    text holds.
    """
    read = read_embedding_replies(responses, dim)
    reply = F.struct(F.col("embedding").alias("_vector"), F.col("embedding_error").alias("_vector_error"))
    order = F.struct(F.col("embedding_error").isNotNull(), F.col("embedding").cast("string"), "embedding_error")
    best = read.groupBy("doc_id").agg(F.min_by(reply, order).alias("_reply"))
    return best.select("doc_id", "_reply.*", F.lit(True).alias("_found"))


def vector_columns() -> tuple[Column, Column]:
    """``embedding`` and ``embedding_error`` of rows that were joined to ``embedding_vectors``."""
    error = F.when(F.col("_found").isNull(), F.lit(EMBEDDING_MISSING_MESSAGE)).otherwise(F.col("_vector_error"))
    return F.col("_vector").alias("embedding"), error.alias("embedding_error")


def apply_embedding_responses(
    articles: DataFrame, responses: DataFrame, dim: int, heavy: DataFrame | None = None
) -> DataFrame:
    """Attach reply vectors; an unusable or missing reply sets ``embedding_error`` (no fallback).

    Replies are one row a document, so that no article is repeated.
    """
    own = [c for c in articles.columns if c not in ("embedding", "embedding_error")]
    joined = join_skewed(articles.select(*own), embedding_vectors(responses, dim), "doc_id", "left", heavy)
    return joined.select(*own, *vector_columns())
