"""Sentiment labels: keyword lexicon, or replies of an offline model run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.fixed_values import (
    NEGATIVE_KEYWORDS,
    POSITIVE_KEYWORDS,
    SENTIMENT_MODEL,
    SENTIMENT_SYSTEM_TEXT,
    SENTIMENT_USER_TEXT,
)
from feedloom.functions.lexicon import keyword_sentiment, label
from feedloom.functions.text import model_sentiment_text, truncate
from feedloom.operators.joins import join_skewed


def with_keyword_sentiment(
    articles: DataFrame,
    positive: Sequence[str] = POSITIVE_KEYWORDS,
    negative: Sequence[str] = NEGATIVE_KEYWORDS,
) -> DataFrame:
    return articles.withColumn("sentiment", keyword_sentiment("title", "content", positive, negative))


def sentiment_requests(
    articles: DataFrame, model: str = SENTIMENT_MODEL, max_chars: int | None = None
) -> DataFrame:
    """One request payload per article, for an offline run of the model.

    ``max_chars`` is the model's input limit, if it has one.
    """

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    text = model_sentiment_text("title", "content")
    text = text if max_chars is None else truncate(text, max_chars)
    payload = F.struct(
        F.lit(model).alias("model"),
        F.lit(0).alias("temperature"),
        F.lit(20).alias("max_tokens"),
        F.struct(F.lit("json_object").alias("type")).alias("response_format"),
        F.array(
            message("system", F.lit(SENTIMENT_SYSTEM_TEXT)),
            message("user", F.concat(F.lit(SENTIMENT_USER_TEXT), text)),
        ).alias("messages"),
    )
    return articles.select("doc_id", F.to_json(payload).alias("request"))


def reply_label(status: str | Column, body: str | Column) -> Column:
    """Label inside a chat reply, or NULL: bad status, bad outer or inner JSON, wrong types, unknown label."""

    def text_at(document: Column, path: str) -> Column:
        value = F.try_variant_get(document, F.lit(path), "variant")
        is_text = F.schema_of_variant(value) == "STRING"
        return F.when(is_text, F.try_variant_get(document, F.lit(path), "string"))

    status, body = (F.col(c) if isinstance(c, str) else c for c in (status, body))
    content = text_at(F.try_parse_json(body), "$.choices[0].message.content")
    found = label(text_at(F.try_parse_json(content), "$.sentiment"))
    return F.when(status.between(200, 299), found)


def sentiment_labels(responses: DataFrame) -> DataFrame:
    """``doc_id`` and ``_label`` of every document with a usable reply. Should one have several, the
    alphabetically first label holds."""
    read = responses.select("doc_id", reply_label("status", "body").alias("_label"))
    return read.filter(F.col("_label").isNotNull()).groupBy("doc_id").agg(F.min("_label").alias("_label"))


def apply_sentiment_responses(
    articles: DataFrame,
    responses: DataFrame,
    positive: Sequence[str] = POSITIVE_KEYWORDS,
    negative: Sequence[str] = NEGATIVE_KEYWORDS,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Label each article from its reply; without a usable one from the lexicon.

    Replies shrink to ``(doc_id, label)`` before the shuffle.
    """
    fallback = keyword_sentiment("title", "content", positive, negative)
    return join_skewed(articles, sentiment_labels(responses), "doc_id", "left", heavy).select(
        *articles.columns, F.coalesce("_label", fallback).alias("sentiment")
    )
