"""From raw response bodies to articles."""

from __future__ import annotations

from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom import schemas
from feedloom.fixed_values import BAD_JSON_MESSAGE, NOT_AN_ARRAY_MESSAGE, UNKNOWN_SOURCE
from feedloom.functions.instants import parse_instant_or
from feedloom.functions.jsonpath import as_array, as_text, parse_body, path_get, path_get_known
from feedloom.functions.text import first_text, has_text
from feedloom.operators.columns import computed_once
from feedloom.operators.config import check_config, check_method
from feedloom.operators.joins import join_skewed

ORDER = ("source_ord", "response_no", "pos")
KEYS = ("run_id", "source_name", *ORDER)


# A configuration of at most this many rows is read once and sent to every task.
LOCAL_CONFIG_ROWS = 20_000
# With at most this many different paths for a field, its lookups are compiled.
COMPILED_PATHS = 64


def _configured(raw: DataFrame, checked: DataFrame) -> tuple[DataFrame, pa.Table | None]:
    """Responses with the columns of their source's configuration, and the configuration if it is small."""
    raw = raw.withColumnRenamed("source", "source_name")
    local = checked.limit(LOCAL_CONFIG_ROWS + 1).toArrow()
    if local.num_rows > LOCAL_CONFIG_ROWS:
        return join_skewed(raw, checked, "source_name"), None
    sources = F.broadcast(raw.sparkSession.createDataFrame(local, checked.schema))
    return raw.join(sources, "source_name"), local


def flatten_responses(raw: DataFrame, config: DataFrame) -> DataFrame:
    """One row per item of every response body, with the texts its source's mapping names.

    A body that cannot be read gives one row with ``error_message``, an empty article
    list one row without an item: every response stays visible to the run metrics, and
    a broken source never stops the others.
    """
    names = schemas.RESPONSE_MAPPING.names
    checked = check_config(config).select(
        F.col("name").alias("source_name"),
        F.col("error_message").alias("config_error"),
        *[F.col(f"response_mapping.{name}").alias(f"{name}_path") for name in names],
    )
    bodies, local = _configured(raw, checked)
    known = {} if local is None else {name: set(local.column(f"{name}_path").to_pylist()) for name in names}

    def lookup(value: str, name: str) -> Column:
        path = F.col(f"{name}_path")
        if 0 < len(known.get(name, ())) <= COMPILED_PATHS:
            return path_get_known(value, path, known[name])
        return path_get(value, path)

    rooted = computed_once(bodies, root=parse_body("body"))
    parsed = computed_once(
        rooted, unreadable=F.col("root").isNull(), items=as_array(lookup("root", "articles_path"))
    )
    error = F.coalesce(
        F.col("config_error"),
        F.when(F.col("unreadable"), F.format_string(BAD_JSON_MESSAGE, "source_name")).when(
            F.col("items").isNull(),
            F.format_string(NOT_AN_ARRAY_MESSAGE, "source_name", "articles_path_path"),
        ),
    )
    items = parsed.select(
        "run_id",
        "source_name",
        "source_ord",
        "response_no",
        "fetched_at",
        *[f"{name}_path" for name in names[1:]],
        error.alias("error_message"),
        F.posexplode_outer(F.when(F.col("config_error").isNull(), F.col("items"))).alias("pos", "item"),
    )
    texts = {f"raw_{name}": as_text(lookup("item", name)) for name in names[1:]}
    return computed_once(items, **texts).select(*KEYS, "fetched_at", "error_message", *texts)


def normalize_generic(items: DataFrame, run_at: str | datetime | Column) -> DataFrame:
    """Articles from flattened items, with the fallback rules of the generic mapper.

    ``run_at`` stands in for a missing or unreadable publication time; it may be an
    expression over the items, such as ``fetched_at``.

    Rows of ``flatten_responses`` keep their place: ``kept`` is true for the articles and
    false for untitled items, errors and empty responses.
    """
    return items.select(
        *KEYS,
        "error_message",
        "fetched_at",
        has_text("raw_title").alias("kept"),
        F.col("raw_url").alias("external_id"),
        F.col("raw_title").alias("title"),
        first_text("raw_content", "raw_title").alias("content"),
        first_text("raw_source", "source_name").alias("source"),
        F.lit(None).cast("string").alias("author"),
        F.col("raw_url").alias("url"),
        parse_instant_or("raw_timestamp", run_at).alias("published_at"),
    )


def articles_of(normalized: DataFrame) -> DataFrame:
    return normalized.filter("kept").drop("kept", "error_message")


def response_errors(normalized: DataFrame) -> DataFrame:
    """The first error of each failing source."""
    return (
        normalized.filter(F.col("error_message").isNotNull())
        .groupBy("run_id", "source_name")
        .agg(F.min_by("error_message", F.struct("source_ord", "response_no")).alias("error_message"))
    )


def typed_responses(raw: DataFrame, schema=schemas.TYPED_PAYLOAD) -> DataFrame:
    """Bodies of the typed provider as a nested struct ``payload``, and ``unreadable``.

    A body that is missing, is no JSON object or has a value of another type is unreadable and
    has no payload; a body that says ``null`` has none either, but may.
    """
    known = T.StructType([*schema.fields, T.StructField("_as_text", T.StringType())])
    parsed = F.from_json("body", known, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_as_text"})
    body = F.btrim("body", F.lit(" \t\r\n"))
    read = computed_once(raw, _payload=F.when(F.startswith(body, F.lit("{")), parsed))
    good = F.col("_payload").isNotNull() & F.col("_payload._as_text").isNull()
    payload = F.struct(*[F.col(f"_payload.{name}").alias(name) for name in schema.names])
    unreadable = ~good & ~F.coalesce(body == "null", F.lit(False))
    return read.select(*raw.columns, F.when(good, payload).alias("payload"), unreadable.alias("unreadable"))


def flatten_typed(
    typed: DataFrame, run_at: str | datetime | Column, fallback: str | Column | None = UNKNOWN_SOURCE
) -> DataFrame:
    """One row per item of typed payloads, shaped like those of ``normalize_generic``.

    ``kept`` is true for items with title and url. An unreadable body, or one with an
    ``error_message`` already, gives one row with that message, an empty one a row without
    an item.
    """
    fallback = fallback if isinstance(fallback, Column) else F.lit(fallback).cast("string")
    known = F.col("error_message") if "error_message" in typed.columns else F.lit(None).cast("string")
    source = "source_name" if "source_name" in typed.columns else "source"
    error = F.coalesce(known, F.when(F.col("unreadable"), F.format_string(BAD_JSON_MESSAGE, source)))
    marked = typed.withColumn("_error", error)
    items = marked.select(
        "run_id",
        F.col(source).alias("source_name"),
        "source_ord",
        "response_no",
        "fetched_at",
        F.col("_error").alias("error_message"),
        fallback.alias("fallback"),
        F.posexplode_outer(F.when(F.col("_error").isNull(), F.col("payload.articles"))).alias("pos", "item"),
    )
    return items.select(
        *KEYS,
        "error_message",
        "fetched_at",
        (has_text("item.title") & has_text("item.url")).alias("kept"),
        F.col("item.url").alias("external_id"),
        F.col("item.title").alias("title"),
        first_text("item.content", "item.description", F.lit("")).alias("content"),
        first_text("item.source.name", "fallback", F.lit(UNKNOWN_SOURCE)).alias("source"),
        F.col("item.author").alias("author"),
        F.col("item.url").alias("url"),
        parse_instant_or("item.publishedAt", run_at).alias("published_at"),
    )


def normalize_typed(
    typed: DataFrame, run_at: str | datetime | Column, fallback: str | Column | None = UNKNOWN_SOURCE
) -> DataFrame:
    """Articles of the typed provider; title and url are both required."""
    return articles_of(flatten_typed(typed, run_at, fallback))


def typed_items(raw: DataFrame, config: DataFrame, run_at: str | datetime | Column) -> DataFrame:
    """Items of all typed bodies of configured sources; a source's name stands in for a missing one."""
    checked = check_method(config).select(F.col("name").alias("source_name"), "error_message")
    bodies, _ = _configured(raw, checked)
    return flatten_typed(typed_responses(bodies), run_at, F.col("source_name"))


def extract(df: DataFrame, body: str, **paths: str) -> DataFrame:
    """Add text columns read from a JSON text column by dotted paths."""
    root = df.withColumn("_root", parse_body(body))
    return root.select(
        *df.columns, *[as_text(path_get("_root", path)).alias(name) for name, path in paths.items()]
    )
