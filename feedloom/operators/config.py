"""Source configuration as a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.fixed_values import (
    API_KEY_PARAM,
    BAD_METHOD_MESSAGE,
    DEFAULT_METHOD,
    DEFAULT_SOURCE_TYPE,
    NO_ARTICLES_PATH_MESSAGE,
    NO_MAPPING_MESSAGE,
    NO_SOURCES_MESSAGE,
)
from feedloom.functions.jsonpath import as_text
from feedloom.functions.text import first_text, has_text
from feedloom.functions.urls import request_url, request_url_without


def source_config(df: DataFrame) -> DataFrame:
    """Fill the defaults of a configuration table; missing columns count as NULL.

    ``enabled`` may be boolean or text: blank means enabled, otherwise only ``true``
    (any case) does.
    """

    def given(name: str) -> Column:
        return F.col(name) if name in df.columns else F.lit(None)

    enabled = given("enabled").cast("string")
    empty_map = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))

    def text_map(name: str) -> Column:
        return F.coalesce(given(name).cast("map<string,string>"), empty_map)

    return df.select(
        given("name").cast("string").alias("name"),
        F.when(has_text(enabled), F.lower(enabled) == "true").otherwise(True).alias("enabled"),
        first_text(given("type").cast("string"), F.lit(DEFAULT_SOURCE_TYPE)).alias("type"),
        given("url").cast("string").alias("url"),
        first_text(given("method").cast("string"), F.lit(DEFAULT_METHOD)).alias("method"),
        text_map("headers").alias("headers"),
        text_map("params").alias("params"),
        given("schedule").cast("string").alias("schedule"),
        given("response_mapping").cast(schemas.RESPONSE_MAPPING).alias("response_mapping"),
    )


def source_config_from_json(df: DataFrame, entry: str = "entry") -> DataFrame:
    """The same from one JSON object per source, with camel-case keys and loose types.

    A header, parameter or mapping entry that is not an object counts as absent.
    """
    value = F.try_parse_json(F.col(entry))

    def text(path: str) -> Column:
        return F.try_variant_get(value, F.lit(path), "string")

    def text_map(path: str) -> Column:
        entries = F.try_variant_get(value, F.lit(path), "map<string,variant>")
        return F.transform_values(entries, lambda _, v: as_text(v))

    fields = zip(
        schemas.RESPONSE_MAPPING.names,
        ("articlesPath", "title", "content", "url", "source", "timestamp"),
        strict=True,
    )
    mapping = F.struct(*[text(f"$.responseMapping.{key}").alias(name) for name, key in fields])
    is_object = F.try_variant_get(value, F.lit("$.responseMapping"), "map<string,variant>").isNotNull()
    return source_config(
        df.select(
            *[text(f"$.{n}").alias(n) for n in ("name", "enabled", "type", "url", "method", "schedule")],
            text_map("$.headers").alias("headers"),
            text_map("$.params").alias("params"),
            F.when(is_object, mapping).alias("response_mapping"),
        )
    )


def enabled_sources(config: DataFrame) -> DataFrame:
    return config.filter(F.col("enabled") & (F.lower("type") == DEFAULT_SOURCE_TYPE))


def require_sources(config: DataFrame) -> DataFrame:
    if config.isEmpty():
        raise ValueError(NO_SOURCES_MESSAGE)
    return config


def _method_error() -> Column:
    method = first_text("method", F.lit(DEFAULT_METHOD))
    message = F.format_string(BAD_METHOD_MESSAGE, F.coalesce("name", F.lit("null")), method)
    return F.when(F.upper(method) != DEFAULT_METHOD, message)


def check_method(config: DataFrame) -> DataFrame:
    """Add ``error_message``: wrong method, or NULL. Enough for parsers that need no mapping."""
    return config.withColumn("error_message", _method_error())


def check_config(config: DataFrame) -> DataFrame:
    """Add ``error_message``: wrong method, missing mapping, missing articles path, or NULL."""
    name = F.coalesce("name", F.lit("null"))
    return config.withColumn(
        "error_message",
        F.coalesce(
            _method_error(),
            F.when(F.col("response_mapping").isNull(), F.format_string(NO_MAPPING_MESSAGE, name)).when(
                ~has_text("response_mapping.articles_path"), F.format_string(NO_ARTICLES_PATH_MESSAGE, name)
            ),
        ),
    )


def with_request_url(config: DataFrame, drop_api_key: bool = False) -> DataFrame:
    """Add ``request_url``; the typed provider sends its key elsewhere and drops it here."""
    target = (
        request_url_without("url", "params", API_KEY_PARAM) if drop_api_key else request_url("url", "params")
    )
    return config.withColumn("request_url", target)
