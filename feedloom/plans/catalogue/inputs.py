"""Inputs of the catalogue, derived by Spark from the given tables."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.functions.hashing import sha256_id
from feedloom.functions.instants import iso_instant
from feedloom.session import spread

RUN_AT = datetime(2026, 5, 9, 8, tzinfo=UTC)
RUN_AT_MICROS = int(RUN_AT.timestamp()) * 1_000_000
# Seconds of 2024-01-01T00:00:00Z; an article's publication time counts on from there.
EPOCH_2024 = 1_704_067_200
# Number of consecutive ids that share one response; bounds the articles of a body.
IDS_PER_RESPONSE = 200

POSITIVE_FRAGMENTS = ("wh", "ly", "ing", "men")
NEGATIVE_FRAGMENTS = ("th", "eau", "ien", "ado")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def utc(timestamp_ntz: str | Column) -> Column:
    """Read a zone-less time as UTC whatever the session's time zone is."""
    value = F.col(timestamp_ntz) if isinstance(timestamp_ntz, str) else timestamp_ntz
    return F.concat(value.cast("string"), F.lit("Z")).cast("timestamp")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as articles: title is the first line, content the rest."""
    title = F.substring_index("text", "\n", 1)
    return (
        spread(read(spark, sf_dir, "documents"))
        .withColumn("title", title)
        .select(
            F.col("doc_id").alias("n"),
            "source",
            "lang",
            "n_chars",
            "title",
            F.expr("substring(text, length(title) + 2)").alias("content"),
            F.concat_ws("/", F.lit("https://feed.example"), "source", "doc_id").alias("url"),
            F.timestamp_seconds(F.lit(EPOCH_2024) + F.col("doc_id") * 61).alias("published_at"),
        )
    )


def keyed_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles(spark, sf_dir).withColumn("doc_id", sha256_id("url"))


def article_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and document id of every article; reads no text."""
    url = F.concat_ws("/", F.lit("https://feed.example"), "source", "doc_id")
    return read(spark, sf_dir, "documents").select(F.col("doc_id").alias("n"), sha256_id(url).alias("doc_id"))


def published_text() -> Column:
    """Publication text that is good, shifted, a bare date or absent, by language."""
    iso = iso_instant("published_at")
    return (
        F.when(F.col("lang") == "en", iso)
        .when(F.col("lang") == "fr", F.regexp_replace(iso, "Z$", "+02:00"))
        .when(F.col("lang") == "de", F.substring(iso, 1, 10))
    )


# The same rule for the expected results; a bare date or no text gives the time of the run.
PUBLISHED_MICROS = f"""CASE lang WHEN 'en' THEN ({EPOCH_2024} + doc_id * 61) * 1000000
  WHEN 'fr' THEN ({EPOCH_2024} - 7200 + doc_id * 61) * 1000000 ELSE {RUN_AT_MICROS} END"""


def responses(rows: DataFrame, item: Column, wrap) -> DataFrame:
    """One body per source and run of consecutive ids, its items in id order."""
    grouped = rows.groupBy("source", F.expr(f"n div {IDS_PER_RESPONSE}").cast("int").alias("response_no"))
    items = F.transform(F.array_sort(F.collect_list(F.struct("n", item.alias("item")))), lambda x: x["item"])
    return grouped.agg(items.alias("items")).select(
        F.lit("run-1").alias("run_id"),
        "source",
        F.regexp_extract("source", r"(\d+)$", 1).cast("int").alias("source_ord"),
        "response_no",
        F.to_json(wrap(F.col("items"))).alias("body"),
        F.lit(RUN_AT).cast("timestamp").alias("fetched_at"),
    )


def wire_item() -> Column:
    """Items of the first shape. Short documents lose their title, French ones their source."""
    return F.struct(
        F.when(F.col("n_chars") < 300, F.lit(" \t")).otherwise(F.col("title")).alias("title"),
        F.col("content").alias("description"),
        "url",
        F.struct(F.when(F.col("lang") == "fr", F.lit("")).otherwise(F.col("lang")).alias("name")).alias("source"),
        published_text().alias("publishedAt"),
    )


def wire_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses(articles(spark, sf_dir), wire_item(), lambda items: F.struct(items.alias("articles")))


WIRE_MAPPING = ("$.articles", "$.title", "$.description", "$.url", "$.source.name", "$.publishedAt")


def mapping(*paths: str) -> Column:
    names = schemas.RESPONSE_MAPPING.names
    return F.struct(*[F.lit(p).alias(n) for n, p in zip(names, paths, strict=True)])


def config_for(sources: DataFrame, response_mapping: Column, method: Column | None = None) -> DataFrame:
    """A configuration with one row per source that occurs in the data."""
    return sources.select(F.col("source").alias("name")).distinct().select(
        "name",
        F.lit(True).alias("enabled"),
        F.lit("generic-json").alias("type"),
        F.lit("https://feed.example/api").alias("url"),
        (F.lit("GET") if method is None else method).alias("method"),
        response_mapping.alias("response_mapping"),
    )


def wire_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    return config_for(read(spark, sf_dir, "documents"), mapping(*WIRE_MAPPING))
