"""Run metrics per source and their roll-ups."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.fixed_values import (
    LABELS,
    METRICS_FAILED,
    METRICS_SUCCESS,
    SUMMARY_FAILED,
    SUMMARY_OK,
    SUMMARY_PARTIAL,
)
from feedloom.functions.instants import as_instant
from feedloom.functions.vectors import has_embedding

RUN_KEYS = ("run_id", "source_name")

# Counters that the run summary adds up; failed requests are not among them.
SUMMED = (
    "fetched_count",
    "normalized_count",
    "processed_count",
    "embedded_count",
    "indexed_count",
    "created_count",
    "updated_count",
    "total_results",
    "positive_count",
    "negative_count",
    "neutral_count",
)


def sentiment_counts(enriched: DataFrame, *keys: str) -> DataFrame:
    counts = [F.count_if(F.col("sentiment") == word).alias(f"{word}_count") for word in LABELS]
    return enriched.groupBy(*(keys or RUN_KEYS)).agg(*counts)


def embedded_count(enriched: DataFrame, *keys: str) -> DataFrame:
    return enriched.groupBy(*(keys or RUN_KEYS)).agg(
        F.count_if(has_embedding("embedding")).alias("embedded_count")
    )


def failed_requests(processed: str | Column, indexed: str | Column) -> Column:
    """Writes of a successful source that did not reach the index."""
    processed, indexed = (F.col(c) if isinstance(c, str) else c for c in (processed, indexed))
    return F.greatest(F.lit(0).cast("long"), processed - indexed)


def parse_counts(normalized: DataFrame, *keys: str) -> DataFrame:
    """Items in the responses, articles made of them, and the difference."""
    fetched, kept = F.count("pos"), F.count_if(F.col("kept"))
    return normalized.groupBy(*(keys or RUN_KEYS)).agg(
        fetched.alias("fetched_count"),
        kept.alias("normalized_count"),
        (fetched - kept).alias("discarded_count"),
    )


def source_metrics(
    items: DataFrame, summary: DataFrame, failures: DataFrame, run_at: str | datetime | Column
) -> DataFrame:
    """One row per source of the run, successful and failed ones.

    ``items`` are enriched rows of ``normalize_generic`` (articles, dropped items and
    empty responses), ``summary`` comes from ``indexing_summary`` and ``failures`` has
    ``(run_id, source_name, error_message)``. Everything is counted in one pass with
    map-side combine; only per-source rows meet in the joins.
    """
    kept = F.col("kept")
    counted = items.groupBy(*RUN_KEYS).agg(
        F.count("pos").alias("fetched_count"),
        F.count_if(kept).alias("normalized_count"),
        F.count_if(kept & has_embedding("embedding")).alias("embedded_count"),
        *[F.count_if(kept & (F.col("sentiment") == word)).alias(f"{word}_count") for word in LABELS],
    )
    joined = (
        counted.join(failures.select(*RUN_KEYS, "error_message"), list(RUN_KEYS), "full")
        .join(summary, list(RUN_KEYS), "left")
        .withColumn("failed", F.col("error_message").isNotNull())
    )

    def count(name: str) -> Column:
        value = F.when(~F.col("failed"), F.col(name))
        return F.coalesce(value, F.lit(0)).cast("long")

    indexed = F.coalesce("indexed_count", F.lit(0)).cast("long")
    lost = failed_requests("normalized_count", indexed)
    return joined.select(
        "run_id",
        as_instant(run_at).alias("run_at"),
        F.col("source_name").alias("source"),
        F.when(F.col("failed"), METRICS_FAILED).otherwise(METRICS_SUCCESS).alias("status"),
        F.when(~F.col("failed"), F.lit("ok")).alias("upstream_status"),
        count("normalized_count").alias("total_results"),
        count("fetched_count").alias("fetched_count"),
        count("normalized_count").alias("normalized_count"),
        (count("fetched_count") - count("normalized_count")).alias("discarded_count"),
        F.when(F.col("failed"), F.lit(1)).otherwise(lost).cast("long").alias("failed_requests"),
        *[
            count(name).alias(name)
            for name in (
                "embedded_count",
                "indexed_count",
                "created_count",
                "updated_count",
                "positive_count",
                "negative_count",
                "neutral_count",
            )
        ],
        "error_message",
    )


def failed_source_metrics(failures: DataFrame, run_at: str | datetime | Column) -> DataFrame:
    """Metrics rows of failed sources alone: all counts 0, one failed request."""
    names = [f.name for f in schemas.RUN_METRICS.fields if f.dataType == schemas.LONG]
    counts = [F.lit(1 if n == "failed_requests" else 0).cast("long").alias(n) for n in names]
    return failures.select(
        "run_id",
        as_instant(run_at).alias("run_at"),
        F.col("source_name").alias("source"),
        F.lit(METRICS_FAILED).alias("status"),
        F.lit(None).cast("string").alias("upstream_status"),
        *counts,
        "error_message",
    )


def source_summary(metrics: DataFrame, *keys: str) -> DataFrame:
    """The reply row per source (after ``keys``); failed requests and the message appear on
    failures only."""
    failed = F.col("status") == METRICS_FAILED
    return metrics.select(
        *keys,
        "source",
        F.when(failed, SUMMARY_FAILED).otherwise(SUMMARY_OK).alias("status"),
        "fetched_count",
        "normalized_count",
        F.col("normalized_count").alias("processed_count"),
        "embedded_count",
        "indexed_count",
        "created_count",
        "updated_count",
        "total_results",
        "positive_count",
        "negative_count",
        "neutral_count",
        F.when(failed, F.col("failed_requests")).alias("failed_requests"),
        F.when(failed, F.col("error_message")).alias("error_message"),
    )


def run_status(status: str | Column = "status") -> Column:
    """Aggregate: ok when all sources are, failed when none is, else partial."""
    status = F.col(status) if isinstance(status, str) else status
    good = F.count_if(status == SUMMARY_OK)
    return (
        F.when(good == F.count(F.lit(1)), SUMMARY_OK).when(good == 0, SUMMARY_FAILED).otherwise(SUMMARY_PARTIAL)
    )


def run_summary(summaries: DataFrame, *keys: str) -> DataFrame:
    """Status, number of sources and summed counters of a run (per ``keys`` if given)."""
    return summaries.groupBy(*keys).agg(
        run_status().alias("status"),
        F.count(F.lit(1)).alias("source_count"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in SUMMED],
    )
