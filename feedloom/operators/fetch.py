"""Fetch outcomes from a log of attempts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.fixed_values import (
    DEFAULT_MAX_RETRIES,
    FETCH_FAILED_MESSAGE,
    RETRYABLE_KINDS,
    RETRYABLE_STATUS_CODES,
)
from feedloom.functions.text import error_text


def fetch_outcomes(
    attempts: DataFrame, max_retries: int = DEFAULT_MAX_RETRIES, retryable_kinds: Sequence[str] = RETRYABLE_KINDS
) -> DataFrame:
    """Outcome per (run_id, source): the attempt that ended the retry loop decides.

    An attempt is a success when its status is 2xx and no ``error_kind`` is set. Failures
    without a status whose kind is one of ``retryable_kinds`` (client, I/O, timeout and
    interrupt errors) and the retryable statuses go on to the next attempt, up to
    ``max_retries + 1``; any other failure ends the loop at once.

    ``min_by`` and ``max_by`` combine before the shuffle, so a source with very many
    attempts sends one row per task.
    """
    last_allowed = max(0, max_retries) + 1
    ok = F.col("error_kind").isNull() & F.coalesce(F.col("status").between(200, 299), F.lit(False))
    by_kind = F.col("status").isNull() & F.coalesce(F.col("error_kind").isin(*retryable_kinds), F.lit(False))
    retryable = by_kind | F.coalesce(F.col("status").isin(*RETRYABLE_STATUS_CODES), F.lit(False))
    reason = F.when(
        F.col("status").isNotNull(), F.format_string("HTTP %d %s", "status", F.coalesce("message", F.lit("")))
    ).otherwise(error_text("message", "error_kind"))
    ends = ok | ~retryable | (F.col("attempt") == last_allowed)

    attempt = F.struct("attempt", ok.alias("ok"), reason.alias("reason"))
    decided = F.coalesce(
        F.min_by(F.when(ends, attempt), F.when(ends, F.col("attempt"))), F.max_by(attempt, F.col("attempt"))
    )
    return (
        attempts.filter(F.col("attempt") <= last_allowed)
        .groupBy("run_id", "source")
        .agg(decided.alias("d"))
        .select(
            "run_id",
            "source",
            F.col("d.ok").alias("ok"),
            F.col("d.attempt").alias("attempts"),
            F.when(~F.col("d.ok"), F.format_string(FETCH_FAILED_MESSAGE, "source", "d.reason")).alias(
                "error_message"
            ),
        )
    )


def fetch_failures(outcomes: DataFrame) -> DataFrame:
    """Failed fetches in the form ``ingest`` takes: run, source name and message."""
    return outcomes.filter(~F.col("ok")).select(
        "run_id", F.col("source").alias("source_name"), "error_message"
    )
