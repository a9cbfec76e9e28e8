"""Ingestion of newly landed responses with Structured Streaming."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedloom.plans.ingest import ingest
from feedloom.sources.article_index import ArticleIndex
from feedloom.sources.responses import landed_responses, raw_response_stream
from feedloom.streaming.dead_letters import DeadLetters

LOG = logging.getLogger(__name__)


def ingest_stream(
    spark: SparkSession,
    landing: str,
    config: DataFrame,
    index: ArticleIndex,
    metrics_path: str,
    checkpoint: str,
    *,
    name: str = "ingest",
    fmt: str = "json",
    max_files: int | None = None,
    stop_on_error: bool = True,
    retry_path: str | None = None,
    **options,
) -> StreamingQuery:
    """Ingest every response file that has not been ingested yet, then stop.

    Run it as often as the sources are fetched. The checkpoint hands each file to one
    batch; a batch that is replayed after a crash carries the same id and is taken once.
    A failed batch raises, and its files are ingested by the next call. Without
    ``stop_on_error`` the stream goes on, and the names of the batch's files are kept in
    ``retry_path`` (beside the checkpoint unless given); the next call takes those first. Texts
    without a publication time get the time their response was fetched (or its file was
    written), so a replay gives the same documents.
    """
    letters = DeadLetters(spark, retry_path or f"{checkpoint.rstrip('/')}-retry")

    def take(rows: DataFrame, batch_id: str) -> None:
        ingest(
            rows,
            config,
            index,
            metrics_path,
            batch_id=batch_id,
            **{"published_default": F.col("fetched_at"), **options},
        )

    def run(batch: DataFrame, epoch: int) -> None:
        try:
            take(batch, f"{name}-{epoch}")
        except Exception as error:
            if stop_on_error:
                raise
            LOG.exception("Ingestion run %s-%d failed", name, epoch)
            letters.put(batch, f"{name}-{epoch}", error)

    letters.retry(lambda files, batch_id: take(landed_responses(spark, files, fmt), batch_id), name)

    return (
        raw_response_stream(spark, landing, fmt, max_files)
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
