"""One ingestion run over all sources as a single job."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.operators.config import check_config, check_method, enabled_sources, require_sources, source_config
from feedloom.operators.enrich import enrich, source_atomic_gate, source_failures
from feedloom.operators.metrics import RUN_KEYS, run_summary, source_metrics, source_summary
from feedloom.operators.normalize import flatten_responses, normalize_generic, typed_items
from feedloom.operators.upsert import RUN_ORDER, indexing_summary, latest_per_key, ordered_writes, to_document
from feedloom.session import materialize
from feedloom.sources.article_index import ArticleIndex, Commit
from feedloom.sources.run_log import append_metrics

Parser = Callable[[DataFrame, DataFrame, Column], DataFrame]
Sink = Callable[[DataFrame], None]
Check = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class RunResult:
    metrics: DataFrame
    sources: DataFrame
    summary: DataFrame
    commit: Commit | None


def parse_generic(raw: DataFrame, config: DataFrame, run_at: Column) -> DataFrame:
    return normalize_generic(flatten_responses(raw, config), run_at)


def parse_typed(raw: DataFrame, config: DataFrame, run_at: Column) -> DataFrame:
    """Bodies of the typed provider; their sources need no mapping."""
    return typed_items(raw, config, run_at)


def process(
    raw: DataFrame,
    config: DataFrame,
    run_at: datetime | Column,
    dim: int,
    *,
    parser: Parser = parse_generic,
    **enrichment,
) -> DataFrame:
    """Parse, clean and enrich every response of every source in one plan.

    ``raw`` may hold any number of runs. Rows that carry no article keep their place with
    ``kept`` false, so that counting needs no second parse.
    """
    run_at = run_at if isinstance(run_at, Column) else F.lit(run_at).cast("timestamp")
    items = parser(raw, config, run_at)
    if enrichment.keys() & {"sentiment_responses", "embedding_responses"}:
        # Joining replies reads the articles more than once; they are parsed only once.
        items = materialize(items, "articles")
    enriched = enrich(items, dim, **enrichment)
    kept = F.col("kept")
    return enriched.withColumns(
        {
            "sentiment": F.when(kept, F.col("sentiment")),
            "embedding": F.when(kept, F.col("embedding")),
            "embedding_error": F.when(kept, F.col("embedding_error")),
        }
    )


def failures_of(items: DataFrame, fetch_failures: DataFrame | None = None) -> DataFrame:
    """Each failing source's first error: fetch, then parse, then embedding."""
    found = source_failures(
        items.withColumn("_error", F.coalesce("error_message", "embedding_error")), "_error"
    ).withColumn("_stage", F.lit(1))
    if fetch_failures is not None:
        found = found.unionByName(
            fetch_failures.select(*RUN_KEYS, "error_message", F.lit(0).alias("_stage"))
        )
    return found.groupBy(*RUN_KEYS).agg(F.min_by("error_message", "_stage").alias("error_message"))


def misconfigured(sources: DataFrame, runs: list[str], check: Check = check_config) -> DataFrame:
    """A failure of every wrongly configured source in each run, whether it answered or not."""
    wrong = check(sources).where("error_message IS NOT NULL")
    run_ids = F.array(*map(F.lit, runs)).cast("array<string>")
    return wrong.select(F.explode(run_ids).alias("run_id"), F.col("name").alias("source_name"), "error_message")


def ingest(
    raw: DataFrame,
    config: DataFrame,
    index: ArticleIndex,
    metrics_path: str,
    *,
    run_at: datetime | None = None,
    published_default: Column | None = None,
    fetch_failures: DataFrame | None = None,
    batch_id: str | None = None,
    parser: Parser = parse_generic,
    check: Check | None = None,
    sink: Sink | None = None,
    **enrichment,
) -> RunResult:
    """Run a batch of responses into the index and append its metrics.

    The enriched rows are written once to the shared scratch folder; merge, counts and
    failure gate read columns of that copy. With a ``batch_id`` the run may be repeated:
    the index takes a batch once and so does the run log. ``sink`` receives the merged
    documents instead of the index, for a store of the caller's own. ``check`` tells which
    sources are wrongly configured; only the generic parser wants a mapping.

    ``raw`` may hold several runs: of two writes of a document, the one fetched later holds.
    Responses without a run belong to the run named like the batch, or like ``run_at``. The
    summary has a row per run.
    """
    run_at = run_at or datetime.now(UTC)
    own_run = F.coalesce("run_id", F.lit(batch_id or run_at.isoformat()))
    raw = raw.withColumn("run_id", own_run)
    if fetch_failures is not None:
        fetch_failures = fetch_failures.withColumn("run_id", own_run)
    sources = require_sources(enabled_sources(source_config(config)))
    commit = index.commit() or index.create()
    done = index.commit_of_batch(batch_id) if batch_id is not None else None

    default = published_default if published_default is not None else F.lit(run_at).cast("timestamp")
    items = process(raw, sources, default, commit.dim, parser=parser, **enrichment)
    items = materialize(items.withColumn("row", F.monotonically_increasing_id()), "items")

    # One value per run of the batch.
    runs = sorted(r["run_id"] for r in items.select("run_id").distinct().collect())
    check = check or (check_config if parser is parse_generic else check_method)
    known = misconfigured(sources, runs or [batch_id or run_at.isoformat()], check)
    early = known if fetch_failures is None else known.unionByName(fetch_failures.select(*RUN_KEYS, "error_message"))
    early = early.groupBy(*RUN_KEYS).agg(F.min("error_message").alias("error_message"))
    failures = materialize(failures_of(items, early), "failures")
    writes = source_atomic_gate(items.filter("kept"), failures)
    before = index.read(done.version - 1 if done else None)
    order = ("source_name", *RUN_ORDER, "doc_id")
    summary = indexing_summary(before.select("doc_id"), writes.select(*order))
    metrics = materialize(source_metrics(items, summary, failures, run_at), "metrics")

    if sink is not None:
        sink(to_document(latest_per_key(writes, order=RUN_ORDER)))
        committed = None
    else:
        committed = index.upsert(ordered_writes(writes), batch_id, stored=True)
    append_metrics(metrics, metrics_path, batch_id)
    replies = source_summary(metrics, "run_id")
    return RunResult(metrics, replies, run_summary(replies, "run_id"), committed)
