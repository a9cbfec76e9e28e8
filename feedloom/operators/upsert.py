"""Keyed merge of an article batch into the index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.session import materialize

ORDER = ("source_ord", "response_no", "pos")
# Runs follow each other by the time they fetched.
RUN_ORDER = ("fetched_at", "run_id", *ORDER)
# What the index keeps of a write's place among all writes.
WRITTEN = ("written_at", "written_run")
# Ids with more copies than this in a batch are cut down to their last copy before they move.
HEAVY_COPIES = 100_000


def to_document(enriched: DataFrame, *more: str | Column) -> DataFrame:
    """The stored fields (and ``more``); author and external id are not part of the index."""
    return enriched.select(
        "doc_id",
        "title",
        "content",
        "source",
        "url",
        F.col("published_at").alias("timestamp"),
        F.lower("sentiment").alias("sentiment"),
        "embedding",
        *more,
    )


def latest_per_key(batch: DataFrame, key: str = "doc_id", order: tuple[str, ...] = ORDER) -> DataFrame:
    """The last write of every key.

    Spark pushes ``rank <= 1`` below the exchange (WindowGroupLimit), so each task
    sends at most one row per key however many copies it holds.
    """
    window = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order])
    return batch.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def ordered_writes(enriched: DataFrame) -> DataFrame:
    """Documents to store with their place among all writes, repeated ids included."""
    placed = enriched.withColumns({"written_at": F.col("fetched_at"), "written_run": F.col("run_id")})
    return to_document(placed, *WRITTEN, *ORDER, *[c for c in ("row",) if c in enriched.columns])


def later(a: str, b: str) -> Column:
    """Whether the write of alias ``a`` comes after that of ``b``; false unless both know their time."""

    def place(side: str) -> Column:
        return F.struct(F.col(f"{side}.written_at"), F.coalesce(F.col(f"{side}.written_run"), F.lit("")))

    return F.coalesce(place(a) > place(b), F.lit(False)) & F.col(f"{a}.written_at").isNotNull() & F.col(
        f"{b}.written_at"
    ).isNotNull()


def upsert(index: DataFrame, documents: DataFrame) -> DataFrame:
    """Replace documents by id, keep all others. Both sides hold each id once and are read once.

    Where both sides know when they were written (``written_at``, ``written_run``), a document
    is not replaced by an older one. Documents marked ``stale`` (older than a lower layer's) only
    replace what they meet here.
    """
    ordered = set(WRITTEN) <= set(index.columns) & set(documents.columns)
    joined = index.alias("old").join(documents.alias("new"), F.col("old.doc_id") == F.col("new.doc_id"), "full")
    taken = F.col("new.doc_id").isNotNull()
    if ordered:
        taken = taken & ~(F.col("old.doc_id").isNotNull() & later("old", "new"))
    if "stale" in documents.columns:
        joined = joined.where(F.col("old.doc_id").isNotNull() | ~F.col("new.stale"))
    return joined.select(
        *[F.when(taken, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in index.columns]
    )


def without_heavy_copies(writes: DataFrame, heavy_copies: int = HEAVY_COPIES) -> DataFrame:
    """``writes`` with one row, the last, of every id that has very many.

    Only ids and places are shuffled, combined before that; there can be no more such ids than
    all rows divided by ``heavy_copies``. ``row`` numbers the rows; ``writes`` should be stored,
    since it is read twice.
    """
    place = F.struct(*WRITTEN, *ORDER, "row")
    counted = writes.groupBy("doc_id").agg(F.count(F.lit(1)).alias("copies"), F.max(place).alias("last"))
    heavy = counted.where(F.col("copies") > heavy_copies)
    heavy = materialize(heavy.select(F.col("doc_id").alias("heavy_id"), F.col("last.row").alias("last_row")), "heavy-ids")
    if heavy.isEmpty():
        return writes
    kept = writes.join(F.broadcast(heavy), F.col("doc_id").eqNullSafe(F.col("heavy_id")), "left")
    return kept.where(F.col("last_row").isNull() | (F.col("row") == F.col("last_row"))).select(*writes.columns)


def indexing_summary(index_ids: DataFrame, writes: DataFrame) -> DataFrame:
    """Indexed, created and updated counts per (run_id, source_name).

    ``writes`` holds every write in order, repeats included; ``index_ids`` the ids before
    the run. The first write of an unknown id creates it; all others update.
    """
    order = [c for c in RUN_ORDER if c in writes.columns]
    per_source = writes.groupBy("run_id", "source_name").agg(F.count(F.lit(1)).alias("indexed_count"))
    first_writer = writes.groupBy("doc_id").agg(
        F.min(F.struct(*order, *[c for c in ("run_id", "source_name") if c not in order])).alias("first")
    )
    created = (
        first_writer.join(index_ids.select("doc_id"), "doc_id", "left_anti")
        .groupBy(F.col("first.run_id").alias("run_id"), F.col("first.source_name").alias("source_name"))
        .agg(F.count(F.lit(1)).alias("created_count"))
    )
    created_count = F.coalesce("created_count", F.lit(0)).cast("long")
    return per_source.join(created, ["run_id", "source_name"], "left").select(
        "run_id",
        "source_name",
        "indexed_count",
        created_count.alias("created_count"),
        (F.col("indexed_count") - created_count).alias("updated_count"),
    )


def summarize_write_results(results: DataFrame) -> DataFrame:
    """Counts from a log of write results ``(source, result)``; a failed write has a NULL result.

    A successful write with any other result than created or updated counts as indexed only.
    """
    return results.groupBy("source").agg(
        F.count("result").alias("indexed_count"),
        F.count_if(F.col("result") == "created").alias("created_count"),
        F.count_if(F.col("result") == "updated").alias("updated_count"),
    )
