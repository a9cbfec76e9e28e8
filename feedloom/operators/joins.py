"""Joins that hold when one key carries a third of all rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only after a count has shown that it is no longer than this.
BROADCAST_ROWS = 100_000
# Keys with more rows than this are spread over tasks. There can be no more of them than all
# rows divided by it.
HEAVY_ROWS = 1_000_000
# Keys that a task's sketch tells apart.
TRACKED_KEYS = 4096
SALTS = 32


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; reads no further than that."""
    return df.limit(max_rows + 1).count() <= max_rows


def join_small(
    left: DataFrame, right: DataFrame, on: str, how: str = "inner", max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Join to a side that is expected to be small: broadcast if it is, else a salted shuffle join."""
    if fits(right, max_rows):
        return left.join(F.broadcast(right), on, how)
    return join_skewed(left, right, on, how)


def heavy_keys(
    df: DataFrame, key: str, heavy_rows: int = HEAVY_ROWS, *, weight: Column | None = None, tracked: int = TRACKED_KEYS
) -> DataFrame:
    """All keys with more than ``heavy_rows`` rows, or with more than that ``weight`` in all.

    ``weight`` (bytes, say) is 1 a row unless given. One pass with a sketch of bounded size: a task
    holds the weights of ``tracked`` keys; whenever it holds twice as many it takes the largest
    weight below those off all keys and drops what is used up. What a task took off bounds its
    error, so a key that is above the mark in all tasks together cannot be missed. Keys close to
    the mark may come too; there are at most two for each mark that fits into the whole. Only the
    sketches are shuffled. With so many keys that the sketches' error is above the mark, the mark
    is twice the error: such keys hold a 1/``tracked``-th of all weight at most.
    """
    kind = df.schema[key].dataType
    rows = df.where(F.col(key).isNotNull()).select(
        F.col(key).alias("key"), (F.lit(1.0) if weight is None else weight.cast("double")).alias("weight")
    )
    out = T.StructType([T.StructField("key", kind), T.StructField("weight", T.DoubleType()), T.StructField("lost", T.DoubleType())])

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        lost = 0.0
        for batch in batches:
            own = pa.table({"key": batch.column(0), "weight": batch.column(1)})
            held = own if held is None else pa.concat_tables([held, own])
            held = held.group_by("key").aggregate([("weight", "sum")]).rename_columns(["key", "weight"])
            if len(held) > 2 * tracked:
                weights = held.column("weight").to_numpy()
                off = float(np.partition(weights, len(weights) - tracked - 1)[len(weights) - tracked - 1])
                lost += off
                held = held.filter(pc.greater(held.column("weight"), off))
                held = held.set_column(1, "weight", pc.subtract(held.column("weight"), off))
        if held is not None:
            # All keys may have been taken off: without rows the type has to be told.
            held = held.append_column("lost", pa.array([0.0] * len(held), pa.float64())).combine_chunks()
            yield from held.to_batches()
            yield pa.RecordBatch.from_arrays([pa.nulls(1, held.schema.field("key").type), pa.array([0.0]), pa.array([lost])], schema=held.schema)

    sketched = rows.mapInArrow(sketch, out).groupBy("key").agg(F.sum("weight").alias("weight"), F.sum("lost").alias("lost"))
    error = sketched.where("key IS NULL").select(F.col("lost").alias("error"))  # one row
    met = sketched.where("key IS NOT NULL").join(F.broadcast(error))
    mark = F.greatest(F.lit(float(heavy_rows)), 2 * F.col("error"))
    return met.where(F.col("weight") + F.col("error") > mark).select(F.col("key").alias(key))


def join_skewed(
    left: DataFrame,
    right: DataFrame,
    on: str,
    how: str = "inner",
    heavy: DataFrame | None = None,
    salts: int = SALTS,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Equi-join whose left side may hold very many rows of one key.

    The left rows of ``heavy`` keys (found by ``heavy_keys`` unless given; a short list, so
    it is safe to broadcast) and those without a key, which match nothing, are spread over
    ``salts`` tasks by a hash of the row and its number in its task, so that exact copies
    part as well. The right rows of heavy keys are repeated per salt. All other keys join as usual. ``how`` is
    inner, left, left_semi or left_anti.

    Finding heavy keys reads the key column of ``left`` once more, without shuffling it: pass a
    stored table where ``left`` is costly to compute, or the keys where they are known.
    """
    heavy = heavy_keys(left, on, heavy_rows) if heavy is None else heavy
    flagged = F.broadcast(heavy.select(on, F.lit(True).alias("_heavy")))
    is_heavy = F.coalesce(F.col("_heavy"), F.lit(False))
    hashable = [F.col(f.name) for f in left.schema.fields if f.dataType.typeName() not in ("variant", "map")]
    salted_left = left.join(flagged, on, "left").select(
        *left.columns,
        F.when(is_heavy | F.col(on).isNull(), F.pmod(F.xxhash64(*hashable, F.monotonically_increasing_id()), F.lit(salts)).cast("int")).otherwise(0).alias("_salt"),
    )
    every_salt = F.sequence(F.lit(0), F.lit(salts - 1))
    salted_right = right.join(flagged, on, "left").select(
        *right.columns, F.explode(F.when(is_heavy, every_salt).otherwise(F.array(F.lit(0)))).alias("_salt")
    )
    return salted_left.join(salted_right, [on, "_salt"], how).drop("_salt")
