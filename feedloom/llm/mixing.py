"""Mixing sources to target weights by entropy balancing. Built-in functions only.

Sources (code-point order, null last) weigh 1, 2, 3, repeating, and share 100 % of all words;
a target stops at ``MAX_COPIES`` times its source's words and the excess is shared again.

The rates closest to 1 in relative entropy, at most ``MAX_COPIES``, that meet a source's token
constraint are ``min(MAX_COPIES, exp(tilt * size / mean size))``. The tilts solve the convex
dual: a Newton step for all sources at once is one aggregate over (source, size) counts, kept
inside a bracket. The rates are then rounded into whole copies: a document takes its rate's
whole part, and one more where its fraction exceeds a fixed hash by more than the source's
threshold; a last document per source takes one more copy where that brings the sum closer.

Defined cases: a null text has size 0 and takes no words; an empty table gives an empty
result; equal rows are mixed row by row; a null id or source is a value like others; ties go
by hash, id and row. A window over the sources (one row each) ranks them. Further columns are
ignored, or carried along inside one struct, so clashing names do no harm.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.llm.inputs import table, words
from feedloom.session import materialize

MAX_COPIES = 3
BINS = 4096
TOLERANCE = 1e-10
MAX_STEPS = 60


def source_targets(totals: DataFrame) -> DataFrame:
    """``totals`` (source, source_size, ...) with ``sid`` and ``target``.

    With sources in the order of their cap per weight, the level of those not capped is the
    largest of (rest of all words) / (rest of the weights), each taken after so many caps.
    """
    ranked = totals.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weighed = ranked.withColumn("weight", F.col("sid") % 3 + 1)
    cap = F.col("source_size") * MAX_COPIES
    order = Window.orderBy(cap / F.col("weight"), "sid")
    capped = F.coalesce(F.sum(cap).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.partitionBy()
    return (
        weighed.withColumn("level", (F.sum("source_size").over(everything) - capped) / rest)
        .withColumn("level", F.max("level").over(everything))
        .withColumn("target", F.least(cap.cast("double"), F.col("weight") * F.col("level")))
        .drop("level")
    )


def tilts(counts: DataFrame, targets: DataFrame) -> DataFrame:
    """Newton iterations: ``targets`` with the ``tilt`` of every source that is not capped.

    ``counts`` has sid, size, n. Without a tilt (null) a source takes every document
    ``MAX_COPIES`` times.
    """
    free = (F.col("source_size") > 0) & (F.col("target") < F.col("source_size") * MAX_COPIES)
    # One row a source: one partition, whatever the session's number.
    state = materialize(
        targets.coalesce(1).withColumn("mean", F.col("source_size") / F.col("n_docs"))
        .withColumn("tilt", F.when(free, F.lit(0.0)))
        .withColumn("low", -50 * F.col("mean") / F.col("min_size"))
        .withColumn("high", math.log(MAX_COPIES) * F.col("mean") / F.col("min_size")),
        "mixing-tilts",
    )
    x = F.col("size") / F.col("mean")
    rate = F.least(F.lit(float(MAX_COPIES)), F.exp(F.col("tilt") * x))
    mass = F.col("n") * F.col("size") * rate
    slope = F.when(rate < MAX_COPIES, mass * x).otherwise(0.0)
    for _ in range(MAX_STEPS):
        sums = (
            counts.join(state.select("sid", "mean", "tilt"), "sid")
            .where("tilt IS NOT NULL")
            .groupBy("sid")
            .agg(F.sum(mass).alias("mass"), F.sum(slope).alias("slope"))
        )
        gap = F.log(F.col("mass") / F.col("target"))
        newton = F.col("tilt") - gap * F.col("mass") / F.nullif(F.col("slope"), F.lit(0.0))
        inside = (newton > F.col("low")) & (newton < F.col("high"))
        step = F.when(inside, newton).otherwise((F.col("low") + F.col("high")) / 2)
        moved = state.join(sums, "sid", "left").withColumn("gap", gap)
        moved = moved.withColumn("low", F.when(F.col("gap") < 0, F.col("tilt")).otherwise(F.col("low"))).withColumn(
            "high", F.when(F.col("gap") > 0, F.col("tilt")).otherwise(F.col("high"))
        )
        done = F.col("gap").isNull() | (F.abs("gap") <= TOLERANCE)
        moved = moved.withColumn("tilt", F.when(done, F.col("tilt")).otherwise(step)).coalesce(1)
        moved = materialize(moved, "mixing-tilts")
        state = moved.drop("mass", "slope", "gap")
        if moved.where(F.abs("gap") > TOLERANCE).isEmpty():
            return state
    raise RuntimeError(f"the weights were not found in {MAX_STEPS} steps")


def mix(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``own`` (a struct of the ``keep`` columns), size, source_size, target, rate, copies, taken."""
    sized = materialize(
        docs.select(
            F.struct(*keep).alias("own"),
            "source",
            F.col("doc_id").alias("id"),
            F.size(words(F.col("text"))).cast("long").alias("size"),
            F.xxhash64("doc_id", "text").alias("hash"),
        ).withColumn("row", F.monotonically_increasing_id()),
        "mixing-sizes",
    )
    counts = sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")).where("size > 0 OR n > 0")
    counts = materialize(counts, "mixing-counts")
    totals = counts.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"),
        F.sum("n").alias("n_docs"),
        F.min(F.when(F.col("size") > 0, F.col("size"))).alias("min_size"),
    )
    targets = materialize(source_targets(totals).coalesce(1), "mixing-targets")
    same_source = F.col("source").eqNullSafe(F.col("of_source"))
    named = targets.select(F.col("source").alias("of_source"), "sid")
    keyed = counts.where("size > 0").join(named, same_source).select("sid", "size", "n")
    solved = tilts(materialize(keyed, "mixing-keyed"), targets).withColumnRenamed("source", "of_source")

    exact = F.least(F.lit(float(MAX_COPIES)), F.exp(F.col("tilt") * F.col("size") / F.col("mean")))
    uniform = (F.pmod("hash", F.lit(1 << 30)) + 0.5) / (1 << 30)
    whole = F.floor("rate")
    rated = (
        sized.join(solved.select("of_source", "sid", "source_size", "target", "tilt", "mean"), same_source)
        .withColumn("rate", F.when(F.col("size") == 0, 0.0).otherwise(F.coalesce(exact, F.lit(float(MAX_COPIES)))))
        .withColumn("lead", F.col("rate") - whole - uniform)
        .withColumn("bin", F.floor((1 - F.col("lead")) / 2 * BINS).cast("int"))
        .withColumn("may_grow", (F.col("size") > 0) & (F.col("rate") < MAX_COPIES))
    )
    # Threshold of each source: all bins whose sum stays within what the whole parts leave.
    left = rated.groupBy("sid").agg((F.first("target") - F.sum(whole * F.col("size"))).alias("left"))
    by_bin = rated.where("may_grow").groupBy("sid", "bin").agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(Window.partitionBy("sid").orderBy("bin"))
    fits = by_bin.withColumn("upto", upto).join(left, "sid").where(F.col("upto") <= F.col("left"))
    cut = fits.groupBy("sid").agg(F.max("bin").alias("cut"), F.max("upto").alias("upto"))
    cut = materialize(
        left.join(cut, "sid", "left").select(
            "sid", F.coalesce("cut", F.lit(-1)).alias("cut"), (F.col("left") - F.coalesce("upto", F.lit(0))).alias("gap")
        ).coalesce(1),
        "mixing-cuts",
    )
    rounded = rated.join(cut, "sid").withColumn(
        "copies", (whole + (F.col("may_grow") & (F.col("bin") <= F.col("cut"))).cast("int")).cast("int")
    )
    spare = rounded.where(F.col("may_grow") & (F.col("bin") > F.col("cut")))
    distance = F.abs(F.col("size") - F.col("gap"))
    last = spare.where(distance < F.col("gap")).groupBy("sid").agg(
        F.min(F.struct(distance.alias("distance"), "hash", "id", "row")).alias("best")
    )
    last = last.select(F.col("sid").alias("last_sid"), F.col("best.row").alias("last_row")).coalesce(1)
    last = materialize(last, "mixing-last")
    one_more = (F.col("row") == F.col("last_row")).cast("int")
    return (
        rounded.join(last, F.col("sid") == F.col("last_sid"), "left")
        .withColumn("copies", F.col("copies") + F.coalesce(one_more, F.lit(0)))
        .select(
            "own", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken")
        )
    )


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"), ["doc_id"])
    return mixed.select("own.doc_id", "size", "source_size", "target", "taken", "rate")
