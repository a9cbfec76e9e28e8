"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Statistics of the whole text are standardized and mapped to ``FEATURES`` random Fourier
features of a Gaussian kernel (fixed seed). Every task sums the normal equations of its rows;
the sums, of fixed size, are added and solved. The ridge scores of rows kept back are binned
and made monotone by pooling adjacent violators, which gives probabilities.

Labels are learnt from rows whose crc32(doc_id as text) mod 4 is not ``HELD_OUT``: remainder
``CALIBRATES`` calibrates, the others fit. Labels, language, source and id are never inputs.

Defined cases: a null or empty text has statistics of 0; a null id counts as the text '' in
the split and is never labelled; a document labelled twice takes the larger label; without
rows to fit or to calibrate the score is 0.5; repeated rows are scored row by row; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.inputs import table, words
from feedloom.llm.quality_rules import base_counts
from feedloom.session import materialize

FEATURES = 256
RIDGE = 1e-4
SEED = 11
HELD_OUT, CALIBRATES = 2, 3
MIN_SCORE = 0.7
BIN = 1e-3


def _share(part: Column, of: Column) -> Column:
    return F.when(of > 0, part / of).otherwise(0.0)


def statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and ``x``: an array of statistics of the text."""
    text = F.coalesce("text", F.lit(""))
    marks = docs.select(
        *keep,
        "text",
        F.regexp_count(text, F.lit(r"\p{Lu}")).alias("upper"),
        F.regexp_count(text, F.lit(r"\p{N}")).alias("digits"),
        F.regexp_count(text, F.lit(r"[^\p{L}\p{N}\s]")).alias("signs"),
        F.size(F.array_distinct(words(text))).alias("distinct_words"),
        F.regexp_count(text, F.lit("\n")).alias("breaks"),
    )
    counted = base_counts(marks, "text", [*keep, "upper", "digits", "signs", "distinct_words", "breaks"])
    n, chars = F.col("n_words"), F.col("word_chars")
    x = F.array(
        F.log1p(n),
        _share(chars, n),
        _share(F.col("upper"), chars),
        _share(F.col("digits"), chars),
        _share(F.col("signs"), chars),
        _share(F.col("n_symbols"), chars),
        _share(F.col("distinct_words"), n),
        _share(F.col("n_repeat_words"), n),
        _share(F.col("n_dup_lines"), F.col("breaks") + 1),
        _share(F.col("breaks"), n),
    )
    return counted.select(*keep, F.transform(x, lambda v: v.cast("double")).alias("x"))


class Fourier:
    """Random Fourier features of standardized statistics, with a constant as the last one."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray) -> None:
        draw = np.random.default_rng(SEED)
        self.mean, self.scale = mean, scale
        self.weights = draw.normal(0, 1 / np.sqrt(len(mean)), (len(mean), FEATURES))
        self.phase = draw.uniform(0, 2 * np.pi, FEATURES)

    def __call__(self, x: pd.Series) -> np.ndarray:
        rows = np.clip((np.vstack(x.to_numpy()) - self.mean) / self.scale, -8, 8)
        out = np.sqrt(2 / FEATURES) * np.cos(rows @ self.weights + self.phase)
        return np.hstack([out, np.ones((len(out), 1))])


def fit_fourier(rows: DataFrame) -> Fourier | None:
    """Means and deviations of the rows' statistics; None without rows."""
    per = rows.select(F.posexplode("x").alias("k", "v")).groupBy("k")
    found = per.agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("scale")).orderBy("k").collect()
    if not found:
        return None
    scale = np.array([r["scale"] for r in found])
    return Fourier(np.array([r["mean"] for r in found]), np.where(scale > 1e-12, scale, 1.0))


def fit_ridge(rows: DataFrame, fourier: Fourier) -> np.ndarray:
    """Weights from the normal equations, summed per task and then over tasks."""

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for batch in batches:
            if len(batch):
                z = fourier(batch["x"])
                total += z.T @ np.hstack([z, batch["label"].to_numpy(dtype=float)[:, None]])
        yield pd.DataFrame({"i": np.arange(len(total)), "sums": list(total)})

    def added(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": part["i"].iloc[:1], "sums": [np.vstack(part["sums"].to_numpy()).sum(axis=0)]})

    schema = "i int, sums array<double>"
    parts = rows.select("x", "label").mapInPandas(summed, schema).groupBy("i").applyInPandas(added, schema)
    total = np.array([r["sums"] for r in parts.orderBy("i").collect()])
    n = total[-1, -2]
    ridge = RIDGE * max(n, 1) * np.eye(FEATURES + 1)
    ridge[-1, -1] = 0
    return np.linalg.solve(total[:, :-1] + ridge, total[:, -1])


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: mean score and probability of each block, both ascending."""
    blocks: list[list[float]] = []
    for a, b, w in zip(x, y, weight, strict=True):
        blocks.append([a * w, b * w, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last, strict=True)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def score_quality(docs: DataFrame, labels: DataFrame, keep: list[str]) -> DataFrame:
    """``own`` (the ``keep`` columns), ``held_out`` and ``score`` of every document."""
    part = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4
    own = docs.select(F.struct(*keep).alias("own"), F.col("doc_id").alias("id"), part.alias("part"), "text")
    all_rows = materialize(statistics(own, ["own", "id", "part"]), "quality-statistics")
    known = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy(F.col("doc_id").alias("id"))
        .agg(F.max("quality").alias("label"))
    )
    train = materialize(all_rows.where(F.col("part") != HELD_OUT).select("id", "part", "x").join(known, "id"), "quality-train")
    fit, calibrate = train.where(F.col("part") != CALIBRATES), train.where(F.col("part") == CALIBRATES)
    held_out = (F.col("part") == HELD_OUT).alias("held_out")
    fourier = fit_fourier(fit)
    if fourier is None or not calibrate.limit(1).count():
        return all_rows.select("own", held_out, F.lit(0.5).alias("score"))
    weights = fit_ridge(fit, fourier)

    @F.pandas_udf("double")
    def ridge_score(x: pd.Series) -> pd.Series:
        return pd.Series(fourier(x) @ weights) if len(x) else pd.Series(dtype=float)

    binned = F.round(F.least(F.greatest(ridge_score("x"), F.lit(-1.0)), F.lit(2.0)) / BIN)
    bins = calibrate.groupBy(binned.alias("bin")).agg(F.avg("label").alias("y"), F.count("label").alias("n"))
    found = bins.orderBy("bin").collect()  # 3001 rows at most
    at, probability = isotonic(*(np.array([float(r[c]) for r in found]) for c in ("bin", "y", "n")))

    @F.pandas_udf("double")
    def calibrated(raw: pd.Series) -> pd.Series:
        return pd.Series(np.interp(raw.to_numpy() / BIN, at, probability))

    return all_rows.select("own", held_out, calibrated(ridge_score("x")).alias("score"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score_quality(docs.select("doc_id", "text"), labels, ["doc_id"])
    return scored.select("own.doc_id", "held_out", "score", (F.col("score") >= MIN_SCORE).cast("int").alias("predicted"))
