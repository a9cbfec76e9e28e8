"""Toxicity with a classifier chain.

The categories stand in a fixed order. The linear model of each reads which selected terms (words
and four-letter word starts) the whole text has, and the probabilities of all earlier
categories. In training, those probabilities come out of fold: a row's are predicted by models
that did not see it; in scoring they come from the models of all training rows.

Models are fitted on at most ``TRAIN_ROWS`` labelled documents (smallest hash of the id), a
documented bound; of repeated rows of an id one is used. Spark counts their terms; the ``FEATURES`` terms that tell each category best
(chi-squared, ties by term) are kept, so what is fitted has a fixed size. Every document is
scored, over its whole text.

Defined cases: a null or empty text has no terms and gets the intercepts' probabilities;
without labelled rows all probabilities are 0; a category with one class in training predicts
that class; labels that are null or of unknown documents are not used; a document labelled
twice takes the larger label; repeated rows are scored row by row; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.inputs import table
from feedloom.session import materialize

TRAIN_ROWS = 10_000
FEATURES = 256
MIN_ROWS = 3
FOLDS = 3
STEM = 4
RIDGE = 1.0
STEPS = 25
MIN_PROBABILITY = 0.5
# Words that name a category within the rows labelled toxic.
CATEGORY_WORDS = {
    "insult": ("clown", "idiot", "loser", "moron", "stupid"),
    "contempt": ("disgusting", "pathetic", "scum", "trash", "worthless"),
}
CATEGORIES = (*CATEGORY_WORDS, "toxic")


def terms(text: Column) -> Column:
    """Distinct words of a text in lower case, and their starts marked with ``-``."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"\p{L}+"), F.lit(0)))
    starts = F.transform(words, lambda w: F.concat(F.substring(w, 1, STEM), F.lit("-")))
    return F.concat(words, F.array_distinct(starts))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Training rows: terms, fold and a 0/1 column per category, of at most ``TRAIN_ROWS`` labels."""
    chosen = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy(F.col("doc_id").alias("labelled_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("labelled_id"), "labelled_id")
        .limit(TRAIN_ROWS)
    )
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled_id"))
    # One row an id, however often the table repeats it, so that the bound holds for rows as well.
    text = F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    rows = found.groupBy("doc_id", "toxic").agg(text)
    for name, listed in CATEGORY_WORDS.items():
        found = F.lower("text").rlike(rf"\b({'|'.join(listed)})\b")
        rows = rows.withColumn(name, (F.coalesce(found, F.lit(False)) & (F.col("toxic") > 0)).cast("int"))
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int")
    return rows.select(terms(F.col("text")).alias("terms"), fold.alias("fold"), *CATEGORIES)


def select_terms(train: DataFrame, rows: int) -> list[str]:
    """The terms that tell each category best."""
    sums = [F.sum(name).alias(name) for name in CATEGORIES]
    total = train.agg(*sums).first()
    counts = train.select(F.explode("terms").alias("term"), *CATEGORIES).groupBy("term")
    counts = materialize(counts.agg(F.count(F.lit(1)).alias("n"), *sums).where(F.col("n") >= MIN_ROWS), "toxicity-terms")
    chosen: dict[str, None] = {}
    for name in CATEGORIES:
        share = total[name] / rows
        if 0 < share < 1:
            gap = F.col(name) - F.col("n") * share
            score = gap * gap / (F.col("n") * share * (1 - share) * (1 - F.col("n") / (rows + 1)))
            best = counts.orderBy(score.desc(), "term").limit(FEATURES).select("term").collect()
            chosen.update(dict.fromkeys(r["term"] for r in best))
    return list(chosen)


def fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge-penalized logistic regression by Newton steps; the last weight is the intercept."""
    x = np.hstack([x, np.ones((len(x), 1))])
    weights = np.zeros(x.shape[1])
    if y.min() == y.max():
        weights[-1] = np.inf if y.min() else -np.inf
        return weights
    penalty = np.full(x.shape[1], RIDGE)
    penalty[-1] = 1e-6
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, x.T @ (y - p) - penalty * weights)
        weights = weights + step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def predict(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    if np.isinf(weights[-1]):
        return np.full(len(x), float(weights[-1] > 0))
    return 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -700, 700)))


def fit_chain(x: np.ndarray, labels: dict[str, np.ndarray], fold: np.ndarray) -> list[np.ndarray]:
    """A model per category, in order, each fed with the out-of-fold probabilities of those before."""
    models = []
    for y in labels.values():
        models.append(fit_logistic(x, y))
        outside = np.zeros(len(y))
        for k in np.unique(fold):
            inside = fold == k
            if not inside.all():
                outside[inside] = predict(x[inside], fit_logistic(x[~inside], y[~inside]))
        x = np.hstack([x, outside[:, None]])
    return models


def matrix(hits: pd.Series, place: dict[str, int]) -> np.ndarray:
    out = np.zeros((len(hits), len(place)))
    for k, found in enumerate(hits):
        out[k, [place[term] for term in found]] = 1
    return out


def score_toxicity(docs: DataFrame, labels: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns of every document, and a probability per category in ``p_`` columns."""
    train = materialize(labelled(docs, labels), "toxicity-train")
    own = docs.select(F.struct(*keep).alias("own"), "text")
    rows = train.count()
    if not rows:
        return own.select("own", *(F.lit(0.0).alias(f"p_{name}") for name in CATEGORIES))
    chosen = select_terms(train, rows)
    place = {term: k for k, term in enumerate(chosen)}
    listed = F.array(*map(F.lit, chosen)).cast("array<string>")
    hits = F.array_intersect("terms", listed)
    sample = train.select(hits.alias("hits"), "fold", *CATEGORIES).toArrow().to_pandas()  # TRAIN_ROWS at most
    answers = {name: sample[name].to_numpy(dtype=float) for name in CATEGORIES}
    models = fit_chain(matrix(sample["hits"], place), answers, sample["fold"].to_numpy())

    @F.pandas_udf(", ".join(f"p_{name} double" for name in CATEGORIES))
    def chain(found: pd.Series) -> pd.DataFrame:
        x, out = matrix(found, place), {}
        for name, weights in zip(CATEGORIES, models, strict=True):
            out[f"p_{name}"] = predict(x, weights)
            x = np.hstack([x, out[f"p_{name}"][:, None]])
        return pd.DataFrame(out)

    found = own.select("own", terms(F.col("text")).alias("terms")).select("own", chain(hits).alias("p"))
    return found.select("own", "p.*")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score_toxicity(docs.select("doc_id", "text"), labels, ["doc_id"])
    probabilities = [F.col(f"p_{name}") for name in CATEGORIES]
    return scored.select("own.doc_id", *probabilities, (F.col("p_toxic") >= MIN_PROBABILITY).alias("toxic"))
