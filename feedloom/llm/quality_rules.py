"""Quality rules: base counts, then a hashed n-gram log-likelihood ratio. Built-in functions only.

Tokens are runs of letters and digits, and runs of other signs; unigrams and bigrams of tokens
are hashed into ``BUCKETS``. One multinomial counts the n-grams of all documents, the other
those of trusted documents; a Dirichlet prior of ``PRIOR`` n-grams with the corpus' own
distribution smooths the second, so with few trusted texts the ratio tends to 0. A document's
ratio is the mean over its n-grams, which makes it independent of its length, and documents
under ``MIN_RATIO`` are rejected. The verdict depends on counts alone, never on a draw.

Both models count every document. The ids of trusted documents are broadcast if they are few,
else they meet the texts in a join that spreads ids with very many rows.

Defined cases: a null or empty text has no words and fails the base rule; without trusted
documents every ratio is 0; a null id is scored but never trusted; ties and repeated rows are
scored row by row; an empty table gives an empty result; further columns are ignored
(``judge`` carries them along).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.inputs import table, words
from feedloom.operators.columns import computed_once
from feedloom.operators.joins import join_small

BUCKETS = 1 << 16
PRIOR = 1 << 16
MIN_RATIO = -0.12
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
# The signs counted as symbols.
SYMBOLS = "#*$%&|<>"
TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"
BLANK_SIGNS = " \t\n\x0b\x0c\r"


def base_counts(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (all long)."""
    own = F.struct(*keep).alias("kept_columns")
    split = docs.select(own, words(F.col(text)).alias("words"), F.col(text).alias("text"))
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(BLANK_SIGNS)) != "")
    # `words` stands three times in the window's expression: the optimizer keeps it a column.
    windows = F.transform("words", lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)))
    parts = split.select(
        "kept_columns",
        F.size("words").alias("n"),
        F.array_join("words", "").alias("signs"),
        lines.alias("lines"),
        F.slice(windows, F.lit(1), F.greatest(F.size("words") - 2, F.lit(0))).alias("windows"),
    )
    numbered = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    empty = F.lit(None).cast("array<struct<h:bigint,i:int>>")
    sorted_parts = parts.withColumn("sorted", F.when(repeats, numbered).otherwise(empty))

    def twice(x: Column, k: Column) -> Column:
        same_before = F.coalesce(F.get("sorted", k - 1)["h"] == x["h"], F.lit(False))
        return same_before | F.coalesce(F.get("sorted", k + 1)["h"] == x["h"], F.lit(False))

    places = F.sort_array(F.transform(F.filter("sorted", twice), lambda x: x["i"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("sum")),
        lambda acc, p: F.struct(
            p.alias("last"), (acc["sum"] + F.least(F.lit(3), p - acc["last"]).cast("long")).alias("sum")
        ),
        lambda acc: acc["sum"],
    )
    plain = F.col("signs")
    for sign in SYMBOLS:
        plain = F.replace(plain, F.lit(sign), F.lit(""))
    return sorted_parts.select(
        "kept_columns.*",
        F.col("n").cast("long").alias("n_words"),
        F.char_length("signs").cast("long").alias("word_chars"),
        (F.char_length("signs") - F.char_length(plain)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"),
    )


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))


def bucket(*ngram: Column) -> Column:
    return F.pmod(F.xxhash64(*ngram), F.lit(BUCKETS).cast("long")).cast("int")


def ratio_table(docs: DataFrame, trusted: DataFrame) -> list[float]:
    """Log ratio of the trusted to the corpus multinomial for every bucket (a list of fixed size)."""
    ids = trusted.select("doc_id").where("doc_id IS NOT NULL").distinct().withColumn("trusted", F.lit(1))
    flagged = join_small(docs.select("doc_id", "text"), ids, "doc_id", "left")
    flagged = flagged.select(tokens(F.col("text")).alias("tokens"), "trusted")
    following = F.slice("tokens", F.lit(2), F.greatest(F.size("tokens") - 1, F.lit(0)))
    pairs = flagged.select(F.explode(F.arrays_zip("tokens", following.alias("next"))).alias("at"), "trusted")
    first, second = F.col("at")["tokens"], F.col("at")["next"]
    both = F.array(bucket(first), F.when(second.isNotNull(), bucket(first, second)))
    counts = (
        pairs.select(F.explode(both).alias("bucket"), "trusted")
        .where("bucket IS NOT NULL")
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("n"), F.count("trusted").alias("t"))
        .collect()
    )
    n_all, n_trusted = sum(r["n"] for r in counts), sum(r["t"] for r in counts)
    ratios = [0.0] * BUCKETS
    for r in counts:
        share = r["n"] / n_all
        ratios[r["bucket"]] = math.log((r["t"] + PRIOR * share) / (n_trusted + PRIOR) / share)
    return ratios


def with_ratio(docs: DataFrame, ratios: list[float], keep: list[str]) -> DataFrame:
    """``keep`` and ``ratio``, the mean log ratio over a text's n-grams.

    The ratios are one constant of the plan. `tokens` is used several times, so the optimizer
    keeps it a column.
    """
    constant = F.from_json(F.lit("[" + ",".join(map(repr, ratios)) + "]"), "array<double>")
    cut = docs.select(*keep, tokens(F.col("text")).alias("tokens"))

    def at(token: Column, i: Column) -> Column:
        later = F.get("tokens", i + 1)
        pair = F.when(later.isNotNull(), F.get(constant, bucket(token, later))).otherwise(0.0)
        return F.get(constant, bucket(token)) + pair

    total = F.aggregate(F.transform("tokens", at), F.lit(0.0), lambda acc, x: acc + x)
    n = F.size("tokens")
    return cut.select(*keep, F.when(n > 0, total / (2 * n - 1)).otherwise(0.0).alias("ratio"))


def judge(docs: DataFrame, trusted: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns of every document, its counts, ``ratio``, ``base_failed`` and ``kept``.

    ``trusted`` lists the ``doc_id`` of trusted documents.
    """
    own = docs.select(F.struct(*keep).alias("own"), "text")
    scored = with_ratio(own, ratio_table(docs, trusted), ["own", "text"])
    counted = base_counts(scored, "text", ["own", "ratio"])
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    # Behind a generator: else a filter on the verdict copies the counts' expressions below the
    # columns they build on, and evaluates those once an array element.
    kept = ~failed & (F.col("ratio") >= MIN_RATIO)
    return computed_once(counted, base_failed=failed, kept=kept)


def trusted_ids(labels: DataFrame) -> DataFrame:
    return labels.where(F.col("quality") == 1).select("doc_id")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    judged = judge(docs.select("doc_id", "text"), trusted_ids(labels), ["doc_id"])
    return judged.select(
        "own.doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "ratio",
    )
