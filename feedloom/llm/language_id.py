"""Language identification: multinomial naive Bayes over hashed character n-grams.

An n-gram is a run of one to three characters of the lower-cased text. Whatever is no letter
counts as a space, which may stand at the end of an n-gram, never inside one, so n-grams reach
to the borders of words and not across them; a text has a space before and after it. N-grams are
hashed into ``BUCKETS``.

Every task counts the n-grams of its training rows per language, and Spark adds the counts. The
matrix of log probabilities (buckets by languages, smoothed by ``SMOOTHING``) is broadcast. Its
size is bounded: more than ``MAX_LANGUAGES`` language values raise. A batch is scored as the
product of its sparse n-gram rows with that matrix: the matrix' rows of all n-grams are added
up per text. The score is the posterior probability of the predicted language.

Texts are worked through in pieces of ``PIECE`` characters that overlap by what an n-gram
needs, so very long texts give the same sums as in one piece.

Defined cases: a null text, or one without letters, is ``und`` with score 0; without training
rows every text is; a null id counts as the text '' in the split; of two languages as likely the
smaller value is taken; repeated rows count and are predicted row by row; training rows
without letters count for how frequent their language is; an empty table gives an empty
result; further columns are ignored, or carried along inside one struct.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.inputs import table
from feedloom.session import materialize

ORDERS = (1, 2, 3)
BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
SMOOTHING = 0.5
MAX_LANGUAGES = 128
HELD_OUT, FOLDS = 0, 5
UNKNOWN = "und"
PIECE = 200_000
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_SPACE = 32


@cache
def _letters() -> np.ndarray:
    """Which code points are letters; made once per worker."""
    return np.array([chr(c).isalpha() for c in range(sys.maxunicode + 1)])


def pieces(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Texts in lower case with a space at both ends, in groups of about ``PIECE`` characters.

    A longer text is cut into pieces that overlap by the longest n-gram less one.
    """
    owners, group, held = [], [], 0
    for k, text in enumerate(texts):
        padded = f" {(text or '').lower()} "
        for at in range(0, len(padded), PIECE):
            piece = padded[at : at + PIECE + max(ORDERS) - 1]
            if group and held + len(piece) > PIECE:
                yield owners, group
                owners, group, held = [], [], 0
            owners.append(k)
            group.append(piece)
            held += len(piece)
    if group:
        yield owners, group


def ngrams(owners: list[int], group: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of the n-grams of one group of pieces and the texts they stand in, per order."""
    code = np.frombuffer("".join(group).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes = np.array([len(piece) for piece in group])
    piece = np.repeat(np.arange(len(group)), sizes)
    starts = np.arange(len(code)) - np.repeat(np.cumsum(sizes) - sizes, sizes) < PIECE
    letter = _letters()[code]
    sign = np.where(letter, code, _SPACE).astype(np.uint64)
    owner = np.array(owners)[piece]
    for order in ORDERS:
        n = len(code) - order + 1
        if n <= 0:
            return
        key = np.zeros(n, dtype=np.uint64)
        for k in range(order):
            key |= sign[k : k + n] << np.uint64(21 * k)
        inner = [letter[k : k + n] for k in range(1, order - 1)]
        usable = starts[:n] & (piece[:n] == piece[order - 1 :])
        usable &= (letter[:n] | letter[order - 1 :]) if order < 3 else np.logical_and.reduce(inner)
        bucket = ((key[usable] + np.uint64(order)) * _SPREAD) >> np.uint64(64 - BUCKET_BITS)
        yield bucket.astype(np.int64), owner[:n][usable]


def split_part(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def count_ngrams(train: DataFrame) -> pa.Table:
    """``lang``, ``bucket`` and ``n`` of ``train`` (lang, text); bucket -1 counts the rows."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in langs:
                if lang not in totals:
                    if len(totals) == MAX_LANGUAGES:
                        raise ValueError(f"more than {MAX_LANGUAGES} languages")
                    totals[lang] = np.zeros(BUCKETS + 1, dtype=np.int64)
                totals[lang][-1] += 1
            names = list(totals)
            place = {lang: k for k, lang in enumerate(names)}
            of_text = np.array([place[lang] for lang in langs])
            for owners, group in pieces(texts):
                for bucket, owner in ngrams(owners, group):
                    lang = of_text[owner]
                    for k in np.unique(lang):
                        totals[names[k]][:-1] += np.bincount(bucket[lang == k], minlength=BUCKETS)
        for lang, total in totals.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang] * len(used), pa.string()),
                    "bucket": pa.array(np.where(used == BUCKETS, -1, used), pa.int32()),
                    "n": pa.array(total[used]),
                }
            )

    counts = train.select("lang", "text").mapInArrow(counted, "lang string, bucket int, n long")
    summed = materialize(counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "language-counts")
    # Before the counts come to the driver: one row for each language.
    if summed.where("bucket = -1").limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return summed.toArrow()


class Model:
    """Languages in order, their log priors and the log probabilities of all buckets."""

    def __init__(self, counts: pa.Table) -> None:
        langs = np.array(counts.column("lang").to_pylist(), dtype=object)
        bucket, n = counts.column("bucket").to_numpy(), counts.column("n").to_numpy()
        self.langs = sorted(set(langs))
        row = np.searchsorted(np.array(self.langs, dtype=object), langs) if self.langs else np.zeros(0, dtype=np.int64)
        rows, grams = np.zeros(len(self.langs)), np.zeros((BUCKETS, len(self.langs)))
        rows[row[bucket < 0]] = n[bucket < 0]
        grams[bucket[bucket >= 0], row[bucket >= 0]] = n[bucket >= 0]
        self.prior = np.log(rows / max(1, rows.sum())) if self.langs else rows
        self.matrix = np.log((grams + SMOOTHING) / (grams.sum(axis=0) + SMOOTHING * BUCKETS))

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        sums = np.zeros((len(texts), len(self.langs)))
        found = np.zeros(len(texts), dtype=bool)
        for owners, group in pieces(texts):
            for bucket, owner in ngrams(owners, group):
                if len(bucket):
                    first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
                    found[owner[first]] = True
                    sums[owner[first]] += np.add.reduceat(self.matrix[bucket], first, axis=0)
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        sums += self.prior
        best = sums.argmax(axis=1)
        top = sums[np.arange(len(texts)), best]
        score = np.where(found, 1 / np.exp(sums - top[:, None]).sum(axis=1), 0.0)
        return [self.langs[k] if f else UNKNOWN for k, f in zip(best, found, strict=True)], score


def identify(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``own`` (a struct of the ``keep`` columns), ``held_out``, ``lang_pred`` and ``score`` of all ``docs``
    (doc_id, text, lang), learnt from those that are not held out and have a language."""
    held_out = split_part(F.col("doc_id")) == HELD_OUT
    model = Model(count_ngrams(docs.where(~held_out & F.col("lang").isNotNull())))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, score = shared.value.predict(batch.column(2).to_pylist())
            columns = [*batch.columns[:2], pa.array(langs, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["own", "held_out", "lang_pred", "score"])

    carried = docs.select(F.struct(*keep).alias("own"), held_out.alias("held_out"), "text")
    own = carried.schema["own"].dataType.simpleString()
    return carried.mapInArrow(predicted, f"own {own}, held_out boolean, lang_pred string, score double")


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs, ["doc_id"]).select("own.doc_id", "held_out", "lang_pred", "score")
