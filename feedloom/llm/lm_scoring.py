"""LM scoring by cross-entropy difference.

Two bigram models share one vocabulary (all words of the target, all others one unknown word)
and one smoothing, so only their counts differ: one is counted on target documents, the other on
all documents, scaled to the target's size. Both count every pair of known words; a pair with an
unknown word has no count of its own in either. A bigram's probability is ``WEIGHT`` times its
relative frequency after the first word plus the rest times the unigram's, which counts one more
of every word. A document's loss is the mean of -log2 p over its words; its score is the
background's loss minus the target's, so higher means closer to the target.

Texts are coded once, in chunks of about ``CHUNK_CHARS``. A chunk asks for the counts of its
distinct words and pairs, packed by ranges of their 64-bit hashes; a task adds what all chunks
say of one range and answers each in the same order, so answers carry no keys. Hot words cost one
number a chunk. The number of ranges grows with the words of the corpus, so that a range fits a
task. Only totals reach the driver. Two of 10**9 keys share a hash with a probability of about 0.03.

Defined cases: a null or empty text has no words and losses of 0; without target documents
every word is unknown and the models agree, so scores are 0; a null id is never a target;
repeated rows count and are scored row by row; an empty table gives an empty result; further
columns are ignored, or carried along inside one struct.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.inputs import table
from feedloom.llm.word_hashes import mixed
from feedloom.operators.joins import join_small
from feedloom.session import materialize

VOCABULARY = None  # no limit: every word of the target is known
WEIGHT = 0.5
CHUNK_CHARS = 4_000_000
RANGE_ENTRIES = 2_000_000
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_ZSTD = pa.Codec("zstd", compression_level=1)
CHUNK = "chunk long, tokens array<int>, target array<boolean>, codes binary, words binary"
ASKED = "part int, chunk long, keys binary, near binary, far binary"
ANSWERED = "part int, chunk long, near binary, far binary, sums array<bigint>"
LOSSES = "n_tokens long, target_loss double, background_loss double, score double"


def packed(values: np.ndarray) -> bytes:
    raw = np.ascontiguousarray(values).tobytes()
    return len(raw).to_bytes(8, "little") + (_ZSTD.compress(raw, asbytes=True) if raw else b"")


def unpacked(data: bytes, kind: str) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    return np.frombuffer(_ZSTD.decompress(data[8:], size, asbytes=True) if size else b"", dtype=kind)


def text_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about ``CHUNK_CHARS`` characters. A row is never cut."""
    for batch in batches:
        sizes = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes, dtype=np.int64) // CHUNK_CHARS)) + 1
        for start, end in zip([0, *cuts], [*cuts, len(sizes)], strict=True):
            if end > start:
                yield batch.slice(start, end - start)


def coded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all words, the hash of each code, and the number of words per text."""
    split = [(text or "").lower().split() for text in texts.to_pylist()]
    counts = np.array([len(ws) for ws in split], dtype=np.int32)
    codes, distinct = pd.factorize(np.array([w for ws in split for w in ws], dtype=object))
    hashes = pd.util.hash_array(distinct, categorize=False) if len(distinct) else np.zeros(0, np.uint64)
    return codes.astype(np.int32), hashes, counts


def chunks(docs: DataFrame, chosen: DataFrame, keep: list[str]) -> DataFrame:
    """A row for each run of texts: their ``own`` columns, words, and which of them are targets."""
    flagged = join_small(
        docs.select(F.col("doc_id").alias("id"), F.struct(*keep).alias("own"), "text"), chosen, "id", "left"
    ).select("own", F.coalesce("target", F.lit(False)).alias("target"), "text")
    own = flagged.schema["own"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 33
        for part in text_slices(batches):
            codes, hashes, counts = coded(part.column("text"))
            ends = pa.array([0, part.num_rows], pa.int32())
            columns = [
                pa.ListArray.from_arrays(ends, part.column("own")),
                pa.array([chunk], pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array(counts)),
                pa.ListArray.from_arrays(ends, part.column("target")),
                pa.array([packed(codes)], pa.binary()),
                pa.array([packed(hashes)], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["own", *(c.split()[0] for c in CHUNK.split(", "))])
            chunk += 1

    return flagged.mapInArrow(cut, f"own array<{own}>, {CHUNK}")


class Grams(NamedTuple):
    """Distinct words or pairs of a chunk in the order of their keys."""

    keys: np.ndarray
    near: np.ndarray  # how often targets have them
    far: np.ndarray  # how often all texts have them
    at: np.ndarray  # which one stands at each place of the texts


def _grams(keys: np.ndarray, codes: np.ndarray, target: np.ndarray) -> Grams:
    order = np.argsort(keys)
    place = np.empty(len(keys), dtype=np.int64)
    place[order] = np.arange(len(keys))
    at = place[codes]
    near = np.bincount(at[target], minlength=len(keys))
    return Grams(keys[order], near, np.bincount(at, minlength=len(keys)), at)


def chunk_grams(row: dict) -> tuple[Grams, Grams, np.ndarray, np.ndarray]:
    """Words and pairs of a chunk; the place of each pair's second word, and the words per text."""
    codes, hashes = unpacked(row["codes"], "<i4").astype(np.int64), unpacked(row["words"], "<u8")
    tokens = np.array(row["tokens"], dtype=np.int64)
    target = np.repeat(np.array(row["target"], dtype=bool), tokens)
    words = _grams(mixed(hashes), codes, target)
    follows = np.ones(len(codes), dtype=bool)
    follows[(np.cumsum(tokens) - tokens)[tokens > 0]] = False
    second = np.flatnonzero(follows)
    distinct, pair = np.unique(codes[second - 1] * max(1, len(hashes)) + codes[second], return_inverse=True)
    first_hash, second_hash = hashes[distinct // max(1, len(hashes))], hashes[distinct % max(1, len(hashes))]
    pairs = _grams(mixed(first_hash * _FACTOR + mixed(second_hash)), pair, target[second])
    return words, pairs, second, tokens


def ranges(keys: np.ndarray, bits: int) -> np.ndarray:
    """Borders of the hash ranges in sorted keys."""
    starts = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.concatenate([[0], np.searchsorted(keys, starts), [len(keys)]])


def ask(stored: DataFrame, bits: int) -> DataFrame:
    """What every chunk says of each range; ``part`` is even for words and odd for pairs."""

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words, pairs, _, _ = chunk_grams(row)
                rows = []
                for kind, grams in enumerate((words, pairs)):
                    edges = ranges(grams.keys, bits)
                    for k in np.flatnonzero(np.diff(edges)):
                        own = slice(edges[k], edges[k + 1])
                        steps = np.diff(grams.keys[own], prepend=np.uint64(0))
                        counts = (packed(x[own].astype("<u4")) for x in (grams.near, grams.far))
                        rows.append((2 * int(k) + kind, row["chunk"], packed(steps), *counts))
                columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), *[pa.binary()] * 3), strict=True)] if rows else None
                if columns:
                    yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in ASKED.split(", ")])

    return stored.select("chunk", "tokens", "target", "codes", "words").mapInArrow(asked, ASKED)


def answer(rows: pa.Table) -> pa.Table:
    """Add up one range. Every chunk gets the sums in its own order; a last row has totals: near, far,
    known words, how often all texts have those."""
    keys = [np.cumsum(unpacked(x, "<u8"), dtype=np.uint64) for x in rows.column("keys").to_pylist()]
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    near, far = (
        np.bincount(at, weights=np.concatenate([unpacked(x, "<u4") for x in rows.column(c).to_pylist()])).astype(np.int64)
        for c in ("near", "far")
    )
    ends = np.cumsum([len(k) for k in keys])
    own = [at[end - len(k) : end] for k, end in zip(keys, ends, strict=True)]
    part = rows.column("part")[0].as_py()
    sums = [int(near.sum()), int(far.sum()), int((near > 0).sum()), int(far[near > 0].sum())]
    return pa.table(
        {
            "part": pa.array([part] * (len(own) + 1), pa.int32()),
            "chunk": pa.array([*rows.column("chunk").to_pylist(), None], pa.int64()),
            "near": pa.array([*(packed(near[x]) for x in own), None], pa.binary()),
            "far": pa.array([*(packed(far[x]) for x in own), None], pa.binary()),
            "sums": pa.array([[]] * len(own) + [sums], pa.list_(pa.int64())),
        }
    )


def answers(stored: DataFrame, bits: int) -> DataFrame:
    """Sums for every chunk and range, each range added up in one task."""
    return ask(stored, bits).groupBy("part").applyInArrow(answer, ANSWERED)


def losses(
    row: dict, near: tuple[np.ndarray, np.ndarray], far: tuple[np.ndarray, np.ndarray], sums: list[int]
) -> tuple[np.ndarray, list[np.ndarray]]:
    """Words per text, and the mean loss of each text by both models.

    ``near`` and ``far``: the counts of the chunk's words and pairs in the target and everywhere.
    """
    words, pairs, second, tokens = chunk_grams(row)
    n_near, n_far, n_known, far_known = sums
    known = near[0] > 0
    total = n_near or n_far
    size, out = n_known + 1, []
    for (word_counts, pair_counts), everything, unknown in ((near, n_near, 0), (far, n_far, n_far - far_known)):
        if not n_near:  # no target: the unknown word is all there is, for both models
            everything, unknown = n_far, n_far
        scale = total / max(everything, 1)
        counts = np.where(known, word_counts, unknown)
        single = (counts * scale + 1) / (everything * scale + size)
        bits = -np.log2(single[words.at])
        both = known[words.at[second - 1]] & known[words.at[second]]
        share = np.where(both, pair_counts[pairs.at] / np.maximum(counts[words.at[second - 1]], 1), 0.0)
        bits[second] = -np.log2(WEIGHT * share + (1 - WEIGHT) * single[words.at[second]])
        ends = np.append(0, np.cumsum(bits))[np.append(0, np.cumsum(tokens))]
        out.append(np.diff(ends) / np.maximum(tokens, 1))
    return tokens, out


def score_documents(docs: DataFrame, target_ids: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns of every document with n_tokens, target_loss, background_loss, score."""
    chosen = target_ids.select(F.col("doc_id").alias("id")).where("id IS NOT NULL").distinct().withColumn("target", F.lit(True))
    stored = materialize(chunks(docs, chosen, keep), "lm-chunks")
    tokens = stored.select(F.sum(F.aggregate("tokens", F.lit(0).cast("long"), lambda acc, n: acc + n))).first()[0] or 0
    bits = max(2, (2 * tokens // RANGE_ENTRIES).bit_length())
    counted = materialize(answers(stored, bits), "lm-counts")
    totals = counted.where("chunk IS NULL AND part % 2 = 0").select(*(F.sum(F.get("sums", F.lit(k))) for k in range(4)))
    sums = [x or 0 for x in totals.first()]
    replies = counted.where("chunk IS NOT NULL").groupBy("chunk").agg(F.collect_list(F.struct("part", "near", "far")).alias("parts"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("own")
            for k, row in enumerate(batch.drop_columns(["own"]).to_pylist()):
                parts = sorted(row["parts"] or [], key=lambda p: p["part"])
                near, far = (
                    tuple(
                        np.concatenate([np.zeros(0, np.int64), *(unpacked(p[c], "<i8") for p in parts if p["part"] % 2 == kind)])
                        for kind in (0, 1)
                    )
                    for c in ("near", "far")
                )
                n, (target, background) = losses(row, near, far, sums)
                columns = [pa.array(n), pa.array(target), pa.array(background), pa.array(background - target)]
                names = ["own", *(c.split()[0] for c in LOSSES.split(", "))]
                yield pa.RecordBatch.from_arrays([own[k].values, *columns], names=names)

    kind = stored.schema["own"].dataType.elementType.simpleString()
    joined = stored.join(replies, "chunk", "left").select("own", "chunk", "tokens", "target", "codes", "words", "parts")
    found = joined.mapInArrow(scored, f"own {kind}, {LOSSES}")
    return found.select(*(F.col("own")[c].alias(c) for c in keep), *(c.split()[0] for c in LOSSES.split(", ")))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return score_documents(docs, labels.where("quality = 1").select("doc_id"), ["doc_id"])
