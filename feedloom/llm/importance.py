"""Importance resampling towards a target distribution, weighed by bit-sliced aggregation.

Features are single words and pairs of words that follow each other, hashed into ``BUCKETS``. A
bucket's gain is the floored log ratio of the target's to the corpus' smoothed share of it. A
document's counts per bucket are held as bit planes: plane ``j`` has a bit for each bucket whose
count has bit ``j``. The gains are held the same way, as planes of the positive and of the
negative ones. The sum of count times gain is then the sum of ``2^(j + k)`` times the population
count of ``plane j AND gain plane k``, in whole numbers, so it is exact in any order.

The draw adds Gumbel noise from a hash of the id and takes the highest scores. They are ranked
without any task seeing more than its share: rows are dealt by range, numbered inside their
range, and the ranges' sizes (one number a partition) become offsets.

Counts go from tasks to the driver as sums per bucket (``BUCKETS`` rows); gains travel to the
tasks as one constant of that size. Defined cases: a null or empty text has no features and
weight 0; an empty target or corpus counts 0 in every bucket; a null id is hashed as the text ''
and stands last among equal scores; repeated rows are weighed and drawn row by row; equal scores
go by id, then by row; an empty table gives an empty result; further columns are ignored, or
carried along inside one struct.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.inputs import table
from feedloom.llm.word_crcs import flat_bytes, pair_crcs, word_crcs
from feedloom.llm.word_hashes import PLAIN
from feedloom.session import materialize

BUCKETS = 10_000
GAIN_SCALE = 1000
SHARE_PERCENT = 25
MIN_WORDS = 20
SEED = 7
SLICE_BYTES = 4_000_000
PLANE_ROWS = 2048
WIDTH = -(-BUCKETS // 64)
PLACE_BITS = 33  # of ``monotonically_increasing_id`` inside a partition


def text_slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about ``SLICE_BYTES``."""
    ends = flat_bytes(texts)[1] // SLICE_BYTES
    edges = np.flatnonzero(np.diff(ends)) + 1
    yield from zip([0, *edges.tolist()], [*edges.tolist(), len(ends)], strict=True)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features of the texts, their texts, and the number of words of each text."""
    words = word_crcs(*flat_bytes(texts), PLAIN)
    pairs, owner = pair_crcs(words)
    buckets = np.concatenate([words.crc, pairs]) % np.uint32(BUCKETS)
    n_words = np.bincount(words.owner, minlength=len(texts))
    return buckets.astype(np.int64), np.concatenate([words.owner, owner]), n_words


def bucket_counts(docs: DataFrame) -> list[int]:
    """Features of all texts per bucket. A task sends one number a bucket."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for low, high in text_slices(batch.column(0)):
                total += np.bincount(features(batch.column(0).slice(low, high - low))[0], minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(used, pa.int32()), "n": pa.array(total[used], pa.int64())})

    out = [0] * BUCKETS
    for row in docs.select("text").mapInArrow(counted, "bucket int, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[row[0]] = row[1]
    return out


def gains(corpus: list[int], target: list[int]) -> np.ndarray:
    of_corpus, of_target = float(sum(corpus) + BUCKETS), float(sum(target) + BUCKETS)
    ratios = (((t + 1) * of_corpus) / ((s + 1) * of_target) for s, t in zip(corpus, target, strict=True))
    return np.array([math.floor(GAIN_SCALE * math.log(ratio)) for ratio in ratios], dtype=np.int64)


def gain_planes(gain: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Signed powers of two, each with the set of buckets whose gain holds it."""
    out = []
    for sign, part in ((1, np.maximum(gain, 0)), (-1, np.maximum(-gain, 0))):
        for k in range(int(part.max(initial=0)).bit_length()):
            plane = np.zeros(WIDTH * 64, dtype=bool)
            plane[: len(part)] = (part >> k) & 1 == 1
            out.append((sign << k, np.packbits(plane, bitorder="little").view(np.uint64)))
    return out


def count_planes(buckets: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of the counts of all texts: rows of ``WIDTH`` words, with their text and power."""
    cell, n = np.unique(owner * BUCKETS + buckets, return_counts=True)
    text, bucket = cell // BUCKETS, cell % BUCKETS
    planes, owners, powers = [], [], []
    for j in range(int(n.max(initial=0)).bit_length()):
        held = (n >> j) & 1 == 1
        if not held.any():
            continue
        word = text[held] * WIDTH + (bucket[held] >> 6)
        bit = np.uint64(1) << (bucket[held] & 63).astype(np.uint64)
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        texts, row = np.unique(word[first] // WIDTH, return_inverse=True)
        plane = np.zeros((len(texts), WIDTH), dtype=np.uint64)
        plane[row, word[first] % WIDTH] = np.bitwise_or.reduceat(bit, first)
        planes.append(plane)
        owners.append(texts)
        powers.append(np.full(len(texts), 1 << j, dtype=np.int64))
    if not planes:
        none = np.zeros(0, dtype=np.int64)
        return np.zeros((0, WIDTH), dtype=np.uint64), none, none
    return np.concatenate(planes), np.concatenate(owners), np.concatenate(powers)


def gain_sums(buckets: np.ndarray, owner: np.ndarray, n_texts: int, of_gain: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Sum of count times gain of every text."""
    planes, texts, powers = count_planes(buckets, owner)
    out = np.zeros(n_texts, dtype=np.int64)
    for at in range(0, len(planes), PLANE_ROWS):
        part = planes[at : at + PLANE_ROWS]
        sums = np.zeros(len(part), dtype=np.int64)
        for signed_power, plane in of_gain:
            sums += signed_power * np.bitwise_count(part & plane).sum(axis=1, dtype=np.int64)
        np.add.at(out, texts[at : at + PLANE_ROWS], sums * powers[at : at + PLANE_ROWS])
    return out


def weigh(docs: DataFrame, gain: np.ndarray, keep: list[str]) -> DataFrame:
    """``keep`` columns of every document, ``n_words``, ``n_features`` and ``weight``."""
    of_gain = gain_planes(gain)

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for low, high in text_slices(texts):
                part = batch.slice(low, high - low)
                buckets, owner, n_words = features(part.column(part.num_columns - 1))
                n = np.bincount(owner, minlength=len(part))
                weight = gain_sums(buckets, owner, len(part), of_gain) // np.maximum(n, 1)
                added = [pa.array(x.astype(np.int64)) for x in (n_words, n, weight)]
                columns = [*part.columns[:-1], *added]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "n_words", "n_features", "weight"])

    own = docs.select(*keep).schema.simpleString()[len("struct<") : -1]
    return docs.select(*keep, "text").mapInArrow(weighed, f"{own}, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, keep: list[str]) -> DataFrame:
    """``own`` (a struct of the ``keep`` columns), n_words, n_features, weight, score, rank.

    ``rank`` is null where a document is not drawn.
    """
    carried = docs.select(F.struct(*keep).alias("own"), F.col("doc_id").alias("id"), "text")
    gain = gains(bucket_counts(docs), bucket_counts(target))
    digest = F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296
    noise = F.floor(-GAIN_SCALE * F.log(-F.log(uniform))).cast("long")
    scored = weigh(carried, gain, ["own", "id"]).withColumn("score", F.col("weight") + noise)
    scored = materialize(scored.withColumn("row", F.monotonically_increasing_id()), "importance-scores")

    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("row")]
    may_stand = F.col("n_words") >= MIN_WORDS
    dealt = scored.where(may_stand).repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = materialize(dealt.withColumn("place", F.monotonically_increasing_id()), "importance-order")
    part = F.shiftright("place", PLACE_BITS).alias("part")
    sizes = {r["part"]: r["count"] for r in dealt.groupBy(part).count().collect()}  # a row for each partition
    before, offsets = 0, []
    for k in sorted(sizes):
        offsets.append((k, before))
        before += sizes[k]
    drawn = SHARE_PERCENT * before // 100
    placed = dealt.withColumn("part", part).join(
        F.broadcast(docs.sparkSession.createDataFrame(offsets, "part long, before long")), "part"
    )
    place = F.col("before") + F.col("place").bitwiseAND((1 << PLACE_BITS) - 1) + 1
    shown = ["own", "n_words", "n_features", "weight", "score"]
    ranked = placed.select(*shown, F.when(place <= drawn, place).alias("rank"))
    return ranked.unionByName(scored.where(~may_stand).select(*shown, F.lit(None).cast("long").alias("rank")))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    drawn = resample(docs.select("doc_id", "text"), target.select("text"), ["doc_id"])
    return drawn.select("own.doc_id", "n_features", "weight", "score", "rank")


def _byte_sql() -> str:
    """The list of the 256 values of the table of CRC-32."""
    values = []
    for value in range(256):
        for _ in range(8):
            value = 0xEDB88320 ^ (value >> 1) if value & 1 else value >> 1
        values.append(str(value))
    return f"[{', '.join(values)}]::UBIGINT[]"


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORDS_SQL = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
_STEP_SQL = f"xor(({_byte_sql()})[CAST(xor(c, b) & 255 AS INTEGER) + 1], c >> 8)"
OP13_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS_SQL} AS w FROM documents),
items AS (SELECT {_WORDS_SQL} AS w FROM benchmark),
doc_features AS (
  SELECT rid, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM docs
), doc_counts AS (SELECT rid, f, count(*) AS n FROM doc_features GROUP BY ALL),
item_features AS (
  SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM items
), names AS (SELECT f FROM doc_counts UNION SELECT f FROM item_features),
bytes AS (
  SELECT f, list_transform(range(0, len(hex(encode(f))) // 2),
    lambda i: CAST('0x' || substr(hex(encode(f)), 2 * i + 1, 2) AS UBIGINT)) AS bs FROM names
), hashed AS (
  SELECT f, CAST(xor(list_reduce(list_prepend(4294967295::UBIGINT, bs), lambda c, b: {_STEP_SQL}), 4294967295::UBIGINT)
    % {BUCKETS} AS BIGINT) AS bucket FROM bytes
), s AS (SELECT bucket, CAST(sum(n) AS BIGINT) AS s FROM doc_counts JOIN hashed USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM item_features JOIN hashed USING (f) GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor({GAIN_SCALE} * ln(
    (CAST(coalesce(t, 0) + 1 AS DOUBLE) * ((SELECT sum(s) FROM s) + {BUCKETS}))
    / (CAST(s + 1 AS DOUBLE) * ((SELECT coalesce(sum(t), 0) FROM t) + {BUCKETS})))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket)
), sums AS (
  SELECT rid, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS total
  FROM doc_counts JOIN hashed USING (f) JOIN gains USING (bucket) GROUP BY rid
), weighed AS (
  SELECT rid, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features,
    CASE WHEN n_features > 0 THEN (total - (total % n_features + n_features) % n_features) // n_features ELSE 0 END AS weight,
    CAST('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8) AS UBIGINT) AS h
  FROM docs LEFT JOIN sums USING (rid)
), scored AS (
  SELECT *, weight + CAST(floor(-{GAIN_SCALE} * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM weighed
), ranked AS (
  SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id, rid) AS rank, count(*) OVER () AS n
  FROM scored WHERE n_words >= {MIN_WORDS}
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= {SHARE_PERCENT} * n // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (rid)
"""
