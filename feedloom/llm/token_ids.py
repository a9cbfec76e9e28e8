"""Token ids of a corpus in a binary format: Simple-8b words in chunks, in document order.

The table of chunks is the file format (Parquet carries the bytes, so that Spark commits them
on any store): ``shard`` and ``chunk`` order the chunks; ``first`` counts the ids of the shard
before the chunk; ``words``, ``offsets`` and ``escaped`` are little-endian arrays of
``simple8b``; ``doc_ids`` and ``doc_tokens`` list its documents. A chunk holds whole documents
and decodes alone.

Defined cases: a null text is empty and has the end id alone; a null ``doc_id`` comes first;
rows with one ``doc_id`` are ordered by a hash of their text, and equal rows all stay; an
empty table gives no chunk; further columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.llm import simple8b
from feedloom.llm.inputs import table, text_slices
from feedloom.session import scratch_dir

END_ID = 0
CHUNK_IDS = 1 << 19
CACHED_PIECES = 500_000
BATCH_CHARS = 1_000_000
# Texts that one call of the library encodes: what it returns takes many times their size.
TEXTS_AT_ONCE = 16
CHUNKS = (
    "shard int, chunk int, first long, n_ids long, words binary, offsets binary, escaped binary, "
    "doc_ids array<bigint>, doc_tokens array<bigint>"
)
# The same for Arrow. Spark would tell it by a job of its own, whose Python workers stay on every executor.
_ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}
CHUNK_FIELDS = pa.schema([(name, _ARROW[kind]) for name, kind in (c.split() for c in CHUNKS.split(", "))])


class PieceEncoder:
    """Encode texts with a byte-level tokenizer, each distinct piece once.

    The tokenizer never joins what stands before a single space or beside a single line break
    to what follows, nor letters or digits to a full stop or comma, so texts are cut there and
    the library encodes the distinct pieces, many in one call. Where white space is anything
    else, or a stop follows another sign, or the text spells an added token, the library encodes
    the whole text. The pieces known
    are dropped when there are ``limit`` of them, which bounds memory and changes no id.
    """

    def __init__(self, tokenizer_json: str, limit: int = CACHED_PIECES) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.limit = limit
        self.line_break = self.whole("\n")
        vocabulary = self.tokenizer.get_vocab()
        self.spaced = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # ids that begin with a space
        self.spaced[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.starts = np.zeros(1 << 14, dtype=np.int64)
        self.counts = np.zeros(1 << 14, dtype=np.int64)  # -1: not to be encoded alone
        self.used = 0
        self.add([".", ","])

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def _joined(self, pieces: list[str], glue: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces encoded in one text each few hundred, and how many each piece has."""
        texts = [glue.join(pieces[k : k + 512]) + glue for k in range(0, len(pieces), 512)]
        some = (texts[k : k + TEXTS_AT_ONCE] for k in range(0, len(texts), TEXTS_AT_ONCE))
        found = (e for t in some for e in self.tokenizer.encode_batch_fast(t, add_special_tokens=False))
        ids = np.concatenate([np.array(e.ids, dtype=np.uint32) for e in found])
        if glue:
            ends = np.flatnonzero(ids == self.line_break[0])
            counts = np.diff(ends, prepend=-1) - 1
            ids = np.delete(ids, ends)
        else:
            counts = np.diff(np.append(np.flatnonzero(self.spaced[ids]), len(ids)))
        if len(counts) != len(pieces):
            raise ValueError("the tokenizer does not cut texts at spaces and line breaks")
        return ids, counts

    @staticmethod
    def _alone(pieces: list[str], at: int, glue: str, odd: list[str]) -> list[str]:
        """The pieces that are one word from place ``at`` on; the others go to ``odd``. Only where
        several hundred together do not split into as many words is each looked at."""
        found: list[str] = []
        for k in range(0, len(pieces), 512):
            some = pieces[k : k + 512]
            words = [p[at:] for p in some]
            if glue.join(some).split() == words:
                found += some
                continue
            for piece, word in zip(some, words, strict=True):
                (found if word.split() == [word] else odd).append(piece)
        return found

    def add(self, pieces: list[str]) -> None:
        odd: list[str] = []
        spaced = self._alone([p for p in pieces if p[:1] == " "], 1, "", odd)
        bare = self._alone([p for p in pieces if p[:1] != " "], 0, "\n", odd)
        for some, glue in ((spaced, ""), (bare, "\n")):
            if some:
                self._store(some, *self._joined(some, glue))
        if odd:
            self._store(odd, np.zeros(0, np.uint32), np.full(len(odd), -1))
            if "\n" in odd:
                at = self.index["\n"]
                self.flat = np.append(self.flat[: self.used], np.append(self.line_break, self.flat * 0))
                self.starts[at], self.counts[at] = self.used, len(self.line_break)
                self.used += len(self.line_break)

    def _store(self, pieces: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        first, n = len(self.index), len(pieces)
        while first + n > len(self.starts):
            for name in ("starts", "counts"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old, np.zeros_like(old)]))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.starts[first : first + n] = self.used + np.cumsum(counts) - counts
        self.counts[first : first + n] = counts
        self.used += len(ids)
        self.index.update(zip(pieces, range(first, first + n), strict=True))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and how many each text has."""
        if len(self.index) > self.limit:
            self.clear()
        special = pc.match_substring(texts, "\0")
        for token in self.added:
            special = pc.or_(special, pc.match_substring(texts, token))
        cut = pc.if_else(special, pa.scalar("", pa.large_string()), texts.cast(pa.large_string()))
        for old, new in (("\n", "\0\n\0"), (" ", "\0 "), (".\0", "\0.\0"), (",\0", "\0,\0")):
            cut = pc.replace_substring(cut, old, new)
        cut = pc.split_pattern(cut, "\0")
        pieces = pc.dictionary_encode(cut.flatten())
        first = np.append(0, np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False), dtype=np.int64))
        distinct = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        index = self.index
        # Looked up by distinct piece first: those tables are small, the gathers below stay in the caches.
        known = np.fromiter(map(index.get, distinct, repeat(-1)), dtype=np.int64, count=len(distinct))
        if len(missing := np.flatnonzero(known < 0)):
            self.add(new := [distinct[k] for k in missing.tolist()])
            known[missing] = np.fromiter(map(index.__getitem__, new), dtype=np.int64, count=len(new))
        codes = pieces.indices.to_numpy(zero_copy_only=False)
        known_counts = self.counts[known].astype(np.int32)
        direct = special.to_numpy(zero_copy_only=False).copy()
        if (known_counts < 0).any():
            direct[self._owners(first, np.flatnonzero((known_counts < 0)[codes]))] = True
        direct[self._owners(first, self._stops_after_signs(distinct, known, codes, first))] = True
        counts = known_counts[codes]
        for k in np.flatnonzero(direct):
            counts[first[k] : first[k + 1]] = 0
        ends = np.append(0, np.cumsum(counts, dtype=np.int64))
        lengths = ends[first[1:]] - ends[first[:-1]]
        # Places fit 32 bits unless the ids known, or those of the batch, are more than that holds.
        kind = np.int32 if max(self.used, int(ends[-1])) < 1 << 31 else np.int64
        shift = self.starts[known].astype(kind)[codes] - ends[:-1].astype(kind)
        at = np.repeat(shift, counts)
        at += np.arange(int(ends[-1]), dtype=kind)
        ids = self.flat[at]
        if not direct.any():
            return ids, lengths
        parts, ends = [], np.cumsum(lengths)
        for k in range(len(texts)):
            parts.append(self.whole(texts[k].as_py()) if direct[k] else ids[ends[k] - lengths[k] : ends[k]])
        return np.concatenate(parts), np.array([len(p) for p in parts], dtype=np.int64)

    @staticmethod
    def _owners(first: np.ndarray, places: np.ndarray) -> np.ndarray:
        """The texts in which the pieces at ``places`` stand."""
        return np.searchsorted(first, places, side="right") - 1

    def _stops_after_signs(
        self, distinct: list[str], known: np.ndarray, codes: np.ndarray, first: np.ndarray
    ) -> np.ndarray:
        """Places of full stops and commas that follow neither a letter nor a digit of their text."""
        stops = np.flatnonzero(((known == self.index["."]) | (known == self.index[","]))[codes])
        stops = stops[stops > 0]
        before = codes[stops - 1]
        asked = np.zeros(len(distinct), dtype=bool)
        asked[before] = True
        sign = np.zeros(len(distinct), dtype=bool)
        sign[[k for k in np.flatnonzero(asked).tolist() if not distinct[k][-1:].isalnum()]] = True
        found = stops[sign[before]]
        return found[first[self._owners(first, found)] < found]


_ENCODERS: dict[int, PieceEncoder] = {}


def _encoder(tokenizer_json: str) -> PieceEncoder:
    """One encoder per Python worker; its pieces serve the worker's later tasks too.

    Tasks fill the cores already: the library's own threads would only hold memory, each its own.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    key = zlib.crc32(tokenizer_json.encode())
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = PieceEncoder(tokenizer_json)
    return _ENCODERS[key]


def write_token_ids(docs: DataFrame, path: str, tokenizer_json: str, end_id: int = END_ID) -> None:
    """Write the chunks of ``docs`` (``doc_id``, ``text``) to ``path``, in ascending order of doc_id.

    A range partitioning deals the documents out, so shards follow each other; a random last key
    splits one doc_id that has a large part of all rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    dealt = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .withColumn("deal", F.rand(0))
        .repartitionByRange("doc_id", "tie", "deal")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
    )

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_json)
        shard, chunk, first = TaskContext.get().partitionId(), 0, 0
        ids: list[np.ndarray] = []
        docs: list[object] = []
        sizes: list[int] = []
        held = 0

        def packed() -> pa.RecordBatch:
            words, offsets, escaped = simple8b.encode(np.concatenate(ids))
            row = (shard, chunk, first, held, words.tobytes(), offsets.tobytes(), escaped.tobytes(), docs, sizes)
            columns = [pa.array([v], field.type) for v, field in zip(row, CHUNK_FIELDS, strict=True)]
            return pa.RecordBatch.from_arrays(columns, schema=CHUNK_FIELDS)

        for batch in text_slices(batches, 1, BATCH_CHARS):
            flat, lengths = encoder.encode(batch.column(1).cast(pa.large_string()))
            out = np.insert(flat, np.cumsum(lengths), end_id)
            ids.append(out)
            held += len(out)
            docs += batch.column(0).to_pylist()
            sizes += (lengths + 1).tolist()
            if held >= CHUNK_IDS:
                yield packed()
                chunk, first = chunk + 1, first + held
                ids, docs, sizes, held = [], [], [], 0
                # The worker lives on beside later stages: what texts took goes back.
                pa.default_memory_pool().release_unused()
        if docs:
            yield packed()
        pa.default_memory_pool().release_unused()

    dealt.mapInArrow(chunks, CHUNKS).write.parquet(path)


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """Decode every chunk: doc_id, start, n_tokens, ids_crc32 per document."""
    chunks = spark.read.schema(CHUNKS).parquet(path)
    # One row per shard, i.e. per task that wrote: the window sorts no documents.
    shards = chunks.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = shards.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                ids = decoded(row).astype("<u4")
                sizes = np.asarray(row.doc_tokens, dtype=np.int64)
                ends = np.cumsum(sizes)
                raw = ids.tobytes()
                crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends - sizes, ends, strict=True)]
                keys = pd.array(list(row.doc_ids), dtype="Int64")
                yield pd.DataFrame(
                    {"shard": row.shard, "doc_id": keys, "at": row.first + ends - sizes, "n_tokens": sizes, "ids_crc32": crcs}
                )

    per_doc = chunks.mapInPandas(documents, "shard int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return per_doc.join(bases, "shard").select(
        "doc_id", (F.col("at") + F.col("base")).alias("start"), "n_tokens", "ids_crc32"
    )


def decoded(row: object) -> np.ndarray:
    """The ids of one chunk."""
    words, offsets, escaped = (
        np.frombuffer(getattr(row, name), dtype=kind)
        for name, kind in (("words", "<u8"), ("offsets", "<u4"), ("escaped", "<u8"))
    )
    return simple8b.decode(words, offsets, escaped, int(row.n_ids))


def tokenize_documents(spark: SparkSession, docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write the token ids of ``docs`` to the shared folder and read them back."""
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer_json = file.read()
    path = scratch_dir(spark, "token-ids")
    write_token_ids(docs, path, tokenizer_json)
    return read_token_ids(spark, path)


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize_documents(spark, table(spark, sf_dir, "documents"), tokenizer_file())
