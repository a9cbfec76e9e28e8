"""Benchmark decontamination with suffix arrays over shards of the training words.

A task cuts its documents into shards of whole documents, sorts all suffixes of a shard's words
by prefix doubling (16 words deep, beyond the longest window), and binary-searches every test
suffix, so each window's occurrences are one range of the array. Windows that follow each other
in document and item join into the longest verbatim matches, with their places. A task needs its
own rows and the benchmark; with a benchmark of one block nothing is shuffled.

The benchmark is the stated query set. It is cut into blocks of about ``BLOCK_CHARS`` characters.
Each block travels to the tasks for one pass over the documents and is released after it, and the
hits of all passes, few and narrow, meet per document.

Words are compared by 64-bit hashes. Defined cases: a null or empty text has no words, so is
never hit and has no window; an item shorter than ``WINDOW`` words is one window; equal rows
are judged row by row, equal items each count; an item without id stays out of the list of
ids; an empty benchmark or table gives no hits or no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.inputs import slices, table
from feedloom.llm.word_hashes import PLAIN, word_hashes
from feedloom.session import materialize

WINDOW = 13
DEPTH = 16
SHARD_CHARS = 6_000_000
BLOCK_CHARS = 16_000_000
# Places of one document and one item that meet in one table; more are followed one by one.
PLACES = 1_000_000
MATCH = "array<struct<item:string, item_at:int, doc_at:int, n_words:int>>"


class Suffixes(NamedTuple):
    """Test suffixes of one block: distinct windows and where the items have them."""

    words: np.ndarray  # (windows, WINDOW) hashes, 0 beyond a window's length
    length: np.ndarray
    first: np.ndarray  # occurrences of window k are first[k]:first[k + 1]
    item: np.ndarray
    at: np.ndarray
    names: list[str | None]


def test_suffixes(items: list[tuple[object, str | None]]) -> Suffixes:
    hashes, counts = word_hashes([text for _, text in items], PLAIN)
    start = np.cumsum(counts) - counts
    windows = np.where(counts == 0, 0, np.maximum(1, counts - WINDOW + 1))
    item = np.repeat(np.arange(len(items)), windows)
    at = np.arange(len(item)) - np.repeat(np.cumsum(windows) - windows, windows)
    length = np.minimum(WINDOW, counts[item])
    steps = np.arange(WINDOW)
    padded = np.append(hashes, np.zeros(WINDOW, dtype=np.uint64))
    rows = padded[(start[item] + at)[:, None] + steps]
    rows[steps >= length[:, None]] = 0
    order = np.lexsort(rows.T[::-1]) if len(rows) else np.zeros(0, dtype=np.int64)
    rows = rows[order]
    new = np.append(True, (rows[1:] != rows[:-1]).any(axis=1))[: len(rows)]
    names = [None if i is None or i != i else str(i) for i, _ in items]
    first = np.append(np.flatnonzero(new), len(rows))
    return Suffixes(rows[new], length[order][new], first, item[order], at[order], names)


def suffix_array(rank: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes, sorted by their first ``DEPTH`` words."""
    n, depth = len(rank), 1
    rank = rank.astype(np.int64) + 1
    order = np.argsort(rank, kind="stable")
    while depth < DEPTH:
        later = np.zeros(n, dtype=np.int64)
        later[:-depth] = rank[depth:]
        key = rank * (n + 2) + later
        order = np.argsort(key)
        sorted_key = key[order]
        groups = np.append(0, np.cumsum(sorted_key[1:] != sorted_key[:-1]))
        rank[order] = groups + 1
        if groups[-1] == n - 1:
            break
        depth *= 2
    return order


def find(words: np.ndarray, tests: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """Every (window, position) at which a window stands in ``words``."""
    values, rank = np.unique(words, return_inverse=True)
    order = suffix_array(rank)
    near = np.searchsorted(values, tests.words)
    near[near == len(values)] = 0
    used = np.arange(WINDOW) < tests.length[:, None]
    present = np.flatnonzero(((values[near] == tests.words) | ~used).all(axis=1))
    wanted, used = near[present], used[present]
    padded = np.append(rank, np.full(WINDOW, -1))
    steps = np.arange(WINDOW)

    def border(beyond_equal: bool) -> np.ndarray:
        low, high = np.zeros(len(wanted), dtype=np.int64), np.full(len(wanted), len(order))
        while (open_ := low < high).any():
            middle = (low + high) // 2
            here = padded[order[np.minimum(middle, len(order) - 1)][:, None] + steps]
            differs = (here != wanted) & used
            at = differs.argmax(axis=1)
            row = np.arange(len(wanted))
            less = np.where(differs[row, at], here[row, at] < wanted[row, at], beyond_equal)
            low = np.where(open_ & less, middle + 1, low)
            high = np.where(open_ & ~less, middle, high)
        return low

    low, high = border(False), border(True)
    n = high - low
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
    return np.repeat(present, n), order[place]


def longest_matches(tests: Suffixes, window: np.ndarray, position: np.ndarray, owner: np.ndarray) -> pd.DataFrame:
    """Join occurrences of one item's windows that follow each other into verbatim matches.

    Of a document and an item, every place of a window in the one meets every place in the other.
    Where texts repeat themselves these are very many: such a pair is followed along the
    document with one number for each place in the item, so memory stays that of the item.
    """
    # Per occurrence, the items that have the window and how often.
    group = np.union1d(tests.first[:-1], np.flatnonzero(np.diff(tests.item)) + 1)
    n_at = np.diff(np.append(group, len(tests.item)))
    of_window = np.searchsorted(group, tests.first)
    n_items = np.diff(of_window)[window]
    place = np.arange(n_items.sum()) - np.repeat(np.cumsum(n_items) - n_items, n_items) + np.repeat(of_window[window], n_items)
    met = pd.DataFrame(
        {
            "item": tests.item[group[place]],
            "owner": np.repeat(owner, n_items),
            "window": np.repeat(window, n_items),
            "position": np.repeat(position, n_items),
            "start": group[place],
            "times": n_at[place],
        }
    )
    pairs = met.groupby(["owner", "item"], sort=False)["times"].transform("sum").to_numpy()
    few, found = met[pairs <= PLACES], []
    if len(few):
        found.append(_joined(tests, few))
    for (_, item), rows in met[pairs > PLACES].groupby(["owner", "item"]):
        found.append(_followed(tests, int(item), rows.sort_values("position")))
    return pd.concat(found) if found else pd.DataFrame(columns=["item", "at", "position", "n_words"], dtype=np.int64)


def _joined(tests: Suffixes, met: pd.DataFrame) -> pd.DataFrame:
    times = met["times"].to_numpy()
    place = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(met["start"].to_numpy(), times)
    found = pd.DataFrame(
        {
            "item": tests.item[place],
            "at": tests.at[place],
            "position": np.repeat(met["position"].to_numpy(), times),
            "length": np.repeat(tests.length[met["window"].to_numpy()], times),
        }
    )
    found["shift"] = found["position"] - found["at"]
    found = found.sort_values(["item", "shift", "position"])
    run = (found[["item", "shift"]].diff().ne(0).any(axis=1) | found["position"].diff().ne(1)).cumsum()
    runs = found.groupby(run.to_numpy())
    out = runs.first()
    out["n_words"] = runs["position"].last() - out["position"] + out["length"]
    return out[["item", "at", "position", "n_words"]]


def _followed(tests: Suffixes, item: int, met: pd.DataFrame) -> pd.DataFrame:
    """The matches of one document and one item, position by position."""
    size = int(tests.at[tests.item == item].max()) + 1
    begun = np.full(size, -1, dtype=np.int64)  # where the match that now ends at a place in the item began
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    last, last_length = -2, 0

    def ended(at: np.ndarray, position: int, length: int) -> None:
        if len(at):
            n = position - begun[at] + 1
            out.append((at - n + 1, begun[at], n + length - 1))

    for position, window, start, times in met[["position", "window", "start", "times"]].itertuples(index=False):
        at = tests.at[start : start + times]
        goes_on = position == last + 1
        moved = np.full(size, -1, dtype=np.int64)
        if goes_on:
            before = np.append(-1, begun[:-1])[at]
            moved[at] = np.where(before >= 0, before, position)
        else:
            moved[at] = position
        open_ = np.flatnonzero(begun >= 0)
        carried = goes_on & (np.append(moved[1:], -1)[open_] == begun[open_])
        ended(open_[~carried], last, last_length)
        begun, last, last_length = moved, position, int(tests.length[window])
    ended(np.flatnonzero(begun >= 0), last, last_length)
    at, position, n = (np.concatenate(x) for x in zip(*out, strict=True))
    return pd.DataFrame({"item": item, "at": at, "position": position, "n_words": n})


class Found(NamedTuple):
    """What one block of the benchmark hits in a shard of documents."""

    n_words: np.ndarray
    covered: np.ndarray  # whether a window stands over each word of the shard
    starts: np.ndarray  # the first word of each document
    matches: list[list[tuple]]


def search_shard(texts: list[str | None], tests: Suffixes) -> Found:
    hashes, counts = word_hashes(texts, PLAIN)
    ends = np.cumsum(counts)
    # A 0 after each document keeps matches inside it.
    words = np.insert(hashes, ends, 0)
    starts = ends - counts + np.arange(len(counts))
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    matches: list[list[tuple]] = [[] for _ in counts]
    if len(tests.words):
        window, position = find(words, tests)
        np.add.at(covered, position, 1)
        np.add.at(covered, position + tests.length[window], -1)
        joined = longest_matches(tests, window, position, np.searchsorted(starts, position, side="right") - 1)
        owner = np.searchsorted(starts, joined["position"].to_numpy(), side="right") - 1
        rows = zip(owner, joined["item"], joined["at"], joined["position"] - starts[owner], joined["n_words"], strict=True)
        for doc, item, at, place, n in rows:
            matches[doc].append((tests.names[item], int(at), int(place), int(n)))
    return Found(counts, np.cumsum(covered[:-1]) > 0, starts, matches)


def _block(items: DataFrame) -> Suffixes:
    """The suffixes of one block, whose size is bounded."""
    return test_suffixes([(row["item_id"], row["text"]) for row in items.select("item_id", "text").collect()])


def match_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with its own columns, and n_words, n_hit, matches per document."""
    chars = benchmark.agg(F.sum(F.char_length(F.coalesce("text", F.lit(""))) + 1)).first()[0] or 0
    blocks = -(-chars // BLOCK_CHARS)
    if blocks > 1:
        return _match_blocks(docs, benchmark, blocks)
    shared = docs.sparkSession.sparkContext.broadcast(_block(benchmark))

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for shard in slices(batches, "text", SHARD_CHARS):
            found = search_shard(shard["text"].tolist(), shared.value)
            hit = np.append(0, np.cumsum(found.covered))
            n_hit = hit[found.starts + found.n_words] - hit[found.starts]
            yield shard.drop(columns="text").assign(n_words=found.n_words, n_hit=n_hit, matches=found.matches)

    own = [c for c in docs.columns if c != "text"]
    schema = docs.select(*own).schema.simpleString()[len("struct<") : -1] if own else ""
    return docs.mapInPandas(judged, f"{schema}{', ' if own else ''}n_words long, n_hit long, matches {MATCH}")


def _match_blocks(docs: DataFrame, benchmark: DataFrame, blocks: int) -> DataFrame:
    """One pass over the documents for each block of the benchmark; driver and tasks hold one block at
    a time. What the passes hit is joined per document."""
    spark = docs.sparkSession
    own = [c for c in docs.columns if c != "text"]
    numbered = docs.select(F.struct(*own, F.lit(0).alias("_")).alias("own"), "text", F.monotonically_increasing_id().alias("row"))
    stored = materialize(numbered, "decontamination-documents")
    block = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).alias("block")
    items = materialize(benchmark.select("item_id", "text", block), "decontamination-items")
    schema = f"row long, spans array<struct<low:long, high:long>>, matches {MATCH}"
    passes = None
    for k in range(blocks):
        shared = spark.sparkContext.broadcast(_block(items.where(F.col("block") == k)))

        def hit(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            for shard in slices(batches, "text", SHARD_CHARS):
                found = search_shard(shard["text"].tolist(), shared.value)
                edges = np.flatnonzero(np.diff(found.covered.astype(np.int8), prepend=0, append=0))
                owner = np.searchsorted(found.starts, edges[::2], side="right") - 1
                spans: list[list[tuple[int, int]]] = [[] for _ in found.n_words]
                for doc, low, high in zip(owner, edges[::2] - found.starts[owner], edges[1::2] - found.starts[owner], strict=True):
                    spans[doc].append((int(low), int(high)))
                rows = [(row, s, m) for row, s, m in zip(shard["row"], spans, found.matches, strict=True) if s]
                yield pd.DataFrame(rows, columns=["row", "spans", "matches"])

        found = materialize(stored.select("row", "text").mapInPandas(hit, schema), "decontamination-hits")
        shared.destroy()
        passes = found if passes is None else passes.unionByName(found)
    spans = F.array_sort(F.flatten(F.collect_list("spans")))
    per_doc = passes.groupBy("row").agg(spans.alias("spans"), F.flatten(F.collect_list("matches")).alias("matches"))
    zero = F.lit(0).cast("long")
    covered = F.aggregate(
        "spans",
        F.struct(zero.alias("end"), zero.alias("sum")),
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["high"]).alias("end"),
            (acc["sum"] + F.greatest(zero, s["high"] - F.greatest(acc["end"], s["low"]))).alias("sum"),
        ),
        lambda acc: acc["sum"],
    )

    def sized(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for shard in slices(batches, "text", SHARD_CHARS):
            yield shard[["row"]].assign(n_words=word_hashes(shard["text"].tolist(), PLAIN)[1])

    sizes = stored.select("row", "text").mapInPandas(sized, "row long, n_words long")
    hits = per_doc.select("row", covered.alias("n_hit"), "matches")
    joined = stored.select("row", "own").join(sizes, "row").join(hits, "row", "left")
    return joined.select(
        *(F.col("own")[c].alias(c) for c in own),
        "n_words",
        F.coalesce("n_hit", zero).alias("n_hit"),
        F.coalesce("matches", F.array().cast(MATCH)).alias("matches"),
    )


def contaminated() -> Column:
    """Five percent of a document's words or more stand in benchmark windows."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = match_benchmark(docs, table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item"])))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORDS_SQL = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
OP7_SQL = f"""
WITH items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS_SQL} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item, least(len(w), {WINDOW}) AS n, array_to_string(w[i : i + least(len(w), {WINDOW}) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {WINDOW} + 1, 1) + 1)) AS i FROM items WHERE len(w) > 0)
), docs AS (
  SELECT row_number() OVER () AS rid, doc_id, {_WORDS_SQL} AS w FROM documents
), places AS (
  SELECT rid, i, n, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT rid, w, unnest(range(1, len(w) + 1)) AS i FROM docs), (SELECT DISTINCT n FROM windows)
  WHERE i + n - 1 <= len(w)
), hits AS (SELECT rid, i, n, item FROM places JOIN windows USING (n, win)),
covered AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hits) GROUP BY rid
), listed AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated
FROM docs LEFT JOIN covered USING (rid) LEFT JOIN listed USING (rid)
"""
