"""N-gram Jaccard join by minimum hashes and signature trees, as classes of linked documents.

No link is drawn that does not hold; a pair is missed with the probability in 2.

1. Every text becomes its set of hashed word shingles, and of that a digest, ``KEYS`` minimum
   hashes and a token bitmap. Equal sets are one class, represented by its smallest document.
2. Classes meet where they share a minimum hash, and are candidates if they share ``MIN_KEYS`` of
   ``KEYS``. Two sets with a similarity of 0.75 share fewer with probability 2e-10, whatever their
   sizes; the more alike, the less.
3. Where classes meet, a signature tree is built: nodes hold OR-combined bitmaps and ranges of
   set sizes. A traversal of the tree with itself drops node pairs whose largest possible
   overlap is too small. What is left ties classes into candidate groups.
4. In each candidate group the same traversal runs over the whole sets, and pairs that are left
   are compared exactly. Pairs already connected are skipped in both traversals: a group of
   copies takes about one comparison each, not all pairs.
5. Links found give the components; members of a class follow their representative.

Groups of more than ``BLOCK_ROWS`` classes or ``BLOCK_SHINGLES`` shingles are cut into blocks, and
every two blocks meet in a cell, so that a task's memory does not grow with a group.

Defined cases: a text without words (null, empty) has no shingles and is its own component; a
text of fewer than five words is one shingle; equal rows are linked; a null ``doc_id`` counts
as larger than any other in a component; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.components import connected_components
from feedloom.llm.inputs import table, text_slices
from feedloom.llm.word_hashes import SPACED, mixed, word_hashes
from feedloom.session import materialize

SHINGLE = 5
KEYS = 24
MIN_KEYS = 4
BITMAP_WORDS = 8
LEAF = 16
FAN_OUT = 8
BATCH_CHARS = 2_000_000
BLOCK_ROWS = 20_000
BLOCK_SHINGLES = 2_000_000
PAIRS_AT_ONCE = 1 << 18

_DRAW = np.random.default_rng(3)
_SALTS = _DRAW.integers(0, 1 << 63, KEYS, dtype=np.uint64)
_FACTORS = _DRAW.integers(0, 1 << 63, KEYS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    hashes, counts = word_hashes(texts, SPACED)
    joined = np.zeros(max(0, len(hashes) - SHINGLE + 1), dtype=np.uint64)
    for k in range(SHINGLE):
        joined = joined * _STEP + hashes[k : k + len(joined)]
    joined = mixed(joined)
    out = []
    for end, n in zip(np.cumsum(counts).tolist(), counts.tolist(), strict=True):
        if n >= SHINGLE:
            out.append(np.unique(joined[end - n : end - SHINGLE + 1]))
        elif n:
            whole = np.uint64(n)
            for h in hashes[end - n : end]:
                whole = np.uint64((int(whole) * int(_STEP) + int(h)) % (1 << 64))
            out.append(mixed(np.array([whole])))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def bitmaps(sets: list[np.ndarray], words: int) -> np.ndarray:
    """(sets, words) bitmaps of the low bits of the hashes; no set may be empty."""
    out = np.zeros((len(sets), words), dtype=np.uint64)
    if len(sets):
        flat = np.concatenate(sets)
        first = np.cumsum([0] + [len(s) for s in sets[:-1]])
        bit = np.uint64(1) << (flat & np.uint64(63))
        word = (flat >> np.uint64(6)) % np.uint64(words)
        for w in range(words):
            out[:, w] = np.bitwise_or.reduceat(np.where(word == w, bit, np.uint64(0)), first)
    return out


def digests(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, 2) numbers that equal sets, and only they, share."""
    flat = np.concatenate(sets)
    first = np.cumsum([0] + [len(s) for s in sets[:-1]])
    size = np.array([len(s) for s in sets], dtype=np.uint64)
    sums = [mixed(np.add.reduceat(mixed(flat ^ salt), first) + size) for salt in _SALTS[:2]]
    return np.stack(sums, axis=1)


def minimum_hashes(sets: list[np.ndarray]) -> np.ndarray:
    flat = np.concatenate(sets)
    first = np.cumsum([0] + [len(s) for s in sets[:-1]])
    return np.stack([np.minimum.reduceat((flat ^ s) * f, first) for s, f in zip(_SALTS, _FACTORS, strict=True)], axis=1)


class Forest:
    """Union-find over the rows of one group."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)

    def labels(self) -> np.ndarray:
        return np.array([self.find(x) for x in range(len(self.parent))])


def may_link(overlap: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether an overlap of two sets, whose sizes add up to ``sizes``, is a similarity of 0.75."""
    return 7 * overlap >= 3 * sizes


Confirm = Callable[[np.ndarray, np.ndarray, Forest], None]


def link_all(
    maps: np.ndarray, size: np.ndarray, confirm: Confirm | None = None, marks: np.ndarray | None = None
) -> np.ndarray:
    """Component label of each row: rows whose bitmaps allow a link (``confirm``: and that it ties;
    ``marks``: and that share ``MIN_KEYS`` marks).

    Rows should come in an order that puts similar ones together. ``confirm`` gets pairs that
    may be linked and joins those that are.
    """
    n = len(size)
    extra = size - np.bitwise_count(maps).sum(axis=1).astype(np.int64)
    forest = Forest(n)

    def tie(a: np.ndarray, b: np.ndarray) -> None:
        common = np.bitwise_count(maps[a] & maps[b]).sum(axis=1).astype(np.int64) + np.minimum(extra[a], extra[b])
        fits = may_link(np.minimum(common, np.minimum(size[a], size[b])), size[a] + size[b])
        a, b = a[fits], b[fits]
        if marks is not None:
            alike = (marks[a] == marks[b]).sum(axis=1) >= MIN_KEYS
            a, b = a[alike], b[alike]
        if confirm is not None:
            confirm(a, b, forest)
        else:
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                forest.join(x, y)

    tie(np.arange(n - 1), np.arange(1, n))
    if n <= LEAF:
        a, b = np.triu_indices(n, 2)
        tie(a, b)
        return forest.labels()

    # Level 0 are the rows. A node covers its range of the level below.
    levels = [(maps, size, size, extra)]
    while len(levels[-1][0]) > 1:
        low = levels[-1]
        cut = np.arange(0, len(low[0]), LEAF if len(levels) == 1 else FAN_OUT)
        merged = (np.bitwise_or.reduceat, np.minimum.reduceat, np.maximum.reduceat, np.maximum.reduceat)
        levels.append(tuple(f(x, cut) for f, x in zip(merged, low, strict=True)))

    def refreshed() -> list[np.ndarray]:
        """Component of each node's rows, -1 where they differ."""
        out = [forest.labels()]
        for level in range(1, len(levels)):
            cut = np.arange(0, len(out[-1]), LEAF if level == 1 else FAN_OUT)
            low, high = np.minimum.reduceat(out[-1], cut), np.maximum.reduceat(out[-1], cut)
            out.append(np.where(low == high, low, -1))
        return out

    owner = refreshed()
    stack = [(len(levels) - 1, np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64))]
    while stack:
        level, a, b = stack.pop()
        same = (owner[level][a] == owner[level][b]) & (owner[level][a] >= 0)
        a, b = a[~same], b[~same]
        if not level:
            tie(a, b)
            owner = refreshed()
            continue
        node_maps, least, most, spare = levels[level]
        common = np.bitwise_count(node_maps[a] & node_maps[b]).sum(axis=1).astype(np.int64)
        common = np.minimum(common + np.minimum(spare[a], spare[b]), np.minimum(most[a], most[b]))
        keep = may_link(common, least[a] + least[b]) & (4 * most[a] >= 3 * least[b]) & (4 * most[b] >= 3 * least[a])
        a, b = a[keep], b[keep]
        fan = LEAF if level == 1 else FAN_OUT
        below = len(levels[level - 1][0])
        for k in range(0, len(a), PAIRS_AT_ONCE // fan**2):
            first = a[k : k + PAIRS_AT_ONCE // fan**2, None] * fan + np.repeat(np.arange(fan), fan)
            second = b[k : k + PAIRS_AT_ONCE // fan**2, None] * fan + np.tile(np.arange(fan), fan)
            inside = (first < below) & (second < below) & (first <= second if level > 1 else first < second)
            if inside.any():
                stack.append((level - 1, first[inside], second[inside]))
    return forest.labels()


def exact_links(sets: list[np.ndarray]) -> np.ndarray:
    """Component label of each set under the exact similarity; labels are places in ``sets``."""
    size = np.array([len(s) for s in sets], dtype=np.int64)
    least = np.array([s[:3].tolist() + [0] * (3 - min(3, len(s))) for s in sets], dtype=np.uint64)
    order = np.lexsort((size, least[:, 2], least[:, 1], least[:, 0]))
    typical = int(np.median(size))
    words = 1 << max(4, min(9, (4 * typical // 64).bit_length()))

    def confirm(a: np.ndarray, b: np.ndarray, forest: Forest) -> None:
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            if forest.find(x) != forest.find(y):
                one, two = sets[order[x]], sets[order[y]]
                at = np.minimum(np.searchsorted(two, one), len(two) - 1)
                if may_link(np.count_nonzero(two[at] == one), len(one) + len(two)):
                    forest.join(x, y)

    labels = link_all(bitmaps([sets[k] for k in order], words), size[order], confirm)
    out = np.empty(len(sets), dtype=np.int64)
    out[order] = order[labels]
    return out


def _binary(rows: np.ndarray) -> pa.Array:
    """A fixed number of 64-bit numbers per row as a binary column, in byte order."""
    rows = np.ascontiguousarray(rows, dtype=">u8")
    width = rows.dtype.itemsize * rows.shape[1]
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(rows.tobytes())])


def _numbers(column: pa.Array, width: int) -> np.ndarray:
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]] if len(column) else b""
    return np.frombuffer(data, dtype=">u8").astype(np.uint64).reshape(-1, width)


PROFILE = "doc_id long, tag long, n_shingles long, node binary, keys array<bigint>, bitmap binary, marks binary"


def profiles(docs: DataFrame, tag: str | None = None) -> DataFrame:
    """Digest, minimum hashes and bitmap of every document's set; null where it is empty."""

    def profiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, 1, BATCH_CHARS):
            sets = shingle_sets(part.column(1).to_pylist())
            full = [s for s in sets if len(s)]
            place = np.full(len(sets), len(full))
            place[[len(s) > 0 for s in sets]] = np.arange(len(full))
            at = pa.array(place, mask=place == len(full))
            if full:
                keys = minimum_hashes(full).view(np.int64)
                columns = [
                    _binary(digests(full)),
                    pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), KEYS).cast(pa.list_(pa.int64())),
                    _binary(bitmaps(full, BITMAP_WORDS)),
                    # One byte of each minimum hash, to count how many are shared.
                    _binary(np.ascontiguousarray(keys.astype(np.uint8)).view(">u8")),
                ]
            else:
                columns = [pa.array([], t) for t in (pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.binary())]
            sizes = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), sizes, *(c.take(at) for c in columns)],
                names=[c.split()[0] for c in PROFILE.split(", ")]
            )

    tag = F.col(tag).cast("long") if tag else F.lit(0).cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", tag.alias("tag")).mapInArrow(profiled, PROFILE)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of batches sorted by their first column that end where that column changes."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cell = batch.column(0).to_numpy()
        if held and held[-1].column(0)[0].as_py() != cell[0]:
            yield pa.Table.from_batches(held)
            held = []
        start = int(np.searchsorted(cell, cell[-1]))
        if start:
            yield pa.Table.from_batches([*held, batch.slice(0, start)])
            held = []
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def _cells(rows: DataFrame, group: str, blocks: Column) -> DataFrame:
    """Cut a group into blocks and copy each block's rows to the cells of all two blocks."""
    cut = rows.withColumn("blocks", blocks).withColumn("mine", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int"))
    other = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)))
    # One block is cell (0, 0); of several, each two meet once and a block is whole in any of its cells.
    met = other.where((F.col("blocks") == 1) | (F.col("mine") != F.col("other")))
    cell = F.xxhash64(group, F.least("mine", "other"), F.greatest("mine", "other"))
    return met.withColumn("cell", cell).drop("blocks", "mine", "other")


def candidate_edges(classes: DataFrame) -> DataFrame:
    """Edges u, v between classes that share a minimum hash and whose bitmaps allow a link."""
    keyed = classes.select(F.explode("keys").alias("key"), "node", "n_shingles", "bitmap", "marks")
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("rows"))
    hot = materialize(sizes.where(F.col("rows") > BLOCK_ROWS), "jaccard-hot-keys")
    blocks = F.ceil(F.coalesce("rows", F.lit(1)) / BLOCK_ROWS)
    cells = _cells(keyed.join(hot, "key", "left"), "key", blocks).select(
        "cell", "node", "n_shingles", "bitmap", "marks"
    )

    def tied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            cell = rows.column("cell").to_numpy()
            size = rows.column("n_shingles").to_numpy()
            order = np.lexsort((size, cell))
            cell, size = cell[order], size[order]
            start = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
            many = np.diff(np.append(start, len(cell)))
            used = np.repeat(many > 1, many)
            if not used.any():
                continue
            node = _numbers(rows.column("node").combine_chunks(), 2)[order]
            maps = _numbers(rows.column("bitmap").combine_chunks(), BITMAP_WORDS)[order]
            marks = _numbers(rows.column("marks").combine_chunks(), KEYS // 8)[order].astype(">u8").view(np.uint8)
            two = start[many == 2]
            extra = size - np.bitwise_count(maps).sum(axis=1).astype(np.int64)
            common = np.bitwise_count(maps[two] & maps[two + 1]).sum(axis=1).astype(np.int64)
            common += np.minimum(extra[two], extra[two + 1])
            fits = may_link(np.minimum(common, size[two]), size[two] + size[two + 1])
            two = two[fits & ((marks[two] == marks[two + 1]).sum(axis=1) >= MIN_KEYS)]
            left, right = [two], [two + 1]
            for a, n in zip(start[many > 2].tolist(), many[many > 2].tolist(), strict=True):
                labels = link_all(maps[a : a + n], size[a : a + n], marks=marks[a : a + n])
                moved = np.flatnonzero(labels != np.arange(n))
                left.append(a + labels[moved])
                right.append(a + moved)
            u, v = node[np.concatenate(left)], node[np.concatenate(right)]
            pairs = np.unique(np.hstack([u, v]), axis=0)
            yield pa.RecordBatch.from_arrays([_binary(pairs[:, :2]), _binary(pairs[:, 2:])], names=["u", "v"])

    dealt = cells.repartition("cell").sortWithinPartitions("cell")
    return dealt.mapInArrow(tied, "u binary, v binary")


def link_edges(docs: DataFrame, members: DataFrame) -> DataFrame:
    """Edges u, v of the components inside each candidate group, by exact comparison.

    ``members``: label (group), node, rep (a document of the class), n_shingles.
    """
    total = members.groupBy("label").agg(F.sum("n_shingles").alias("shingles"))
    cells = _cells(members.join(total, "label"), "label", F.ceil(F.col("shingles") / BLOCK_SHINGLES))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # The list of candidates grows with the input, so it is never broadcast.
    rows = texts.join(cells.hint("merge"), F.col("doc_id").eqNullSafe(F.col("rep"))).select("cell", "node", "text")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _groups(batches):
            cell = run.column("cell").to_numpy()
            start = np.append(np.flatnonzero(np.append(True, cell[1:] != cell[:-1])), len(cell))
            text, node = run.column("text"), _numbers(run.column("node").combine_chunks(), 2)
            left, right = [], []
            for a, b in zip(start[:-1].tolist(), start[1:].tolist(), strict=True):
                sets = shingle_sets(text.slice(a, b - a).to_pylist())
                # Several rows may have the representative's id: the class's own text is meant, once.
                full = [k for k, s in enumerate(sets) if len(s)]
                own = digests([sets[k] for k in full]) == node[a:b][full] if full else np.zeros((0, 2), dtype=bool)
                full = [k for k, ok in zip(full, own.all(axis=1), strict=True) if ok]
                if not full:
                    continue
                _, first = np.unique(node[a:b][full], axis=0, return_index=True)
                full = [full[k] for k in first]
                labels = exact_links([sets[k] for k in full])
                nodes = node[a:b][full]
                moved = labels != np.arange(len(full))
                left.append(nodes[labels[moved]])
                right.append(nodes[moved])
            if left:
                yield pa.RecordBatch.from_arrays([_binary(np.concatenate(left)), _binary(np.concatenate(right))], names=["u", "v"])

    return rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(linked, "u binary, v binary")


def jaccard_components(docs: DataFrame, tag: str | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id of every document, and what tells its component and row:

    ``component`` (bytes, null for an empty set) and the caller's ``tag`` column.
    """
    profile = materialize(profiles(docs, tag), "jaccard-profiles")
    classes = materialize(
        profile.where("node IS NOT NULL")
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("rep"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("keys").alias("keys"),
            F.first("bitmap").alias("bitmap"),
            F.first("marks").alias("marks"),
        ),
        "jaccard-classes",
    )
    groups = connected_components(candidate_edges(classes))
    members = materialize(
        classes.select("node", "rep", "n_shingles").join(groups, "node").select("label", "node", "rep", "n_shingles"),
        "jaccard-groups",
    )
    found = connected_components(link_edges(docs, members))
    labelled = classes.select("node", "rep").join(found, "node", "left")
    labelled = labelled.select("node", "rep", F.coalesce("label", "node").alias("label"))
    least = labelled.groupBy("label").agg(F.min("rep").alias("component_id"))
    by_node = labelled.join(least, "label").select("node", "component_id", F.col("label").alias("component"))
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    joined = profile.join(by_node, "node", "left")
    return joined.select("doc_id", "n_shingles", own.alias("component_id"), "component", "tag")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")
