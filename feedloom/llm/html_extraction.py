"""Main text of web pages by equivalence-class template deduction.

Every page is read once, into blocks of text and the paths of elements around them; later steps
work on those. Tokens are element openings, told apart by the path of elements around them, and
blocks of text, told apart by their words and path. For every host, the occurrence vector of a
token says how often each page (row) has it; it is kept as a fingerprint that tasks sum up, never
as a list of pages. Tokens with one vector are an equivalence class; a class on enough pages of
its host is valid. Valid classes nest by their paths into the host's template, and what lies
between their tokens are its slots.

Text in one valid class with an element, on ``TEXT_PAGES`` different pages at least, comes with
that element always: it is template and is dropped. Text in one class with its own element fills
that element on all pages, as nothing else does. Text that shares a class with other elements
only could stand in a copied article too, so it stays on pages whose slot mostly consists of such
text.

What is left is counted per path; the article's slot is the element marked as article or main
with most text, else the deepest container that holds most of the host's text. An element is
once a page if it repeats on less than ``REPEATS`` of its pages. A page without the slot's
element is read by its own marks. Side elements (menus, notices, adverts, forms, comments, ...)
have no tokens and no blocks. Other text of the slot is data, repeated or not.

Templates are one row a host and go to the pages by broadcast only if they are few; else they
meet the pages in a join that spreads the pages of large hosts.

Defined cases: a null or empty page has the empty text; a null url counts as the host ''; a host
with one page has that page as its template; pages are told apart by their rows, so repeated
pages and null ids count and are read each; an unclosed element ends with its parent; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.html_markup import HOLDS, MARKED, hashed, read_page
from feedloom.llm.inputs import table
from feedloom.operators.joins import join_small
from feedloom.session import materialize

MIN_SUPPORT = 0.2  # share of a host's pages; it also bounds the tokens of a template
HALF = 0.5
REPEATS = 0.1  # share of an element's pages
TEXT_PAGES = 4
BROADCAST_HOSTS = 2_000
# Per path: its number, the place of the path around it, depth, kind, occurrences. Per block: its text, the
# place of its path, its token, whether the page marks it as the article. Per different token of blocks:
# the token, occurrences, the place of its path.
PARSED = (
    "likeness long, path array<bigint>, up array<int>, depth array<int>, kind array<int>, n array<int>, "
    "text array<string>, at array<int>, token array<bigint>, main array<boolean>, "
    "words array<bigint>, times array<int>, place array<int>"
)
TOKENS = "host string, row long, token long, n int, is_text boolean, around long, depth int, kind int, likeness long"


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][\w+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1))


class Parsed(NamedTuple):
    likeness: int  # one of 64 bits, the same for pages with the same text
    path: list[int]
    up: list[int]
    depth: list[int]
    kind: list[int]
    n: list[int]
    text: list[str]
    at: list[int]
    token: list[int]
    main: list[bool]
    words: list[int]
    times: list[int]
    place: list[int]


def parsed_page(html: str | None) -> Parsed:
    elements, blocks = read_page(html or "")
    place: dict[int, int] = {}
    path, up, depth, kind, n = [], [], [], [], []
    for element in elements:
        if element.side:
            continue
        k = place.get(element.path)
        if k is None:
            place[element.path] = len(path)
            path.append(element.path)
            up.append(place[element.parent.path] if element.parent else -1)
            depth.append(element.depth)
            kind.append(element.kind)
            n.append(1)
        else:
            n[k] += 1
    owners = [block.element for block in blocks]
    at = [place[e.path] if e else -1 for e in owners]
    text = [block.text for block in blocks]
    token = [hashed("text", e.path if e else 0, words) for e, words in zip(owners, text, strict=True)]
    bit = 1 << (zlib.crc32(np.array(sorted(token), dtype=np.int64).tobytes()) & 63)
    likeness = bit - (1 << 64) if bit >> 63 else bit
    times = Counter(token)
    where = dict(zip(token, at, strict=True))
    main = [bool(e and e.main) for e in owners]
    return Parsed(
        likeness, path, up, depth, kind, n, text, at, token, main, list(times), list(times.values()), [where[t] for t in times]
    )


def _lists(rows: list[list], kind: pa.DataType) -> pa.Array:
    ends = np.append(0, np.cumsum([len(r) for r in rows])).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array([x for r in rows for x in r], kind))


def parse_pages(pages: DataFrame) -> DataFrame:
    """``own``, ``host`` and ``row`` of every page with what it holds; the one pass over the html."""
    kinds = [pa.int64(), *[pa.int32()] * 4, pa.string(), pa.int32(), pa.int64(), pa.bool_(), pa.int64(), *[pa.int32()] * 2]
    names = ["own", "host", "row", *(c.split()[0] for c in PARSED.split(", "))]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = [parsed_page(source) for source in part.column(3).to_pylist()]
                likeness, *fields = zip(*found, strict=True)
                columns = [_lists(list(rows), kind) for rows, kind in zip(fields, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(likeness, pa.int64()), *columns], names=names)

    own = pages.schema["own"].dataType.simpleString()
    wanted = pages.select("own", "host", F.monotonically_increasing_id().alias("row"), "html")
    return wanted.mapInArrow(read, f"own {own}, host string, row long, {PARSED}")


def page_tokens(parsed: DataFrame) -> DataFrame:
    """Per page and token: how often it occurs."""
    elements = F.transform(
        F.arrays_zip("path", "n", "up", "depth", "kind"),
        lambda e: F.struct(e["path"], e["n"], F.lit(False), F.get("path", e["up"]), e["depth"], e["kind"]),
    )
    texts = F.transform(
        F.arrays_zip("words", "times", "place"),
        lambda t: F.struct(t["words"], t["times"], F.lit(True), F.get("path", t["place"]), F.lit(-1), F.lit(0)),
    )
    shape = "array<struct<token:bigint,n:int,is_text:boolean,around:bigint,depth:int,kind:int>>"
    found = parsed.select("host", "row", "likeness", F.inline(F.concat(elements.cast(shape), texts.cast(shape))))
    return found.select(*(c.split()[0] for c in TOKENS.split(", ")))


def equivalence_classes(tokens: DataFrame, host_pages: DataFrame) -> DataFrame:
    """Tokens of valid classes per host: token, vector (the class), support (pages), most a page, and
    for elements the path around them, depth and kind. ``host_pages``: host, host_pages."""
    per_token = tokens.groupBy("host", "token").agg(
        F.count(F.lit(1)).alias("support"),
        F.bit_xor(F.xxhash64("row", "n")).alias("vector"),
        F.when(F.count_if(F.col("n") > 1) < REPEATS * F.count(F.lit(1)), 1).otherwise(F.max("n")).alias("most"),
        F.bit_count(F.bit_or("likeness")).alias("different"),
        F.max("is_text").alias("is_text"),
        F.max("around").alias("around"),
        F.max("depth").alias("depth"),
        F.max("kind").alias("kind"),
    )
    varied = per_token.where((F.col("different") >= TEXT_PAGES) | ~F.col("is_text"))
    valid = join_small(varied, host_pages, "host").where(F.col("support") >= MIN_SUPPORT * F.col("host_pages"))
    return valid.drop("host_pages", "different")


def _member() -> Column:
    return F.struct("token", "vector", "most", "is_text", "around", "depth", "kind")


def template_texts(members: list[dict]) -> tuple[list[int], list[int]]:
    """Text tokens in one class with their own element, and those in one with other elements only."""
    vector = {m["token"]: m["vector"] for m in members if not m["is_text"]}
    of_elements = set(vector.values())
    texts = [m for m in members if m["is_text"] and m["vector"] in of_elements]
    own = [m["token"] for m in texts if vector.get(m["around"]) == m["vector"]]
    filling = set(own)
    return own, [m["token"] for m in texts if m["token"] not in filling]


def article_path(members: list[dict], chars: dict[int, int]) -> int | None:
    """Nest a host's elements and choose the article's slot.

    A class is nested in the class that owns the path around its tokens. Slots that occur once a
    page and are in no repeated class can hold the article. ``chars`` counts what is no template.
    """
    elements = {m["token"]: m for m in members if not m["is_text"]}
    once: dict[int, bool] = {}
    for token in sorted(elements, key=lambda t: elements[t]["depth"]):
        m = elements[token]
        once[token] = m["most"] == 1 and once.get(m["around"], True)
    slots = [(chars.get(t, 0), m["depth"], t, m["kind"]) for t, m in elements.items() if once[t]]
    marked = [s for s in slots if s[3] & MARKED and s[0]]
    if marked:
        # The outermost marked element with most text; its inner elements hold no more.
        return max(marked, key=lambda s: (s[0], -s[1], s[2]))[2]
    most = max((s[0] for s in slots), default=0)
    deep = [(s[1], s[0], s[2]) for s in slots if most and s[0] >= HALF * most and s[3] & HOLDS]
    return max(deep)[2] if deep else None


def host_texts(classes: DataFrame) -> DataFrame:
    """Per host its template's members, and the texts among them."""
    # Tokens on a fifth of a host's pages are at most five times as many as a page has.
    grouped = classes.groupBy("host").agg(F.collect_list(_member()).alias("members"))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [template_texts(members) for members in batch.column(1).to_pylist()]
            own, shared = (_lists([f[k] for f in found], pa.int64()) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, own, shared], names=["host", "members", "filling", "shared"])

    members = grouped.schema["members"].dataType.simpleString()
    return grouped.mapInArrow(chosen, f"host string, members {members}, filling array<bigint>, shared array<bigint>")


def path_chars(parsed: DataFrame, texts: DataFrame) -> DataFrame:
    """Main text per host and path, of blocks that are no template."""
    sizes = F.transform("text", lambda t: F.char_length(t)).alias("sizes")
    template = texts.select("host", F.concat("filling", "shared").alias("template"))
    met = join_small(parsed.select("host", "path", "up", "at", "token", sizes), template, "host", "left", BROADCAST_HOSTS)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: dict[tuple[str, int], int] = {}
            rows = zip(*(batch.column(c).to_pylist() for c in ("host", "path", "up", "at", "token", "sizes", "template")), strict=True)
            for name, path, up, at, token, size, template in rows:
                fixed = frozenset(template or ())
                sums = [0] * len(path)
                for k, t, n in zip(at, token, size, strict=True):
                    if k >= 0 and t not in fixed:
                        sums[k] += n
                # A path comes after the one around it.
                for k in range(len(path) - 1, -1, -1):
                    if sums[k]:
                        total[name, path[k]] = total.get((name, path[k]), 0) + sums[k]
                        if up[k] >= 0:
                            sums[up[k]] += sums[k]
            keys = list(total)
            yield pa.RecordBatch.from_pydict(
                {
                    "host": pa.array([h for h, _ in keys], pa.string()),
                    "token": pa.array([p for _, p in keys], pa.int64()),
                    "chars": pa.array(list(total.values()), pa.int64()),
                }
            )

    counts = met.mapInArrow(counted, "host string, token long, chars long")
    return counts.groupBy("host", "token").agg(F.sum("chars").alias("chars"))


def host_templates(parsed: DataFrame) -> DataFrame:
    """Of each host, the path of the article's slot in its template, and the template's texts."""
    host_pages = parsed.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    classes = materialize(equivalence_classes(page_tokens(parsed), host_pages), "template-classes")
    texts = materialize(host_texts(classes), "template-texts")
    chars = path_chars(parsed, texts).join(classes.where("NOT is_text").select("host", "token"), ["host", "token"])
    counts = chars.groupBy("host").agg(F.collect_list(F.struct("token", "chars")).alias("counts"))
    joined = texts.join(counts, "host", "left").select("host", "members", "counts", "filling", "shared")

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            paths = [article_path(m, {c["token"]: c["chars"] for c in counts or ()}) for m, counts in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(paths, pa.int64()), batch.column(3), batch.column(4)],
                names=["host", "article", "filling", "shared"],
            )

    return joined.mapInArrow(chosen, "host string, article long, filling array<bigint>, shared array<bigint>")


def main_text(page: Parsed, article: int | None, filling: frozenset[int] = frozenset(), shared: frozenset[int] = frozenset()) -> str:
    """The text in the article's slot, or in what the page itself marks if it has no such slot."""
    blocks = range(len(page.text))
    if article is not None and article in page.path:
        slot, inside = page.path.index(article), [False] * len(page.path)
        for k, up in enumerate(page.up):
            inside[k] = k == slot or up >= 0 and inside[up]
        wanted = [b for b in blocks if page.at[b] >= 0 and inside[page.at[b]]]
    else:
        wanted = [b for b in blocks if page.main[b]] or list(blocks)
    kept = [b for b in wanted if page.token[b] not in filling]
    data = [b for b in kept if page.token[b] not in shared]
    chars = [sum(len(page.text[b]) for b in some) for some in (kept, data)]
    copied = chars[1] <= (1 - HALF) * chars[0]
    return "\n".join(page.text[b] for b in (kept if copied else data))


def extract_text(pages: DataFrame) -> DataFrame:
    """``pages`` with its own columns in ``own``, and text and n_chars of every page.

    Needs ``url`` and ``html``.
    """
    own = [c for c in pages.columns if c != "html"]
    named = pages.select(F.struct(*own).alias("own"), host(F.col("url")).alias("host"), "html")
    parsed = materialize(parse_pages(named), "parsed-pages")
    templates = materialize(host_templates(parsed), "host-templates")
    fields = ("path", "up", "text", "at", "token", "main")
    joined = join_small(parsed.select("own", "host", *fields), templates, "host", "left", BROADCAST_HOSTS)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in (*fields, "article", "filling", "shared")), strict=True)
            texts = []
            for path, up, text, at, token, main, article, filling, shared in rows:
                page = Parsed(0, path, up, [], [], [], text, at, token, main, [], [], [])
                texts.append(main_text(page, article, frozenset(filling or ()), frozenset(shared or ())))
            yield pa.RecordBatch.from_arrays([batch.column("own"), pa.array(texts, pa.string())], names=["own", "text"])

    schema = f"own {parsed.schema['own'].dataType.simpleString()}, text string"
    return joined.mapInArrow(read, schema).withColumn("n_chars", F.char_length("text").cast("long"))


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_text(pages).select("own.page_id", "own.url", "text", "n_chars")
