"""Chat formatting, token ids, decontamination and HTML extraction."""

from __future__ import annotations

import hashlib
import os
import random
import re
import time
import tracemalloc
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from feedloom.llm import decontamination as dec
from feedloom.llm import html_extraction as ext
from feedloom.llm import simple8b, token_ids
from feedloom.llm.chat import OP8_SQL, conversation_digests, escape, format_examples, op8_chat_format, unescape
from feedloom.llm.decontamination import OP7_SQL, contaminated, match_benchmark, op7_decontamination
from feedloom.llm.html_markup import path_id, read_page
from feedloom.llm.inputs import slices, text_slices
from feedloom.llm.token_ids import PieceEncoder, op10_token_ids, tokenize_documents, tokenizer_file
from feedloom.session import materialize

SMALL = "/root/testdata/sf0.001"


def _key(row):
    return tuple((x is not None, str(type(x)), x) for x in row)


def _against_sql(frame, sql, sf_dir):
    names = sorted(frame.columns)
    db = duckdb.connect()
    for name in ("documents", "benchmark", "conversations"):
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    expected = db.sql(f"SELECT {', '.join(names)} FROM ({sql})").fetchall()
    got = [tuple(r) for r in frame.select(*names).collect()]
    assert sorted(got, key=_key) == sorted(expected, key=_key)


def test_chat_format_matches_sql(spark):
    _against_sql(op8_chat_format(spark, SMALL), OP8_SQL, SMALL)


TURNS = "conv_id long, turn long, role string, text string, formatted string"


def test_chat_format_reads_back_odd_turns(spark):
    nasty = "<|im_end|>\n<|im_start|>user\n\\</s>[INST]\\\\<\\|<<SYS>>\x00é\U0001f600"
    rows = [
        (1, 0, "system", None), (1, 1, "user", nasty), (1, 2, "assistant", nasty), (1, 3, "user", ""),
        (2, 5, "assistant", "b"), (2, 5, "assistant", "a"), (2, 5, "assistant", "a"), (2, None, "user", "end"),
        (None, 1, "assistant", "x"), (3, 0, "odd\nrole<|", "long " * 50_000), (4, 0, None, None),
    ]
    turns = spark.createDataFrame([(*r, "f") for r in rows], TURNS)
    got = {r.conv_id: r for r in conversation_digests(format_examples(turns)).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is None, r[1] or 0, r[2] or "", r[3] or ""))
        text = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert got[conv].n_turns == len(own)
        assert got[conv].turns_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    examples = format_examples(turns).where("conv_id = 1").collect()
    assert [e.loss_end > e.loss_start for e in sorted(examples, key=lambda e: e.example_no)] == [True, False]
    back = turns.select("text", unescape(escape(turns["text"])).alias("back")).collect()
    assert all((r.text or "") == r.back for r in back)
    assert conversation_digests(format_examples(turns.limit(0))).count() == 0


@pytest.mark.parametrize("high", [1, 2, 60, 50_000, 1 << 31, (1 << 64) - 1])
@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 3000])
def test_simple8b_round_trip(n, high):
    draw = np.random.default_rng(n)
    ids = draw.integers(0, high, n, dtype=np.uint64, endpoint=True)
    ids[: n // 2] %= np.uint64(5)
    words, offsets, escaped = simple8b.encode(ids)
    assert (simple8b.decode(words, offsets, escaped, n) == ids).all()
    assert len(offsets) == -(-n // simple8b.BLOCK)
    if n == 3000:  # any run of blocks decodes alone
        part = slice(offsets[2], offsets[5])
        assert (simple8b.decode(words[part], offsets[2:5] - offsets[2], escaped, 768) == ids[512:1280]).all() or len(escaped)


def _brute_tokens(rows):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file())
    start, out = 0, []
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_token_ids_of_the_documents(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    got = op10_token_ids(spark, SMALL).collect()
    assert sorted(map(tuple, got)) == _brute_tokens(rows)


@pytest.mark.parametrize("limit", [3, 500_000])
def test_pieces_of_arrow_runs_give_the_ids_of_whole_texts(limit):
    odd = ["", " ", "a.b.,c ., d!., e", "x\u00a0y. z", "\n\n. a", "\0.", ".", ", .", "w " * 700, "q\tr, s.", "<|endoftext|>. a", "\u00e9, 1,5."]
    texts = [*odd, None, *(f"v{k} v{k}, (v{k}). " * (k % 5) for k in range(900)), *odd[::-1]]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    runs = list(text_slices(iter([batch.slice(0, 0), batch]), 1, 500))
    assert [t for run in runs for t in run.column(1).to_pylist()] == texts
    # The same runs as of pandas batches: cut where the characters counted so far pass a multiple of 500.
    assert [len(run) for run in slices(iter([batch.to_pandas()]), "text", 500)] == [run.num_rows for run in runs]
    with open(tokenizer_file(), encoding="utf-8") as file:
        encoder = PieceEncoder(file.read(), limit)
    for run in runs:
        some = pc.fill_null(run.column(1), "").cast(pa.large_string())
        ids, lengths = encoder.encode(some)
        expected = [encoder.whole(t).tolist() for t in some.to_pylist()]
        assert lengths.tolist() == [len(e) for e in expected]
        assert ids.tolist() == sum(expected, [])


def test_token_ids_of_odd_texts(spark):
    texts = [
        None, "", " ", "\n", "a", " a", "a ", "a\n\nb\n", "x  y", "a.b.,c ., d!., e", "x　 　y z  w", "\0", "a\0b. c",
        "<|endoftext|> a<|endoftext|>", "x <|endoftext|> y", "a. <|endoftext|>\n<|endoftext|>\nb c", "don't we'll.\nIt's 1,000. 2,5 x. .y", "é, è.\tq\r\n\x1c ​", "\U0001f600. \U0001f600", "w " * 100_000,
    ]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, start long").repartition(5)
    got = tokenize_documents(spark, docs, tokenizer_file())
    assert sorted(map(tuple, got.collect())) == _brute_tokens(rows)
    special = got.where(f"doc_id = {texts.index('x <|endoftext|> y')}").first()
    assert special.ids_crc32 == zlib.crc32(np.array([87, 220, 50256, 331, 0], dtype="<u4").tobytes())
    assert tokenize_documents(spark, docs.limit(0), tokenizer_file()).count() == 0
    same = spark.createDataFrame([(7, "a b")] * 3 + [(None, "c")], "doc_id long, text string")
    again = sorted(tokenize_documents(spark, same, tokenizer_file()).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in again] == [None, 7, 7, 7]
    assert [r.start for r in again] == np.cumsum([0] + [r.n_tokens for r in again[:-1]]).tolist()


def test_token_ids_start_no_job_for_their_columns(spark, monkeypatch):
    """A job on local rows leaves Python workers of its own kind on every executor."""
    kinds = spark.createDataFrame([], token_ids.CHUNKS).toArrow().schema
    assert kinds.names == token_ids.CHUNK_FIELDS.names
    assert all(a.type.equals(b.type) for a, b in zip(kinds, token_ids.CHUNK_FIELDS, strict=True))
    rows = [(k, f"a b{k} c, d. {k}") for k in range(9)]
    docs = materialize(spark.createDataFrame(rows, "doc_id long, text string"), "token-id-rows")
    with monkeypatch.context() as patch:
        patch.setattr(type(spark), "createDataFrame", None)
        got = sorted(map(tuple, tokenize_documents(spark, docs, tokenizer_file()).collect()))
    assert got == _brute_tokens(rows)


def test_the_library_gets_few_texts_at_once():
    """What it returns takes many times the size of the texts, so new pieces go to it in small lots."""
    with open(tokenizer_file(), encoding="utf-8") as file:
        encoder = PieceEncoder(file.read())
    sizes, library = [], encoder.tokenizer

    class Counted:
        def __getattr__(self, name):
            return getattr(library, name)

        def encode_batch_fast(self, texts, **more):
            sizes.append(len(texts))
            return library.encode_batch_fast(texts, **more)

    encoder.tokenizer = Counted()
    text = " ".join(f"w{k}" for k in range(20_000)) + "\n" + "\n".join(f"v{k}" for k in range(20_000))
    ids, lengths = encoder.encode(pa.array([text, "w1"]))
    assert len(sizes) > 2 and max(sizes) <= token_ids.TEXTS_AT_ONCE == 16
    assert ids[: lengths[0]].tolist() == library.encode(text, add_special_tokens=False).ids
    assert ids[lengths[0] :].tolist() == library.encode("w1", add_special_tokens=False).ids


def test_decontamination_matches_sql(spark):
    _against_sql(op7_decontamination(spark, "/root/testdata/sf0.01"), OP7_SQL, "/root/testdata/sf0.01")


def test_a_benchmark_of_many_blocks_matches_sql(spark, monkeypatch):
    monkeypatch.setattr(dec, "BLOCK_CHARS", 4000)
    found = op7_decontamination(spark, SMALL)
    _against_sql(found, OP7_SQL, SMALL)
    assert found.where("n_hit > 0").count() > 0


def test_longest_matches_have_their_places(spark, monkeypatch):
    monkeypatch.setattr(dec, "BLOCK_CHARS", 60)
    item = [f"w{k}" for k in range(30)]
    items = [(1, " ".join(item)), (1, " ".join(item)), (2, "short item"), (3, None), (4, ""), (None, "alone"), (5, "a " * 14)]
    texts = [
        "x y " + " ".join(item[3:25]).upper() + "; short-item z",
        " ".join(item[:12]),
        None,
        "",
        "a " * 5000,
        "nothing here",
        "Alone",
        "nothing here",
    ]
    docs = spark.createDataFrame([(k, t, "m") for k, t in enumerate(texts)], "doc_id long, text string, item string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = match_benchmark(docs, benchmark).withColumn("bad", contaminated())
    got = {r.doc_id: r for r in found.collect()}
    assert sorted((m["item"], m.item_at, m.doc_at, m.n_words) for m in got[0].matches) == [
        ("1", 3, 2, 22),
        ("1", 3, 2, 22),
        ("2", 0, 24, 2),
    ]
    assert (got[0].n_words, got[0].n_hit, got[0].bad) == (27, 24, True)
    assert [got[k].n_hit for k in (1, 2, 3, 5, 6, 7)] == [0, 0, 0, 0, 1, 0]
    assert (got[4].n_hit, got[4].n_words) == (5000, 5000)
    assert got[6].matches[0]["item"] is None
    assert match_benchmark(docs, benchmark.limit(0)).where("n_hit > 0").count() == 0
    assert match_benchmark(docs.limit(0), benchmark).count() == 0


def _matches(items, docs):
    tests = dec.test_suffixes(items)
    hashes, counts = dec.word_hashes(docs, dec.PLAIN)
    ends = np.cumsum(counts)
    words = np.insert(hashes, ends, 0)
    starts = ends - counts + np.arange(len(counts))
    window, position = dec.find(words, tests)
    found = dec.longest_matches(tests, window, position, np.searchsorted(starts, position, side="right") - 1)
    return sorted(map(tuple, found[["item", "at", "position", "n_words"]].astype(int).to_numpy().tolist()))


def test_repeated_texts_match_alike_in_both_ways(monkeypatch):
    draw = random.Random(6)

    def text(n):
        return " ".join(draw.choice("ab") * draw.choice([1, 1, 1, 1, 2]) for _ in range(n))

    phrase = "a b " * 9
    items = [(k, text(20) + " " + phrase + text(5)) for k in range(6)] + [(7, "a " * 40), (8, "b a"), (9, phrase)]
    docs = [phrase + text(30) + " " + phrase, "a " * 60, None, "b a b a", text(300), "a " * 14 + "c " + "a " * 13]
    joined = _matches(items, docs)
    monkeypatch.setattr(dec, "PLACES", 0)
    assert len(joined) > 100 and _matches(items, docs) == joined


def test_very_long_repeated_texts_stay_small():
    tracemalloc.start()
    found = _matches([(1, "a " * 2000)], ["a " * 20_000])
    assert max(n for *_, n in found) == 2000 and len(found) == 1988 + 19_988 - 1
    assert tracemalloc.get_traced_memory()[1] < 300e6
    tracemalloc.stop()


def test_suffix_array_is_sorted():
    draw = np.random.default_rng(1)
    rank = draw.integers(0, 3, 500)
    order = dec.suffix_array(rank)
    prefixes = [rank[k : k + dec.DEPTH].tolist() for k in order]
    assert prefixes == sorted(prefixes) and sorted(order) == list(range(500))


def _expected_article(html):
    import html as references

    body = re.search(r"<article>(.*?)(?:</article>|$)", html, re.S)[1]
    blocks = (" ".join(references.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1|br)[^>]*>", body))
    return "\n".join(b for b in blocks if b)


def test_articles_of_the_given_pages(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    got = {r.own.page_id: r for r in ext.extract_text(pages).collect()}
    for row in pages.collect():
        expected = _expected_article(row.html)
        assert (got[row.page_id].text, got[row.page_id].n_chars) == (expected, len(expected))


def test_the_template_finds_unmarked_articles(spark):
    """Hosts without article elements: the slot that holds most text, whatever its page says."""

    def page(k, words):
        return (
            "<html><head><title>t</title></head><body><div class=top><a>Home</a> <a>News</a></div>"
            f"<div id=x><div class=story><h1>T{k}</h1><p>{' '.join(words)}</p>"
            f"<div class=comments><p>I disagree {k}</p></div></div></div><div class=low>about us {k}</div></body></html>"
        )

    rows = [(k, "http://a.example/1", page(k, [f"w{k}{i}" for i in range(60 if k else 1)])) for k in range(12)]
    docs = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    got = {r.own.page_id: r.text for r in ext.extract_text(docs).collect()}
    assert got[0] == "T0\nw00"  # little text of its own: the host's template says where it is
    assert got[5] == "T5\n" + " ".join(f"w5{i}" for i in range(60))


def _classes(spark, rows):
    """Valid classes of (host, row, html), with paths named."""
    named = {}
    for path in ("body", "body>div", "body>div>p", "body>ul", "body>ul>li"):
        named[path_id(path)] = path
    pages = spark.createDataFrame([(h, html) for h, html in rows], "host string, html string")
    parsed = ext.parse_pages(pages.select(F.struct("host").alias("own"), "host", "html"))
    sizes = parsed.groupBy("host").agg(F.count("*").alias("host_pages"))
    found = defaultdict(set)
    for r in ext.equivalence_classes(ext.page_tokens(parsed), sizes).collect():
        found[r.vector, r.support, r.most].add(named.get(r.token, "text"))
    return {(support, most, frozenset(members)) for (_, support, most), members in found.items()}


def test_equivalence_classes_share_occurrence_vectors(spark):
    rows = [("a", "<body><div><p>x<p>y</div>" + "<ul><li>z</ul>" * (k % 2) + "</body>") for k in range(4)]
    expected = {
        (4, 1, frozenset({"body", "body>div"})),
        (4, 2, frozenset({"body>div>p"})),
        (2, 1, frozenset({"body>ul", "body>ul>li"})),
    }
    assert _classes(spark, rows) == expected
    # Equal pages are told apart, so vectors of a doubled table are as they were.
    assert _classes(spark, rows * 2) == {(2 * n, most, members) for n, most, members in expected}


def test_odd_pages(spark):
    pages = [
        (1, "http://h/", None), (2, None, ""), (3, "x", "plain &amp; &lt;b&gt; &#233;&eacute; text"), (4, "x", "<p>a<!-- <p>b --><script>p</script>"),
        (5, "x", "<article><p class='a>b'>q\n\n r<b>s</b><br/>t</p><nav>n</nav><form>f</form></article><p>out"), (5, "x", "<article>again</article>"),
        (6, "y", "<div>" * 3000 + "deep" + "</div>" * 3000), (7, "y", "<a href=\"x>y" + "z" * 100_000), (8, "z", "<style>p"), (None, "z", "<p>n"),
    ]
    frame = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, n_chars long")
    got = [(r.own.page_id, r.text) for r in ext.extract_text(frame).collect()]
    assert sorted(got, key=_key) == sorted(
        [
            (1, ""), (2, ""), (3, "plain & <b> éé text"), (4, "a"), (5, "q rs t"), (5, "again"), (6, "deep"), (7, "y" + "z" * 100_000), (8, ""), (None, "n"),
        ],
        key=_key,
    )
    assert ext.extract_text(frame.limit(0)).count() == 0


def test_side_names_on_wrappers_of_the_article():
    def read(html):
        return ext.main_text(ext.parsed_page(html), None)

    tail = "<div class='sidebar'><p>more</p></div><div class=notice>n</div></div></body>"
    assert read(f"<body><div class='content-sidebar-wrap'><main><p>the text</p></main>{tail}") == "the text"
    assert read(f"<body><div class='content no-sidebar'><article><p>the text</p></article>{tail}") == "the text"
    assert read(f"<body><div id='social-science'><p>the text of the page</p>{tail}") == "the text of the page"
    # A page with a mark elsewhere: comments stay out, be they long or articles of their own.
    comments = "<div id=comments><article class=comment><p>yes</p></article>" + "<p>I disagree</p>" * 9 + "</div>"
    assert read(f"<body><div class=widget-wrap><article><p>the text</p>{comments}</article></div>") == "the text"
    assert read(f"<body><article><p>the text</p></article>{comments}") == "the text"


def test_text_that_is_template_on_the_host_is_dropped(spark):
    """A notice of unlisted name and a repeated line in the slot go; a line that only some articles share stays."""

    def page(k):
        story = "".join(f"<p>story {k} {i} {'word ' * 9}</p>" for i in range(1 + k % 3))
        shared = "<p>as some say</p>" if k % 2 else ""
        more = "<h2>more</h2><h2>still more</h2>" if k == 3 else "<h2>more</h2>"
        hint = "<div class=hinweis>Read our letter</div>" if k % 4 else ""
        return f"<body><div class=story><h1>T{k}</h1>{story}{shared}{hint}<p>All rights kept</p></div>{more}</body>"

    rows = [(k, "http://a.example/1", page(k)) for k in range(20)] + [(k, "http://b.example/", page(1)) for k in range(20, 30)]
    got = {r.own.page_id: r.text for r in ext.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(20):
        lines = [f"T{k}", *(f"story {k} {i} {'word ' * 9}".strip() for i in range(1 + k % 3)), *["as some say"] * (k % 2)]
        assert got[k] == "\n".join(lines)
    for k in range(20, 30):  # copies of one page: nothing tells its template from its data
        assert got[k].endswith("Read our letter\nAll rights kept") and got[k].startswith("T1\nstory 1 0")


def test_one_odd_page_does_not_repeat_an_element(spark):
    rows = [("h", k, 5, 1 + (k == 0), False, None, 0, 0, 1) for k in range(30)]
    sizes = spark.createDataFrame([("h", 30)], "host string, host_pages long")
    (found,) = ext.equivalence_classes(spark.createDataFrame(rows, ext.TOKENS), sizes).collect()
    assert (found.support, found.most) == (30, 1)


def _extracted(spark, rows):
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    return [(r.own.page_id, r.text) for r in ext.extract_text(frame).collect()]


def test_a_strip_that_is_longer_than_the_story(spark):
    """The strip fills its element on every page; it is template however short the stories are."""
    strip = "Read the whole of our paper for a month without paying, and stop whenever you like to do so."
    rows = [(k, "http://a.example/", f"<body><div class=x><p>Short story {k}</p><div class=strip>{strip}</div></div></body>") for k in range(20)]
    assert sorted(_extracted(spark, rows)) == [(k, f"Short story {k}") for k in range(20)]


def test_doubled_tables_and_null_ids_give_the_same_texts(spark):
    def page(k):
        figure = "<figure><img src=x></figure>" if k % 2 else ""
        even = "" if k % 2 else "<p>as the others say</p>"
        return f"<body><div class=story><h1>T{k}</h1><p>{'word ' * (20 + k)}</p>{even}{figure}</div><div class=low>about us</div></body>"

    rows = [(k, "http://a.example/", page(k)) for k in range(16)]
    single = sorted(_extracted(spark, rows))
    assert all(("as the others say" in text) == (k % 2 == 0) and "about us" not in text for k, text in single)
    assert sorted(_extracted(spark, rows * 2)) == sorted(single * 2)
    assert sorted(t for _, t in _extracted(spark, [(None, u, h) for _, u, h in rows])) == sorted(t for _, t in single)


def test_reading_is_linear():
    pages = ["<b>" * 100_000 + "</i>" * 100_000 + "x", "<div>" * 100_000 + "x", "<p><caption>" + "<div>" * 100_000 + "x", "<ul>" + "<li><p>x" * 100_000]
    for page in pages:
        read_page("<p>warm")
        start = time.process_time()
        _, blocks = read_page(page)
        assert time.process_time() - start < 4 and blocks[-1].text == "x"


def test_deep_elements_keep_paths_of_their_own(spark):
    """A template below many wrappers, and formulas inside the article."""
    wrap = "<div>" * 60
    rows = [(k, "http://a.example/", f"<body>{wrap}<div class=t><p>T{k} is <math><mi>x</mi></math> {'w ' * 30}</p></div><div class=u>fixed line</div>") for k in range(9)]
    assert sorted(_extracted(spark, rows)) == [(k, f"T{k} is x {'w ' * 30}".strip()) for k in range(9)]


def _plain_main(rows):
    """A plain version for pages without article marks: drop what is on all pages of the host in an element of its own."""
    blocks = {k: re.findall(r"<(?:p|h1|div class=\w+)>([^<]+)<", html) for k, html in rows}
    common = set.intersection(*map(set, blocks.values()))
    return sorted((k, "\n".join(b.strip() for b in found if b not in common)) for k, found in blocks.items())


def test_unmarked_pages_against_a_plain_version(spark):
    draw = random.Random(2)
    rows = []
    for k in range(40):
        story = "".join(f"<p>{' '.join(draw.choice('abcdefgh') * draw.randint(2, 6) for _ in range(draw.randint(5, 30)))}</p>" for _ in range(draw.randint(1, 6)))
        rows.append((k, f"<body><div class=top>Daily paper</div><div class=story><h1>Head {k}</h1>{story}<div class=hint>Write to us</div></div><div class=low>all rights</div></body>"))
    assert sorted(_extracted(spark, [(k, "http://c.example/x", h) for k, h in rows])) == _plain_main(rows)

