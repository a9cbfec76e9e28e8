"""Column functions on edge values."""

import math
import random

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedloom.functions.automaton import keyword_balance
from feedloom.functions.hashing import bucket, direction, document_id, java_string_hash
from feedloom.functions.instants import iso_instant, parse_instant, parse_instant_or
from feedloom.functions.jsonpath import as_array, as_text, parse_body, path_get, path_string
from feedloom.functions.lexicon import keyword_hits, keyword_label, keyword_sentiment, label
from feedloom.functions.text import (
    article_text,
    error_text,
    first_text,
    has_text,
    java_trim,
    model_embedding_text,
    model_sentiment_text,
    tokens,
    truncate,
)
from feedloom.functions.urls import request_url, request_url_without
from feedloom.functions.vectors import (
    has_embedding,
    hashed_vector,
    hashed_vector_expr,
    l2_normalize,
    l2_score,
)


def over(spark, values, build, kind="string"):
    """Values of ``build(column)`` over a one-column table, in order."""
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in rows.select("i", build(F.col("x")).alias("y")).orderBy("i").collect()]


def test_has_text_follows_unicode_white_space(spark):
    blank = [None, "", " ", "\t\n", "\u2003", "\u3000"]
    text = ["a", "\u00a0", " x "]
    assert over(spark, blank + text, has_text) == [False] * 6 + [True] * 3


def test_first_text_keeps_the_last_value_as_it_is(spark):
    assert over(spark, ["a", " ", None], lambda c: first_text(c, F.lit(""))) == ["a", "", ""]


def test_java_trim_strips_control_characters_only(spark):
    values = ["\x00\t a b \r\n", "\u00a0x\u00a0", "x \u2028", "\x1f"]
    assert over(spark, values, java_trim) == ["a b", "\u00a0x\u00a0", "x \u2028", ""]


def test_article_texts(spark):
    rows = spark.createDataFrame([("A", None), (None, None), (" ", "\n"), ("T ", " C")], "t string, c string")
    got = rows.select(
        article_text("t", "c").alias("a"), model_embedding_text("t", "c").alias("e"), model_sentiment_text("t", "c").alias("s")
    ).collect()
    empty = "untitled news article"
    assert [tuple(r) for r in got] == [
        ("a ", "A", "A"),
        (" ", empty, empty),
        ("  \n", empty, empty),
        ("t   c", "T   C", "T \n\n C"),
    ]


def test_truncate(spark):
    assert over(spark, ["abcdef", "ab"], lambda c: truncate(c, 3)) == ["abc", "ab"]
    with pytest.raises(ValueError):
        truncate("x", 0)


def test_tokens_are_ascii_runs(spark):
    assert over(spark, ["--a1 b,é c", "—", ""], tokens) == [["a1", "b", "c"], [], []]


def test_error_text(spark):
    assert over(spark, ["boom", " ", None], lambda c: error_text(c, F.lit("IOException"))) == [
        "boom",
        "IOException",
        "IOException",
    ]


def string_hash(text):
    value = 0
    for ch in text:
        value = (value * 31 + ord(ch)) & 0xFFFFFFFF
    return value - 2**32 if value >= 2**31 else value


def test_string_hash_known_values(spark):
    assert over(spark, ["hello", "polygenelubricants", "", "a"], java_string_hash) == [
        99162322,
        -2147483648,
        0,
        97,
    ]


def test_bucket_and_direction_of_negative_hashes(spark):
    values = [-2147483648, -3, 3, 4]
    assert over(spark, values, lambda c: bucket(c, 7), "int") == [v % 7 for v in values]
    assert over(spark, values, direction, "int") == [1, -1, -1, 1]


def plain_vector(text, dim):
    vector = [0.0] * dim
    token = ""
    for ch in text + " ":
        if "a" <= ch <= "z" or "0" <= ch <= "9":
            token += ch
        elif token:
            h = string_hash(token)
            vector[h % dim] += 1.0 if h % 2 == 0 else -1.0
            token = ""
    norm = math.sqrt(sum(x * x for x in vector))
    return [x / norm for x in vector] if norm else vector


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    texts=st.lists(st.text("abz09 -é\n ", max_size=60), min_size=1, max_size=20),
    dim=st.integers(1, 40),
)
def test_hashed_vector_equals_a_plain_loop(spark, texts, dim):
    for vector, text in zip(over(spark, texts, lambda c: hashed_vector(c, dim)), texts, strict=True):
        assert vector == pytest.approx(plain_vector(text, dim), abs=1e-12)


def test_both_hashed_vector_forms_agree_and_have_norm_one_or_zero(spark, table):
    docs = table("benchmark").select(F.lower("text").alias("t"))
    pairs = docs.select(hashed_vector("t", 16).alias("a"), hashed_vector_expr("t", 16).alias("b")).collect()
    for r in pairs:
        assert r.a == pytest.approx(r.b, abs=1e-12)
        assert sum(x * x for x in r.a) == pytest.approx(1.0)
    assert over(spark, ["—", "", None], lambda c: hashed_vector(c, 4)) == [[0.0] * 4] * 3
    for build in (hashed_vector, hashed_vector_expr):
        with pytest.raises(ValueError):
            build("t", 0)


def test_long_tokens_and_large_batches(spark):
    texts = ["x" * 50_000, "a b " * 20_000] + ["w"] * 1000
    got = over(spark, texts, lambda c: hashed_vector(c, 8))
    assert got[0] == plain_vector(texts[0], 8) and got[1] == pytest.approx(plain_vector(texts[1], 8))
    assert all(v == plain_vector("w", 8) for v in got[2:])


def test_vector_expressions(spark):
    kind = "array<double>"
    assert over(spark, [[3.0, 4.0], [0.0, 0.0]], l2_normalize, kind) == [[0.6, 0.8], [0.0, 0.0]]
    assert over(spark, [[1.0, 0.0]], lambda c: l2_score(c, c), kind) == [1.0]
    assert over(spark, [[1.0, 0.0]], lambda c: l2_score(c, F.array(F.lit(0.0), F.lit(1.0))), kind) == [
        pytest.approx(1 / 3)
    ]
    assert over(spark, [[1.0], [], None], has_embedding, kind) == [True, False, False]


def test_instants(spark):
    cases = {
        "2026-05-09T00:00:00Z": "2026-05-09T00:00:00Z",
        "2026-05-09T10:00:00.123456Z": "2026-05-09T10:00:00.123456Z",
        "2026-05-09T10:00:00.1Z": "2026-05-09T10:00:00.100Z",
        "2026-05-09T10:00:00.123456789Z": "2026-05-09T10:00:00.123456Z",
        "2026-05-09t10:00:00z": "2026-05-09T10:00:00Z",
        "2026-05-09T10:00:00+02:00": "2026-05-09T08:00:00Z",
        "2026-05-09T24:00:00Z": "2026-05-10T00:00:00Z",
        "2016-12-31T23:59:60Z": "2016-12-31T23:59:59Z",
        "1960-01-01T00:00:00.5Z": "1960-01-01T00:00:00.500Z",
        "2026-05-09": None,
        "2026-05-09T10:00Z": None,
        "2026-05-09 10:00:00Z": None,
        "2026-05-09T10:00:00": None,
        "2026-05-09T25:00:00Z": None,
        "2026-05-09T24:00:00.5Z": None,
        "2026-02-30T10:00:00Z": None,
        " 2026-05-09T10:00:00Z": None,
        "garbage": None,
        "": None,
        None: None,
    }
    assert over(spark, list(cases), lambda c: iso_instant(parse_instant(c))) == list(cases.values())
    late = "2026-05-09T08:00:00Z"
    default = F.lit(late).cast("timestamp")
    got = over(spark, ["2026-05-09", None], lambda c: iso_instant(parse_instant_or(c, default)))
    assert got == [late, late]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_instants_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = ["2026-11-01T05:30:00Z", "2026-11-01T06:30:00.250Z", "2026-03-08T07:00:00.000001Z"]
        assert over(spark, texts, lambda c: iso_instant(parse_instant(c))) == texts
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


PATHS = {
    "$.a.b.0": "1.5",
    "a.b.1.c": "x",
    "a.b.+1.c": "x",
    "a.b.007": None,
    "a.b.-0": "1.5",
    "a.b.-1": None,
    "a.b.9": None,
    "a..b. .2": "true",
    " $.a.n ": "1000.0",
    "0": "zero",
    "k v": "3",
    "null": None,
    "null.x": None,
    "o": '{"z":1}',
    'q"[': "9",
    "a.b.x": None,
    "a.b.3": None,
    "a.s.x": None,
    "": None,
    " ": None,
    "missing": None,
}


def test_paths_as_literals_and_as_columns(spark):
    body = (
        '{"a":{"b":[1.50,{"c":"x"},true,null],"n":1e3,"s":"t"},"0":"zero","k v":3,"null":null,'
        '"o":{"z":1},"q\\"[":9}'
    )
    rows = spark.createDataFrame([(body, p, i) for i, p in enumerate(PATHS)], "body string, p string, i int")
    rows = rows.withColumn("v", parse_body("body"))
    by_column = rows.orderBy("i").select(path_string("v", F.col("p")).alias("x")).collect()
    assert dict(zip(PATHS, [r.x for r in by_column], strict=True)) == PATHS
    literal = rows.limit(1).select(*[path_string("v", p).alias(f"c{i}") for i, p in enumerate(PATHS)]).first()
    assert dict(zip(PATHS, literal, strict=True)) == PATHS


def test_root_path_and_arrays(spark):
    bodies = ['[{"t":1},{"t":2}]', '{"t":[1]}', '"text"', "{bad", "", None]
    got = over(spark, bodies, lambda c: F.size(as_array(path_get(parse_body(c), "$"))))
    assert got[0] == 2 and all(n in (None, -1) for n in got[1:])
    assert over(spark, bodies, lambda c: parse_body(c).isNull()) == [False] * 3 + [True] * 3
    assert over(spark, bodies[:1], lambda c: path_string(parse_body(c), "1.t")) == ["2"]


def test_request_urls(spark):
    rows = spark.createDataFrame(
        [
            ("http://x", {"a b&c": "é*~", "k": None}),
            ("http://x?y=1", {"ApiKey": "s"}),
            ("http://x?y=1", {"apikey": "s"}),
            ("http://x", {}),
            ("http://x", None),
        ],
        "url string, params map<string,string>",
    )
    got = rows.select(request_url("url", "params").alias("g"), request_url_without("url", "params", "apiKey").alias("t"))
    assert [tuple(r) for r in got.collect()] == [
        ("http://x?a+b%26c=%C3%A9*%7E&k=", "http://x?a+b%26c=%C3%A9*%7E&k="),
        ("http://x?y=1&ApiKey=s", "http://x?y=1"),
        ("http://x?y=1&apikey=s", "http://x?y=1"),
        ("http://x", "http://x"),
        ("http://x", "http://x"),
    ]
    ordered = F.create_map(*[F.lit(x) for x in ("b", "1", "APIKEY", "s", "a", "2")])
    urls = spark.range(1).select(
        request_url(F.lit("http://x?y"), ordered).alias("g"),
        request_url_without(F.lit("http://x?y"), ordered, "apiKey").alias("t"),
    )
    assert tuple(urls.first()) == ("http://x?y&b=1&APIKEY=s&a=2", "http://x?y?b=1&a=2")


def test_keyword_sentiment(spark):
    cases = {
        "Bakery posts record gains this spring": "positive",
        "Losses deepen as risks mount": "negative",
        "The harbour opens at nine": "neutral",
        "A committee meets on Tuesday": "neutral",
        "Award for a surprise": "neutral",
        "GAINS": "positive",
    }
    assert over(spark, list(cases), lambda c: keyword_sentiment(c, F.lit(""))) == list(cases.values())
    assert over(spark, [None], lambda c: keyword_sentiment(c, F.lit(None).cast("string"))) == ["neutral"]


def test_keyword_hits_count_every_keyword_once(spark):
    from feedloom.fixed_values import NEGATIVE_KEYWORDS, POSITIVE_KEYWORDS

    words = [*POSITIVE_KEYWORDS, *NEGATIVE_KEYWORDS]
    texts = [*words, "gains gain gains", "xsuccessfulx", "award", "", *(" ".join(words[i:]) for i in range(45))]
    for keywords in (POSITIVE_KEYWORDS, NEGATIVE_KEYWORDS, ("a", "ab", "abc", "b", "x"), ()):
        got = over(spark, texts, lambda c, keywords=keywords: keyword_hits(c, keywords))
        assert got == [sum(k in t for k in keywords) for t in texts]


def test_automaton_equals_the_expression(spark):
    draw = random.Random(4)

    def words(n):
        return ["".join(draw.choice("abc") for _ in range(draw.randint(0, 4))) for _ in range(n)]

    texts = [None, "", "abc", *("".join(draw.choice("abc ") for _ in range(draw.randint(0, 30))) for _ in range(60))]
    for n in (0, 1, 5, 40):
        up, down = words(n), words(n)  # with overlaps, prefixes, repeats and words on both lists
        hits = over(spark, texts, lambda c, up=up, down=down: keyword_hits(c, up) - keyword_hits(c, down))
        assert over(spark, texts, lambda c, up=up, down=down: keyword_balance(c, up, down)) == hits


def test_large_lexicons_are_one_pass(spark):
    up = [f"w{k}x" for k in range(2500)]
    down = [f"v{k}x" for k in range(2500)]
    texts = ["w1x w22x v3x", "v3x v3x", "w1", "xw2499xv0xv1x"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select(keyword_label("t", up, down).alias("label"))
    assert [r.label for r in frame.collect()] == ["positive", "negative", "neutral", "negative"]
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 3000 and plan.count("balance(") == 1


def test_label(spark):
    assert over(spark, ["POSITIVE", "negative", "Neutral", " positive", "mixed", None], label) == [
        "positive",
        "negative",
        "neutral",
        None,
        None,
        None,
    ]


def test_document_ids(spark):
    import hashlib

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    rows = spark.createDataFrame(
        [
            (" http://x/é \n", "s", "t", "2026-05-09T00:00:00Z"),
            (" \t", "s", " t ", "2026-05-09T00:00:00.5Z"),
            (None, None, "t", None),
        ],
        "url string, source string, title string, at string",
    )
    got = rows.select(document_id("url", "source", "title", F.col("at").cast("timestamp")).alias("d")).collect()
    assert [r.d for r in got] == [
        sha("http://x/é"),
        sha("s| t |2026-05-09T00:00:00.500Z"),
        sha("null|t|null"),
    ]


ODD_PATHS = {
    "$.a. .b": 1,  # a no-break space is text
    "$.a. .b": 2,  # an em space is blank, so the segment is skipped
    "$.a..b": 2,
    " $.a.b\n": 2,
    "$.list.+0": "x",
    "$.list.-1": None,
    "$.list.1\n.": "y",
    " ": 7,
    " ": None,
}


def test_literal_and_column_paths_follow_one_grammar(spark):
    import json as js

    value = {"a": {" ": {"b": 1}, "b": 2}, "list": ["x", "y"], " ": 7}
    rows = spark.createDataFrame([(js.dumps(value), p) for p in ODD_PATHS], "body string, path string")
    root = rows.withColumn("root", parse_body("body"))
    by_row = {r.path: r.v for r in root.select("path", as_text(path_get("root", F.col("path"))).alias("v")).collect()}
    for path, expected in ODD_PATHS.items():
        literal = root.limit(1).select(as_text(path_get("root", path)).alias("v")).first().v
        assert literal == by_row[path], path
        if path != "$.list.1\n.":
            assert by_row[path] == (None if expected is None else str(expected)), path


def test_instants_end_where_the_text_ends(spark):
    frame = spark.createDataFrame([("2026-05-09T08:00:00Z",), ("2026-05-09T08:00:00Z\n",)], "t string")
    assert [r.p is None for r in frame.select(parse_instant("t").alias("p")).collect()] == [False, True]


def test_memory_of_the_hashed_vector_follows_bytes_and_not_rows(spark):
    from feedloom.functions.vectors import _hashed_vector_udf

    embed = _hashed_vector_udf(16).func
    texts = pa.array(["ab cd, " * 100_000, "", "x"] * 64)
    pool = pa.proxy_memory_pool(pa.default_memory_pool())
    usual = pa.default_memory_pool()
    pa.set_memory_pool(pool)
    try:
        vectors = embed(texts).to_pylist()
        held = pool.max_memory()
    finally:
        pa.set_memory_pool(usual)
    assert held < 60_000_000  # 45 million bytes of text, in texts of 700,000
    alone = [embed(texts.slice(k, 1)).to_pylist()[0] for k in range(3)]
    assert vectors == alone * 64
    assert len(embed(texts.slice(0, 0))) == 0
