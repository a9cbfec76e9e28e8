"""Configuration, JSON reading, cleaning and fetch outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.fixed_values import (
    BAD_JSON_MESSAGE,
    BAD_METHOD_MESSAGE,
    NO_ARTICLES_PATH_MESSAGE,
    NO_MAPPING_MESSAGE,
    NOT_AN_ARRAY_MESSAGE,
)
from feedloom.functions.instants import iso_instant, parse_instant_or
from feedloom.functions.jsonpath import as_text, parse_body, path_get, path_get_known
from feedloom.functions.text import has_text
from feedloom.operators.columns import computed_once
from feedloom.operators.config import (
    check_config,
    enabled_sources,
    source_config,
    source_config_from_json,
    with_request_url,
)
from feedloom.operators.fetch import fetch_outcomes
from feedloom.operators.normalize import (
    articles_of,
    extract,
    flatten_responses,
    normalize_generic,
    normalize_typed,
    response_errors,
    typed_responses,
)
from feedloom.plans.catalogue import inputs as I
from feedloom.plans.catalogue import sql as S
from feedloom.plans.catalogue.registry import query


def _message(template: str, *args: str) -> str:
    """SQL text of a message; ``args`` are SQL expressions."""
    text = "'" + template.replace("'", "''") + "'"
    for i, arg in enumerate(args, 1):
        text = text.replace(f"%{i}$s", f"' || {arg} || '")
    return text


# -- configuration: every customer stands for one configured source --------------------

_ENABLED = (
    "CASE c_mktsegment WHEN 'MACHINERY' THEN 'TRUE' WHEN 'FURNITURE' THEN 'no'"
    " WHEN 'HOUSEHOLD' THEN ' ' WHEN 'AUTOMOBILE' THEN 'false' END"
)
_TYPE = (
    "CASE WHEN c_nationkey < 5 THEN NULL WHEN c_nationkey < 10 THEN 'GENERIC-JSON'"
    " WHEN c_nationkey < 15 THEN ' ' WHEN c_nationkey < 18 THEN 'other' ELSE 'generic-json' END"
)
_METHOD = (
    "CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 2000 THEN 'get'"
    " WHEN c_acctbal < 3000 THEN 'POST' ELSE 'GET' END"
)
_MAPPING_STATE = "CASE WHEN c_acctbal > 9000 THEN 'none' WHEN c_acctbal > 8000 THEN 'blank' ELSE 'full' END"

_CONFIG_SQL = f"""
WITH raw AS (
  SELECT c_name AS name, {_ENABLED} AS enabled_text, {_TYPE} AS type_text, {_METHOD} AS method_text,
         {_MAPPING_STATE} AS state, c_nationkey
  FROM customer
),
filled AS (
  SELECT name, state, coalesce(nullif(trim(type_text), ''), 'generic-json') AS type,
         coalesce(method_text, 'GET') AS method,
         CASE WHEN enabled_text IS NULL OR trim(enabled_text) = '' THEN TRUE
              ELSE lower(enabled_text) = 'true' END AS enabled,
         CASE WHEN c_nationkey < 10 THEN 2 ELSE 0 END::BIGINT AS param_count
  FROM raw
)
SELECT name, enabled, type, method, param_count, state <> 'none' AS has_mapping,
       enabled AND lower(type) = 'generic-json' AS ingested,
       CASE WHEN upper(method) <> 'GET' THEN {_message(BAD_METHOD_MESSAGE, "name", "method")}
            WHEN state = 'none' THEN {_message(NO_MAPPING_MESSAGE, "name")}
            WHEN state = 'blank' THEN {_message(NO_ARTICLES_PATH_MESSAGE, "name")} END AS error_message
FROM filled
"""


def _config_report(config: DataFrame) -> DataFrame:
    ingested = enabled_sources(config).select("name", F.lit(True).alias("ingested"))
    return (
        check_config(config)
        .join(ingested, "name", "left")
        .select(
            "name",
            "enabled",
            "type",
            "method",
            F.size("params").cast("long").alias("param_count"),
            F.col("response_mapping").isNotNull().alias("has_mapping"),
            F.coalesce("ingested", F.lit(False)).alias("ingested"),
            "error_message",
        )
    )


@query(_CONFIG_SQL)
def source_config_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = F.expr(_MAPPING_STATE)
    full = I.mapping(*I.WIRE_MAPPING)
    blank = I.mapping(" ", *I.WIRE_MAPPING[1:])
    raw = I.read(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"),
        F.expr(_ENABLED).alias("enabled"),
        F.expr(_TYPE).alias("type"),
        F.expr(_METHOD).alias("method"),
        F.expr("CASE WHEN c_nationkey < 10 THEN map('q', c_mktsegment, 'n', CAST(NULL AS STRING)) END").alias(
            "params"
        ),
        F.when(state == "full", full).when(state == "blank", blank).alias("response_mapping"),
    )
    return _config_report(source_config(raw))


@query(_CONFIG_SQL)
def source_config_json_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = F.expr(_MAPPING_STATE)
    paths = {"articlesPath": F.when(state == "blank", F.lit("")).otherwise(F.lit("$.articles"))}
    entry = F.struct(
        F.col("c_name").alias("name"),
        F.expr(_ENABLED).alias("enabled"),
        F.expr(_TYPE).alias("type"),
        F.expr(_METHOD).alias("method"),
        F.expr("CASE WHEN c_nationkey < 10 THEN named_struct('q', c_acctbal, 'n', c_name) END").alias("params"),
        F.when(state != "none", F.struct(*[v.alias(k) for k, v in paths.items()])).alias("responseMapping"),
    )
    entries = I.read(spark, sf_dir, "customer").select(F.to_json(entry).alias("entry"))
    return _config_report(source_config_from_json(entries))


_URL = "coalesce(nullif(regexp_extract(url, '^[^#]*', 0), ''), url)"
_PAIRS = (
    f"'page+id=' || page_id || '&origin=' || {S.form_encoded('url')}"
    f" || '&body=' || {S.form_encoded('html')} || '&none='"
)


@query(
    f"""
SELECT page_id, url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || {_PAIRS} || '&apiKey=k' AS generic_url,
       url || '?' || {_PAIRS} AS typed_url
FROM (SELECT page_id, html, {_URL} AS url FROM pages)
"""
)
def request_url_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = F.create_map(
        F.lit("page id"), F.col("page_id").cast("string"),
        F.lit("origin"), F.col("url"),
        F.lit("body"), F.col("html"),
        F.lit("none"), F.lit(None).cast("string"),
        F.lit("apiKey"), F.lit("k"),
    )
    config = (
        I.read(spark, sf_dir, "pages")
        .withColumn("url", F.regexp_extract("url", "^[^#]*", 0))
        .withColumn("params", params)
    )
    both = with_request_url(config).withColumnRenamed("request_url", "generic_url")
    return with_request_url(both, drop_api_key=True).select(
        "page_id", "generic_url", F.col("request_url").alias("typed_url")
    )


# -- reading JSON ----------------------------------------------------------------------


@query(
    """
SELECT event_id, regexp_extract(props, ':\\s*(-?[0-9]+)', 1) AS k, event_type AS kind,
       regexp_extract(props, ':\\s*(-?[0-9]+)', 1) AS first_k, NULL::VARCHAR AS absent
FROM events
"""
)
def json_path_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.format_string('{"p":[%s,{"type":"%s","none":null}]}', "props", "event_type")
    events = I.read(spark, sf_dir, "events").withColumn("body", body)
    found = extract(events, "body", kind="$.p.1.type", first_k="p.0.k", absent="$.p.1.none.x")
    return extract(found, "props", k="$.k").select("event_id", "k", "kind", "first_k", "absent")


_TITLE = "CASE WHEN n_chars < 300 THEN NULL ELSE title END"


@query(
    f"""
WITH {S.ARTICLES}
SELECT source AS source_name, doc_id // {I.IDS_PER_RESPONSE} AS response_no, url AS external_id, title,
       CASE WHEN trim(content, chr(9) || chr(10) || ' ') = '' THEN title ELSE content END AS content,
       CASE lang WHEN 'fr' THEN source ELSE lang END AS source, NULL::VARCHAR AS author,
       url, {I.PUBLISHED_MICROS} AS published_us
FROM articles WHERE {_TITLE} IS NOT NULL
"""
)
def normalize_generic_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = flatten_responses(I.wire_responses(spark, sf_dir), I.wire_config(spark, sf_dir))
    return articles_of(normalize_generic(items, I.RUN_AT)).select(
        "source_name",
        F.col("response_no").cast("long").alias("response_no"),
        "external_id",
        "title",
        "content",
        "source",
        "author",
        "url",
        F.unix_micros("published_at").alias("published_us"),
    )


@query(
    f"""
WITH {S.ARTICLES}
SELECT source AS source_name, title,
       CASE WHEN trim(content, chr(9) || chr(10) || ' ') = '' THEN title ELSE content END AS content, url
FROM articles
UNION ALL
SELECT 'pages0', page_id::VARCHAR, html, url FROM pages
"""
)
def normalize_mixed_mappings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three payload shapes in one plan: nested, nested with array steps, and a bare array."""
    articles = I.articles(spark, sf_dir)
    two_digits = F.length("source") > 4
    wire = F.struct("title", F.col("content").alias("description"), "url")
    nested = F.struct(
        F.col("title").alias("headline"),
        F.array(F.struct(F.lit("x").alias("text")), F.struct(F.col("content").alias("text"))).alias("parts"),
        F.struct(F.array("url").alias("links")).alias("meta"),
    )
    pages = I.read(spark, sf_dir, "pages").select(
        F.col("page_id").alias("n"), F.lit("pages0").alias("source"), "page_id", "html", "url"
    )
    page = F.struct(F.struct("page_id").alias("page"), "html", F.array("url").alias("hrefs"))
    raw = (
        I.responses(articles.filter(~two_digits), wire, lambda i: F.struct(i.alias("articles")))
        .unionByName(
            I.responses(
                articles.filter(two_digits), nested, lambda i: F.struct(F.struct(i.alias("items")).alias("data"))
            )
        )
        .unionByName(I.responses(pages, page, lambda i: i))
    )
    wire_mapping = I.mapping("$.articles", "$.title", "$.description", "$.url", "$.source", "$.at")
    nested_mapping = I.mapping(
        "$.data.items", "$.headline", "$.parts.1.text", "meta.links.0", "$.publisher", "$.published_at"
    )
    page_mapping = I.mapping(" $ ", "page..page_id", "$.html", "$.hrefs.+0", "$.source", "")
    name = F.col("name")
    chosen = (
        F.when(name == "pages0", page_mapping).when(F.length(name) > 4, nested_mapping).otherwise(wire_mapping)
    )
    sources = articles.select("source").unionByName(pages.select("source"))
    items = flatten_responses(raw, I.config_for(sources, chosen))
    return articles_of(normalize_generic(items, I.RUN_AT)).select("source_name", "title", "content", "url")


_SOURCE = "source"
_ERROR_SQL = f"""CASE source
  WHEN 'src3' THEN {_message(BAD_JSON_MESSAGE, _SOURCE)}
  WHEN 'src5' THEN {_message(NOT_AN_ARRAY_MESSAGE, _SOURCE, "'$.articles'")}
  WHEN 'src7' THEN {_message(NO_MAPPING_MESSAGE, _SOURCE)}
  WHEN 'src11' THEN {_message(NO_ARTICLES_PATH_MESSAGE, _SOURCE)}
  WHEN 'src13' THEN {_message(BAD_METHOD_MESSAGE, _SOURCE, "'post'")} END"""


@query(
    f"""
WITH {S.ARTICLES}
SELECT source AS source_name, {_ERROR_SQL} AS error_message,
       count(*) FILTER (WHERE {_ERROR_SQL} IS NULL AND n_chars >= 300) AS articles
FROM articles GROUP BY source
"""
)
def normalize_source_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cut bodies, wrong shapes and broken configurations fail alone."""
    source = F.col("source")
    raw = I.wire_responses(spark, sf_dir).withColumn(
        "body",
        F.when(source == "src3", F.expr("substring(body, 1, length(body) div 2)"))
        .when(source == "src5", F.regexp_replace("body", "^.{10}", '{"oddities'))
        .otherwise(F.col("body")),
    )
    name = F.col("name")
    full, blank = I.mapping(*I.WIRE_MAPPING), I.mapping(" ", *I.WIRE_MAPPING[1:])
    config = I.config_for(
        I.read(spark, sf_dir, "documents"),
        F.when(name == "src11", blank).when(name != "src7", full),
        F.when(name == "src13", F.lit("post")).otherwise(F.lit("GET")),
    )
    normalized = normalize_generic(flatten_responses(raw, config), I.RUN_AT)
    counts = normalized.groupBy("run_id", "source_name").agg(F.count_if("kept").alias("articles"))
    return counts.join(response_errors(normalized), ["run_id", "source_name"], "left").select(
        "source_name", "error_message", "articles"
    )


@query(
    f"""
WITH {S.ARTICLES}
SELECT a.source AS source_name, p.url AS external_id, title,
       CASE WHEN trim(content, chr(9) || chr(10) || ' ') <> '' THEN content
            WHEN lang = 'en' THEN 'About ' || title ELSE '' END AS content,
       CASE lang WHEN 'fr' THEN 'Wire' ELSE upper(lang) END AS source,
       lang AS author, p.url AS url, {I.PUBLISHED_MICROS} AS published_us
FROM articles a JOIN pages p ON p.page_id = a.doc_id WHERE n_chars >= 300
"""
)
def normalize_typed_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed payloads; most documents have no page, hence no url, and are dropped."""
    pages = I.read(spark, sf_dir, "pages").select(F.col("page_id").alias("n"), F.col("url").alias("page_url"))
    rows = I.articles(spark, sf_dir).join(pages, "n", "left")
    item = F.struct(
        F.struct(
            F.lit(None).cast("string").alias("id"),
            F.when(F.col("lang") != "fr", F.upper("lang")).alias("name"),
        ).alias("source"),
        F.col("lang").alias("author"),
        F.when(F.col("n_chars") >= 300, F.col("title")).otherwise(F.lit("")).alias("title"),
        F.when(F.col("lang") == "en", F.concat(F.lit("About "), "title")).alias("description"),
        F.col("page_url").alias("url"),
        I.published_text().alias("publishedAt"),
        "content",
    )
    raw = I.responses(
        rows,
        item,
        lambda items: F.struct(
            F.lit("ok").alias("status"), F.size(items).alias("totalResults"), items.alias("articles")
        ),
    )
    return normalize_typed(typed_responses(raw), I.RUN_AT, "Wire").select(
        "source_name",
        "external_id",
        "title",
        "content",
        "source",
        "author",
        "url",
        F.unix_micros("published_at").alias("published_us"),
    )


# -- cleaning --------------------------------------------------------------------------

_MICROS = f"""CASE event_type WHEN 'click' THEN epoch_us(ts) WHEN 'view' THEN epoch_us(ts) - 7200000000
  WHEN 'error' THEN epoch_us(date_trunc('second', ts)) ELSE {I.RUN_AT_MICROS} END"""


@query(
    f"""
SELECT event_id, published_us, {S.iso("make_timestamp(published_us)")} AS published
FROM (SELECT event_id, {_MICROS} AS published_us FROM events)
"""
)
def instant_or_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    iso = iso_instant("at")
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", iso)
        .when(kind == "view", F.regexp_replace(iso, "Z$", "+02:00"))
        .when(kind == "error", F.regexp_replace(iso, r"(\.\d+)?Z$", "Z"))
        .when(kind == "purchase", F.substring(iso, 1, 10))
        .otherwise(F.lit("soon"))
    )
    events = I.read(spark, sf_dir, "events").withColumn("at", I.utc("ts"))
    parsed = events.select("event_id", parse_instant_or(text, I.RUN_AT).alias("p"))
    return parsed.select(
        "event_id", F.unix_micros("p").alias("published_us"), iso_instant("p").alias("published")
    )


@query(
    """
SELECT conv_id, turn, role <> 'system' AND turn <> 2 AS kept FROM conversations
"""
)
def has_text_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """System texts become Unicode spaces, second answers tabs, first questions an NBSP (which is text)."""
    text = (
        F.when(F.col("role") == "system", F.lit("\u2003\u3000\t"))
        .when(F.col("turn") == 2, F.lit(" \n\t"))
        .when(F.col("turn") == 0, F.lit("\u00a0"))
        .otherwise(F.col("text"))
    )
    return I.read(spark, sf_dir, "conversations").select("conv_id", "turn", has_text(text).alias("kept"))


# -- fetching --------------------------------------------------------------------------

_STATUS = "CASE event_type WHEN 'click' THEN 200 WHEN 'error' THEN 503 WHEN 'view' THEN 429 WHEN 'signup' THEN 400 END"
_NOTE = (
    "CASE event_type WHEN 'error' THEN 'Service Unavailable' WHEN 'view' THEN 'Too Many Requests'"
    " WHEN 'signup' THEN 'Bad Request' WHEN 'purchase' THEN CASE WHEN value < 10 THEN ' ' ELSE 'timed out' END END"
)


@query(
    f"""
WITH log AS (
  SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS run_id, 'user-' || user_id AS source,
         row_number() OVER (PARTITION BY date_trunc('week', ts), user_id ORDER BY ts, event_id) AS attempt,
         {_STATUS} AS status, {_NOTE} AS note
  FROM events
),
used AS (SELECT * FROM log WHERE attempt <= 4),
decisive AS (
  SELECT run_id, source,
         coalesce(min(attempt) FILTER (WHERE status IN (200, 400) OR attempt = 4), max(attempt)) AS attempt
  FROM used GROUP BY 1, 2
)
SELECT run_id, source, coalesce(status = 200, FALSE) AS ok, attempt AS attempts,
       CASE WHEN status = 200 THEN NULL
            ELSE 'HTTP fetch failed for source ' || source || ': '
              || CASE WHEN status IS NOT NULL THEN 'HTTP ' || status || ' ' || note
                      WHEN trim(note) = '' THEN 'ReadTimeoutException' ELSE note END END AS error_message
FROM used JOIN decisive USING (run_id, source, attempt)
"""
)
def fetch_outcomes_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as attempts: one run per week, one source per user."""
    week = F.date_trunc("week", "ts")
    order = Window.partitionBy("run_id", "source").orderBy("ts", "event_id")
    log = (
        I.read(spark, sf_dir, "events")
        .select(
            F.date_format(week, "yyyy-MM-dd").alias("run_id"),
            F.concat(F.lit("user-"), "user_id").alias("source"),
            "ts",
            "event_id",
            F.expr(_STATUS).alias("status"),
            F.when(F.col("event_type") == "purchase", "ReadTimeoutException").alias("error_kind"),
            F.expr(_NOTE).alias("message"),
        )
        .withColumn("attempt", F.row_number().over(order))
    )
    return fetch_outcomes(log).withColumn("attempts", F.col("attempts").cast("long"))


# -- JSON paths with odd segments: blanks, signs, keys like indexes, steps into texts ------------

_ODD_PATHS = {
    "$.a.b c": "event_id::VARCHAR",
    "a..0": "user_id::VARCHAR",
    "$.list.0": "event_type",
    "$.list.+1.t": "event_id::VARCHAR",
    "$.list.01": "'{\"t\":' || event_id || '}'",
    "$.list.-1": "NULL",
    " $.a.\u00e9 \t": "event_type",
    "$.s.0": "NULL",
    "$.a.missing.x": "NULL",
    "list.2147483648": "NULL",
    " \t": "NULL",
    "$.a.0.0": "NULL",
}


def _odd_case() -> str:
    cases = " ".join(f"WHEN {k} THEN {value}" for k, value in enumerate(_ODD_PATHS.values()))
    return f"CASE event_id % {len(_ODD_PATHS)} {cases} END"


@query(f"SELECT event_id, {_odd_case()} AS by_row, {_odd_case()} AS compiled FROM events")
def json_path_odd_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event's body read by its row's path, and by the compiled lookups of all paths."""
    events = I.read(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    inner = F.struct(
        F.col("event_id").alias("b c"), F.col("user_id").cast("string").alias("0"), F.col("event_type").alias("\u00e9")
    )
    items = F.array(F.to_json(F.struct("event_type")), F.to_json(F.struct(F.col("event_id").alias("t"))))
    # An array of unlike items: the first one is the bare text.
    listed = F.concat(F.lit("["), F.regexp_extract(items[0], r":(.*)\}$", 1), F.lit(","), items[1], F.lit("]"))
    body = F.concat(F.lit('{"s":"text","a":'), F.to_json(inner), F.lit(',"list":'), listed, F.lit("}"))
    path = F.get(F.array(*map(F.lit, _ODD_PATHS)), (F.col("event_id") % len(_ODD_PATHS)).cast("int"))
    root = computed_once(events.select("event_id", body.alias("body"), path.alias("path")), root=parse_body("body"))
    return root.select(
        "event_id",
        as_text(path_get("root", F.col("path"))).alias("by_row"),
        as_text(path_get_known("root", "path", _ODD_PATHS)).alias("compiled"),
    )
