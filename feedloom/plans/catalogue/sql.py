"""SQL fragments shared by the expected results."""

from __future__ import annotations

from collections.abc import Sequence

from feedloom.fixed_values import NEGATIVE_KEYWORDS, POSITIVE_KEYWORDS

# Title is the first line of a document, content the rest.
ARTICLES = """
articles AS (
  SELECT doc_id, source, lang, n_chars, title, substr(text, length(title) + 2) AS content,
         'https://feed.example/' || source || '/' || doc_id AS url
  FROM (SELECT *, split_part(text, chr(10), 1) AS title FROM documents)
)"""


def hits(text: str, words: Sequence[str]) -> str:
    return " + ".join(f"CAST(contains({text}, '{w}') AS INT)" for w in words)


def lexicon(
    text: str, positive: Sequence[str] = POSITIVE_KEYWORDS, negative: Sequence[str] = NEGATIVE_KEYWORDS
) -> str:
    up, down = hits(text, positive), hits(text, negative)
    return (
        f"CASE WHEN ({up}) > ({down}) THEN 'positive'"
        f" WHEN ({down}) > ({up}) THEN 'negative' ELSE 'neutral' END"
    )


def token_hash(token: str) -> str:
    unsigned = (
        f"list_reduce(list_prepend(0::BIGINT, list_transform(string_split({token}, ''),"
        " lambda ch: ascii(ch)::BIGINT)), lambda a, x: (a * 31 + x) & 4294967295)"
    )
    return f"(({unsigned} + 2147483648) & 4294967295) - 2147483648"


def weights(name: str, texts: str, dim: int) -> str:
    """CTEs ending in ``name(id, b, w)``: the non-zero weights of the hashed vectors of ``texts(id, text)``."""
    return f"""
{name}_tokens AS (
  SELECT id, tok FROM (
    SELECT id, unnest(string_split_regex(lower(text), '[^a-z0-9]+')) AS tok FROM {texts}
  ) WHERE tok <> ''
),
{name}_hashes AS (
  SELECT tok, {token_hash("tok")} AS h FROM (SELECT DISTINCT tok FROM {name}_tokens)
),
{name}_sums AS (
  SELECT id, ((h % {dim}) + {dim}) % {dim} AS b, SUM(CASE WHEN h % 2 = 0 THEN 1 ELSE -1 END)::DOUBLE AS s
  FROM {name}_tokens JOIN {name}_hashes USING (tok) GROUP BY 1, 2
),
{name} AS (
  SELECT id, b, s / sqrt(SUM(s * s) OVER (PARTITION BY id)) AS w FROM {name}_sums WHERE s <> 0
)"""


def scores(queries: str, query_weights: str, documents: str, document_weights: str) -> str:
    """CTE ``scored(query, id, score)`` over all pairs of ``queries(id)`` and ``documents(id)``."""
    return f"""
dots AS (
  SELECT q.id AS query, d.id AS id, SUM(q.w * d.w) AS dot
  FROM {query_weights} q JOIN {document_weights} d USING (b) GROUP BY 1, 2
),
scored AS (
  SELECT q.id AS query, d.id AS id,
         round(1 / (1 + (q.id IN (SELECT id FROM {query_weights}))::INT
                      + (d.id IN (SELECT id FROM {document_weights}))::INT - 2 * coalesce(dot, 0)), 9) AS score
  FROM {queries} q CROSS JOIN {documents} d LEFT JOIN dots ON dots.query = q.id AND dots.id = d.id
)"""


def iso(ts: str) -> str:
    """ISO instant text of a timestamp expression."""
    micros = f"(epoch_us({ts}) % 1000000)"
    return (
        f"strftime({ts}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN {micros} = 0 THEN ''"
        f" WHEN {micros} % 1000 = 0 THEN '.' || lpad(({micros} // 1000)::VARCHAR, 3, '0')"
        f" ELSE '.' || lpad({micros}::VARCHAR, 6, '0') END || 'Z'"
    )


def trimmed(text: str) -> str:
    return f"regexp_replace({text}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"


def form_encoded(text: str) -> str:
    return f"replace(replace(replace(url_encode({text}), '%20', '+'), '~', '%7E'), '%2A', '*')"
