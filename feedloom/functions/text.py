"""Text rules shared by cleaning, sentiment and embedding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.fixed_values import EMPTY_ARTICLE_TEXT


# What Java takes as white space (no-break spaces are text).
JAVA_BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2008\u2009\u200a\u2028\u2029\u205f\u3000"


def is_blank(text: str | None) -> bool:
    """The opposite of ``has_text`` for a Python string."""
    return text is None or not text.strip(JAVA_BLANKS)


def col_of(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def has_text(value: str | Column) -> Column:
    """True when the text holds anything but Unicode white space (NBSP counts as text)."""
    return F.coalesce(col_of(value).rlike(r"[^\p{javaWhitespace}]"), F.lit(False))


def first_text(*values: str | Column) -> Column:
    """The first value that has text; the last one is taken as it is."""
    *candidates, last = [col_of(v) for v in values]
    result = last
    for candidate in reversed(candidates):
        result = F.when(has_text(candidate), candidate).otherwise(result)
    return result


def java_trim(value: str | Column) -> Column:
    """Strip characters up to U+0020 at both ends, and no others."""
    return F.regexp_replace(col_of(value), r"^[\x00-\x20]+|[\x00-\x20]+\z", "")


def _joined(title: str | Column, content: str | Column, separator: str) -> Column:
    empty = F.lit("")
    return F.concat(F.coalesce(col_of(title), empty), F.lit(separator), F.coalesce(col_of(content), empty))


def article_text(title: str | Column, content: str | Column) -> Column:
    """Lower-case ``title content``: the text that keywords and token hashes see."""
    return F.lower(_joined(title, content, " "))


def _model_text(title: str | Column, content: str | Column, separator: str) -> Column:
    return first_text(java_trim(_joined(title, content, separator)), F.lit(EMPTY_ARTICLE_TEXT))


def model_embedding_text(title: str | Column, content: str | Column) -> Column:
    return _model_text(title, content, " ")


def model_sentiment_text(title: str | Column, content: str | Column) -> Column:
    return _model_text(title, content, "\n\n")


def truncate(value: str | Column, max_chars: int) -> Column:
    """The first ``max_chars`` characters (the model's documented input limit)."""
    if max_chars <= 0:
        raise ValueError("max_chars must be greater than zero")
    return F.substring(col_of(value), 1, max_chars)


def tokens(text: str | Column) -> Column:
    """Tokens of lower-case text: runs of ``a-z`` and ``0-9``; all else separates."""
    return F.filter(F.split(col_of(text), "[^a-z0-9]+"), lambda token: token != "")


def error_text(message: str | Column, kind: str | Column) -> Column:
    """The error's message, or its short type name where the message is blank."""
    return first_text(message, kind)
