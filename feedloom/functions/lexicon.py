"""Keyword sentiment as one code-generated expression."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.fixed_values import (
    LABELS,
    NEGATIVE,
    NEGATIVE_KEYWORDS,
    NEUTRAL,
    POSITIVE,
    POSITIVE_KEYWORDS,
)
from feedloom.functions.automaton import keyword_balance
from feedloom.functions.text import article_text, col_of

# Lexicons of more words than this, together, go through an automaton: the plan does not grow with
# them, and a text is read once.
EXPRESSION_KEYWORDS = 100


def keyword_hits(text: str | Column, keywords: Sequence[str]) -> Column:
    """How many different keywords occur anywhere in the text, also inside words.

    A keyword that contains another one ("gains", "gain") is only looked for where the
    shorter one was found, which spares a third of the scans of most texts.
    """
    text = col_of(text)
    keywords = tuple(dict.fromkeys(keywords))
    shortest = [k for k in keywords if not any(o != k and o in k for o in keywords)]
    longer: dict[str, list[str]] = {k: [] for k in shortest}
    for keyword in keywords:
        if keyword not in longer:
            longer[next(k for k in shortest if k in keyword)].append(keyword)
    found = (
        F.when(F.contains(text, F.lit(k)), F.lit(1) + keyword_hits(text, longer[k]) if longer[k] else F.lit(1)).otherwise(0)
        for k in shortest
    )
    return reduce(add, found, F.lit(0))


def keyword_label(
    text: str | Column,
    positive: Sequence[str] = POSITIVE_KEYWORDS,
    negative: Sequence[str] = NEGATIVE_KEYWORDS,
) -> Column:
    """Label of already lower-case text: the lexicon with more hits, else neutral."""
    if len(positive) + len(negative) > EXPRESSION_KEYWORDS:
        balance = keyword_balance(col_of(text), positive, negative)
    else:
        balance = keyword_hits(text, positive) - keyword_hits(text, negative)
    return F.when(balance > 0, POSITIVE).when(balance < 0, NEGATIVE).otherwise(NEUTRAL)


def keyword_sentiment(
    title: str | Column,
    content: str | Column,
    positive: Sequence[str] = POSITIVE_KEYWORDS,
    negative: Sequence[str] = NEGATIVE_KEYWORDS,
) -> Column:
    return keyword_label(article_text(title, content), positive, negative)


def label(text: str | Column) -> Column:
    """One of the three labels in any case, without trimming; anything else is NULL."""
    lower = F.lower(col_of(text))
    return F.when(lower.isin(*LABELS), lower)
