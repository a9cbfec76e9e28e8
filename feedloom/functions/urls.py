"""Request URLs from a base url and a parameter map."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.text import col_of


def _query_text(params: Column) -> Column:
    pairs = F.transform(
        F.map_entries(params),
        lambda e: F.concat(F.url_encode(e["key"]), F.lit("="), F.url_encode(F.coalesce(e["value"], F.lit("")))),
    )
    return F.array_join(pairs, "&")


def request_url(url: str | Column, params: str | Column) -> Column:
    """Append form-encoded parameters; a url that already has a query is continued with ``&``."""
    url, params = col_of(url), col_of(params)
    separator = F.when(F.contains(url, F.lit("?")), F.lit("&")).otherwise(F.lit("?"))
    return F.when(F.size(params) > 0, F.concat(url, separator, _query_text(params))).otherwise(url)


def request_url_without(url: str | Column, params: str | Column, key: str) -> Column:
    """As ``request_url`` but without one parameter (any case); always starts with ``?``."""
    url = col_of(url)
    kept = F.map_filter(col_of(params), lambda k, _: F.lower(k) != key.lower())
    return F.when(F.size(kept) > 0, F.concat(url, F.lit("?"), _query_text(kept))).otherwise(url)
