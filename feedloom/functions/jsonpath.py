"""Dotted-path lookups in parsed JSON (``VARIANT`` columns).

A path may be a Python string, compiled to a chain of literal lookups, or a
column, in which case each row follows its own path: all sources of a run are
then read by one plan whatever their mappings are. Spark reads a literal lookup
path once but a computed one per row, so where the paths that occur in a column
are few and known, ``path_get_known`` picks among literal lookups instead.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.text import col_of, has_text, is_blank, java_trim

_PLAIN_KEY = "[A-Za-z0-9_-]+"
_INDEX = "[+-]?[0-9]{1,10}"


def _whole(pattern: str) -> str:
    return rf"\A{pattern}\z"


def parse_body(body: str | Column) -> Column:
    """The whole document as VARIANT; NULL when it is not JSON."""
    return F.try_parse_json(col_of(body))


def path_segments(path: str | Column) -> Column:
    """Segments of a dotted path: NULL for a blank path, empty for the root ``$``."""
    trimmed = java_trim(path)
    tail = F.regexp_replace(trimmed, r"^\$\.", "")
    return F.when(trimmed == "$", F.array().cast("array<string>")).when(
        has_text(path), F.filter(F.split(tail, r"\."), has_text)
    )


def _segments_of(path: str) -> list[str] | None:
    trimmed = path.strip("".join(map(chr, range(33))))
    if is_blank(trimmed):
        return None
    if trimmed == "$":
        return []
    return [s for s in trimmed.removeprefix("$.").split(".") if not is_blank(s)]


def _member(current: Column, key: Column) -> Column:
    """Value under an object key. Keys outside the path grammar go through a map cast."""
    return F.when(
        key.rlike(_whole(_PLAIN_KEY)), F.try_variant_get(current, F.concat(F.lit("$."), key), "variant")
    ).otherwise(F.element_at(F.try_variant_get(current, F.lit("$"), "map<string,variant>"), key))


def _element(current: Column, key: Column) -> Column:
    """Array element for a key that reads as an index; an object never answers to it."""
    index = key.try_cast("int")
    return F.when(
        key.rlike(_whole(_INDEX)) & (index >= 0),
        F.try_variant_get(current, F.concat(F.lit("$["), index.cast("string"), F.lit("]")), "variant"),
    )


def follow(value: str | Column, segments: Column) -> Column:
    """Follow per-row segments step by step; the first missing step gives NULL."""
    return F.when(
        segments.isNotNull(),
        F.aggregate(
            segments,
            col_of(value),
            lambda current, key: F.coalesce(_member(current, key), _element(current, key)),
        ),
    )


def path_get(value: str | Column, path: str | Column) -> Column:
    """VARIANT at ``path`` (see the module text for what a path may be)."""
    if isinstance(path, Column):
        return follow(value, path_segments(path))
    segments = _segments_of(path)
    if segments is None:
        return F.lit(None).cast("variant")
    current = col_of(value)
    plain = ""
    for segment in segments:
        if re.fullmatch(_PLAIN_KEY, segment) and not re.fullmatch(_INDEX, segment):
            plain += f".{segment}"
            continue
        if plain:
            current, plain = F.try_variant_get(current, F.lit(f"${plain}"), "variant"), ""
        key = F.lit(segment)
        current = F.coalesce(_member(current, key), _element(current, key))
    return F.try_variant_get(current, F.lit(f"${plain}"), "variant") if plain else current


def path_get_known(value: str | Column, path: str | Column, known: Iterable[str | None]) -> Column:
    """As ``path_get`` for a path column whose values are all among ``known``."""
    path = col_of(path)
    choice = F.lit(None).cast("variant")
    for text in sorted({k for k in known if k is not None}, reverse=True):
        choice = F.when(path == text, path_get(value, text)).otherwise(choice)
    return choice


def as_text(value: Column) -> Column:
    """Text of a JSON value. JSON null is NULL; objects and arrays stay JSON text."""
    return F.try_variant_get(value, F.lit("$"), "string")


def path_string(value: str | Column, path: str | Column) -> Column:
    return as_text(path_get(value, path))


def as_array(value: Column) -> Column:
    """Elements of a JSON array; NULL for anything else."""
    return F.try_variant_get(value, F.lit("$"), "array<variant>")
