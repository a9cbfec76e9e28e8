"""Token hashes and document ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.instants import iso_instant
from feedloom.functions.text import col_of, has_text, java_trim


def java_string_hash(token: str | Column) -> Column:
    """31-polynomial string hash, wrapped to signed 32 bits (plain ASCII tokens)."""
    chars = F.filter(F.split(col_of(token), ""), lambda c: c != "")
    unsigned = F.aggregate(
        chars,
        F.lit(0).cast("long"),
        lambda acc, c: (acc * F.lit(31) + F.ascii(c)).bitwiseAND(F.lit(0xFFFFFFFF)),
    )
    sign = F.lit(1 << 31)
    return (unsigned.bitwiseXOR(sign) - sign).cast("int")


def bucket(hash_value: str | Column, dim: int) -> Column:
    return F.pmod(col_of(hash_value), F.lit(dim))


def direction(hash_value: str | Column) -> Column:
    return F.when(col_of(hash_value) % 2 == 0, F.lit(1)).otherwise(F.lit(-1))


def sha256_id(text: str | Column) -> Column:
    return F.sha2(col_of(text).cast("binary"), 256)


def document_id(
    url: str | Column, source: str | Column, title: str | Column, published_at: str | Column
) -> Column:
    """SHA-256 of the trimmed url; without one, of ``source|title|instant``."""
    parts = [col_of(source), col_of(title), iso_instant(published_at)]
    fallback = F.concat_ws("|", *[F.coalesce(p, F.lit("null")) for p in parts])
    key = F.when(has_text(url), col_of(url)).otherwise(fallback)
    return sha256_id(java_trim(key))
