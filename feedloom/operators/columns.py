"""Column helpers on DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row, however often later steps use them.

    The optimizer copies a projected expression into every place that reads it, filters
    included, which repeats a JSON parse several times. A generator of exactly one row
    is not copied.
    """
    packed = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(packed)))
