"""What the operators of this package share: given tables, word rules, sizes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space that ends a word (space and 0x09-0x0D).
BLANKS = ("\t", "\n", "\x0b", "\x0c", "\r")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text, ``[^\\x20\\x09-\\x0D]+``; none for null."""
    spaced = F.coalesce(text, F.lit(""))
    for blank in BLANKS:
        spaced = F.replace(spaced, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(spaced, " "), "")


def slices(batches: Iterator[pd.DataFrame], column: str, chars: int) -> Iterator[pd.DataFrame]:
    """Cut batches into runs of rows of about ``chars`` characters, so that memory follows the
    text and not the number of rows. A row is never cut."""
    for batch in batches:
        if not len(batch):
            continue
        sizes = batch[column].map(lambda t: len(t) if isinstance(t, str) else 0).cumsum() // chars
        yield from (run for _, run in batch.groupby(sizes.to_numpy(), sort=False))


def text_slices(batches: Iterator[pa.RecordBatch], column: int, chars: int) -> Iterator[pa.RecordBatch]:
    """The same runs of Arrow batches, which share the batch's memory. A null has no characters."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.utf8_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        run = np.cumsum(sizes, dtype=np.int64) // chars
        starts = np.flatnonzero(np.append(True, run[1:] != run[:-1])).tolist()
        for at, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            yield batch.slice(at, end - at)
