"""Files of failed stream batches, kept until a later call has ingested them."""

from __future__ import annotations

import hashlib
import logging
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = logging.getLogger(__name__)

LETTERS = "landed_file STRING, batch_id STRING, ingested BOOLEAN, error STRING"
ERROR_CHARS = 2000

# Ingests the rows of some files under a batch id.
Ingest = Callable[[list[str], str], None]


class DeadLetters:
    """An append-only table of files that failed and, later, were ingested."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        try:
            return self.spark.read.schema(LETTERS).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return self.spark.createDataFrame([], LETTERS)
            raise

    def waiting(self) -> list[str]:
        """Files that failed and have not been ingested since, in order. One name a file, as the
        listing of a folder has."""
        states = self.read().groupBy("landed_file").agg(F.bool_or("ingested").alias("ingested"))
        return [r["landed_file"] for r in states.where("NOT ingested").orderBy("landed_file").collect()]

    def put(self, batch: DataFrame, batch_id: str, error: Exception) -> None:
        """Note the files of a failed batch."""
        files = batch.select("landed_file").distinct()
        rows = files.select(
            "landed_file",
            F.lit(batch_id).alias("batch_id"),
            F.lit(False).alias("ingested"),
            F.lit(str(error)[:ERROR_CHARS]).alias("error"),
        )
        rows.write.mode("append").parquet(self.path)

    def _done(self, files: list[str], batch_id: str) -> None:
        rows = [(f, batch_id, True, None) for f in files]
        self.spark.createDataFrame(rows, LETTERS).coalesce(1).write.mode("append").parquet(self.path)

    def retry(self, ingest: Ingest, name: str) -> list[str]:
        """Ingest all waiting files; those that fail again stay and are returned.

        Files are taken together. Should that fail, they are halved, so that a few bad files
        keep no others out and cost a number of runs that grows with the logarithm of all.
        """
        parts, failed = [self.waiting()], []
        while parts:
            files = parts.pop()
            if not files:
                continue
            batch_id = f"{name}-retry-{hashlib.md5(chr(10).join(files).encode()).hexdigest()}"
            try:
                ingest(files, batch_id)
            except Exception:
                LOG.exception("Files of a failed batch failed again: %d", len(files))
                if len(files) == 1:
                    failed += files
                else:
                    parts += [files[len(files) // 2 :], files[: len(files) // 2]]
                continue
            self._done(files, batch_id)
        return failed
