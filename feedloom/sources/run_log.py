"""The append-only table of run metrics.

A batch that has an id owns a folder below the log, named after it. Writing the batch again
replaces that folder's rows by the same rows, so replays change nothing, whatever state other
files of the log are in.
"""

from __future__ import annotations

import hashlib
import logging

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import schemas

LOG = logging.getLogger(__name__)


def append_metrics(metrics: DataFrame, path: str, batch_id: str | None = None) -> bool:
    """Append one row per source of a run, or write a batch's rows again. A failed write is logged,
    never raised."""
    rows = metrics.withColumn("batch_id", F.lit(batch_id).cast("string")).select(*schemas.RUN_METRICS.names)
    try:
        if batch_id is None:
            rows.write.mode("append").parquet(path)
        else:
            folder = f"batch-{hashlib.md5(batch_id.encode()).hexdigest()}"
            rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{folder}")
        return True
    except (PySparkException, Py4JJavaError, OSError) as error:
        LOG.error("Could not write run metrics to %s: %s", path, error)
        return False


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """All recorded rows. A missing log is empty; unreadable files are passed over."""
    try:
        reader = spark.read.schema(schemas.RUN_METRICS).options(ignoreCorruptFiles=True, recursiveFileLookup=True)
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schemas.RUN_METRICS)
        raise


def batch_recorded(spark: SparkSession, path: str, batch_id: str) -> bool:
    return not read_metrics(spark, path).filter(F.col("batch_id") == batch_id).isEmpty()


def metrics_history(metrics: DataFrame, *keys: str) -> DataFrame:
    """Time of the last run and number of recorded rows (per ``keys`` if given)."""
    return metrics.groupBy(*keys).agg(F.max("run_at").alias("last_run_at"), F.count(F.lit(1)).alias("runs"))
