"""Landed response bodies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import schemas


def raw_responses(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Raw bodies from a folder of JSON lines or Parquet; the schema is never inferred."""
    return spark.read.schema(schemas.RAW_RESPONSE).format(fmt).load(path)


def raw_response_stream(
    spark: SparkSession, path: str, fmt: str = "json", max_files: int | None = None
) -> DataFrame:
    """The same as a stream over new files of a landing folder.

    A body without a fetch time gets the time its file was written. ``landed_file`` names the file.
    """
    reader = spark.readStream.schema(schemas.RAW_RESPONSE).format(fmt)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _stamped(reader.load(path))


def landed_responses(spark: SparkSession, files: list[str], fmt: str = "json") -> DataFrame:
    """The same rows as the stream's, of the named files."""
    return _stamped(spark.read.schema(schemas.RAW_RESPONSE).format(fmt).load(files))


def _stamped(rows: DataFrame) -> DataFrame:
    written = F.col("_metadata.file_modification_time")
    # The path comes percent-encoded, readers want it plain; a plus sign stands for itself.
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return rows.withColumns({"fetched_at": F.coalesce("fetched_at", written), "landed_file": path})
