"""The local archive of processed links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docintake.schemas import ARCHIVE
from docintake.sources.tables import replace_part


def append_archive(rows: DataFrame, path: str, run_id: str) -> None:
    """Append rows with the time of writing.

    Each run owns one part of the archive.
    """
    replace_part(rows.withColumn("last_updated", F.current_timestamp()), path, "run_id", run_id)


def truncate_archive(spark: SparkSession, path: str) -> None:
    """Empty the archive but keep its schema."""
    spark.createDataFrame([], ARCHIVE).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).parquet(path)
