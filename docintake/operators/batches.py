"""The working batch: loading, bulk transitions, closing, archiving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docintake.functions.urls import link_or_hash
from docintake.operators.claims import pick, wants_download
from docintake.operators.state import DONE, PROCESSED, UNPROCESSED
from docintake.schemas import ARCHIVE

# Everything that an archive row has but the time it was written.
ARCHIVE_COLUMNS = tuple(c for c in ARCHIVE.names if c != "last_updated")


def load(rows: DataFrame) -> DataFrame:
    """Fresh working rows: status unprocessed, nothing known about uncertainty."""
    return rows.withColumn("status", F.lit(UNPROCESSED)).withColumn(
        "uncertainty", F.lit(None).cast("boolean")
    )


def append(batch: DataFrame, rows: DataFrame) -> DataFrame:
    """Add rows as unprocessed; columns that one side lacks become NULL."""
    fresh = rows.withColumn("status", F.lit(UNPROCESSED))
    return batch.unionByName(fresh, allowMissingColumns=True)


def with_status(batch: DataFrame, status: str) -> DataFrame:
    return batch.where(F.col("status") == status)


def without_status(batch: DataFrame, status: str) -> DataFrame:
    """Drops exactly the named status; rows without a status stay."""
    return batch.where(~F.col("status").eqNullSafe(F.lit(status)))


def move_status(batch: DataFrame, old: str, new: str, url: str | None = None) -> DataFrame:
    """Move rows from one status to another, for one link or for all."""
    match = F.col("status") == old
    if url:
        match = match & (F.col("pdf_link") == url)
    return batch.withColumn("status", F.when(match, new).otherwise(F.col("status")))


def set_processed(batch: DataFrame) -> DataFrame:
    return move_status(batch, UNPROCESSED, PROCESSED)


def set_done(batch: DataFrame, url: str | None = None) -> DataFrame:
    return move_status(batch, PROCESSED, DONE, url)


def status_counts(batch: DataFrame) -> DataFrame:
    return batch.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def empty_like(batch: DataFrame) -> DataFrame:
    return batch.sparkSession.createDataFrame([], batch.schema)


def archive_rows(batch: DataFrame) -> DataFrame:
    return batch.withColumn("pg_id", F.col("id")).select(*ARCHIVE_COLUMNS)


def processed_archive(batch: DataFrame) -> DataFrame:
    """What closing a batch archives: every processed row."""
    return archive_rows(with_status(batch, PROCESSED))


def first_archive(batch: DataFrame, url: str) -> DataFrame:
    """What archiving one link archives: its first row, whatever its status."""
    return archive_rows(batch.where(F.col("pdf_link") == url).orderBy("id").limit(1))


def close_plan(batch: DataFrame) -> DataFrame:
    """What closing does to each row, in one pass without a shuffle.

    Processed rows are archived and done; unprocessed rows go back to the queue;
    rows in any other status are dropped and keep their queue status.
    """
    status = F.col("status")
    return batch.select(
        "id",
        "pdf_link",
        "status",
        F.when(status == PROCESSED, "archive")
        .when(status == UNPROCESSED, "release")
        .otherwise("drop")
        .alias("action"),
        F.when(status == PROCESSED, DONE).otherwise(status).alias("final_status"),
    )


def worklist(links: DataFrame, batch_size: int, seed: str) -> DataFrame:
    """The claimed links in the order they are worked through, as JSON records."""
    return pick(links, wants_download(), batch_size, seed).select(
        F.col("_turn").cast("int").alias("position"),
        "id",
        "pdf_link",
        link_or_hash(F.col("pdf_link")).alias("href"),
        F.to_json(F.struct("id", "pdf_link")).alias("record"),
    )


def up_to(rows: DataFrame, batch_size: int) -> DataFrame:
    """The part of a worklist that one run works through."""
    return rows.where(F.col("position") <= batch_size)
