"""Files and finished downloads as streams."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from docintake.functions.urls import base_name
from docintake.operators.browser import download_states
from docintake.session import materialize
from docintake.sources.tables import SnapshotTable
from docintake.streaming.jobs import ONCE, log_sink, start, table_sink

LEDGER = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("sha256", T.StringType()),
        T.StructField("modified", T.TimestampType()),
    ]
)


def ledger_table(spark: SparkSession, root: str) -> SnapshotTable:
    return SnapshotTable(spark, root, LEDGER, ("path",))


def stream_ledger(
    files: DataFrame, table: SnapshotTable, checkpoint: str, trigger: Mapping[str, object] = ONCE
) -> StreamingQuery:
    """Keep a ledger of arrived files: one row per file, with its length and the digest of its
    content as last written.

    The state of the stream is the newest version of each file, so a file that is listed again
    changes nothing. ``files`` is a ``file_stream`` with digests. Spark's file source names a path
    once; ``relist`` finds the files that were written again since.
    """
    version = F.struct("modificationTime", "length", "sha256")
    newest = files.groupBy("path", "name").agg(F.max(version).alias("newest"))
    rows = newest.select(
        "path",
        "name",
        "newest.length",
        "newest.sha256",
        F.col("newest.modificationTime").alias("modified"),
    )
    return start(rows, table_sink(table), checkpoint, "update", trigger)


def relist(spark: SparkSession, folder: str, table: SnapshotTable) -> None:
    """Bring the ledger up to what the folder holds now: files that were written again, and any
    that no stream has named, replace or add their rows. Running it twice changes nothing.

    Listing reads no content. Only files as old as those that are new to the ledger are read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(folder)
    seen = table.read().select("path", "length", F.col("modified").alias("modificationTime"))
    listed = files.select("path", "length", "modificationTime")
    new = materialize(listed.join(seen, listed.columns, "left_anti"), "listed")
    since, until = new.agg(F.min("modificationTime"), F.max("modificationTime")).first()
    if since is None:
        return
    read = files.where(F.col("modificationTime").between(since, until)).select(
        "path",
        base_name(F.col("path")).alias("name"),
        "length",
        F.sha2("content", 256).alias("sha256"),
        F.col("modificationTime").alias("modified"),
    )
    table.change(read.join(new.select("path"), "path", "left_semi"))


def completed_items(
    changes: DataFrame, items: DataFrame, late: str = "1 hour", apart: str = "1 hour"
) -> DataFrame:
    """The items of downloads that have completed, where both come as streams.

    ``changes`` have ``download_id, state, changed_at``, ``items`` have ``download_id`` and
    ``listed_at``; either may come first. Both wait for the other for as long as it may be
    ``apart`` in time and ``late`` in coming, and then leave the state.
    """
    done = download_states(changes, "complete").select(
        F.col("download_id").alias("_done"), "changed_at"
    )
    done = done.withWatermark("changed_at", late)
    wait = F.expr(f"INTERVAL {apart}")
    near = (F.col("changed_at") >= F.col("listed_at") - wait) & (
        F.col("changed_at") <= F.col("listed_at") + wait
    )
    listed = items.withWatermark("listed_at", late)
    return listed.join(done, (F.col("download_id") == F.col("_done")) & near, "left_semi")


def stream_completed_items(
    changes: DataFrame,
    items: DataFrame,
    path: str,
    checkpoint: str,
    late: str = "1 hour",
    apart: str = "1 hour",
    trigger: Mapping[str, object] = ONCE,
) -> StreamingQuery:
    """Log the items of completed downloads, each once."""
    return start(completed_items(changes, items, late, apart), log_sink(path), checkpoint, trigger=trigger)
