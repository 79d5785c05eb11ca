"""The whole way of a batch: load, record events, close.

The batch is kept as it was loaded, together with a log of its events; its state and
the archive rows are always derived from the two. Every step may be run again after
it failed: log and archive parts replace themselves, and a table changes only when
its new version is complete.

Loading and closing a batch change two tables. One record, the intent, is written first: it
names the versions that both tables have and the rows that go into them. Whoever comes next
after a crash does what the newest intent says and a table lacks, so both tables change or,
if the intent was not complete, neither does.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docintake.operators import batches, claims, patches, state
from docintake.schemas import EVENTS, LINKS
from docintake.sources.archive import append_archive
from docintake.sources.tables import SnapshotTable, child_folders, read_parts, replace_part

CLAIM, CLOSE = "claim", "close"
INTENT = "kind string, batch_version long, links_version long, rows string"

BATCH = T.StructType([*LINKS.fields, T.StructField("uncertainty", T.BooleanType())])


class Intake:
    """Link table, working batch, event logs and archive below one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark = spark
        self._root = root
        self.links = SnapshotTable(spark, f"{root}/links", LINKS)
        self.batch = SnapshotTable(spark, f"{root}/batch", BATCH)
        self.archive = f"{root}/archive"

    def start_batch(
        self,
        batch_size: int,
        seed: str,
        eligible: Callable[[], Column] = claims.wants_download,
    ) -> DataFrame:
        """Close the old batch, claim a new one, and give its ids and links. The
        result is empty when nothing could be claimed."""
        self.close_batch()
        picked = claims.pick(self.links.read(), eligible(), batch_size, seed)
        self._intend(CLAIM, picked.select(*LINKS.names))
        return self.batch.read().select("id", "pdf_link")

    def _intend(self, kind: str, rows: DataFrame) -> None:
        """Write down a change of both tables with its ``rows``, then make it."""
        path = f"{self._root}/intended/{uuid4().hex}"
        rows.write.parquet(path)
        intent = (kind, self.batch.version(), self.links.version(), path)
        number = len(child_folders(self._spark, f"{self._root}/intents"))
        self._spark.createDataFrame([intent], INTENT).coalesce(1).write.mode("overwrite").parquet(
            f"{self._root}/intents/{number:08d}"
        )
        self.recover()

    def recover(self) -> None:
        """Make what the newest intent names and a crash has left undone."""
        for folder in reversed(child_folders(self._spark, f"{self._root}/intents")):
            found = self._spark.read.schema(INTENT).parquet(folder).collect()
            if found:
                return self._make(found[0])
        return None

    def _make(self, intent: Row) -> None:
        rows = self._spark.read.schema(LINKS).parquet(intent["rows"])
        batch_waits = self.batch.version() == intent["batch_version"]
        links_wait = self.links.version() == intent["links_version"]
        if intent["kind"] == CLAIM:
            if batch_waits:
                self.batch.commit(batches.load(rows))
            if links_wait:
                self.links.change(rows.withColumn("status", F.lit(claims.IN_PROCESS)))
            return
        if links_wait:
            self.links.change(rows)
        if batch_waits:
            # The batch stays until all else is done, as its state is what is archived.
            self._archive()
            self.batch.commit(batches.empty_like(self.batch.read()))

    def _log(self) -> str:
        """Each loaded batch has a log of its own."""
        return f"{self._root}/events/batch-{self.batch.version():08d}"

    def record(self, events: DataFrame, run_id: str) -> None:
        """Add events to the log of the current batch."""
        replace_part(events.select(*EVENTS.names), self._log(), "run_id", run_id)

    def events(self) -> DataFrame:
        return read_parts(self._spark, self._log(), EVENTS)

    def state(self) -> DataFrame:
        return state.link_state(self.batch.read(), self.events())

    def close_batch(self) -> None:
        """Archive downloads and what is processed, release what was not touched,
        forget the rest."""
        self.recover()
        if self.batch.read().isEmpty():
            return
        waiting = batches.with_status(self.state(), state.UNPROCESSED)
        self._intend(CLOSE, patches.released(self.links.read(), waiting))

    def _archive(self) -> None:
        batch, run_id = self.batch.read(), f"batch-{self.batch.version():08d}"
        downloads = state.archive_on_download(batch, self.events())
        append_archive(
            downloads.select(*batches.ARCHIVE_COLUMNS).unionByName(
                batches.processed_archive(self.state())
            ),
            self.archive,
            run_id,
        )

    def merge(self, patch: DataFrame, ordinal: str = "ordinal") -> None:
        self.recover()
        self.links.change(
            patches.merge_patch(self.links.read(), patch, ordinal, changed_only=True)
        )
