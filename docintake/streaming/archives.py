"""Archive rows as a stream keeps them.

An archive row shows its link just after a download, so a late download changes the rows of the
downloads after it. The table has one row per download, in parts by the hash of its link. An
epoch reads the rows of the links that it brings downloads of, from their parts only, works them
out anew together with the new ones, and replaces them. A download that comes again, or an epoch
that runs again, replaces its row by the same one.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from docintake.operators.batches import ARCHIVE_COLUMNS
from docintake.operators.state import DOWNLOAD, ORDER, archive_on_download, writing_events
from docintake.schemas import ARCHIVE
from docintake.session import materialize
from docintake.sources.tables import SnapshotTable
from docintake.streaming.jobs import ONCE, start, table_sink

# Parts of the table, by the hash of the link.
PARTS = 64


def part_of(link: Column, parts: int = PARTS) -> Column:
    return F.pmod(F.xxhash64(link), F.lit(parts)).cast("int")


class ArchiveStore:
    """Downloads with the archive rows that they make."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        events: T.StructType,
        order: Sequence[str] = ORDER,
        parts: int = PARTS,
    ):
        self.order, self.parts = list(order), parts
        self.given = list(
            dict.fromkeys([*order, "pdf_link", "kind", "pred", "filename", "tag_json"])
        )
        self.made = [c for c in ARCHIVE_COLUMNS if c != "pdf_link"]
        schema = T.StructType(
            [
                T.StructField("part", T.IntegerType()),
                *[events[c] for c in self.given],
                T.StructField("archived", T.BooleanType()),
                *[ARCHIVE[c] for c in self.made],
            ]
        )
        self.table = SnapshotTable(spark, root, schema, ("part", *self.order), part="part")

    def read(self) -> DataFrame:
        """The archive rows, with the stamp of their download."""
        rows = self.table.read().where("archived")
        return rows.select(*dict.fromkeys([*self.order, *ARCHIVE_COLUMNS]))

    def take(self, events: DataFrame, batch: DataFrame) -> DataFrame:
        """The rows of the links that ``events`` bring downloads of, with those downloads."""
        downloads = writing_events(events).where(F.col("kind") == DOWNLOAD)
        new = downloads.select(part_of(F.col("pdf_link"), self.parts).alias("part"), *self.given)
        new = materialize(new.dropDuplicates(["part", *self.order]), "new-downloads")
        touched = [r["part"] for r in new.select("part").distinct().collect()]  # few parts
        links = new.select("pdf_link").distinct()
        known = self.table.read(F.col("part").isin(touched)).select("part", *self.given)
        known = known.join(links, "pdf_link", "left_semi")
        known = known.join(new.select("part", *self.order), ["part", *self.order], "left_anti")
        theirs = materialize(known.select("part", *self.given).union(new), "touched-downloads")
        rows = archive_on_download(batch, theirs.drop("part"), order=self.order)
        rows = rows.select(*self.order, F.lit(True).alias("archived"), *self.made)
        joined = theirs.join(rows, self.order, "left")
        return joined.withColumn("archived", F.coalesce("archived", F.lit(False)))


def stream_archive(
    events: DataFrame,
    batch: Callable[[], DataFrame],
    store: ArchiveStore,
    checkpoint: str,
    trigger: Mapping[str, object] = ONCE,
) -> StreamingQuery:
    """Keep one archive row per download of a link of the batch. ``batch`` gives the batch as it
    was loaded, and is read in each epoch."""
    write = table_sink(store.table)

    def sink(rows: DataFrame, epoch: int) -> None:
        write(store.take(rows, batch()), epoch)

    return start(events, sink, checkpoint, trigger=trigger)
