"""Tables in plain Parquet that change without being rewritten."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VERSION = T.StructField("_version", T.IntegerType())


def path_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def replace_part(rows: DataFrame, path: str, name: str, value: str | int) -> None:
    """Write ``rows`` as one part of a table. Writing the same part again replaces
    it, so a repeated job or micro-batch adds nothing twice."""
    (
        rows.withColumn(name, F.lit(value))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(name)
        .parquet(path)
    )


def read_parts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All parts of a table; empty if none was written."""
    try:
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    except AnalysisException as error:
        if not path_missing(error):
            raise
        return spark.createDataFrame([], schema)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders below a folder, by name; none if it is not there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not system.exists(folder):
        return []
    return sorted(f.getPath().toString() for f in system.listStatus(folder) if f.isDirectory())


class SnapshotTable:
    """A table as a full snapshot plus the rows changed since, in plain Parquet.

    Claiming ten links out of billions must not rewrite the table, so a change adds
    only the new images of the changed rows. Reading takes the newest image of each
    changed row, and the snapshot without those rows; filters and column lists still
    reach both scans. ``compact`` folds the changes into a new snapshot.

    A small table of versions names the folders that count. A job that dies before
    it adds its version leaves the table as it was. There is one writer at a time.
    Versions lie in one folder per snapshot, and only the newest folder is read, so
    what a compaction folded in is not looked at again.

    With ``part``, one of the key columns, the data lie in parts by its values, and a
    condition on it reads those parts only.
    """

    VERSIONS = "version long, kind string, path string"

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        key: Sequence[str] = ("id",),
        part: str | None = None,
    ):
        self._spark = spark
        self._root = root.rstrip("/")
        self._schema = schema
        self._key = list(key)
        if part and part not in self._key:
            raise ValueError(f"{part} is no key column")
        self._part = part

    def commit(self, df: DataFrame) -> None:
        """Make ``df`` the whole table."""
        self._add(df.select(*self._schema.names), "snapshot")

    def change(self, rows: DataFrame) -> None:
        """Replace the rows that have the keys of ``rows``; keys must be unique."""
        self._add(rows.select(*self._schema.names), "change")

    def compact(self) -> None:
        self.commit(self.read())

    def _add(self, df: DataFrame, kind: str) -> None:
        live = self._live()
        version = live[-1]["version"] + 1 if live else 1
        since = version if kind == "snapshot" or not live else live[0]["version"]
        path = f"{self._root}/data/v{version:08d}"
        rows = df.withColumn("_version", F.lit(version))
        if self._part:
            rows = rows.repartition(self._part).write.partitionBy(self._part)
        else:
            rows = rows.write
        rows.mode("overwrite").parquet(path)
        self._spark.createDataFrame([(version, kind, path)], self.VERSIONS).write.mode(
            "append"
        ).parquet(f"{self._root}/versions/since={since:08d}")

    def _live(self) -> list:
        """The newest snapshot and the changes after it; one small row per version."""
        for folder in reversed(child_folders(self._spark, f"{self._root}/versions")):
            # A job may have died before it wrote the first version of a folder.
            rows = sorted(self._spark.read.schema(self.VERSIONS).parquet(folder).collect())
            if rows:
                return rows
        return []

    def version(self) -> int:
        live = self._live()
        return live[-1]["version"] if live else 0

    def read(self, where: Column | None = None) -> DataFrame:
        """The rows of the table. ``where`` may ask for some keys only."""
        live = self._live()
        names = self._schema.names
        scan = self._spark.read.schema(T.StructType([*self._schema.fields, _VERSION]))

        def files(*paths: str) -> DataFrame:
            rows = [scan.parquet(p) for p in paths] if self._part else [scan.parquet(*paths)]
            found = reduce(DataFrame.unionByName, rows)
            return found if where is None else found.where(where)

        changed = [v["path"] for v in live if v["kind"] == "change"]
        if not live:
            return self._spark.createDataFrame([], self._schema)
        if not changed:
            return files(live[0]["path"]).select(*names)
        rest = [c for c in names if c not in self._key]
        newest = (
            files(*changed)
            .groupBy(*self._key)
            .agg(F.max(F.struct("_version", *rest)).alias("_row"))
            .select(*[c if c in self._key else F.col(f"_row.{c}").alias(c) for c in names])
        )
        if live[0]["kind"] == "change":
            return newest
        base = files(live[0]["path"]).select(*names)
        gone = newest.select(*[F.col(k).alias(f"_gone_{k}") for k in self._key])
        same = [F.col(k).eqNullSafe(F.col(f"_gone_{k}")) for k in self._key]
        return base.join(gone, same, "left_anti").unionByName(newest)
