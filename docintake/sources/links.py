"""The link table: JDBC in production, versioned Parquet elsewhere."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from docintake.schemas import ARCHIVE, LINKS
from docintake.sources.tables import SnapshotTable


@dataclass(frozen=True)
class Environment:
    """Where one working environment keeps its tables."""

    link_snapshots: str | None = None
    jdbc: Mapping[str, str] = field(default_factory=dict)
    archive: str | None = None


def choose(environments: Mapping[str, Environment], name: str) -> Environment:
    if name not in environments:
        raise ValueError(f"unknown working environment: {name}")
    return environments[name]


def read_jdbc(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    lower: int,
    upper: int,
    partitions: int,
) -> DataFrame:
    """Read the link table over JDBC, split by id. Filters reach the database."""
    return (
        spark.read.format("jdbc")
        .options(**options)
        .option("dbtable", table)
        .option("partitionColumn", "id")
        .option("lowerBound", str(lower))
        .option("upperBound", str(upper))
        .option("numPartitions", str(partitions))
        .load()
    )


def read_links(
    spark: SparkSession, environment: Environment, **jdbc_split: int
) -> DataFrame:
    if environment.link_snapshots:
        return SnapshotTable(spark, environment.link_snapshots, LINKS).read()
    return read_jdbc(spark, environment.jdbc, "pdf_links", **jdbc_split)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ARCHIVE).parquet(path)
