"""CSV files: human labels, the document dataset, and exports of the link table."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docintake.schemas import DATASET_CSV, EXPORT_COLUMNS, LABEL_CSV

# Fixed value: rows of a limited snapshot.
SNAPSHOT_ROWS = 5000

# Many part files of limited size can be read back in parallel even though a file
# with line breaks inside quotes cannot be split.
ROWS_PER_FILE = 1_000_000

_FORMAT = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

# What pandas takes as missing when it reads a CSV file.
MISSING = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def _read(
    spark: SparkSession, path: str, schema: T.StructType, empty: str, multi_line: bool
) -> DataFrame:
    """``multi_line`` allows line breaks inside quotes; then a file cannot be split."""
    return (
        spark.read.schema(schema)
        .options(**_FORMAT, emptyValue=empty, multiLine=multi_line, enforceSchema="true")
        .csv(path)
    )


def _without(rows: DataFrame, missing: Sequence[str]) -> DataFrame:
    text = [f.name for f in rows.schema if isinstance(f.dataType, T.StringType)]
    quoted = {c: F.col(f"`{c}`") for c in text}
    return rows.withColumns(
        {c: F.when(~v.isin(list(missing)), v) for c, v in quoted.items()} if missing else quoted
    )


def read_labels(
    spark: SparkSession,
    path: str,
    missing: Sequence[str] = MISSING,
    multi_line: bool = False,
) -> DataFrame:
    """The label file; its first column is only an index. Fields that hold one of the
    words in ``missing`` read as NULL."""
    return _without(_read(spark, path, LABEL_CSV, "", multi_line).drop("_index"), missing)


def read_dataset(
    spark: SparkSession,
    path: str,
    missing: Sequence[str] = MISSING,
    multi_line: bool = False,
) -> DataFrame:
    return _without(_read(spark, path, DATASET_CSV, "", multi_line), missing)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.options(
        **_FORMAT, emptyValue='""', maxRecordsPerFile=str(ROWS_PER_FILE)
    ).csv(path)


def export_links(links: DataFrame, path: str) -> None:
    """All rows, with the exported columns only."""
    write_csv(links.select(*EXPORT_COLUMNS), path)


def export_snapshot(table: DataFrame, path: str, key: str, rows: int = SNAPSHOT_ROWS) -> None:
    """The first rows by key, with every column. The limit is the feature here."""
    write_csv(table.orderBy(key).limit(rows), path)


def import_snapshot(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of an export; a quoted empty field is '' and a bare one NULL.

    While a file is read, a word made up for this call stands for the quoted empty field.
    Exports may hold line breaks, and their files have a limited size.
    """
    empty = f"\u0001{uuid.uuid4().hex}"
    rows = _read(spark, path, schema, empty, multi_line=True)
    text = [f.name for f in schema if isinstance(f.dataType, T.StringType)]
    return rows.withColumns(
        {c: F.when(F.col(c) == empty, "").otherwise(F.col(c)) for c in text}
    )
