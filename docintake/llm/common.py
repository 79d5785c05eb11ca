"""What the operators of this subpackage share: tables, scratch folders, Arrow batches."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docintake.session import scratch_path

# Python workers cut their input into chunks of about this many bytes of text, so that
# their arrays stay within some tens of megabytes whatever the Arrow batch holds.
CHUNK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder, compressed, and read it back."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@lru_cache(maxsize=8)
def ship_code(app: str) -> None:
    """Send this package to the Python workers of an application, once.

    The archive is made on the driver; Spark itself hands it to the executors.
    """
    package = Path(__file__).parent.parent
    archive = os.path.join(tempfile.mkdtemp(prefix="docintake-code-"), "docintake.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    SparkSession.active().sparkContext.addPyFile(archive)


def on_batches(df: DataFrame, step: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` for functions of this package."""
    ship_code(df.sparkSession.sparkContext.applicationId)
    return df.mapInArrow(step, schema)


def fresh(name: str, taken: Iterable[str]) -> str:
    """``name``, with underscores before it until no column is called so."""
    lowered = {c.lower() for c in taken}
    while name.lower() in lowered:
        name = f"_{name}"
    return name


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without gaps, and where each text starts and ends."""
    column = column.fill_null("") if column.null_count else column
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1]
    bounds = bounds.astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def chunks(
    batches: Iterator[pa.RecordBatch], text: str = "text", most: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches with about ``most`` bytes of text; a longer text is one slice."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, bounds = texts_of(batch.column(text))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(bounds, bounds[first] + most, "right")) - 1
            last = max(first + 1, min(last, batch.num_rows))
            yield batch.slice(first, last - first)
            first = last


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of many runs, one after the other: starts[0], starts[0] + 1, ..."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)


def binary_array(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A large binary column out of bytes that lie one after the other."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), buffers).cast(pa.binary())


def arrow_schema(spark: SparkSession, fields: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], fields).schema)
