"""Operator 4: shards along a Hilbert curve through several metadata dimensions.

Each dimension is cut into 2^bits cells of about equal numbers of rows, the cells of a row
are a point of a grid, and rows are sorted by the point's place on the curve. Runs of that
order are files and shards, so a file spans a small box of the grid and the minimum and
maximum that Parquet keeps of each column let a reader skip it on any of the dimensions.

Numbers are cut at quantiles, which are counted digit by digit over all rows. So are strings, by
the first seven bytes behind what all of them begin with. Rows in one cell are ordered by ``doc_id`` and text, so the
range partition also splits a cell that holds a third of all rows.

Defined results: nulls lie in the first cell of their dimension; a null text counts as
empty; rows with a null ``doc_id`` come first in their cell; repeated rows are all kept; an
empty table gives an empty result. All columns are kept; what this adds gets a name that
the table doesn't have.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from docintake.llm.common import fresh, table, whole_text
from docintake.session import scratch_path

DIMENSIONS = ("lang", "source", "n_chars")
BITS = 5
SHARDS = 40

# Bytes of every row besides its text.
ROW_BYTES = 16

# The grid has at most 2^16 cells, so the table of their places on the curve is small.
GRID_BITS = 16

# Values are cut by whole numbers of 36 bits, found in three digits.
CODE_BITS = 36
DIGIT_BITS = 12

WITHIN = (1 << 33) - 1


def curve_places(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points with ``bits`` bits in each dimension.

    The walk from the highest bit down turns and mirrors the sub-cube a point lies in;
    the Gray code of what results, read across dimensions, is the place.
    """
    x = [c.astype(np.int64) for c in cells.T]
    n = len(x)
    for bit in range(bits - 1, 0, -1):
        q, low = 1 << bit, (1 << bit) - 1
        for i in range(n):
            mirror = (x[i] & q) > 0
            swap = np.where(mirror, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(mirror, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[n - 1] & (1 << bit), (1 << bit) - 1, 0)
    place = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            place = place << 1 | ((x[i] ^ turn) >> bit & 1)
    return place


def common_start(low: str, high: str) -> int:
    n = 0
    while n < min(len(low), len(high)) and low[n] == high[n]:
        n += 1
    return n


def as_codes(docs: DataFrame, dimensions: Sequence[str]) -> dict[str, Column]:
    """Each dimension as a whole number of ``CODE_BITS`` bits in the same order, by its place
    between the smallest and the largest value."""
    text = [d for d in dimensions if not isinstance(docs.schema[d].dataType, NumericType)]
    plain = {d: F.col(d).cast("string" if d in text else "double") for d in dimensions}
    found = docs.agg(
        F.count(F.lit(1)),
        *[F.min(c).alias(f"<{d}") for d, c in plain.items()],
        *[F.max(c).alias(f">{d}") for d, c in plain.items()],
    ).first()
    codes = {}
    for d, value in plain.items():
        low, high = found[f"<{d}"], found[f">{d}"]
        if d in text:
            skip = common_start(low or "", high or "")
            value, low, high = (
                bytes_as_number(c, skip) for c in (value, F.lit(low), F.lit(high))
            )
        low, high = (F.lit(c).cast("double") if d not in text else c for c in (low, high))
        share = (value - low) / F.greatest(high - low, F.lit(1e-300))
        code = F.floor(share * float(1 << CODE_BITS))
        codes[d] = F.least(code, F.lit((1 << CODE_BITS) - 1)).cast("long")
    return codes


def bytes_as_number(text: Column, skip: int) -> Column:
    """The first seven bytes behind the first ``skip`` characters, as a number."""
    rest = F.substring(F.encode(F.substring(text, skip + 1, 7), "utf-8"), 1, 7)
    return F.conv(F.rpad(F.hex(rest), 14, "0"), 16, 10).cast("double")


def quantiles(docs: DataFrame, codes: dict[str, Column], parts: int) -> dict[str, list[int]]:
    """The codes at which ``parts`` parts of equally many rows end, for each dimension.

    Digit by digit, rows are counted whose leading digits are those of an edge, over all rows:
    at most ``parts`` times ``1 << DIGIT_BITS`` numbers of a dimension reach the driver.
    """
    every = F.array(
        *[F.struct(F.lit(k).alias("of"), c.alias("code")) for k, c in enumerate(codes.values())]
    )
    coded = docs.select(F.explode(every).alias("at")).select("at.*").where("code IS NOT NULL")
    # Per dimension the edges as (leading digits, rows still to pass behind those).
    edges: list[list[tuple[int, int]]] = [[] for _ in codes]
    for left in range(CODE_BITS - DIGIT_BITS, -1, -DIGIT_BITS):
        lead = F.shiftright("code", left + DIGIT_BITS)
        digit = F.shiftright("code", left).bitwiseAND((1 << DIGIT_BITS) - 1)
        counted = coded.select("of", lead.alias("lead"), digit.alias("digit"))
        if left + DIGIT_BITS < CODE_BITS:
            asked = F.lit(False)
            for k, of in enumerate(edges):
                asked |= (F.col("of") == k) & F.col("lead").isin(sorted({e[0] for e in of}))
            counted = counted.where(asked)
        counts: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for r in counted.groupBy("of", "lead", "digit").count().orderBy("digit").collect():
            counts.setdefault((r["of"], r["lead"]), []).append((r["digit"], r["count"]))
        if left + DIGIT_BITS == CODE_BITS:
            for k in range(len(codes)):
                rows = sum(n for _, n in counts.get((k, 0), []))
                edges[k] = [(0, -(-i * rows // parts)) for i in range(1, parts) if rows]
        for k, of in enumerate(edges):
            edges[k] = [further(*edge, counts[k, edge[0]]) for edge in of]
    return {d: sorted({e[0] for e in of}) for d, of in zip(codes, edges, strict=True)}


def further(lead: int, rows: int, counts: list[tuple[int, int]]) -> tuple[int, int]:
    """An edge with one more digit, and the rows to pass behind that."""
    for digit, n in counts:
        if rows <= n:
            break
        rows -= n
    return lead << DIGIT_BITS | digit, rows


def at_or_below(edges: Column, value: Column) -> Column:
    return F.size(F.filter(edges, lambda edge: edge <= value))


def cells(docs: DataFrame, dimensions: Sequence[str], bits: int) -> dict[str, Column]:
    """The cell of each dimension: the number of quantiles that lie at or below the value."""
    codes = as_codes(docs, dimensions)
    found = {}
    for d, cuts in quantiles(docs, codes, 1 << bits).items():
        edges = F.array(*[F.lit(c) for c in cuts]).cast("array<long>")
        found[d] = F.when(codes[d].isNull(), 0).otherwise(at_or_below(edges, codes[d]))
    return found


@dataclass(frozen=True)
class CurveFiles:
    """Files in curve order, and what the added columns are called."""

    path: str
    curve: str
    position: str

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)


def write_along_curve(
    docs: DataFrame,
    path: str,
    dimensions: Sequence[str] = DIMENSIONS,
    bits: int = BITS,
    runs: int | None = None,
) -> CurveFiles:
    """Write all columns of ``docs`` in curve order, one run per task; ``runs`` sets how
    many, otherwise Spark does."""
    if bits * len(dimensions) > GRID_BITS:
        raise ValueError(f"the grid may have {GRID_BITS} bits")
    spark, n = docs.sparkSession, len(dimensions)
    names = CurveFiles(path, fresh("curve", docs.columns), fresh("position", docs.columns))
    point = fresh("point", docs.columns)
    every = np.arange(1 << bits * n)
    grid = np.stack([every >> bits * (n - 1 - i) & ((1 << bits) - 1) for i in range(n)], 1)
    places = spark.createDataFrame(
        pd.DataFrame({point: every, names.curve: curve_places(grid, bits)}),
        f"`{point}` long, `{names.curve}` long",
    )
    code = F.lit(0).cast("long")
    for cell in cells(docs, dimensions, bits).values():
        code = code * (1 << bits) + cell
    order = [F.col(names.curve), F.col("doc_id").asc_nulls_first()]
    (
        docs.withColumn(point, code)
        .join(F.broadcast(places), point)
        .drop(point)
        .repartitionByRange(*([runs] if runs else []), *order, F.xxhash64("text"))
        .sortWithinPartitions(*order, F.xxhash64("text"), "text")
        .withColumn(names.position, F.monotonically_increasing_id())
        .write.parquet(path)
    )
    return names


@dataclass(frozen=True)
class Shards:
    """Rows with their shard and slot, and what those columns are called."""

    rows: DataFrame
    shard: str
    slot: str


def shards(spark: SparkSession, files: CurveFiles, n_shards: int = SHARDS) -> Shards:
    """The rows of the files in shards: runs whose sizes differ by one at most.

    A row's rank is its place in its run plus the rows of the runs before, of which there is
    one number per task that wrote.
    """
    read = files.read(spark)
    taken = list(read.columns)
    shard, slot, run, before, total, rank = (
        fresh(c, taken) for c in ("shard", "slot", "run", "before_run", "all_rows", "rank_of_row")
    )
    placed = read.withColumn(run, F.shiftright(F.col(files.position), 33))
    earlier = Window.orderBy(run).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(run).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    runs = placed.groupBy(run).agg(F.count(F.lit(1)).alias("rows"))
    runs = runs.select(
        run,
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias(before),
        F.sum("rows").over(whole).alias(total),
    )
    rank_of_row = F.col(before) + F.col(files.position).bitwiseAND(WITHIN)
    rows = (
        placed.join(F.broadcast(runs), run)
        .withColumn(rank, rank_of_row)
        .withColumn(shard, F.expr(f"int(`{rank}` * {n_shards} div `{total}`)"))
        .withColumn(
            slot, F.expr(f"`{rank}` - (`{shard}` * `{total}` + {n_shards - 1}) div {n_shards}")
        )
        .select(*taken, shard, slot)
    )
    return Shards(rows, shard, slot)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``op4``: the shard of each document and its slot there, read back from the files."""
    return digest(spark, table(spark, sf_dir, "documents"))


def digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    files = write_along_curve(docs, scratch_path(spark, "hilbert"))
    text, found = whole_text(), shards(spark, files)
    return found.rows.select(
        "doc_id",
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col(found.shard).alias("shard"),
        F.col(found.slot).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
