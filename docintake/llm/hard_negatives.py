"""Operator 11: hard negatives by rotated one-bit codes.

A vector is rotated and kept as the signs of its components, a code, with its alignment: how
far the vector reaches along its code. What is left over is rotated and coded again, a few
times. An anchor's components are bytes in eight bit planes, so its product with a code is a
sum of popcounts, and its product with the vector is estimated by alignments times those.

**The interval is proven.** Left over after a code is a vector at right angles to it, of known
length, and of the anchor only the part at right angles to the code can reach it; by
Cauchy-Schwarz their product is at most the product of the two lengths. That, and what the
bytes round off, is how far the estimate can be wrong. Whoever cannot be among the wanted by
that goes; the next code halves the interval of those that stay; what remains after the last
is scored in integers. So results are exact, whatever the vectors.

Positives come first, as they fix what scores a negative may have. Rows and anchors are cut
into blocks of fixed sizes, every block of anchors meets every block of rows, and each pair of
blocks gives the few best per anchor; nothing else leaves it. Of equal vectors of one label
only the first ids can be among the best; the rest, a third of all rows say, are anchors at
most.

Defined results: rows with a null label, a null vector or a null or non-finite component take
no part; vectors of other lengths than the anchor's are not compared with it; a null id is
larger than any other and is no anchor; rows with the same id are rows of their own; products
that no long holds are given as the largest or smallest long; an empty table, or one without
anchors, gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docintake.llm.common import on_batches, ship_code, table, written

# Components are rounded down to so many parts of one.
PARTS = 256

POSITIVES = 5
NEGATIVES = 5

# A negative scores from 80 to 100 hundredths of the positive.
LOW, HIGH = 80, 100

# Codes of a vector; each shortens what is left over to about six tenths.
CODES = 4

# Rows and anchors that meet in one task at once.
ROW_BLOCK = 8192
ANCHOR_BLOCK = 4096

# Relative slack for the rounding of double precision, far above what it can be.
ROUNDING = 1e-9

LONGEST = 2**63 - 1


def width_of(dim: int) -> int:
    """Components after padding: a power of two, and whole words of 64 signs."""
    return max(64, 1 << max(0, dim - 1).bit_length())


@lru_cache(maxsize=16)
def signs(width: int, turn: int) -> np.ndarray:
    draw = np.random.default_rng([width, turn])
    return draw.integers(0, 2, (2, width)) * 2.0 - 1


def rotated(x: np.ndarray, turn: int) -> np.ndarray:
    """A fixed rotation of rows: twice random signs and a Walsh-Hadamard transform."""
    n, width = x.shape
    for sign in signs(width, turn):
        x = x * sign
        half = 1
        while half < width:
            pairs = x.reshape(n, -1, 2, half)
            x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2)
            half *= 2
        x = x.reshape(n, width) / np.sqrt(width)
    return x


def padded(vectors: np.ndarray) -> np.ndarray:
    out = np.zeros((len(vectors), width_of(vectors.shape[1])))
    out[:, : vectors.shape[1]] = vectors
    return out


def coded(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row its codes as words, its alignments, and the lengths of what is left over."""
    left = padded(vectors)
    n, width = left.shape
    codes = np.zeros((n, CODES, width // 64), np.uint64)
    aligned, over = np.zeros((n, CODES)), np.zeros((n, CODES))
    for turn in range(CODES):
        left = rotated(left, turn)
        up = left >= 0
        codes[:, turn] = np.packbits(up, axis=1, bitorder="little").view(np.uint64)
        aligned[:, turn] = np.abs(left).sum(1) / np.sqrt(width)
        left = left - aligned[:, turn, None] * np.where(up, 1.0, -1.0) / np.sqrt(width)
        over[:, turn] = np.linalg.norm(left, axis=1)
    return codes, aligned, over


class Asked:
    """An anchor in bytes: eight bit planes per rotation."""

    def __init__(self, vector: np.ndarray) -> None:
        turned = padded(vector[None])
        self.width = turned.shape[1]
        self.length = float(np.linalg.norm(turned))
        self.turns = []
        for turn in range(CODES):
            turned = rotated(turned, turn)
            x = turned[0]
            least, step = float(x.min()), float(x.max() - x.min()) / 255
            units = np.rint((x - least) / step) if step > 0 else np.zeros(self.width)
            near = least + step * units
            bits = units.astype(np.uint8)[None] >> np.arange(8, dtype=np.uint8)[:, None] & 1
            planes = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
            self.turns.append(
                (planes, least, step, near.sum(), np.linalg.norm(near), np.linalg.norm(x - near))
            )

    def along(self, turn: int, codes: np.ndarray) -> np.ndarray:
        """Products of the anchor in bytes with codes, by popcounts."""
        planes, least, step, total, _, _ = self.turns[turn]
        units = np.zeros(len(codes), np.int64)
        for bit, plane in enumerate(planes):
            units += np.bitwise_count(codes & plane).sum(1, dtype=np.int64) << bit
        set_ = np.bitwise_count(codes).sum(1, dtype=np.int64)
        return (2 * (least * set_ + step * units) - total) / np.sqrt(self.width)


class Block:
    """Rows of one dimension that anchors are compared with."""

    def __init__(self, rows: pa.Table) -> None:
        self.row = rows.column("row").to_numpy()
        ids = rows.column("vec_id")
        self.unknown = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int8)
        self.vec_id = ids.fill_null(0).to_numpy()
        self.label = rows.column("label").to_numpy()
        self.vectors = matrix(rows.column("vector"), np.int64)
        n, words = len(self.row), width_of(self.vectors.shape[1]) // 64
        self.codes = matrix(rows.column("codes"), np.uint64).reshape(n, CODES, words)
        measures = matrix(rows.column("measures"), np.float64).reshape(n, 2, CODES)
        self.aligned, self.over = measures[:, 0], measures[:, 1]
        self.length = np.linalg.norm(self.vectors.astype(np.float64), axis=1)
        self.largest = largest(self.vectors)

    def intervals(self, asked: Asked, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Least and largest possible products, code after code; takes what to go on with."""
        estimate, rounded = np.zeros(len(at)), np.zeros(len(at))
        for turn in range(CODES):
            *_, length, off = asked.turns[turn]
            along = asked.along(turn, self.codes[at, turn])
            estimate = estimate + self.aligned[at, turn] * along
            rounded = rounded + self.aligned[at, turn] * off
            beside = np.sqrt(np.maximum(length**2 - along**2, 0)) + off
            wide = rounded + beside * self.over[at, turn]
            wide = wide * (1 + ROUNDING) + ROUNDING * (asked.length * self.length[at] + 1)
            stay = yield estimate - wide, estimate + wide
            at, estimate, rounded = at[stay], estimate[stay], rounded[stay]

    def narrowed(self, asked: Asked, at: np.ndarray, wanted) -> np.ndarray:
        """Those of ``at`` that ``wanted``, asked after every code, does not rule out."""
        steps = self.intervals(asked, at)
        found = next(steps)
        for _ in range(CODES - 1):
            stay = wanted(*found)
            at = at[stay]
            if not len(at):
                return at
            found = steps.send(stay)
        return at[wanted(*found)]

    def scores(self, vector: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Integer products, exact; Python's integers where a long might not hold them."""
        others = self.vectors[at]
        bound = largest(vector) * self.largest * max(1, len(vector))
        if bound < 2**52:
            return (others.astype(np.float64) @ vector.astype(np.float64)).astype(np.int64)
        if bound < 2**62:
            return others @ vector
        return others.astype(object) @ vector.astype(object)

    def best(self, at: np.ndarray, scores: np.ndarray, most: int) -> np.ndarray:
        """Places in ``at`` of the first by score, then id."""
        if len(at) > 4 * most and scores.dtype != object:
            # Only those no worse than the last wanted one need an order.
            edge = np.partition(scores, len(scores) - most)[len(scores) - most]
            near = np.flatnonzero(scores >= edge)
        else:
            near = np.arange(len(at))
        of = at[near]
        down = -scores[near] if scores.dtype != object else np.array([-x for x in scores[near]])
        return near[np.lexsort((self.row[of], self.vec_id[of], self.unknown[of], down))[:most]]


def matrix(column: pa.ChunkedArray, kind) -> np.ndarray:
    """Binary values of one length as the rows of an array."""
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, kind).reshape(len(column), -1)


def as_long(scores: np.ndarray) -> list[int]:
    return [min(max(int(x), -LONGEST - 1), LONGEST) for x in scores]


def largest(x: np.ndarray) -> float:
    return float(np.abs(x.astype(np.float64)).max(initial=0))


def nth_largest(values: np.ndarray, n: int) -> float:
    if len(values) < n:
        return -np.inf
    return float(np.partition(values, len(values) - n)[len(values) - n])


def positives_of(rows: pa.Table, anchors: pa.Table, most: int) -> pa.Table:
    """The best rows of the same label in a block, for each anchor."""
    found: list[tuple] = []
    if rows.num_rows and anchors.num_rows:
        block = Block(rows.rename_columns(COLUMNS))
        of_label = {int(x): np.flatnonzero(block.label == x) for x in np.unique(block.label)}

        def wanted(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            return high >= nth_largest(low, most)

        for anchor in each(anchors):
            at = of_label.get(anchor["label"], np.zeros(0, np.int64))
            at = at[block.row[at] != anchor["row"]]
            if not len(at):
                continue
            vector = np.frombuffer(anchor["vector"], np.int64)
            at = block.narrowed(Asked(vector.astype(np.float64)), at, wanted)
            scores = block.scores(vector, at)
            take = block.best(at, scores, most)
            found += zip(
                [anchor["row"]] * len(take),
                block.row[at[take]].tolist(),
                ids_of(block, at[take]),
                as_long(scores[take]),
                strict=True,
            )
    return as_table(found, FOUND)


def negatives_of(rows: pa.Table, anchors: pa.Table, most: int, low: int, high: int) -> pa.Table:
    """The best rows of other labels in a block whose scores lie from ``low`` to ``high``
    hundredths of a positive's, for each anchor and score of a positive."""
    found: list[tuple] = []
    if rows.num_rows and anchors.num_rows:
        block = Block(rows.rename_columns(COLUMNS))
        others_of: dict[int, np.ndarray] = {}
        for anchor in each(anchors):
            label = anchor["label"]
            if label not in others_of:
                others_of = {label: np.flatnonzero(block.label != label)}
            ranges = [
                (p, -(-low * p // 100), high * p // 100)
                for p in anchor["positive_scores"]
                if low * p <= high * p
            ]
            at = others_of[label]
            if not ranges or not len(at):
                continue

            def wanted(least: np.ndarray, largest: np.ndarray, ranges=ranges) -> np.ndarray:
                stay = np.zeros(len(least), bool)
                for _, first, last in ranges:
                    inside = (least >= first) & (largest <= last)
                    edge = max(float(first), nth_largest(least[inside], most))
                    stay |= (largest >= edge) & (least <= last)
                return stay

            vector = np.frombuffer(anchor["vector"], np.int64)
            at = block.narrowed(Asked(vector.astype(np.float64)), at, wanted)
            scores = block.scores(vector, at)
            for p, first, last in ranges:
                within = np.flatnonzero((scores >= first) & (scores <= last))
                take = within[block.best(at[within], scores[within], most)]
                found += zip(
                    [anchor["row"]] * len(take),
                    [p] * len(take),
                    block.row[at[take]].tolist(),
                    ids_of(block, at[take]),
                    as_long(scores[take]),
                    strict=True,
                )
    return as_table(found, FOUND_FOR)


def ids_of(block: Block, at: np.ndarray) -> list[int | None]:
    return [
        None if u else int(i) for u, i in zip(block.unknown[at], block.vec_id[at], strict=True)
    ]


def each(anchors: pa.Table) -> Iterator[dict]:
    """Anchors as rows, those of one label after each other."""
    names = [c for c in anchors.column_names if c not in ("dim", "block", "turn")]
    return iter(anchors.select(names).sort_by("label").to_pylist())


COLUMNS = ["dim", "block", "turn", "row", "vec_id", "label", "vector", "codes", "measures"]
FOUND = "anchor long, row long, vec_id long, score long"
FOUND_FOR = "anchor long, positive_score long, row long, vec_id long, score long"


def as_table(found: list[tuple], fields: str) -> pa.Table:
    names = [f.split()[0] for f in fields.split(",")]
    columns = zip(*found, strict=True) if found else [[] for _ in names]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})


CODED = """row long, vec_id long, label long, anchor boolean, dim int, vector binary,
codes binary, measures binary"""


def code_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the codes of their vectors, a few thousand at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, 1024):
            part = batch.slice(start, 1024)
            vectors = [np.array(v, np.int64) for v in part.column("vector").to_pylist()]
            out: list[tuple] = [()] * len(vectors)
            for dim in {len(v) for v in vectors}:
                at = [i for i, v in enumerate(vectors) if len(v) == dim]
                same = np.stack([vectors[i] for i in at])
                codes, aligned, over = coded(same.astype(np.float64))
                measures = np.stack([aligned, over], 1)
                for k, i in enumerate(at):
                    out[i] = (dim, same[k].tobytes(), codes[k].tobytes(), measures[k].tobytes())
            dims, *binaries = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(c) for c in ("row", "vec_id", "label", "anchor")),
                    pa.array(dims, pa.int32()),
                    *(pa.array(b, pa.binary()) for b in binaries),
                ],
                ["row", "vec_id", "label", "anchor", "dim", "vector", "codes", "measures"],
            )


def usable(
    vectors: DataFrame, label: Column, anchor: Column, vec_id: str, embedding: str
) -> DataFrame:
    """``row, vec_id, label, anchor, vector`` of the rows that take part, in integers."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return (
        vectors.select(
            F.col(vec_id).cast("long").alias("vec_id"),
            label.cast("long").alias("label"),
            F.coalesce(anchor & F.col(vec_id).isNotNull(), F.lit(False)).alias("anchor"),
            F.col(embedding).cast("array<double>").alias("embedding"),
        )
        .where("label IS NOT NULL AND embedding IS NOT NULL")
        .where(finite)
        .select(
            F.monotonically_increasing_id().alias("row"),
            "vec_id",
            "label",
            "anchor",
            F.transform("embedding", lambda x: F.floor(x * PARTS).cast("long")).alias("vector"),
        )
    )


def mine(
    vectors: DataFrame,
    label: Column,
    anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    row_block: int = ROW_BLOCK,
    anchor_block: int = ANCHOR_BLOCK,
) -> DataFrame:
    """For each row that is an ``anchor`` and each of its ``positives`` nearest rows of its
    ``label``, the ``negatives`` nearest of other labels whose score is from ``low`` to ``high``
    hundredths of the positive's: ``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``."""
    spark = vectors.sparkSession
    ship_code(spark.sparkContext.applicationId)
    rows = on_batches(usable(vectors, label, anchor, vec_id, embedding), code_rows, CODED)
    rows = written(rows, "negative-codes")
    # One more than wanted, as the anchor itself may be among them.
    keep = max(positives, negatives) + 1
    same = Window.partitionBy("vector", "label").orderBy(F.col("vec_id").asc_nulls_last(), "row")
    kept = (
        rows.withColumn("place", F.row_number().over(same))
        .where(F.col("place") <= keep)
        .drop("place", "anchor")
    )
    kept = written(kept, "negative-rows")
    anchors = rows.where("anchor").drop("anchor")
    blocks = max(1, -(-kept.count() // row_block))
    turns = max(1, -(-anchors.count() // anchor_block))

    def dealt(side: DataFrame, own: str, own_parts: int, other: str, parts: int) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
        placed = side.withColumn(own, F.pmod(F.xxhash64("row"), F.lit(own_parts)).cast("int"))
        placed = placed.withColumn(other, every)
        names = [*COLUMNS, *(c for c in side.columns if c not in COLUMNS)]
        return placed.select(*names)

    key = ["dim", "block", "turn"]
    row_side = dealt(kept, "block", blocks, "turn", turns)
    # Both sides read the same rows; names given anew tell their columns apart.
    row_side = row_side.toDF(*key, *[f"_{c}" for c in COLUMNS[3:]])

    def met(asked: DataFrame, step, fields: str) -> DataFrame:
        asked = dealt(asked, "turn", turns, "block", blocks)
        return row_side.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(step, fields)

    first = F.col("score").desc(), F.col("vec_id").asc_nulls_last(), F.col("row")
    by_anchor = Window.partitionBy("anchor").orderBy(*first)
    best = (
        met(anchors, partial(positives_of, most=positives), FOUND)
        .withColumn("place", F.row_number().over(by_anchor))
        .where(F.col("place") <= positives)
        .select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    )
    best = written(best, "positives")
    scores = best.groupBy("anchor").agg(F.collect_set("positive_score").alias("positive_scores"))
    asked = anchors.join(scores.withColumnRenamed("anchor", "row"), "row")
    by_score = Window.partitionBy("anchor", "positive_score").orderBy(*first)
    step = partial(negatives_of, most=negatives, low=low, high=high)
    hard = (
        met(asked, step, FOUND_FOR)
        .withColumn("rank", F.row_number().over(by_score))
        .where(F.col("rank") <= negatives)
        .select(
            "anchor",
            "positive_score",
            "rank",
            F.col("vec_id").alias("negative_id"),
            F.col("score").alias("negative_score"),
        )
    )
    ids = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return (
        best.join(hard, ["anchor", "positive_score"])
        .join(ids, "anchor")
        .select(
            "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
        )
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``op11``: hard negatives of every 100th vector, after some labels were moved on."""
    vectors = table(spark, sf_dir, "embeddings")
    moved = (F.col("label").cast("long") + 1) % 10
    label = F.when(F.col("vec_id") % 7 == 0, moved).otherwise(F.col("label"))
    return mine(vectors, label, F.col("vec_id") % 100 == 0)


SQL = """
WITH r AS (
  SELECT vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id,
    list_inner_product(a.v, b.v)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)
    AS INTEGER) AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) <= 5
"""
