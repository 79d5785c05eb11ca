"""Operator 5: nearest neighbours by balanced posting lists.

Centroids come from a bounded sample by halving: a cluster is cut at the median between two
means, so all lists get equally many of the sample. A vector lies in the list of its nearest
centroid and, if others are hardly further, in theirs too, unless one it already lies in is
nearer to them than it is. Centroids are found by a walk on a graph that every task holds. A
query reads the lists whose centroid is not further than a ratio of the nearest one.

Equal vectors are one class, of which the first ids are all that can be among the nearest.
Lists are cut into parts by their size, and the queries of a list too, so no task holds more
than a part of each, whatever region of the space a third of all rows or queries lies in.

Defined results: vectors that are null, zero or hold null or non-finite components take no
part, nor do those of another dimension than most; rows with a null id take no part; of
repeated rows with the same id and vector one counts; an empty table gives an empty result.
A query gets fewer than ``k`` rows only where there are fewer candidates.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docintake.llm.common import on_batches, ship_code, table, written

K = 5
EVERY = 50

# Vectors that the centroids are fitted on, vectors to a list, and lists at most: centroids,
# their graph and one number per list are what the driver and every task hold.
SAMPLE = 16_384
LIST_SIZE = 100
MOST_LISTS = 2048

# Edges of a centroid and where walks start; a query's walk keeps one in so many centroids,
# but not fewer than the least, and the ratio below chooses among them.
EDGES = 16
ENTRIES = 16
KEPT_SHARE = 6
KEPT_LEAST = 64

# A vector goes to lists up to this ratio of its nearest distance, a query reads lists up
# to that one.
REPLICA_RATIO = 1.15
MOST_REPLICAS = 8
QUERY_RATIO = 1.3

# Vectors and queries of one part of a list.
PART = 2048

# Pairs of a query and a vector that are measured exactly at once.
PAIRS = 1 << 16


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one, in single precision; large components don't overflow."""
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)


def halved(vectors: np.ndarray, lists: int, draw: np.random.Generator) -> list[np.ndarray]:
    """Centroids of ``lists`` clusters of equal size, neighbours near each other."""
    if lists <= 1 or len(vectors) < 2:
        middle = vectors.mean(0)
        length = np.linalg.norm(middle)
        return [middle / length if length > 1e-6 else vectors[0]]
    means = vectors[draw.choice(len(vectors), 2, replace=False)].copy()
    for _ in range(6):
        near = (vectors @ (means[1] - means[0])) > 0
        if near.all() or not near.any():
            break
        means = np.stack([vectors[~near].mean(0), vectors[near].mean(0)])
        means /= np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-6)
    along = np.argsort(vectors @ (means[1] - means[0]), kind="stable")
    half = len(along) // 2
    return [
        *halved(vectors[along[:half]], lists // 2, draw),
        *halved(vectors[along[half:]], lists - lists // 2, draw),
    ]


@dataclass
class Index:
    """Centroids and the graph on them."""

    centroids: np.ndarray
    edges: np.ndarray
    entries: np.ndarray

    def nearest(self, queries: np.ndarray, kept: int) -> tuple[np.ndarray, np.ndarray]:
        """Up to ``kept`` near centroids of each query and their distances, nearest first.

        The walk takes the nearest centroid that it has not left yet to its neighbours, for
        all queries at once, until none that it keeps is left.
        """
        n, rows = len(queries), np.arange(len(queries))[:, None]
        kept = min(kept, len(self.centroids))
        seen = np.zeros((n, len(self.centroids)), bool)
        seen[:, self.entries] = True
        found = np.broadcast_to(self.entries, (n, len(self.entries)))
        close = queries @ self.centroids[self.entries].T
        left = np.zeros(found.shape, bool)
        while True:
            order = np.argsort(-close, axis=1, kind="stable")[:, :kept]
            found, close, left = found[rows, order], close[rows, order], left[rows, order]
            # Places that are not filled yet count as left.
            open_at = np.where(left | np.isinf(close), -np.inf, close)
            at = open_at.argmax(1)
            going = np.flatnonzero(np.isfinite(open_at[rows[:, 0], at]))
            if not len(going):
                return found, np.sqrt(np.maximum(2 - 2 * close, 0))
            left[going, at[going]] = True
            new = np.zeros((n, self.edges.shape[1]), np.int64)
            new_close = np.full(new.shape, -np.inf, np.float32)
            new[going] = self.edges[found[going, at[going]]]
            dots = np.einsum("qed,qd->qe", self.centroids[new[going]], queries[going])
            dots[seen[going[:, None], new[going]]] = -np.inf
            new_close[going] = dots
            seen[going[:, None], new[going]] = True
            found = np.concatenate([found, new], 1)
            close = np.concatenate([close, new_close], 1)
            left = np.concatenate([left, np.zeros(new.shape, bool)], 1)

    def lists_of(self, vectors: np.ndarray) -> list[list[int]]:
        """The lists of each vector, its own first."""
        found, far = self.nearest(vectors, EDGES)
        apart = np.sqrt(np.maximum(2 - 2 * self.centroids @ self.centroids.T, 0))
        chosen = []
        for near, distance in zip(found, far, strict=True):
            mine = [int(near[0])]
            for c, d in zip(near[1:].tolist(), distance[1:].tolist(), strict=True):
                if d > REPLICA_RATIO * distance[0] or len(mine) == MOST_REPLICAS:
                    break
                if all(apart[c, m] > d for m in mine):
                    mine.append(c)
            chosen.append(mine)
        return chosen

    def lists_to_read(self, queries: np.ndarray, own: np.ndarray, least: int) -> list[list[int]]:
        """The lists a query reads: near ones by ratio, and more until they hold ``least``
        vectors. ``own`` is how many vectors have each list as their first."""
        found, far = self.nearest(
            queries, max(KEPT_LEAST, len(self.centroids) // KEPT_SHARE)
        )
        chosen = []
        for i, (near, distance) in enumerate(zip(found, far, strict=True)):
            reads = near[distance <= QUERY_RATIO * distance[0] + 1e-6].tolist()
            if own[reads].sum() < least:
                by_distance = np.argsort(-(self.centroids @ queries[i]), kind="stable")
                enough = int(np.searchsorted(np.cumsum(own[by_distance]), least)) + 1
                reads = sorted({*reads, *by_distance[:enough].tolist()})
            chosen.append(reads)
        return chosen


def fit(sample: np.ndarray, lists: int) -> Index:
    """An index from unit vectors."""
    draw = np.random.default_rng(11)
    centroids = np.stack(halved(sample, min(lists, len(sample)), draw)).astype(np.float32)
    n = len(centroids)
    near = np.argsort(-(centroids @ centroids.T), axis=1, kind="stable")
    edges = near[:, 1 : EDGES + 1] if n > 1 else np.zeros((1, 1), np.int64)
    return Index(centroids, edges, np.unique(np.linspace(0, n - 1, ENTRIES).astype(np.int64)))


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``vec_id`` and ``embedding`` of the rows that take part."""
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(embedding).cast("array<double>").alias("embedding"),
    )
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0)).where(finite)
    rows = rows.where(F.exists("embedding", lambda x: x != 0))
    sizes = rows.groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.col("n").desc(), F.col("d").desc()).first()
    return rows.where(F.size("embedding") == (most["d"] if most else 0))


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = K,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """The ``k`` nearest found of each row of ``queries``, which are rows of ``vectors``
    too: ``query_id, rank, vec_id, score`` (cosine in double precision)."""
    spark = vectors.sparkSession
    ship_code(spark.sparkContext.applicationId)
    rows = usable(vectors, vec_id, embedding)
    asked = usable(queries, vec_id, embedding)

    # The first ids of every class of equal vectors; one more than asked, for the query's own.
    in_class = Window.partitionBy("embedding").orderBy("vec_id")
    firsts = (
        rows.distinct()
        .withColumn("place", F.row_number().over(in_class))
        .where(F.col("place") <= k + 1)
        .groupBy("embedding")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .withColumn("node", F.element_at("ids", 1))
    )
    firsts = written(firsts, "vector-classes")
    n = firsts.count()
    sample = firsts.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("embedding").toArrow()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    lists = min(MOST_LISTS, 1 << max(0, int(np.ceil(np.log2(max(1, n / LIST_SIZE))))))
    index = fit(unit(matrix(sample.column("embedding").combine_chunks())), lists)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                part = batch.slice(first, 1024)
                chosen = index.lists_of(unit(matrix(part.column("embedding"))))
                size = [len(c) for c in chosen]
                take = pa.array(np.repeat(np.arange(len(chosen)), size))
                own = [i == 0 for c in chosen for i in range(len(c))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([c for cs in chosen for c in cs], pa.int32()),
                        pa.array(own),
                        part.column("node").take(take),
                        part.column("embedding").take(take),
                    ],
                    ["list", "own", "node", "embedding"],
                )

    fields = "list int, own boolean, node long, embedding array<double>"
    posted = written(
        on_batches(firsts.select("node", "embedding"), post, fields), "posting-lists"
    )
    sizes = posted.groupBy("list").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("own").cast("long")).alias("own")
    )
    held = np.zeros((len(index.centroids), 2), np.int64)
    for row in sizes.collect():  # one row per list at most
        held[row["list"]] = row["n"], row["own"]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                part = batch.slice(first, 1024)
                asks = unit(matrix(part.column("embedding")))
                chosen = index.lists_to_read(asks, held[:, 1], k + 1)
                take = pa.array(np.repeat(np.arange(len(chosen)), [len(c) for c in chosen]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([c for cs in chosen for c in cs], pa.int32()),
                        part.column("query").take(take),
                        part.column("embedding").take(take),
                    ],
                    ["list", "query", "embedding"],
                )

    query_classes = written(
        asked.groupBy("embedding").agg(F.min("vec_id").alias("query")), "query-classes"
    )
    routed = written(
        on_batches(query_classes, route, "list int, query long, embedding array<double>"), "routes"
    )
    reads = np.zeros(len(index.centroids), np.int64)
    for row in routed.groupBy("list").count().collect():  # one row per list at most
        reads[row["list"]] = row["count"]

    parts = spark.createDataFrame(
        [
            (i, int(-(-size // PART)), int(-(-asks // PART)))
            for i, (size, asks) in enumerate(zip(held[:, 0], reads, strict=True))
            if size and asks
        ],
        "list int, parts int, turns int",
    )
    parts = F.broadcast(parts)  # one row per list at most
    left = (
        posted.join(parts, "list")
        .withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int"))
        .withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)))
        .select("list", "part", "turn", "node", "embedding")
    )
    right = (
        routed.join(parts, "list")
        .withColumn("turn", F.pmod(F.xxhash64("query"), "turns").cast("int"))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("list", "part", "turn", "query", "embedding")
    )

    def scan(own: pa.Table, asks: pa.Table) -> pa.Table:
        schema = pa.schema([("query", pa.int64()), ("node", pa.int64()), ("score", pa.float64())])
        if not own.num_rows or not asks.num_rows:
            return schema.empty_table()
        nodes, queries = own.column("node").to_numpy(), asks.column("query").to_numpy()
        v = matrix(own.column("embedding").combine_chunks())
        q = matrix(asks.column("embedding").combine_chunks())
        order = np.argsort(nodes, kind="stable")
        nodes, v = nodes[order], v[order]
        close = unit(q) @ unit(v).T
        # All go on to the exact measure that may be among the best by it.
        most = min(k + 1, len(nodes))
        last = np.partition(close, len(nodes) - most, axis=1)[:, len(nodes) - most]
        maybe = close >= (last - 2 * single_error(v.shape[1]))[:, None]
        columns = []
        for turn in turns(maybe.sum(1)):
            at, of = np.nonzero(maybe[turn])
            at += turn.start
            exact = cosine(q[at], v[of])
            order = np.lexsort((nodes[of], -exact, at))
            at, of, exact = at[order], of[order], exact[order]
            # Rows of a query stand together; its first ones are its best.
            chosen = np.arange(len(at)) - np.searchsorted(at, at) < most
            columns.append((queries[at[chosen]], nodes[of[chosen]], exact[chosen]))
        return pa.Table.from_arrays(
            [pa.array(np.concatenate(c)) for c in zip(*columns, strict=True)], schema=schema
        )

    key = ["list", "part", "turn"]
    scanned = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        scan, "query long, node long, score double"
    )
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "node")
    of_class = (
        scanned.groupBy("query", "node")
        .agg(F.max("score").alias("score"))
        .withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= k + 1)
    )
    by_id = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    candidates = (
        of_class.join(firsts.select("node", "ids"), "node")
        .select("query", "score", F.explode("ids").alias("vec_id"))
        .withColumn("place", F.row_number().over(by_id))
        .where(F.col("place") <= k + 1)
        .select("query", "score", "vec_id")
    )
    # A query class may hold many queries; their vectors name it.
    of_query = asked.distinct().join(query_classes, "embedding").select(
        F.col("vec_id").alias("query_id"), "query"
    )
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        of_query.join(candidates, "query")
        .where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def single_error(dimension: int) -> float:
    """How far a dot product of two ``unit`` vectors can be from their ``cosine``.

    Rounding both vectors and summing ``dimension`` products in any order is off by at most
    ``gamma(dimension + 2)`` times the sum of the products' sizes, which is at most one; two
    more units stand for the double precision and for ``last - error`` in single precision,
    and the last term for components too small for single precision.
    """
    steps = (dimension + 4) * 2.0**-24
    return steps / (1 - steps) + dimension * 2.0**-125


def turns(sizes: np.ndarray) -> Iterator[slice]:
    """Runs of queries whose candidates together are at most ``PAIRS``, or one query."""
    first = pairs = 0
    for i, size in enumerate(sizes.tolist()):
        if i > first and pairs + size > PAIRS:
            yield slice(first, i)
            first, pairs = i, 0
        pairs += size
    yield slice(first, len(sizes))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows in double precision, row by row, so equal rows give equal values."""
    a = a / np.abs(a).max(1, keepdims=True)
    b = b / np.abs(b).max(1, keepdims=True)
    dots = np.einsum("ij,ij->i", a, b)
    return dots / np.sqrt(np.einsum("ij,ij->i", a, a) * np.einsum("ij,ij->i", b, b))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``op5``: the five nearest of every 50th vector."""
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where(F.col("vec_id") % EVERY == 0))
