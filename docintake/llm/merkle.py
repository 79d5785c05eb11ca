"""Operator 12: a Merkle manifest of a dataset as a postorder append log.

Every row of a dataset is a leaf: the hash of its fields. The leaves of a source, in the order
of ``doc_id``, are a tree; while several nodes remain, runs of three become their hash. The
roots of the sources, in the order of the sources' bytes, are the leaves of one more tree, whose
root stands for the dataset.

**The log.** Nodes are numbered in the order in which they are complete: a node follows its
last child at once. When leaf ``e`` is complete there are ``e`` leaves before it and, of every
level ``k``, the ``floor(e / 3^k)`` nodes whose subtrees have ended. So the place of node ``i``
of level ``k`` above ``n`` leaves is known without looking: with ``e = min((i + 1) * 3^k, n) - 1``,
its last leaf, it is ``e + floor(e / 3) + floor(e / 9) + ... + k``. Builders are aligned: each
takes 3^6 leaves, a whole subtree, and appends its nodes as one run, a row of its ``first``
place and its ``digests`` of 32 bytes. The roots of builders are the leaves of the next round,
whose runs are a log of their own, of the tree above; so a node is addressed by its round and
its place there.

**Proofs** go the other way. A builder cuts the siblings of its leaves out of its run, by their
places, and puts those before what its own root was given by the round above.

A leaf's number in its tree comes from a range partition by source, id and hash, and from the
rows that earlier slices hold; so a source with a third of all rows, or one row repeated as
often, is many slices and many builders.

Defined results: a null field has a hash input of its own (``-``), unlike an empty one; a null
source comes before all others, a null ``doc_id`` before all others of its source; rows that
agree in both are ordered by their hash, and equal rows are leaves of their own; an empty table
has no tree and gives an empty result. Long texts are hashed whole, where they are read.
Columns other than the five fields are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docintake.llm.common import on_batches, table, written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

# Nodes in a run that become one, and levels of a builder: it has 3^6 leaves.
ARITY = 3
LEVELS = 6
LEAVES = ARITY**LEVELS
DIGEST = 32

# Rows that a worker hands back at once.
ROWS = 2048


def hash_of(digests: Sequence[bytes]) -> bytes:
    """The hash of digests, each as hex text."""
    return sha256(b"".join(digests).hex().encode("ascii")).digest()


def height(n: int) -> int:
    """Levels above ``n`` leaves until one node is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def place(level: int, index: int, n: int) -> int:
    """The place in the log of node ``index`` on ``level`` of a tree of ``n`` leaves."""
    last = min((index + 1) * ARITY**level, n) - 1
    at, ended = last + level, last // ARITY
    while ended:
        at, ended = at + ended, ended // ARITY
    return at


def subtree(leaves: Sequence[bytes], n: int) -> list[list[bytes]]:
    """The levels that an aligned builder makes of its leaves, in a tree of ``n`` leaves."""
    levels = [list(leaves)]
    for _ in range(min(LEVELS, height(n))):
        below = levels[-1]
        levels.append([hash_of(below[i : i + ARITY]) for i in range(0, len(below), ARITY)])
    return levels


def places_of(builder: int, width: int, n: int) -> list[range | list[int]]:
    """For every level of a builder with ``width`` leaves, the places of its nodes in its run."""
    first, start = builder * LEAVES, place(0, builder * LEAVES, n)
    found = []
    for level in range(min(LEVELS, height(n)) + 1):
        step = ARITY**level
        nodes = range(first // step, first // step + -(-width // step))
        found.append([place(level, i, n) - start for i in nodes])
    return found


def in_run(levels: Sequence[Sequence[bytes]], builder: int, n: int) -> bytes:
    """The nodes of a builder in the order in which they are complete."""
    run = [b""] * sum(map(len, levels))
    for nodes, at in zip(levels, places_of(builder, len(levels[0]), n), strict=True):
        for digest, i in zip(nodes, at, strict=True):
            run[i] = digest
    return b"".join(run)


def fold(leaf: bytes, siblings: bytes, shape: bytes) -> bytes:
    """The root that ``leaf`` leads to. ``siblings`` are digests level by level; ``shape`` has
    one byte per level, three times the number of those on the left plus those on the right."""
    at = 0
    for code in shape:
        left, right = code // 3 * DIGEST, code % 3 * DIGEST
        before, after = siblings[at : at + left], siblings[at + left : at + left + right]
        leaf = hash_of((before, leaf, after))
        at += left + right
    return leaf


def field(value: Column) -> Column:
    """A field as the hash takes it: its length in bytes and its value, or a dash."""
    value = value.cast("string")
    sized = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
    return F.coalesce(sized, F.lit("-"))


def leaf_hash(**replaced: Column) -> Column:
    """The leaf of a row as bytes, where some fields may be ``replaced``."""
    values = [field(replaced.get(c, F.col(c))) for c in FIELDS]
    return F.unhex(F.sha2(F.concat(*values).cast("binary"), 256))


def ranked(rows: DataFrame, key: str, order: Sequence[str], label: str) -> DataFrame:
    """``rows`` with ``idx``, the place of each among the rows of equal ``key``, ``n``, how many
    those are, ``tree``, the place of the key among all keys, and ``trees``, how many those are.

    A range partition cuts keys of any size into slices, if ``order`` tells their rows apart.
    Rows are numbered as they stand in their slice; a slice starts behind the rows before it.
    """
    sorting = [F.col(c).asc_nulls_first() for c in (key, *order)]
    slices = written(
        rows.repartitionByRange(*sorting)
        .sortWithinPartitions(*sorting)
        .withColumn("_at", F.monotonically_increasing_id()),
        label,
    ).withColumn("_slice", F.shiftright("_at", 33))
    # One row per key and slice that holds it.
    counts = written(
        slices.groupBy(F.col(key).alias("_key"), "_slice").agg(
            F.count(F.lit(1)).alias("here"), F.min("_at").alias("_from")
        ),
        f"{label}-slices",
    )
    of_key = Window.partitionBy("_key")
    earlier = of_key.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # Keys come in the order of the slices: that of the first row of each.
    firsts = counts.groupBy("_key").agg(F.min("_from").alias("_first"))
    by_slice = Window.partitionBy("_begins").orderBy("_first")
    begun = firsts.withColumn("_begins", F.shiftright("_first", 33))
    # One row per slice.
    per_slice = begun.groupBy("_begins").agg(F.count(F.lit(1)).alias("keys"))
    before = Window.orderBy("_begins").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_begins").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    offsets = per_slice.select(
        "_begins",
        F.coalesce(F.sum("keys").over(before), F.lit(0)).alias("_keys"),
        F.sum("keys").over(whole).alias("trees"),
    )
    numbered = (
        begun.join(offsets, "_begins")
        .withColumn("tree", F.col("_keys") + F.row_number().over(by_slice) - 1)
        .select(F.col("_key").alias("_of"), F.col("tree").cast("long").alias("tree"), "trees")
    )
    starts = counts.select(
        "_key",
        F.col("_slice").alias("_in"),
        (F.coalesce(F.sum("here").over(earlier), F.lit(0)) - F.col("_from")).alias("_shift"),
        F.sum("here").over(of_key).alias("n"),
    )
    starts = starts.join(numbered, F.col("_key").eqNullSafe(F.col("_of")))
    same = slices[key].eqNullSafe(starts["_key"]) & (slices["_slice"] == starts["_in"])
    idx = (F.col("_at") + F.col("_shift")).alias("idx")
    return slices.join(starts, same).select(*rows.columns, idx, "n", "tree", "trees")


def grouped(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """The rows of equal ``keys``, which stand together, also where a batch ends among them."""
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        change = np.zeros(batch.num_rows - 1, bool)
        for column in columns:
            change |= column[1:] != column[:-1]
        edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for start, end in zip(edges[:-1], edges[1:], strict=True):
            key = tuple(int(c[start]) for c in columns)
            if held and key != held_key:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            held_key = key
    if held:
        yield pa.Table.from_batches(held)


RUN = "tree long, builder long, n long, first long, digests binary"


def build_runs(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Sorted leaves ``tree, builder, idx, n, digest`` become one run per builder."""
    rows: list[tuple] = []
    for group in grouped(batches, "tree", "builder"):
        tree, builder, n = (group.column(c)[0].as_py() for c in ("tree", "builder", "n"))
        levels = subtree(group.column("digest").to_pylist(), n)
        rows.append((tree, builder, n, place(0, builder * LEAVES, n), in_run(levels, builder, n)))
        if len(rows) == 64:
            yield batch_of(rows, schema)
            rows = []
    if rows:
        yield batch_of(rows, schema)


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def schema_of(fields: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    pairs = (f.split() for f in fields.replace("\n", " ").split(","))
    return pa.schema([(name, kinds[kind]) for name, kind in pairs])


def build(leaves: DataFrame, label: str) -> list[DataFrame]:
    """The log of a forest from its leaves ``tree, idx, n, digest``: the runs of every round.

    A round makes six levels of all trees; there are as many as the largest tree needs.
    """
    levels = height(leaves.agg(F.max("n")).first()[0] or 1)
    rounds: list[DataFrame] = []
    nodes = leaves
    while True:
        builder = F.call_function("div", F.col("idx"), F.lit(LEAVES)).alias("builder")
        dealt = (
            nodes.select("tree", builder, "idx", "n", "digest")
            .repartition("tree", "builder")
            .sortWithinPartitions("tree", "idx")
        )
        made = on_batches(dealt, partial(build_runs, schema=schema_of(RUN)), RUN)
        rounds.append(written(made, f"{label}-{len(rounds)}"))
        levels -= LEVELS
        if levels <= 0:
            return rounds
        nodes = rounds[-1].where(F.col("n") > LEAVES).select(
            "tree",
            F.col("builder").alias("idx"),
            (F.call_function("div", F.col("n") - 1, F.lit(LEAVES)) + 1).alias("n"),
            last_digest().alias("digest"),
        )


def last_digest() -> Column:
    return F.expr(f"substring(digests, octet_length(digests) - {DIGEST - 1}, {DIGEST})")


def roots(rounds: Sequence[DataFrame]) -> DataFrame:
    """``tree, digest``: the root of every tree, the last node of the log of its last round."""
    found = [r.where(F.col("n") <= LEAVES).select("tree", last_digest().alias("digest")) for r in rounds]
    whole = found[0]
    for more in found[1:]:
        whole = whole.union(more)
    return whole


PATH = "tree long, idx long, siblings binary, shape binary"


def local_path(levels: list[list[bytes]], index: int) -> tuple[bytes, bytes]:
    """The siblings of a leaf within its builder, and their shape."""
    siblings, shape = [], bytearray()
    for nodes in levels[:-1]:
        first = index - index % ARITY
        run = nodes[first : first + ARITY]
        left = index - first
        siblings += run[:left] + run[left + 1 :]
        shape.append(3 * left + len(run) - left - 1)
        index //= ARITY
    return b"".join(siblings), bytes(shape)


def levels_in(digests: bytes, builder: int, n: int) -> list[list[bytes]]:
    """The levels of a builder, each node read at its place in the run."""
    width = min(LEAVES, n - builder * LEAVES)
    return [
        [digests[DIGEST * i : DIGEST * (i + 1)] for i in at]
        for at in places_of(builder, width, n)
    ]


def one_by_one(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch as Python values, one at a time: each is some tens of kilobytes."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def paths_of_leaves(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Runs with the path of their builder's root become the paths of all their leaves."""
    for batch in batches:
        rows = []
        for run in one_by_one(batch):
            levels = levels_in(run["digests"], run["builder"], run["n"])
            above = (run["siblings"] or b"", run["shape"] or b"")
            for i in range(len(levels[0])):
                siblings, shape = local_path(levels, i)
                idx = run["builder"] * LEAVES + i
                rows.append((run["tree"], idx, siblings + above[0], shape + above[1]))
                if len(rows) == ROWS:
                    yield batch_of(rows, schema)
                    rows = []
        if rows:
            yield batch_of(rows, schema)


PROOF = "row long, siblings binary, shape binary, folded binary"


def proofs_of_asked(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The proof of every asked leaf of a run, and the root that its ``candidate`` leads to."""
    for batch in batches:
        rows = []
        for run in one_by_one(batch):
            levels = levels_in(run["digests"], run["builder"], run["n"])
            above = (run["siblings"] or b"", run["shape"] or b"")
            for asked in run["asked"]:
                local = asked["idx"] - run["builder"] * LEAVES
                siblings, shape = local_path(levels, local)
                siblings, shape = siblings + above[0], shape + above[1]
                leaf = asked["candidate"] or levels[0][local]
                rows.append((asked["row"], siblings, shape, fold(leaf, siblings, shape)))
                if len(rows) == ROWS:
                    yield batch_of(rows, schema)
                    rows = []
        if rows:
            yield batch_of(rows, schema)


def with_path(runs: DataFrame, paths: DataFrame) -> DataFrame:
    """The runs of a round with what the round above gave their builder's root. The root of a
    tree, made in its last round, goes on as the tree does, which ``paths`` has as ``idx`` -1."""
    of_root = F.when(F.col("n") > LEAVES, F.col("builder")).otherwise(F.lit(-1))
    keyed = runs.withColumn("idx", of_root)
    return keyed.join(paths, ["tree", "idx"], "left").drop("idx")


def proofs(rounds: Sequence[DataFrame], asked: DataFrame, above: DataFrame | None = None) -> DataFrame:
    """``row, siblings, shape, folded`` for the leaves ``asked`` (``row, tree, idx, candidate``,
    where ``row`` names the answer and a null ``candidate`` stands for the leaf itself; a leaf
    is asked for once).

    ``above`` continues the path of each tree's root: ``tree, siblings, shape``.
    """
    spark = asked.sparkSession
    if above is None:
        above = spark.createDataFrame([], "tree long, siblings binary, shape binary")
    of_trees = above.select("tree", F.lit(-1).cast("long").alias("idx"), "siblings", "shape")
    paths = of_trees
    for runs in reversed(rounds[1:]):
        step = partial(paths_of_leaves, schema=schema_of(PATH))
        found = on_batches(with_path(runs, paths), step, PATH)
        paths = written(found, "merkle-paths").union(of_trees)
    builder = F.call_function("div", F.col("idx"), F.lit(LEAVES)).alias("builder")
    # At most 3^6 leaves to a builder.
    by_builder = asked.groupBy("tree", builder).agg(
        F.collect_list(F.struct("row", "idx", "candidate")).alias("asked")
    )
    met = with_path(rounds[0], paths).join(by_builder, ["tree", "builder"])
    return on_batches(met, partial(proofs_of_asked, schema=schema_of(PROOF)), PROOF)


def manifest(docs: DataFrame, candidate: Column | None = None) -> tuple:
    """``leaves, rounds, subroots, top``: the leaves of ``docs`` in their trees, the log of the
    trees of the sources, their roots, and the log of the tree above those.

    ``candidate`` is a hash that a proof may be asked for instead of a row's leaf.
    """
    hashed = docs.select(
        F.col("source").cast("string").alias("source"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf_hash().alias("leaf"),
        (F.lit(None).cast("binary") if candidate is None else candidate).alias("candidate"),
        F.monotonically_increasing_id().alias("row"),
    )
    leaves = ranked(
        written(hashed, "merkle-leaves"), "source", ["doc_id", "leaf", "row"], "merkle-order"
    )
    leaves = written(leaves, "merkle-ranked")
    rounds = build(leaves.select("tree", "idx", "n", F.col("leaf").alias("digest")), "merkle-sources")
    sizes = leaves.groupBy("tree").agg(F.max("trees").alias("n"))
    subroots = written(
        roots(rounds)
        .join(sizes, "tree")
        .select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), "n", "digest"),
        "merkle-subroots",
    )
    return leaves, rounds, subroots, build(subroots, "merkle-top")


def checked(docs: DataFrame, candidate: Column | None = None) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``leaf``, the ``subroot`` of its source, the ``root``,
    the ``siblings`` of its proof with their ``shape``, and ``folded``, the root that the
    ``candidate`` hash of the row, or else its leaf, leads to. All are bytes."""
    leaves, rounds, subroots, top = manifest(docs, candidate)
    trees = subroots.select(F.col("idx").alias("row"), "tree", "idx", F.lit(None).cast("binary").alias("candidate"))
    above = written(proofs(top, trees), "merkle-above").select(
        F.col("row").alias("tree"), "siblings", "shape"
    )
    found = proofs(rounds, leaves.select("row", "tree", "idx", "candidate"), above)
    of_tree = subroots.select(F.col("idx").alias("tree"), F.col("digest").alias("subroot"))
    root = roots(top).first()  # one row, or none for an empty table
    placed = leaves.select("row", "doc_id", "leaf", "tree").join(found, "row").join(of_tree, "tree")
    root = F.lit(bytes(root["digest"]) if root else None).cast("binary")
    return placed.drop("row", "tree").withColumn("root", root)


def tampered_text() -> Column:
    return F.replace(F.col("text"), F.lit("\n"), F.lit(""))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``op12``: the manifest of ``documents``, and whether rows still prove true after line
    breaks were deleted from the texts of some."""
    return digest(table(spark, sf_dir, "documents"))


def digest(docs: DataFrame) -> DataFrame:
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    touched = chosen & F.contains(F.col("text"), F.lit("\n"))
    candidate = F.when(touched, leaf_hash(text=tampered_text()))
    found = checked(docs, candidate)

    def shown(column: str) -> Column:
        return F.lower(F.hex(column)).alias(column)

    return found.select(
        "doc_id",
        shown("leaf"),
        shown("subroot"),
        shown("root"),
        F.sha2(F.lower(F.hex("siblings")).cast("binary"), 256).alias("proof_sha256"),
        F.lower(F.hex("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, lang, n_chars, text,
    list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1),
        lambda i: ord(substr(doc_id::VARCHAR, i::INTEGER, 1))::BIGINT)),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
        lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)
    ) & 1 = 1 AS even
  FROM documents
), f AS (
  SELECT *,
    coalesce(strlen(doc_id::VARCHAR)::VARCHAR || ':' || doc_id::VARCHAR, '-')
      || coalesce(strlen(source)::VARCHAR || ':' || source, '-')
      || coalesce(strlen(lang)::VARCHAR || ':' || lang, '-')
      || coalesce(strlen(n_chars::VARCHAR)::VARCHAR || ':' || n_chars::VARCHAR, '-') AS head,
    CASE WHEN even THEN replace(text, chr(10), '') ELSE text END AS seen
  FROM d
), leaves AS (
  SELECT doc_id, source,
    sha256(head || coalesce(strlen(text)::VARCHAR || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(seen)::VARCHAR || ':' || seen, '-')) AS candidate,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS idx,
    count(*) OVER (PARTITION BY source) AS n
  FROM f
), nodes AS (
  SELECT tree, 0 AS level, idx, leaf AS digest, n FROM leaves
  UNION ALL
  SELECT tree, level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (n + 2) // 3
  FROM nodes WHERE n > 1 GROUP BY tree, level, idx // 3, n
), subroots AS (
  SELECT tree, level AS height, digest AS subroot, count(*) OVER () AS trees FROM nodes WHERE n = 1
), top AS (
  SELECT 0 AS level, tree AS idx, subroot AS digest, trees AS n FROM subroots
  UNION ALL
  SELECT level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (n + 2) // 3
  FROM top WHERE n > 1 GROUP BY level, idx // 3, n
), steps AS (
  SELECT l.doc_id, a.level AS step,
    coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (s.idx < a.idx), '') AS before,
    coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (s.idx > a.idx), '') AS after
  FROM leaves l
  JOIN nodes a ON a.tree = l.tree AND a.n > 1 AND a.idx = l.idx // (3 ** a.level)::BIGINT
  JOIN nodes s ON s.tree = a.tree AND s.level = a.level AND s.idx // 3 = a.idx // 3
  GROUP BY ALL
  UNION ALL
  SELECT l.doc_id, r.height + a.level,
    coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (s.idx < a.idx), ''),
    coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (s.idx > a.idx), '')
  FROM leaves l JOIN subroots r ON r.tree = l.tree
  JOIN top a ON a.n > 1 AND a.idx = l.tree // (3 ** a.level)::BIGINT
  JOIN top s ON s.level = a.level AND s.idx // 3 = a.idx // 3
  GROUP BY ALL
), folds AS (
  SELECT doc_id, 0::BIGINT AS step, candidate AS digest FROM leaves
  UNION ALL
  SELECT p.doc_id, p.step + 1, sha256(s.before || p.digest || s.after)
  FROM folds p JOIN steps s ON s.doc_id = p.doc_id AND s.step = p.step
), proofs AS (
  SELECT doc_id, sha256(string_agg(before || after, '' ORDER BY step)) AS proof_sha256, max(step) + 1 AS steps
  FROM steps GROUP BY doc_id
)
SELECT l.doc_id, l.leaf, r.subroot, t.digest AS root,
  coalesce(p.proof_sha256, sha256('')) AS proof_sha256,
  f.digest AS folded_root, f.digest = t.digest AS verified
FROM leaves l JOIN subroots r ON r.tree = l.tree JOIN top t ON t.n = 1
LEFT JOIN proofs p ON p.doc_id = l.doc_id
JOIN folds f ON f.doc_id = l.doc_id AND f.step = coalesce(p.steps, 0)
"""
