"""Operator 10: near-duplicates by HyperMinHash.

A document's set is its distinct shingles of five words, as 64-bit hashes. The first bits
of a hash choose one of 128 buckets, and of the smallest rest in a bucket a register keeps
16 bits: how many zeros lead it, and the bits after its first one. Empty buckets borrow the
register of another, by a fixed order of their own. Four registers are a band; documents
that share a band meet. Two documents that met are compared by their registers, corrected
for registers that are equal by chance, and what may be similar enough is confirmed on the
full sets.

**Few pairs within a group.** Documents with equal sets are one class. In a bucket of classes
one leader is compared with all others, and its distances from them are measured on full sets.
Jaccard distance is a metric, so they say which of the others can still be linked with each
other: a class further from every class outside its component than the limit allows is done. So
is one that has too many shingles to itself to be linked with any of the others. A group of
near-copies is done after one leader, whatever its size. While leaders close many classes,
buckets that are still of several components get others.

What is left is settled by bounds. Only shingles that two open classes hold can be in an
intersection; every class counts its own in 128 cells, by hash, and the sum of the smaller of
two counts, cell by cell, is at least the size of the intersection. Blocks of a bucket meet, and
only pairs of different components that sizes, registers and counts all leave open come out, to
be confirmed on full sets.

Defined results: a text that is null or has no words has an empty set and is linked with
nothing; equal texts have equal sets and are linked; a null ``doc_id`` is larger than any
other; an empty table gives an empty result. Columns other than ``doc_id`` and ``text`` are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docintake.llm.common import (
    chunks,
    fresh,
    on_batches,
    table,
    texts_of,
    whole_text,
    written,
)
from docintake.llm.shingles import overlap, shingle_sets

BUCKET_BITS = 7
BUCKETS = 1 << BUCKET_BITS
MANTISSA_BITS = 10
ROWS = 4
BANDS = BUCKETS // ROWS

# Linked at 100 * intersection >= 75 * union.
SIMILARITY = 75

# Leaders go on while a turn closes at least this share of the open members of buckets.
WORTH = 0.1

# Cells in which a class counts the shingles that others hold too.
CELLS = 128

# Members of a bucket that meet as many others in one group.
PART = 2048

# An estimate may be off by this many standard deviations before it rejects a pair.
DEVIATIONS = 6.0
SPREAD = SIMILARITY / 100 * (1 - SIMILARITY / 100)


@lru_cache(maxsize=1)
def lenders() -> np.ndarray:
    """For each bucket the order in which it asks others for their register."""
    draw = np.random.default_rng(20240607)
    return np.stack([draw.permutation(BUCKETS) for _ in range(BUCKETS)])


def registers(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Registers of every set, and how many of them are its own. All zero for empty sets."""
    edges = np.arange(1, BUCKETS, dtype=np.uint64) << np.uint64(64 - BUCKET_BITS)
    least = np.zeros((len(sets), BUCKETS), np.uint64)
    own = np.zeros((len(sets), BUCKETS), bool)
    for i, found in enumerate(sets):
        cut = np.concatenate([[0], np.searchsorted(found, edges), [len(found)]])
        own[i] = cut[1:] > cut[:-1]
        least[i, own[i]] = found[cut[:-1][own[i]]]
    rest = least << np.uint64(BUCKET_BITS)
    # The first set bit, by the exponent of the upper 53 bits as a floating-point number.
    _, exponent = np.frexp((rest >> np.uint64(11)).astype(np.float64))
    zeros = (53 - exponent).astype(np.uint64)
    after = np.where(zeros < 53, rest << (zeros + np.uint64(1)), 0)
    mantissa = after >> np.uint64(64 - MANTISSA_BITS)
    kept = (zeros << np.uint64(MANTISSA_BITS) | mantissa).astype(np.uint16)
    filled, some = own.copy(), own.any(1)
    for turn in range(BUCKETS):
        open_rows = np.flatnonzero(some & ~filled.all(1))
        if not len(open_rows):
            break
        lender = lenders()[:, turn]
        takes = ~filled[open_rows] & own[open_rows][:, lender]
        row, bucket = np.nonzero(takes)
        kept[open_rows[row], bucket] = kept[open_rows[row], lender[bucket]]
        filled[open_rows[row], bucket] = True
    return kept, own.sum(1)


@lru_cache(maxsize=4096)
def chance(n: int, m: int) -> float:
    """The share of buckets in which two disjoint sets of these sizes agree by chance.

    The smallest of k uniform numbers lies in [a, b] with probability (1-a)^k - (1-b)^k;
    a register value is such an interval.
    """
    per, other = max(n / BUCKETS, 1.0), max(m / BUCKETS, 1.0)
    total, steps = 0.0, 1 + np.arange((1 << MANTISSA_BITS) + 1) / (1 << MANTISSA_BITS)
    for zeros in range(53):
        beyond = np.log1p(-0.999999 * steps * 2.0 ** -(zeros + 1))
        a, b = np.exp(per * beyond), np.exp(other * beyond)
        total += float(((a[:-1] - a[1:]) * (b[:-1] - b[1:])).sum())
    return total


def round_size(n: int) -> int:
    """Sizes to two leading binary digits, so that ``chance`` is worked out for few."""
    step = max(1, 1 << max(0, int(n).bit_length() - 2))
    return int(n) // step * step


def estimate(a: np.ndarray, b: np.ndarray, n: int, m: int) -> float:
    """Jaccard similarity by registers, less the agreement that chance gives."""
    by_chance = chance(round_size(n), round_size(m))
    return (float((a == b).mean()) - by_chance) / (1 - by_chance)


def slack(n_own: int) -> float:
    """How far an estimate from so many registers may be off."""
    return DEVIATIONS * float(np.sqrt(SPREAD / max(1, n_own)))


SKETCH = """row long, doc_id long, text_key long, n_shingles long, set_id binary, n_own int,
bands array<long>"""


def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row = TaskContext.get().partitionId() << 33
    for chunk in chunks(batches):
        sets = shingle_sets(chunk.column("text"))
        found, n_own = registers(sets)
        size = [len(s) for s in sets]
        bands = pa.array(found.view("<i8").ravel())
        offsets = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * BANDS)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(row, row + len(sets))),
                chunk.column("doc_id"),
                chunk.column("text_key"),
                pa.array(size, pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]),
                pa.array(n_own.astype(np.int32)),
                pa.ListArray.from_arrays(offsets, bands),
            ],
            ["row", "doc_id", "text_key", "n_shingles", "set_id", "n_own", "bands"],
        )
        row += len(sets)


def keyed_texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))


def sketches(docs: DataFrame) -> DataFrame:
    """One row per document: its set's size, identity and registers, four to a number."""
    texts = keyed_texts(docs)
    return on_batches(texts.withColumn("text_key", F.xxhash64("text")), sketch, SKETCH)


NODES = "node long, n_shingles long, n_own int, bands array<long>, shingles binary"


def with_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes with their sets, made once from their texts."""
    names = ["node", "n_shingles", "n_own", "bands"]
    for chunk in chunks(batches):
        sets = pa.array([s.tobytes() for s in shingle_sets(chunk.column("text"))], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [*(chunk.column(c) for c in names), sets], [*names, "shingles"]
        )


def fingerprint(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges, and as good as never for others."""
    hashed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(hashed)).first())


def components(links: DataFrame) -> DataFrame:
    """``node, root``: the smallest node reachable, for every node of ``links`` (u, v) but
    the roots themselves.

    Each step hangs the larger neighbours of a node, then the smaller ones, under the
    smallest of them, which halves long chains; it ends when all hang under their root.
    """
    edges = written(links.where("u <> v").select("u", "v").distinct(), "edges")
    seen = fingerprint(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        hung = [F.col("v").alias("u"), F.col("m").alias("v")]
        large = both.where("v > u").join(least, "u").select(*hung)
        down = large.where("u <> v").distinct()
        under = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(under, "u").select(*hung)
        kept = under.select("u", F.col("m").alias("v"))
        edges = written(small.where("u <> v").union(kept).distinct(), "edges")
        before, seen = seen, fingerprint(edges)
        if seen == before:
            return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after more links: only what connects two components is worked on."""
    ends = links.select("u", "v")
    for end in ("u", "v"):
        known = labels.select(F.col("node").alias(end), F.col("root").alias("_root"))
        ends = ends.join(known, end, "left").withColumn(end, F.coalesce("_root", end)).drop("_root")
    joined = written(components(ends), "merged-roots")
    further = joined.select(F.col("node").alias("root"), F.col("root").alias("_root"))
    moved = labels.join(further, "root", "left")
    moved = moved.select("node", F.coalesce("_root", "root").alias("root"))
    return written(moved.union(joined), "labels")


def set_of(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint64)


def compare(
    batches: Iterator[pa.RecordBatch], measured: bool
) -> Iterator[pa.RecordBatch]:
    """Pairs with ``linked`` and ``distance``: by registers, and on full sets where those
    leave it open or distances are to be ``measured``."""
    limit = SIMILARITY / 100
    for batch in batches:
        for chunk in chunks(iter([batch]), "shingles_v"):

            def side(name: str, chunk=chunk) -> np.ndarray:
                return chunk.column(name).flatten().to_numpy().view("<u2").reshape(-1, BUCKETS)

            a, b = side("bands_u"), side("bands_v")
            numbers = [chunk.column(c).to_pylist() for c in ("n_u", "n_v", "own_u", "own_v")]
            most = np.array(
                [
                    estimate(a[i], b[i], n, m) + slack(min(p, q))
                    for i, (n, m, p, q) in enumerate(zip(*numbers, strict=True))
                ]
            )
            linked, distance = np.zeros(len(most), bool), 1 - most
            for i in np.flatnonzero((most >= limit) | measured).tolist():
                one, other = (
                    set_of(chunk.column(f"shingles_{of}")[i].as_py()) for of in ("u", "v")
                )
                shared = overlap(one, other)
                joint = len(one) + len(other) - shared
                linked[i] = 100 * shared >= SIMILARITY * joint
                distance[i] = 1 - shared / joint
            yield pa.RecordBatch.from_arrays(
                [chunk.column("u"), chunk.column("v"), pa.array(linked), pa.array(distance)],
                ["u", "v", "linked", "distance"],
            )


def judged(pairs: DataFrame, nodes: DataFrame, measured: bool = False) -> DataFrame:
    """Distinct pairs (u, v) with ``linked`` and ``distance``: exact where they went to the
    full sets, which all do if distances are ``measured``, else a lower bound."""

    def side(of: str) -> DataFrame:
        return nodes.select(
            F.col("node").alias(of),
            F.col("bands").alias(f"bands_{of}"),
            F.col("n_shingles").alias(f"n_{of}"),
            F.col("n_own").alias(f"own_{of}"),
            F.col("shingles").alias(f"shingles_{of}"),
        )

    met = pairs.join(side("v"), "v").join(side("u"), "u")
    return written(
        on_batches(
            met, partial(compare, measured=measured), "u long, v long, linked boolean, distance double"
        ),
        "judged",
    )


def still_open(members: DataFrame, found: DataFrame) -> DataFrame:
    """The members of buckets that a first leader's distances don't settle.

    With the leader at distance d of x and e of y, x and y are at least e - d apart. So of
    those linked with the leader only such stay as may be linked with one that is not.
    """
    limit = 1 - SIMILARITY / 100
    rated = members.where("node <> leader").join(
        found.select(F.col("u").alias("leader"), F.col("v").alias("node"), "linked", "distance"),
        ["leader", "node"],
    )
    nearest = rated.where("NOT linked").groupBy("band", "code").agg(F.min("distance").alias("e"))
    return (
        rated.join(nearest, ["band", "code"])
        .where((~F.col("linked")) | (F.col("e") - F.col("distance") <= limit + 1e-9))
        .select("band", "code", "node")
    )


def explode_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in chunks(batches, "shingles"):
        data, bounds = texts_of(chunk.column("shingles"))
        node = np.repeat(chunk.column("node").to_numpy(), np.diff(bounds) // 8)
        every = np.frombuffer(data.tobytes(), np.int64)
        for first in range(0, len(node), 50_000):
            part = slice(first, first + 50_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[part]), pa.array(every[part])], ["node", "shingle"]
            )


def count_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node, n, most, cells``: the shingles of a class but its ``alone`` ones, counted in
    cells; the smallest number stands for more than 16 bits hold, and rules nothing out."""
    for chunk in chunks(batches, "shingles"):
        found = []
        for node, data, alone in zip(
            *(chunk.column(c).to_pylist() for c in ("node", "shingles", "alone")), strict=True
        ):
            held = set_of(data)
            own = np.array(alone or [], np.int64).view(np.uint64)
            counts = np.bincount((held % CELLS).astype(np.int64), minlength=CELLS)
            counts -= np.bincount((own % CELLS).astype(np.int64), minlength=CELLS)
            if counts.max() > MOST_COUNTED:
                counts[:] = -1
            most = (100 + SIMILARITY) * (len(held) - len(own)) - SIMILARITY * len(held)
            found.append((node, len(held), most, counts.astype("<i2").tobytes()))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)],
            ["node", "n", "most", "cells"],
        )


MOST_COUNTED = 2**15 - 1


def with_possible_partners(left: DataFrame, nodes: DataFrame) -> DataFrame:
    """The open members that a link may still reach, with size ``n``, ``most`` and ``cells``.

    Shingles that no other open class holds are in no intersection. A class of n shingles,
    u of them its own alone, is linked with one of m only if what it shares can be enough:
    75 * m <= 175 * (n - u) - 75 * n, which is ``most``. In a bucket whose classes are all
    too much their own, none can be linked with another, and none stays.
    """
    open_nodes = nodes.join(left.select("node").distinct(), "node", "left_semi").select(
        "node", "shingles"
    )
    held = on_batches(open_nodes, explode_shingles, "node long, shingle long")
    holders = held.groupBy("shingle").agg(
        F.min("node").alias("node"), F.count(F.lit(1)).alias("holders")
    )
    # As many as the shingles of one document, at most.
    alone = holders.where("holders = 1").groupBy("node").agg(F.collect_list("shingle").alias("alone"))
    counted = on_batches(
        open_nodes.join(alone, "node", "left"),
        count_shared,
        "node long, n long, most long, cells binary",
    )
    counted = written(counted, "shared-shingles")
    sized = left.join(counted.drop("cells"), "node")
    bounds = sized.groupBy("band", "code").agg(
        F.min("n").alias("least_n"), F.max("most").alias("largest_most")
    )
    possible = (SIMILARITY * F.col("least_n") <= F.col("most")) & (
        SIMILARITY * F.col("n") <= F.col("largest_most")
    )
    kept = sized.join(bounds, ["band", "code"]).where(possible).select("band", "code", "node")
    return written(kept.join(counted, "node"), "open-members")


def meet(some: pa.Table, others: pa.Table) -> pa.Table:
    """Pairs of members of a bucket that are not connected, not ruled out by their sizes,
    registers or counts, and don't share an earlier band, where they meet too."""

    def columns(table: pa.Table) -> tuple[np.ndarray, ...]:
        plain = [table.column(c).to_numpy() for c in ("node", "n", "most", "root", "n_own")]
        bands = table.column("bands").combine_chunks().flatten().to_numpy()
        cells = np.frombuffer(b"".join(table.column("cells").to_pylist()), "<i2")
        return *plain, bands.view("<u2").reshape(-1, BUCKETS), cells.reshape(-1, CELLS)

    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    if some.num_rows and others.num_rows:
        band = some.column("band")[0].as_py()
        within = some.column("part")[0].as_py() == some.column("other")[0].as_py()
        nodes, n, most, roots, own, drawn, cells = columns(others)
        for u, n_u, most_u, root_u, own_u, drawn_u, cells_u in zip(*columns(some), strict=True):
            open_ = (roots != root_u) & (SIMILARITY * n <= most_u) & (SIMILARITY * n_u <= most)
            at = np.flatnonzero(open_ & (nodes > u) if within else open_)
            same = drawn[at] == drawn_u
            margin = DEVIATIONS * np.sqrt(SPREAD / np.minimum(own[at], own_u))
            first = same.reshape(-1, BANDS, ROWS).all(2).argmax(1) == band
            at = at[first & (same.mean(1) + margin >= SIMILARITY / 100)]
            shared = np.minimum(cells[at], cells_u).sum(1, dtype=np.int64)
            enough = (100 + SIMILARITY) * shared >= SIMILARITY * (n[at] + n_u)
            v = nodes[at[enough | (shared < 0)]]
            found.append((np.minimum(u, v), np.maximum(u, v)))
    u, v = (np.concatenate(side) for side in zip(*found, strict=True))
    return pa.table({"u": u, "v": v})


def split_buckets(left: DataFrame, labels: DataFrame) -> DataFrame:
    """The open members of buckets that hold several components, with their ``root``."""
    labelled = left.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = (
        labelled.groupBy("band", "code")
        .agg(F.min("root").alias("least"), F.max("root").alias("largest"))
        .where("least <> largest")
        .select("band", "code")
    )
    return written(labelled.join(several, ["band", "code"]), "split-buckets")


def next_leaders(split: DataFrame) -> DataFrame:
    """A leader for each bucket: the open member with the largest share of shingles that others
    hold too, which lies in the middle of a group if there is one."""
    share = F.struct(F.col("most") / F.col("n"), -F.col("node"))
    return split.groupBy("band", "code").agg(F.max_by("node", share).alias("leader"))


def connected(reps: DataFrame, with_sets) -> DataFrame:
    """Components of the classes (``node, root`` but for the roots) by their links.

    First every bucket's smallest class is compared with all others of the bucket. Buckets that
    still hold several components get further leaders while that closes many members; then the
    members of each that are left meet in blocks.
    """
    banded = reps.select("node", F.posexplode("bands").alias("band", "code"))
    buckets = banded.groupBy("band", "code").agg(
        F.min("node").alias("leader"), F.count(F.lit(1)).alias("n")
    )
    members = written(
        banded.join(buckets.where("n > 1").drop("n"), ["band", "code"]), "bucket-members"
    )
    nodes = with_sets(members.select("node").distinct())
    star = [F.col("leader").alias("u"), F.col("node").alias("v")]
    known = judged(members.where("node <> leader").select(*star).distinct(), nodes, measured=True)
    labels = written(components(known.where("linked")), "labels")
    left = with_possible_partners(still_open(members, known), nodes)
    split, drawn = split_buckets(left, labels), nodes.select("node", "bands", "n_own")
    n_open, closed = split.count(), 1.0
    while n_open and closed >= WORTH:
        leaders = written(next_leaders(split), "leaders")
        met = split.join(leaders, ["band", "code"]).where("node <> leader").select(*star).distinct()
        found = judged(met, nodes).where("linked")
        if found.take(1):
            labels = merged(labels, found)
        gone = leaders.withColumnRenamed("leader", "node")
        split = split.drop("root").join(gone, ["band", "code", "node"], "left_anti")
        split = split_buckets(split, labels)
        before, n_open = n_open, split.count()
        closed = 1 - n_open / before
    if not n_open:
        return labels
    sizes = split.groupBy("band", "code").agg(
        F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts")
    )
    dealt = split.join(sizes, ["band", "code"]).withColumn(
        "own_part", F.pmod(F.xxhash64("node"), "parts").cast("int")
    )
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("some_part")
    dealt = dealt.select("*", every)
    key = ["band", "code", "part", "other"]
    fields = ["node", "n", "most", "root", "bands", "n_own", "cells"]

    def side(own: str, part: str, keep: str) -> DataFrame:
        rows = dealt.where(keep).withColumnsRenamed({"own_part": own, "some_part": part})
        # Both sides read the same registers; names given anew tell their columns apart.
        return rows.join(drawn, "node").select(*key, *fields).toDF(*key, *fields)

    some = side("part", "other", "own_part <= some_part")
    others = side("other", "part", "some_part <= own_part")
    pairs = some.groupBy(*key).cogroup(others.groupBy(*key)).applyInArrow(meet, "u long, v long")
    found = judged(pairs.distinct(), nodes).where("linked")
    return merged(labels, found) if found.take(1) else labels


def near_groups(docs: DataFrame) -> DataFrame:
    """Per document ``row, doc_id, text_key, n_shingles, root`` (its component, null without
    words) and ``component_id``, the smallest id reachable."""
    rows = written(sketches(docs), "sketches")
    classes = (
        rows.where("set_id IS NOT NULL")
        .groupBy("set_id")
        .agg(F.min("row").alias("node"), F.min("doc_id").alias("least_id"))
    )
    classes = written(classes, "classes")
    reps = written(
        rows.join(classes.select(F.col("node").alias("row")), "row", "left_semi").select(
            F.col("row").alias("node"), "doc_id", "text_key", "n_shingles", "n_own", "bands"
        ),
        "representatives",
    )

    def with_sets(nodes: DataFrame) -> DataFrame:
        asked = reps.join(nodes, "node", "left_semi").withColumnsRenamed(
            {"doc_id": "_id", "text_key": "_key"}
        )
        texts = keyed_texts(docs)
        same = texts["doc_id"].eqNullSafe(asked["_id"]) & (F.xxhash64("text") == asked["_key"])
        found = texts.join(asked, same).drop("doc_id", "_id", "_key")
        return written(
            on_batches(found.dropDuplicates(["node"]), with_shingles, NODES), "sets-of-members"
        )

    labels = connected(reps, with_sets)
    named = classes.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_class = named.join(ids, "root").select("set_id", "root", "component_id")
    grouped = rows.drop("bands", "n_own").join(of_class, "set_id", "left")
    return grouped.select(
        "row",
        "doc_id",
        "text_key",
        "n_shingles",
        "root",
        F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias(
            "component_id"
        ),
    )


def without_near_copies(docs: DataFrame) -> DataFrame:
    """One document of each group, the one with the smallest id, with all columns."""
    groups = near_groups(docs)
    first = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row", "text_key")
    alone = groups.where("root IS NULL").select("doc_id", "text_key")
    least = groups.where("root IS NOT NULL").groupBy("root").agg(F.min(first).alias("first"))
    stay = least.select("first.doc_id", "first.text_key").union(alone)
    stay = stay.toDF("_id", "_key").distinct()
    key = fresh("text_key", docs.columns)
    keyed = docs.withColumn(key, F.xxhash64(whole_text()))
    same = keyed["doc_id"].cast("long").eqNullSafe(stay["_id"]) & (keyed[key] == stay["_key"])
    kept = keyed.join(stay, same, "left_semi")
    return kept.dropDuplicates(["doc_id", key]).drop(key)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``op10``: the near-duplicate component of each document."""
    groups = near_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT doc_id, list_distinct(list_transform(
    range(1, greatest(len(words) - 3, least(len(words), 1) + 1)),
    lambda i: list_slice(words, i::INTEGER, (i + 4)::INTEGER))) AS shingles
  FROM w
), sets AS (
  SELECT doc_id, len(shingles) AS n, md5(list_sort(shingles)::VARCHAR) AS name, shingles FROM s
), classes AS (
  SELECT name, min(doc_id) AS node, any_value(n) AS n, any_value(shingles) AS shingles
  FROM sets WHERE n > 0 GROUP BY name
), held AS (
  SELECT node, n, md5(unnest(shingles)::VARCHAR) AS shingle FROM classes
), links AS (
  SELECT a.node AS u, b.node AS v
  FROM held a JOIN held b ON a.shingle = b.shingle AND a.node < b.node
  GROUP BY a.node, b.node
  HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))
), ends AS (
  SELECT u, v FROM links UNION ALL SELECT v, u FROM links
), reach AS (
  SELECT node AS u, node AS v FROM classes
  UNION SELECT r.u, b.v FROM reach r JOIN ends b ON b.u = r.v
), roots AS (
  SELECT u AS node, min(v) AS root FROM reach GROUP BY u
)
SELECT x.doc_id, x.n AS n_shingles, coalesce(r.root, x.doc_id) AS component_id,
  x.doc_id = coalesce(r.root, x.doc_id) AS kept
FROM sets x LEFT JOIN classes c ON c.name = x.name AND x.n > 0 LEFT JOIN roots r ON r.node = c.node
"""
