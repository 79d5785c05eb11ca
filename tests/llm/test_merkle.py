"""Operator 12 against trees that are built node by node."""

import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docintake.llm import merkle
from docintake.llm.queries import QUERIES
from llm.tables import FIELDS, frame, rows


def joined(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def value(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row):
    doc_id, text, lang, source, n_chars = row
    return joined(*map(value, (doc_id, source, lang, n_chars, text)))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([joined(*below[i : i + 3]) for i in range(0, len(below), 3)])
    return levels


def path(levels, i):
    found = []
    for nodes in levels[:-1]:
        first = i - i % 3
        found.append((nodes[first:i], nodes[i + 1 : first + 3]))
        i //= 3
    return found


def brute(values):
    """Rows as the query gives them; line breaks go from texts of every other id."""
    by_source = {}
    for row in values:
        by_source.setdefault(row[3], []).append(row)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for s in sources:
        by_source[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {s: tree([leaf(r) for r in by_source[s]]) for s in sources}
    top = tree([trees[s][-1][0] for s in sources])
    found = []
    for k, s in enumerate(sources):
        for i, row in enumerate(by_source[s]):
            steps = path(trees[s], i) + path(top, k)
            node = leaf(row)
            even = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0
            if even and row[1] is not None:
                node = leaf((row[0], row[1].replace("\n", ""), *row[2:]))
            for before, after in steps:
                node = joined(*before, node, *after)
            root = top[-1][0]
            proof = joined(*[d for before, after in steps for d in before + after])
            found.append((row[0], leaf(row), trees[s][-1][0], root, proof, node, node == root))
    return Counter(found)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def as_query(found):
    return Counter(tuple(r[c] for c in COLUMNS) for r in found.collect())


def many():
    """One source of several builders, many of one row, some on the edges of runs."""
    found = [(n, f"t{n}\n{n % 5}", None, "big", n) for n in range(2200)]
    found += [(n, f"s{n}\n", "en", f"s{n % 800}", None) for n in range(10_000, 10_800)]
    for size in (2, 3, 4, 9, 10, 27, 28, 729, 730):
        found += [(n, "e\n", "de", f"edge{size}é", 1) for n in range(size)]
    return found


@pytest.mark.parametrize(
    "values",
    [
        rows(),
        [(1, "a\n", None, None, None)],
        [(7, "x\n", "en", "s", 1)] * 40 + [(None, None, None, "", 0)] * 3 + [(5, "", "", "s", 0)],
        many(),
    ],
    ids=["odd", "one", "repeats", "many"],
)
def test_manifest_equals_trees_built_by_hand(spark, values):
    assert as_query(merkle.digest(frame(spark, values, extra=True))) == brute(values)


def test_an_empty_table_has_no_tree(spark):
    assert merkle.digest(spark.createDataFrame([], FIELDS)).isEmpty()


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 26, 27, 28, 80, 100])
def test_places_are_the_order_in_which_nodes_are_complete(n):
    order, pending = [], [[] for _ in range(20)]
    sizes = [n]
    while sizes[-1] > 1:
        sizes.append(-(-sizes[-1] // 3))
    for i in range(n):
        level, index = 0, i
        while True:
            order.append((level, index))
            pending[level].append(index)
            last = index == sizes[level] - 1
            if level == len(sizes) - 1 or not (len(pending[level]) == 3 or last):
                break
            pending[level] = []
            level, index = level + 1, index // 3
    assert len(order) == sum(sizes)
    for at, (level, index) in enumerate(order):
        assert merkle.place(level, index, n) == at


def test_runs_of_builders_are_one_log_without_gaps(spark):
    """Every builder's run begins where all runs and upper nodes before it have ended."""
    n = 3 * merkle.LEAVES + 5
    nodes = [(0, i, n, hashlib.sha256(str(i).encode()).digest()) for i in range(n)]
    leaves = spark.createDataFrame(nodes, "tree long, idx long, n long, digest binary").repartition(5)
    rounds = merkle.build(leaves, "test")
    assert len(rounds) == 2
    runs = sorted(rounds[0].collect(), key=lambda r: r["builder"])
    levels = tree([d.hex() for *_, d in nodes])
    for r in runs:
        size = len(r["digests"]) // merkle.DIGEST
        assert r["first"] == merkle.place(0, r["builder"] * merkle.LEAVES, n)
        if r["builder"] < 3:
            assert size == sum(3**k for k in range(merkle.LEVELS + 1))
    for level, nodes_ in enumerate(levels[: merkle.LEVELS + 1]):
        for i, digest in enumerate(nodes_):
            at = merkle.place(level, i, n)
            run = next(r for r in reversed(runs) if r["first"] <= at)
            start = (at - run["first"]) * merkle.DIGEST
            assert bytes(run["digests"][start : start + merkle.DIGEST]).hex() == digest
    assert merkle.roots(rounds).collect()[0]["digest"].hex() == levels[-1][0]


def test_a_proof_of_another_leaf_leads_elsewhere(spark):
    docs = frame(spark, many())
    wrong = F.when(F.col("doc_id") % 2 == 0, F.unhex(F.sha2(F.lit("x"), 256)))
    for r in merkle.checked(docs, wrong).select("doc_id", "root", "folded", "siblings", "shape", "leaf").collect():
        assert (r["folded"] == r["root"]) == (r["doc_id"] % 2 == 1)
        assert merkle.fold(bytes(r["leaf"]), bytes(r["siblings"]), bytes(r["shape"])) == r["root"]


def test_registered_manifest(spark, sf_dir):
    values = [
        (r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"])
        for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    ]
    assert as_query(QUERIES["op12_merkle_log"](spark, sf_dir)) == brute(values)
