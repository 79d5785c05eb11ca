"""Operator 11 against brute force, and its intervals against the products they bound."""

import math
from collections import Counter

import numpy as np
import pytest
from compare import difference, duck
from pyspark.sql import functions as F

from docintake.llm import hard_negatives
from docintake.llm.queries import ORACLES, QUERIES

FIELDS = "vec_id long, embedding array<float>, label int, row long, anchor string, dim int"


def usable(rows):
    """Rows that take part, in integers."""
    found = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        vector = [math.floor(256 * float(np.float32(x))) for x in vector]
        found.append((vec_id, vector, label))
    return found


def brute(rows, positives=5, negatives=5, low=80, high=100, every=100):
    rows, found = usable(rows), []
    for a, (anchor, vector, label) in enumerate(rows):
        if anchor is None or anchor % every:
            continue
        scored = [
            (-sum(x * y for x, y in zip(vector, other)), vec_id is None, vec_id or 0, of == label)
            for b, (vec_id, other, of) in enumerate(rows)
            if b != a and len(other) == len(vector)
        ]
        scored.sort()
        for p in [s for s in scored if s[3]][:positives]:
            within = [s for s in scored if not s[3] and low * -p[0] <= 100 * -s[0] <= high * -p[0]]
            for rank, s in enumerate(within[:negatives], 1):
                ids = [None if unknown else i for _, unknown, i, _ in (p, s)]
                found.append((anchor, ids[0], rank, ids[1], -p[0], -s[0]))
    return Counter(found)


COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def run(spark, rows, every=100, **settings):
    made = spark.createDataFrame([(*r, 7, "other", 1) for r in rows], FIELDS).repartition(4)
    found = hard_negatives.mine(made, F.col("label"), F.col("vec_id") % every == 0, **settings)
    return Counter(tuple(r[c] for c in COLUMNS) for r in found.collect())


def vectors(n, dim, seed, labels=4, near=0.0):
    draw = np.random.default_rng(seed)
    middles = draw.normal(size=(labels, dim)) * near
    found = []
    for i in range(n):
        label = int(draw.integers(labels))
        x = draw.normal(size=dim) + middles[int(draw.integers(labels))]
        x = x / np.linalg.norm(x) if dim else x
        found.append((i * 5, x.astype(np.float32).tolist(), label))
    return found


@pytest.mark.parametrize(("dim", "near"), [(64, 0.0), (64, 1.0), (3, 0.0), (100, 0.5)])
def test_negatives_equal_brute_force(spark, dim, near):
    rows = vectors(900, dim, dim, near=near)
    expected = brute(rows)
    assert expected and run(spark, rows) == expected
    assert run(spark, rows, row_block=100, anchor_block=10) == expected


def test_odd_rows_have_defined_results(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(300, 8, 1, labels=2)
    rows += [
        (None, [0.5] * 8, 0),
        (None, [0.5] * 8, 1),
        (1000, None, 0),
        (1100, [0.1, None] + [0.1] * 6, 1),
        (1200, [nan] + [0.1] * 7, 1),
        (1300, [inf] + [0.1] * 7, 1),
        (1400, [0.1] * 8, None),
        (1500, [0.0] * 8, 0),
        (1600, [], 0),
        (1605, [], 0),
        (1611, [], 1),
        (1700, [0.3] * 5, 0),
        (1701, [0.3] * 5, 0),
        (1702, [0.29] * 5, 1),
        (-100, [-0.2] * 8, 1),
        *[(2000 + i % 3, [0.25] * 8, i % 2) for i in range(40)],  # ties under few ids
        rows[0],
        rows[20],
        (0, rows[0][1], 1),
    ]
    assert run(spark, rows, row_block=50) == brute(rows)


def test_scores_beyond_double_precision_are_exact(spark):
    draw = np.random.default_rng(2)
    rows = []
    for i in range(120):
        scale = [1.0, 2.0**10, 2.0**19][i % 3]
        rows.append((i * 50, (draw.normal(size=16) * scale).astype(np.float32).tolist(), i % 2))
    assert run(spark, rows) == brute(rows)


def test_a_group_of_equal_vectors_is_cut_to_what_can_be_wanted(spark):
    rows = vectors(200, 16, 3, labels=3) + [(10_000 + i, [0.25] * 16, 1) for i in range(2000)]
    rows += [(30_000 + i, [0.24] * 16, 2) for i in range(500)]
    expected = brute(rows, every=2500)
    assert len(expected) > 20 and run(spark, rows, every=2500) == expected


def test_other_numbers_of_positives_and_negatives(spark):
    rows = vectors(400, 32, 5)
    settings = {"positives": 2, "negatives": 9, "low": 50, "high": 90}
    expected = brute(rows, **settings)
    assert expected and run(spark, rows, **settings) == expected


def test_no_rows(spark):
    assert run(spark, []) == Counter()
    assert run(spark, [(7, [1.0], 1)]) == Counter()
    assert run(spark, [(100, [1.0], 1)]) == Counter()


@pytest.mark.parametrize("dim", [1, 16, 64, 130])
def test_intervals_hold_the_products_and_halve(dim):
    draw = np.random.default_rng(dim)
    kinds = [draw.normal(size=(60, dim)) * 256, np.zeros((2, dim)), np.full((2, dim), 300.0)]
    kinds += [draw.integers(-3, 4, (20, dim)), draw.normal(size=(20, dim)) * 1e9]
    every = np.floor(np.concatenate(kinds)).astype(np.int64)
    codes, aligned, over = hard_negatives.coded(every.astype(np.float64))
    rows = {
        "row": np.arange(len(every)),
        "vec_id": np.arange(len(every)),
        "label": np.zeros(len(every), np.int64),
        "vector": [v.tobytes() for v in every],
        "codes": [c.tobytes() for c in codes],
        "measures": [np.stack(m).tobytes() for m in zip(aligned, over, strict=True)],
    }
    import pyarrow as pa

    block = hard_negatives.Block(pa.table(rows))
    everyone = np.arange(len(every))
    for anchor in every[::7]:
        products = np.array([sum(int(x) * int(y) for x, y in zip(anchor, v)) for v in every], float)
        steps = block.intervals(hard_negatives.Asked(anchor.astype(np.float64)), everyone)
        widths = []
        low, high = next(steps)
        for turn in range(hard_negatives.CODES):
            assert (low <= products).all() and (products <= high).all()
            widths.append(np.median(high - low))
            if turn < hard_negatives.CODES - 1:
                low, high = steps.send(everyone)
        if dim >= 64 and np.abs(anchor).max() > 100:
            assert widths[-1] < 0.5 * widths[0]
        assert [int(x) for x in block.scores(anchor, everyone)] == [
            sum(int(x) * int(y) for x, y in zip(anchor, v)) for v in every
        ]


def test_registered_negatives(spark, sf_dir):
    found = QUERIES["op11_hard_negatives"](spark, sf_dir)
    assert difference(found, duck(sf_dir), ORACLES["op11_hard_negatives"]) is None
