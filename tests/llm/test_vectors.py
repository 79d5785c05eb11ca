"""Operator 5 against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from docintake.llm import posting_lists
from docintake.llm.queries import QUERIES

FIELDS = "vec_id long, embedding array<float>, list int, node string"


def usable(rows):
    """Ids and vectors that take part, repeated rows once."""
    good = {}
    for vec_id, vector, *_ in rows:
        if vec_id is None or not vector or None in vector:
            continue
        vector = np.array(vector, np.float32).astype(np.float64)
        if np.isfinite(vector).all() and vector.any():
            good[vec_id, tuple(vector)] = None
    return list(good)


def brute(rows, k):
    """All neighbours of every 50th vector, in order."""
    found = {}
    every = usable(rows)
    matrix = np.array([v for _, v in every])
    ids = np.array([i for i, _ in every])
    for query_id, vector in every:
        if query_id % 50:
            continue
        scores = posting_lists.cosine(np.repeat([vector], len(ids), 0), matrix)
        keep = ids != query_id
        order = np.lexsort((ids[keep], -scores[keep]))[:k]
        found[query_id] = list(zip(ids[keep][order].tolist(), scores[keep][order], strict=True))
    return found


def run(spark, rows, k=5):
    made = spark.createDataFrame([(*r, 7, "other") for r in rows], FIELDS).repartition(4)
    found = {}
    asked = made.where(F.col("vec_id") % 50 == 0)
    for r in posting_lists.search(made, asked, k).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(found[r["query_id"]])
    return found


def recall(found, expected):
    hits = total = 0
    for query_id, wanted in expected.items():
        hits += len({i for i, _ in wanted} & {i for i, _ in found.get(query_id, [])})
        total += len(wanted)
    return hits / max(1, total)


def exact_scores(found, rows):
    by_id = dict(usable(rows))
    for query_id, got in found.items():
        for vec_id, score in got:
            one = np.array([by_id[query_id]]), np.array([by_id[vec_id]])
            assert score == pytest.approx(posting_lists.cosine(*one)[0], abs=1e-12)


def odd_rows():
    draw = np.random.default_rng(3)
    rows = [(i, draw.normal(size=8).tolist()) for i in range(300)]
    hot = draw.normal(size=8).tolist()
    rows += [(i, hot) for i in range(300, 520)]
    rows += [
        (600, None),
        (650, []),
        (700, [0.0] * 8),
        (750, [1.0] * 7 + [None]),
        (800, [1.0] * 7 + [float("nan")]),
        (850, [1.0] * 7 + [float("inf")]),
        (None, [1.0] * 8),
        (900, [2.0] * 8),
        (901, [4.0] * 8),
        (902, [-3.0] * 8),
    ]
    return [*rows, rows[0], rows[310]]


def test_odd_vectors_copies_and_ties(spark):
    rows = odd_rows()
    found, expected = run(spark, rows), brute(rows, 5)
    assert set(found) == set(expected)
    assert all(len(v) == 5 for v in found.values())
    assert recall(found, expected) > 0.95
    exact_scores(found, rows)
    # Equal vectors tie; the smaller ids come first, and never the query itself.
    assert [i for i, _ in found[350]] == [300, 301, 302, 303, 304]
    assert [i for i, _ in found[300]] == [301, 302, 303, 304, 305]


@pytest.mark.parametrize("n", [0, 1, 2, 4])
def test_few_candidates_are_all_found(spark, n):
    rows = [(50 * i, [float(i + 1), 1.0]) for i in range(n)]
    found = run(spark, rows)
    if n > 1:
        assert {q: len(v) for q, v in found.items()} == {50 * i: n - 1 for i in range(n)}
    else:
        assert found == {}
    exact_scores(found, rows)


def test_parts_of_lists_and_of_queries(spark, monkeypatch):
    monkeypatch.setattr(posting_lists, "PART", 16)
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(12, 16)) * 4
    rows = [(i, (centres[i % 12] + draw.normal(size=16)).tolist()) for i in range(1500)]
    found, expected = run(spark, rows), brute(rows, 5)
    assert recall(found, expected) >= 0.9
    exact_scores(found, rows)


@pytest.mark.parametrize("pairs", [1 << 16, 50])
def test_many_vectors_of_equal_cosine_in_single_precision(spark, monkeypatch, pairs):
    monkeypatch.setattr(posting_lists, "PAIRS", pairs)
    draw = np.random.default_rng(9)
    base = draw.normal(size=16).astype(np.float32)
    ids = draw.permutation(np.arange(1, 91)).tolist()
    # Copies scaled by 2, 3, ...; near copies; both in an order that is not that of the ids.
    scaled = [(i, (base * (n + 2)).tolist()) for n, i in enumerate(ids[:45])]
    near = [(i, (base * (1 + draw.normal(size=16) * 1e-5)).tolist()) for i in ids[45:]]
    rows = [(0, base.tolist()), *scaled, *near]
    assert run(spark, rows) == brute(rows, 5)


def test_error_of_single_precision_is_bounded():
    draw = np.random.default_rng(10)
    for dimension in (1, 7, 64, 768):
        a, b = draw.normal(size=(2, 2000, dimension)) * np.exp(draw.normal(size=(2, 2000, dimension)))
        b[:1000] = a[:1000] * (1 + draw.normal(size=(1000, dimension)) * 1e-5)
        single = np.einsum("ij,ij->i", posting_lists.unit(a), posting_lists.unit(b))
        off = np.abs(single - posting_lists.cosine(a, b)).max()
        assert off <= posting_lists.single_error(dimension)


def test_lists_are_balanced():
    draw = np.random.default_rng(1)
    skewed = np.concatenate([draw.normal(size=(900, 8)) * 0.01 + 1, draw.normal(size=(124, 8))])
    vectors = posting_lists.unit(skewed)
    centroids = posting_lists.halved(vectors, 16, np.random.default_rng(2))
    assert len(centroids) == 16
    index = posting_lists.fit(vectors, 16)
    first = [c[0] for c in index.lists_of(vectors)]
    assert max(np.bincount(first, minlength=16)) < 1024 / 3


def test_walk_finds_near_centroids():
    draw = np.random.default_rng(4)
    vectors = posting_lists.unit(draw.normal(size=(4000, 16)))
    index = posting_lists.fit(vectors, 256)
    queries = posting_lists.unit(draw.normal(size=(200, 16)))
    found, far = index.nearest(queries, 32)
    best = (queries @ index.centroids.T).argmax(1)
    assert np.mean(found[:, 0] == best) > 0.95
    assert (np.diff(far, axis=1) >= -1e-6).all()


def clustered(n, seed):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(60, 16)) * 2
    return centres[np.arange(n) % 60] + draw.normal(size=(n, 16))


def test_recall_where_the_walk_narrows_the_choice(monkeypatch):
    monkeypatch.setattr(posting_lists, "KEPT_LEAST", 8)
    vectors = posting_lists.unit(clustered(4000, 7))
    index = posting_lists.fit(vectors, 256)
    assert 256 // posting_lists.KEPT_SHARE > posting_lists.KEPT_LEAST
    lists = index.lists_of(vectors)
    own = np.bincount([c[0] for c in lists], minlength=256)
    queries = np.arange(0, 4000, 20)
    reads = index.lists_to_read(vectors[queries], own, 6)
    assert max(map(len, reads)) <= 256 // posting_lists.KEPT_SHARE
    close = vectors[queries] @ vectors.T
    close[np.arange(len(queries)), queries] = -np.inf
    best = np.argsort(-close, axis=1)[:, :5]
    hits = [bool({*lists[v]} & {*r}) for r, found in zip(reads, best, strict=True) for v in found]
    assert np.mean(hits) >= 0.9


def test_recall_at_most_lists(spark, monkeypatch):
    monkeypatch.setattr(posting_lists, "LIST_SIZE", 8)
    monkeypatch.setattr(posting_lists, "MOST_LISTS", 16)
    made = []
    fit = posting_lists.fit
    monkeypatch.setattr(posting_lists, "fit", lambda s, n: made.append(n) or fit(s, n))
    rows = [(i, v.tolist()) for i, v in enumerate(clustered(1500, 8))]
    found, expected = run(spark, rows), brute(rows, 5)
    assert made == [16]
    assert recall(found, expected) >= 0.9
    exact_scores(found, rows)


def test_boundary_vectors_lie_in_several_lists():
    centroids = posting_lists.unit(np.array([[1, 0.0], [0, 1.0], [-1, 0.0], [0, -1.0]]))
    index = posting_lists.fit(np.repeat(centroids, 8, 0), 4)
    lists = index.lists_of(posting_lists.unit(np.array([[1.0, 1.0], [1.0, 0.02]])))
    assert [len(x) for x in lists] == [2, 1]


def test_registered_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    found = {}
    for r in QUERIES["op5_posting_lists"](spark, sf_dir).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert recall(found, brute(rows, 5)) >= 0.9
