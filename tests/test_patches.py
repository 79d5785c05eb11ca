import pytest
from test_claims import make

from docintake.operators import patches
from docintake.schemas import PATCH_COLUMNS

SCHEMA = (
    "pdf_link string, ordinal long, classify int, title string, date string, author string, "
    "sector string, status string, filename_location string"
)


@pytest.fixture(scope="module")
def links(spark):
    return make(
        spark,
        [
            {"id": 1, "pdf_link": "a", "title": "old", "sector": "Energy", "status": "in_process"},
            {"id": 2, "pdf_link": "a", "title": None, "classify": 1},
            {"id": 3, "pdf_link": "b", "title": "keep", "status": "done"},
        ],
    )


def patch(spark, *rows):
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r.get(c) for c in names) for r in rows], SCHEMA)


def by_id(df):
    return {r["id"]: r.asDict() for r in df.collect()}


def test_dense_patch_writes_null_and_all_rows_of_a_link(spark, links):
    p = patch(
        spark,
        {"pdf_link": "a", "ordinal": 1, "title": "first", "classify": 3},
        {"pdf_link": "a", "ordinal": 2, "classify": 2},
        {"pdf_link": "unknown", "ordinal": 3, "title": "x"},
    )
    got = by_id(patches.merge_patch(links, p))
    assert len(got) == 3
    for n in (1, 2):
        assert (got[n]["classify"], got[n]["title"], got[n]["sector"]) == (2, None, None)
        assert got[n]["status"] == "ready"
    assert got[3]["title"] == "keep" and got[3]["status"] == "done"
    count = patches.merge_count(links, p).first()
    assert (count["rows_updated"], count["row_writes"]) == (2, 4)


def test_sparse_patch_keeps_what_is_not_given(spark, links):
    p = patch(
        spark,
        {"pdf_link": "a", "ordinal": 1, "title": "new", "author": "A"},
        {"pdf_link": "a", "ordinal": 2, "title": "", "author": "B"},
    )
    got = by_id(patches.sparse_patch(links, p))
    assert (got[1]["title"], got[1]["author"], got[1]["sector"]) == ("new", "B", "Energy")
    assert got[1]["status"] == "in_process"
    applied = patches.patch_has_data(patch(spark, {"pdf_link": "a", "title": ""})).first()
    assert applied["applied"] is False


def test_empty_patch_changes_nothing(spark, links):
    none = patch(spark).limit(0)
    assert by_id(patches.merge_patch(links, none)) == by_id(links)
    assert by_id(patches.sparse_patch(links, none)) == by_id(links)
    assert patches.merge_count(links, none).first()["rows_updated"] == 0


def test_missing_columns_are_refused(spark, links):
    with pytest.raises(ValueError, match="title"):
        patches.merge_patch(links, patch(spark).drop("title"))


def test_release_by_id(spark, links):
    ids = spark.createDataFrame([(1,), (1,), (9,)], "id long")
    got = by_id(patches.release_links(links, ids))
    assert [got[n]["status"] for n in (1, 2, 3)] == ["ready", None, "done"]


def test_lookup_takes_the_first_row(spark, links):
    urls = spark.createDataFrame([("a",), ("a",), ("zzz",)], "pdf_link string")
    got = {r["pdf_link"]: (r["found"], r["title"]) for r in patches.link_lookup(links, urls).collect()}
    assert got == {"a": (True, "old"), "zzz": (False, None)}


def test_nothing_is_marked_for_broadcast(spark, links):
    plans = [
        patches.release_links(links, spark.range(3)),
        patches.merge_patch(links, patch(spark)),
        patches.sparse_patch(links, patch(spark)),
    ]
    for rows in plans:
        assert "strategy=broadcast" not in rows._jdf.queryExecution().analyzed().toString()


def test_rows_of_links_that_nobody_asks_for_go_first(spark, links, tmp_path):
    links.write.parquet(str(tmp_path / "links"))
    stored = spark.read.parquet(str(tmp_path / "links"))
    urls = spark.createDataFrame([("a",)], "pdf_link string")
    plan = patches.look_up(stored, urls, ["title"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate [pdf_link") < plan.index("LeftSemi")


def test_reset_null_tags(spark):
    rows = make(
        spark,
        [
            {"id": 1, "status": "in_process", "classify": 1},
            {"id": 2, "status": "in_process", "classify": 1, "title": ""},
            {"id": 3, "status": "in_process", "classify": 3},
            {"id": 4, "status": None, "classify": 1},
        ],
    )
    got = by_id(patches.reset_null_tags(rows))
    assert [got[n]["status"] for n in (1, 2, 3, 4)] == ["ready", "in_process", "in_process", None]


def test_first_rows_by_position(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, None), ("j", 5, "c")], "k string, n int, v string")
    got = {r["k"]: r["v"] for r in patches.first_rows(df, ["k"], "n", ["n", "v"]).collect()}
    assert got == {"k": None, "j": "c"}
