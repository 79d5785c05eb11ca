import pytest
from pyspark.sql import functions as F

from docintake.operators import batches, claims
from docintake.schemas import CLAIM_COLUMNS, LINKS


def make(spark, rows):
    blank = dict.fromkeys(LINKS.names)
    return spark.createDataFrame(
        [tuple((blank | r)[c] for c in LINKS.names) for r in rows], LINKS
    )


@pytest.fixture(scope="module")
def links(spark):
    urls = ["http://a/1.pdf", "http://a/2.HTM", "http://a/3.html", "http://a/4", "http://a/5.pdf?x=1"]
    rows = [
        {"id": n, "pdf_link": urls[n % 5], "status": (None, "ready", "in_process", "done")[n % 4]}
        for n in range(40)
    ]
    return make(spark, rows)


def test_rows_without_status_are_not_eligible(links):
    got = claims.claim_batch(links, 100, "s")
    assert got.columns == list(CLAIM_COLUMNS)
    assert {r["id"] % 4 for r in got.collect()} == {1, 3}


def test_batch_larger_than_eligible_rows_takes_all(links):
    assert claims.claim_batch(links, 1000, "s").count() == 20


def test_no_eligible_rows(links):
    taken = links.withColumn("status", F.lit("in_process"))
    assert claims.claim_batch(taken, 5, "s").isEmpty()
    assert batches.worklist(taken, 5, "s").isEmpty()


def test_suffixes(links):
    html = {r["pdf_link"] for r in claims.claim_html(links, 100, "s").collect()}
    assert html == {"http://a/2.HTM", "http://a/3.html"}
    bare = {r["pdf_link"] for r in claims.claim_no_extension(links, 100, "s").collect()}
    assert bare == {"http://a/4", "http://a/5.pdf?x=1"}


@pytest.mark.parametrize("size", [0, -1, "5", 2.0, True, None])
def test_batch_size_is_checked(links, size):
    with pytest.raises(ValueError):
        claims.claim_batch(links, size, "s")


def test_seed_decides(links):
    one = [r["id"] for r in claims.claim_batch(links, 5, "s").collect()]
    assert one == [r["id"] for r in claims.claim_batch(links, 5, "s").collect()]
    assert one != [r["id"] for r in claims.claim_batch(links, 5, "t").collect()]


@pytest.mark.parametrize("size", [1, 7, 20, 35, 500])
def test_claims_are_the_first_in_draw_order(links, size):
    got = claims.pick(links, claims.wants_download(), size, "s").orderBy("_turn").collect()
    drawn = links.where(claims.wants_download()).withColumn("_draw", claims.draw_order("s"))
    want = drawn.orderBy("_draw", "id").limit(size).collect()
    assert [r["id"] for r in got] == [r["id"] for r in want]
    assert [r["_turn"] for r in got] == list(range(1, len(want) + 1))


def test_claims_cut_inside_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(
        claims,
        "draw_order",
        lambda seed: F.format_string(
            "%s%04d", F.when(F.col("id") < 50, "0000").otherwise("0001"), (F.col("id") * 7) % 50
        ),
    )
    rows = spark.range(100)
    drawn = rows.withColumn("_draw", claims.draw_order("s"))
    for size in (10, 50, 60, 100, 200):
        got = {r["id"] for r in claims.pick(rows, F.lit(True), size, "s").collect()}
        want = {r["id"] for r in drawn.orderBy("_draw", "id").limit(size).collect()}
        assert got == want


def test_claimed_rows_are_in_process_and_others_unchanged(links):
    claimed, after = claims.claim(links, 5, "s")
    ids = {r["id"] for r in claimed.collect()}
    old = {r["id"]: r["status"] for r in links.collect()}
    for r in after.collect():
        assert r["status"] == ("in_process" if r["id"] in ids else old[r["id"]])
    again, _ = claims.claim(after, 100, "s")
    assert not ids & {r["id"] for r in again.collect()}


def test_claims_filter_at_the_scan_and_run_nothing_when_built(spark, links, tmp_path):
    links.write.parquet(str(tmp_path / "links"))
    stored = spark.read.parquet(str(tmp_path / "links"))
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    rows = claims.claim_batch(stored, 5, "s")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert len(tracker.getJobIdsForGroup(None)) == before
    assert "IsNull(filename_location)" in plan and "Not(EqualTo(status,in_process))" in plan


def test_worklist_is_numbered_in_draw_order(links):
    rows = batches.worklist(links, 6, "s").orderBy("position").collect()
    assert [r["position"] for r in rows] == [1, 2, 3, 4, 5, 6]
    assert {r["id"] for r in rows} == {r["id"] for r in claims.claim_batch(links, 6, "s").collect()}
    assert batches.up_to(batches.worklist(links, 6, "s"), 4).count() == 4


def test_worklist_replaces_an_empty_link(spark):
    rows = make(spark, [{"id": 1, "pdf_link": "", "status": "ready"}])
    got = batches.worklist(rows, 1, "s").first()
    assert (got["href"], got["record"]) == ("#", '{"id":1,"pdf_link":""}')
