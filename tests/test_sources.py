import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_claims import make

from docintake.functions import urls
from docintake.operators import batches, browser, labels, pagetext
from docintake.schemas import ARCHIVE, LINKS
from docintake.session import shared_dir
from docintake.sources import archive, csvfiles
from docintake.sources.arrivals import list_files
from docintake.sources.files import list_folders
from docintake.sources.links import Environment, choose, read_archive, read_links
from docintake.sources.tables import SnapshotTable


def test_label_file(spark, tmp_path):
    path = tmp_path / "labels.csv"
    path.write_text(
        ",LINK,Presentation?\n0,http://a,Yes\n1,http://b,No\n2,http://c,50/50\n"
        '3,http://d,\n4,http://e,maybe\n5,"http://f,""x""\nz",Yes\n'
    )
    rows = labels.ingest(csvfiles.read_labels(spark, str(path), multi_line=True))
    assert rows.columns == ["pdf_link", "Presentation?", "classify_op"]
    assert [r["classify_op"] for r in rows.collect()] == [1, 2, 3, 0, 0, 1]
    assert rows.collect()[5]["pdf_link"] == 'http://f,"x"\nz'
    counts = labels.value_counts(rows, "classify_op").collect()
    assert [(r["value"], r["n"]) for r in counts] == [(0, 2), (1, 2), (2, 1), (3, 1)]
    raw = labels.value_counts(rows, "Presentation?").collect()
    assert [(r["value"], r["n"]) for r in raw] == [("Yes", 2), ("50/50", 1), ("No", 1), ("maybe", 1)]


def test_words_for_missing_values(spark, tmp_path):
    path = tmp_path / "labels.csv"
    path.write_text(",LINK,Presentation?\n0,http://a,NA\n1,http://b,null\n2,http://c,N/A\n3,NaN,Yes\n")
    rows = labels.ingest(csvfiles.read_labels(spark, str(path)))
    assert [(r["pdf_link"], r["Presentation?"]) for r in rows.collect()] == [
        ("http://a", None),
        ("http://b", None),
        ("http://c", None),
        (None, "Yes"),
    ]
    counts = labels.value_counts(rows, "Presentation?").collect()
    assert [(r["value"], r["n"]) for r in counts] == [("Yes", 1)]
    kept = csvfiles.read_labels(spark, str(path), missing=())
    assert [r["Presentation?"] for r in kept.collect()] == ["NA", "null", "N/A", "Yes"]


def test_dataset_file(spark, tmp_path):
    path = tmp_path / "dataset.csv"
    path.write_text("presentation,fname\n3,a.pdf\n1,b.pdf\n3,c.pdf\n")
    rows = labels.mixed_worklist(csvfiles.read_dataset(spark, str(path)), "/docs/")
    assert sorted(r["path"] for r in rows.collect()) == ["/docs/a.pdf", "/docs/c.pdf"]


@pytest.fixture(scope="module")
def links(spark):
    return make(
        spark,
        [
            {"id": 1, "pdf_link": 'a,"q"', "title": "", "status": "processed", "classify": 1},
            {"id": 2, "pdf_link": "b", "title": "two\nlines\r\n", "status": "unprocessed"},
            {"id": 3, "pdf_link": "c", "title": None, "status": "processing"},
            {"id": 4, "pdf_link": "c", "title": " \\ ", "status": None},
        ],
    )


def test_snapshot_round_trip(spark, links, tmp_path):
    csvfiles.export_snapshot(links, str(tmp_path / "s"), "id")
    back = csvfiles.import_snapshot(spark, str(tmp_path / "s"), LINKS)
    assert sorted(back.collect()) == sorted(links.collect())
    csvfiles.export_snapshot(links, str(tmp_path / "two"), "id", 2)
    short = csvfiles.import_snapshot(spark, str(tmp_path / "two"), LINKS)
    assert {r["id"] for r in short.collect()} == {1, 2}


def test_archive_append_repeat_and_truncate(spark, links, tmp_path):
    path = str(tmp_path / "archive")
    rows = batches.processed_archive(links)
    archive.append_archive(rows, path, "r1")
    archive.append_archive(rows, path, "r1")
    archive.append_archive(batches.first_archive(links, "c"), path, "r2")
    got = read_archive(spark, path).collect()
    assert sorted(r["pg_id"] for r in got) == [1, 3]
    assert all(r["last_updated"] is not None for r in got)
    archive.truncate_archive(spark, path)
    assert read_archive(spark, path).count() == 0
    assert spark.read.parquet(path).columns[: len(ARCHIVE.names)] == ARCHIVE.names
    archive.append_archive(rows, path, "r3")
    assert read_archive(spark, path).count() == 1


def test_snapshot_table_keeps_the_version_being_read(spark, links, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), LINKS)
    assert table.version() == 0 and table.read().count() == 0
    table.commit(links)
    before = table.read()
    table.commit(before.where("id > 1"))
    assert table.version() == 2
    assert table.read().count() == 3
    assert before.count() == 4
    env = choose({"development": Environment(link_snapshots=str(tmp_path / "t"))}, "development")
    assert read_links(spark, env).count() == 3


def test_changes_replace_rows_without_a_new_snapshot(spark, links, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), LINKS)
    table.change(links.where("id = 4"))
    assert [r["id"] for r in table.read().collect()] == [4]
    table.commit(links)
    table.change(table.read().where("id IN (1, 2)").withColumn("status", F.lit("x")))
    table.change(table.read().where("id = 2").withColumn("status", F.lit(None).cast("string")))
    want = {1: "x", 2: None, 3: "processing", 4: None}
    assert {r["id"]: r["status"] for r in table.read().collect()} == want
    assert table.read().columns == LINKS.names
    table.compact()
    assert {r["id"]: r["status"] for r in table.read().collect()} == want


def test_filters_reach_both_parts_of_a_changed_table(spark, links, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), LINKS)
    table.commit(links)
    table.change(links.where("id = 1"))
    rows = table.read().where("status <> 'in_process'").select("id", "status")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(status), Not(EqualTo(status,in_process))]" in plan
    assert "ReadSchema: struct<id:bigint,status:string>" in plan


def test_links_come_over_jdbc_where_no_snapshot_is_named(spark):
    env = Environment(jdbc={"url": "jdbc:none://host/db", "user": "u"})
    with pytest.raises(Exception, match="(?i)driver"):
        read_links(spark, env, lower=0, upper=100, partitions=4)


def test_unknown_environment():
    with pytest.raises(ValueError):
        choose({}, "staging")


def test_batch_steps(spark, links):
    assert [r["id"] for r in batches.with_status(links, "processed").collect()] == [1]
    left = batches.without_status(links, "processed").collect()
    assert sorted(r["id"] for r in left) == [2, 3, 4]
    plan = {r["id"]: (r["action"], r["final_status"]) for r in batches.close_plan(links).collect()}
    assert plan == {
        1: ("archive", "done"),
        2: ("release", "unprocessed"),
        3: ("drop", "processing"),
        4: ("drop", None),
    }
    done = {r["id"]: r["status"] for r in batches.set_done(links, "zzz").collect()}
    assert done[1] == "processed"
    done = {r["id"]: r["status"] for r in batches.set_done(links).collect()}
    assert done == {1: "done", 2: "unprocessed", 3: "processing", 4: None}
    assert batches.empty_like(links).isEmpty()
    assert {r["status"] for r in batches.append(links.limit(0), links).collect()} == {"unprocessed"}


@pytest.mark.parametrize(
    "url, ext, route",
    [
        ("http://a/x.PDF", "pdf", "download"),
        ("http://a/x.pdf?a=1", "pdf?a=1", "maybe_pdf"),
        ("http://a/x.Htm", "htm", "html_seen"),
        ("nodot", "nodot", "maybe_pdf"),
        ("pdf", "pdf", "download"),
    ],
)
def test_url_routes(spark, url, ext, route):
    row = spark.range(1).select(
        urls.extension(F.lit(url)).alias("e"), urls.route(F.lit(url)).alias("r")
    ).first()
    assert (row["e"], row["r"]) == (ext, route)


def test_file_names_are_case_sensitive(spark):
    row = spark.range(1).select(
        urls.is_pdf_file(F.lit("x.PDF")).alias("a"), urls.is_pdf_file(F.lit("x.pdf")).alias("b")
    ).first()
    assert (row["a"], row["b"]) == (False, True)


def test_download_states(spark):
    items = spark.createDataFrame([(1, "complete"), (2, "interrupted")], "id int, state string")
    assert [r["id"] for r in browser.download_states(items, "interrupted").collect()] == [2]


def test_shared_dir_is_the_checkpoint_folder(spark):
    folder = shared_dir(spark)
    assert spark.sparkContext.getCheckpointDir().startswith(("file:", folder))
    assert shared_dir(spark) == shared_dir(spark)


def test_versions_before_the_newest_snapshot_are_not_read(spark, tmp_path):
    schema = T.StructType.fromDDL("id long, v string")
    table = SnapshotTable(spark, str(tmp_path / "t"), schema)

    def rows(*pairs):
        return spark.createDataFrame(pairs, schema)

    table.commit(rows((1, "a"), (2, "b")))
    for n in range(3):
        table.change(rows((2, f"b{n}")))
    table.compact()
    table.change(rows((3, "c")))
    assert [v["kind"] for v in table._live()] == ["snapshot", "change"]
    assert table.version() == 6
    # A job that died before its first version leaves an empty folder.
    (tmp_path / "t" / "versions" / "since=00000099").mkdir()
    again = SnapshotTable(spark, str(tmp_path / "t"), schema)
    assert sorted(map(tuple, again.read().collect())) == [(1, "a"), (2, "b2"), (3, "c")]
    again.change(rows((1, "z")))
    assert again.version() == 7


def test_parts_of_a_table_are_read_alone(spark, tmp_path):
    schema = T.StructType.fromDDL("part int, id long, v string")
    table = SnapshotTable(spark, str(tmp_path / "t"), schema, ("part", "id"), part="part")
    table.commit(spark.createDataFrame([(n % 4, n, "old") for n in range(20)], schema))
    table.change(spark.createDataFrame([(1, 5, "new"), (2, 2, "new"), (3, 99, "new")], schema))
    found = table.read(F.col("part") == 1)
    assert sorted((r["id"], r["v"]) for r in found.collect()) == [
        (1, "old"), (5, "new"), (9, "old"), (13, "old"), (17, "old")
    ]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(part") >= 2
    assert table.read().count() == 21
    with pytest.raises(ValueError, match="no key column"):
        SnapshotTable(spark, str(tmp_path / "u"), schema, ("id",), part="part")


def test_pages_of_many_small_files_go_on_together():
    """A frame holds the pages of many runs, and no more than a bounded text."""
    few = [[("p", n, "a", None), ("p", n + 1, "", "b")] for n in range(900)]
    frames = list(pagetext.page_batches()(iter([[], *few])))
    assert [len(f) for f in frames] == [1800]
    wide = [[("p", n, "x" * 100_000, "y")] for n in range(40)]
    frames = list(pagetext.page_batches()(iter(wide)))
    assert sum(len(f) for f in frames) == 40 and max(len(f) for f in frames) <= 11
    assert list(pagetext.page_batches()(iter([[], []]))) == []


def test_tasks_list_the_folders_they_are_given(spark, tmp_path):
    for n in range(30):
        (tmp_path / f"block={n}").mkdir()
        (tmp_path / f"block={n}" / "part-0.txt").write_text("x" * (n + 1))
    (tmp_path / "block=3" / ".part-0.txt.crc").write_text("hidden")
    (tmp_path / "block=3" / "_SUCCESS").write_text("hidden")
    (tmp_path / "block=3" / "empty.txt").write_text("")
    (tmp_path / "block=3" / "below").mkdir()
    (tmp_path / "block=3" / "below" / "part-0.txt").write_text("x")
    wanted = [f"file://{tmp_path}/block={n}" for n in (3, 5, 99)]
    found = list_folders(spark.createDataFrame([(w,) for w in wanted], "folder string"))
    assert {tuple(r) for r in found.collect()} == {
        (f, f"{f}/part-0.txt", n + 1) for f, n in zip(wanted, (3, 5))
    }
    whole = list_folders(spark.createDataFrame([(f"{tmp_path}/block={n}",) for n in range(30)], "folder string"))
    by_spark = {r["path"].removeprefix("file:") for r in list_files(spark, f"{tmp_path}/block=*").collect()}
    assert {r["path"] for r in whole.collect()} == by_spark
