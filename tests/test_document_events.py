"""Downloads bring documents out of the whole table."""

from conftest import SF

from docintake.plans import fixtures as fx
from docintake.plans import queries


def test_downloads_bring_documents_out_of_the_whole_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    named = queries.document_events(spark, sf_dir)
    assert named.count() == fx.link_events(spark, sf_dir).count()
    ids = fx.table(spark, sf_dir, "documents").select("doc_id")
    assert named.select("doc_id").distinct().exceptAll(ids).count() == 0
    # Every document is named by an event, and far more than 200 by a download.
    assert named.select("doc_id").distinct().count() == ids.count()
    loads = named.where("kind = 'download_complete'")
    assert loads.select("doc_id").distinct().count() > ids.count() / 2


def test_documents_whose_ids_have_gaps_are_named_by_place(spark, tmp_path):
    for name in ("events", "pages"):
        fx.table(spark, SF, name).write.parquet(str(tmp_path / f"{name}.parquet"))
    ids = [3, 70_000, 5_000_000_000]
    texts = spark.createDataFrame([(i, "a text") for i in ids], "doc_id long, text string")
    texts.write.parquet(str(tmp_path / "documents.parquet"))
    for r in queries.document_events(spark, str(tmp_path)).collect():
        assert r["doc_id"] == ids[r["event_id"] % 3]
