"""Operator 13 against brute force, other readers and broken archives."""

import gzip
import hashlib
import os
from collections import Counter

import numpy as np
import pytest
from compare import difference, duck
from pyspark.sql import functions as F

from docintake.llm import warc
from docintake.llm.queries import ORACLES, QUERIES
from docintake.session import scratch_path
from docintake.sources.files import file_system

FIELDS = "page_id long, url string, html string"
BIG = "<p>" + "long text " * 200_000 + "</p>"
SAME = "x" * 100


def rows():
    return [
        (5, "http://a/5", SAME),
        (3, "http://a/3", SAME),
        (None, "http://a/none", SAME),
        (9, None, "y" * 99),
        (8, "http://a/8", "y" * 99),
        (1, "http://a/b c\r\nWARC-Type: fake", "é" * 50),
        (2, "http://ä/%20?q=中", "é" * 50),
        (4, "u", None),
        (6, "u", ""),
        (7, "u", BIG),
        (10, "u", BIG),
        (11, "u", "a\r\n\r\nWARC/1.1\r\n\r\nb\x00"),
        (12, "u", "z" * 150),
        (12, "u", "z" * 150),
        (12, "other", "z" * 150),
    ]


def frame(spark, values, extra=False):
    made = spark.createDataFrame(values, FIELDS).repartition(3)
    if extra:
        for name in ("row", "digest", "bytes", "first_page", "archive", "payload", "HTML_"):
            made = made.withColumn(name, F.lit("other"))
    return made


def brute(values):
    found, first = [], {}
    order = sorted(range(len(values)), key=lambda i: (values[i][0] is None, values[i][0] or 0))
    for i in order:
        page, _, html = values[i]
        data = (html or "").encode()
        revisit = len(data) >= 100 and data in first
        refers = first.setdefault(data, page) if revisit else None
        first.setdefault(data, page)
        kind = "revisit" if revisit else "response"
        found.append((page, len(data), hashlib.sha256(data).hexdigest(), kind, refers))
    return Counter(found)


NAMES = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@pytest.mark.parametrize("extra", [False, True])
@pytest.mark.parametrize("most", [1 << 28, 200])
def test_pages_come_back_as_records(spark, extra, most):
    folder = scratch_path(spark, "warc")
    index = warc.write_archives(frame(spark, rows(), extra), folder, archive_bytes=most)
    found = warc.read_records(index, folder, task_bytes=300).collect()
    assert Counter(tuple(r[c] for c in NAMES) for r in found) == brute(rows())
    texts = {(p, (h or "").encode()) for p, _, h in rows()}
    assert all((r["page_id"], bytes(r["payload"])) in texts for r in found if r["payload"] is not None)
    urls = Counter((p, u) for p, u, _ in rows())
    assert Counter((r["page_id"], r["url"]) for r in index.collect()) == urls


def test_an_empty_table_gives_an_empty_index(spark):
    folder = scratch_path(spark, "warc")
    index = warc.write_archives(frame(spark, []), folder)
    assert index.isEmpty() and warc.read_records(index, folder).isEmpty()


def test_archives_are_gzip_files_that_others_read(spark):
    """The index says where records lie; read from the start, they follow each other."""
    folder = scratch_path(spark, "warc")
    index = warc.write_archives(frame(spark, rows()), folder).collect()
    _, path = file_system(folder)
    for name in {r["archive"] for r in index}:
        data = open(os.path.join(path, name), "rb").read()
        mine = sorted((r["offset"], r["length"]) for r in index if r["archive"] == name)
        ends = [0, *np.cumsum([n for _, n in mine]).tolist()]
        assert [at for at, _ in mine] == ends[:-1] and ends[-1] == len(data)
        whole, at = gzip.decompress(data), 0
        for _ in mine:
            head, _, rest = whole[at:].partition(b"\r\n\r\n")
            lines = head.decode("ascii").split("\r\n")
            assert lines[0] == "WARC/1.1" and sum(x.startswith("WARC-Type:") for x in lines) == 1
            length = int(warc.fields_of(head)["content-length"])
            assert rest[length : length + 4] == b"\r\n\r\n"
            at += len(head) + 4 + length + 4
        assert at == len(whole)


def test_ranges_close_together_are_one_read():
    offsets = np.array([0, 10, 500, 505, 2000])
    lengths = np.array([10, 20, 5, 5, 900])
    assert warc.coalesced(offsets, lengths, gap=100, most=10**6) == [(0, 2), (2, 4), (4, 5)]
    assert warc.coalesced(offsets, lengths, gap=10**6, most=600) == [(0, 4), (4, 5)]
    assert warc.coalesced(offsets, lengths, gap=0, most=10**6) == [(0, 2), (2, 4), (4, 5)]
    assert warc.coalesced(offsets[:0], lengths[:0]) == []


def test_selected_records_are_read_and_no_others(spark, monkeypatch):
    values = [(n, f"http://h{n % 7}/{n}", f"page {n} " * (n % 40 + 1)) for n in range(500)]
    folder = scratch_path(spark, "warc")
    index = warc.write_archives(frame(spark, values), folder).collect()
    found = warc.read_records(
        spark.createDataFrame(index), folder, F.col("url").startswith("http://h3/")
    )
    assert {r["page_id"]: r["payload"].decode() for r in found.collect()} == {
        n: html for n, url, html in values if url.startswith("http://h3/")
    }


def test_a_changed_archive_is_found_out(spark):
    folder = scratch_path(spark, "warc")
    index = warc.write_archives(frame(spark, [(1, "u", "some page")]), folder).collect()
    _, path = file_system(folder)
    name = os.path.join(path, index[0]["archive"])
    raw = gzip.decompress(open(name, "rb").read())
    with open(name, "wb") as out:
        out.write(warc.member(raw.replace(b"some page", b"more page")))
    with pytest.raises(Exception, match="another payload"):
        warc.read_records(spark.createDataFrame(index), folder).collect()


def test_registered_records(spark, sf_dir):
    found = QUERIES["op13_warc"](spark, sf_dir)
    assert difference(found, duck(sf_dir), ORACLES["op13_warc"]) is None
