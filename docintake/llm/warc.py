"""Operator 13: WARC archives, index first.

Pages are written as records of WARC 1.1, each a gzip member of its own, into archive files of
a bounded size. What a task returns is the index: archive, offset, length, URL and digest of
every record. Whoever reads asks the index first, sorts the records that are wanted by archive
and offset, joins byte ranges that lie close together, and reads only those.

Archives lie in the shared folder and are reached through ``pyarrow.fs``, which knows shared
file systems, HDFS and object stores by the folder's URI. A task that runs again writes files
of its own; only the index of the attempt that Spark commits names files, and a file that no
index names is never read.

Of records with equal payloads of at least ``least_bytes`` bytes the one with the smallest
``page_id`` is a ``response``; the others are ``revisit`` records, which keep the HTTP header
and the digest and name the response. Payloads that many pages share, a third of all pages
say, meet as counts per digest before they are shuffled; the join with them is a plain one,
which adaptive execution splits.

Defined results: a null ``html`` is an empty payload; a null ``page_id`` is larger than any
other; of repeated rows with one ``page_id`` and one payload one is the response and the
others revisit it; a null ``url`` leaves the record without a target, and blanks, controls and
characters beyond ASCII in a URL are percent-encoded in the record, while the index keeps the
URL as it is; an empty table gives an empty index. Columns other than ``page_id``, ``url`` and
``html`` are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import partial
from urllib.parse import quote
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docintake.llm.common import chunks, on_batches, table, written
from docintake.session import scratch_path
from docintake.sources.files import file_system

# Payloads below this are never worth a revisit record.
LEAST_BYTES = 100

# A task begins another archive beyond this size.
ARCHIVE_BYTES = 256 << 20

# Ranges with at most this gap between them become one read, of about this size at most.
GAP_BYTES = 64 << 10
READ_BYTES = 8 << 20

# Compressed bytes that one reading task gets, about.
TASK_BYTES = 32 << 20

# Pages carry no time of capture.
CAPTURED = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_START = "urn:x-page:"

INDEX = """archive string, offset long, length long, page_id long, url string,
payload_digest string, record_type string"""
RECORD = """page_id long, payload_bytes long, payload_digest string, record_type string,
refers_to long, payload binary"""


def record_id(page_id: int | None, row: int) -> str:
    """Names a record: the page, and the row that it came from, as pages may repeat."""
    return f"<{ID_START}{'null' if page_id is None else page_id}:{row}>"


def page_of(name: str) -> int | None:
    page = name.strip("<>").removeprefix(ID_START).partition(":")[0]
    return None if page == "null" else int(page)


def record(
    row: int,
    page_id: int | None,
    url: str | None,
    digest: str,
    payload: bytes,
    refers_to: tuple[int | None, int] | None,
) -> bytes:
    """One record, a ``revisit`` without payload if it ``refers_to`` a response."""
    kind = "response" if refers_to is None else "revisit"
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode("ascii")
    body = http + (payload if refers_to is None else b"")
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_id(page_id, row)),
        ("WARC-Date", CAPTURED),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Length", str(len(body))),
    ]
    if url is not None:
        fields.insert(3, ("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    if refers_to is not None:
        fields += [("WARC-Refers-To", record_id(*refers_to)), ("WARC-Profile", PROFILE)]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return head.encode("ascii") + body + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member without a time stamp, so the same record gives the same bytes."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def fields_of(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {name.lower(): value.strip() for name, _, value in (x.partition(":") for x in lines)}


def parse(data: bytes) -> dict:
    """What a record says; a ``response`` must have the digest that it names."""
    head, _, rest = data.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("no WARC record at this place")
    fields = fields_of(head)
    body = rest[: int(fields["content-length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    kind = fields["warc-type"]
    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"{fields['warc-record-id']} has another payload than its digest says")
    return {
        "page_id": page_of(fields["warc-record-id"]),
        "payload_bytes": int(fields_of(http)["content-length"]),
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": page_of(fields["warc-refers-to"]) if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
    }


def write_records(
    batches: Iterator[pa.RecordBatch], folder: str, most: int
) -> Iterator[pa.RecordBatch]:
    """Append the records of a task to archives and yield their index."""
    system, path = file_system(folder)
    out, name, at = None, None, 0
    try:
        for chunk in chunks(batches, "html"):
            found = []
            columns = ("row", "page_id", "url", "digest", "html", "first_page", "first_row")
            for row, page, url, digest, html, first_page, first_row in zip(
                *(chunk.column(c).to_pylist() for c in columns), strict=True
            ):
                if out is None or at >= most:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid4().hex}.warc.gz", 0
                    # Records are compressed one by one already.
                    out = system.open_output_stream(f"{path}/{name}", compression=None)
                other = None if first_row is None or first_row == row else (first_page, first_row)
                data = member(record(row, page, url, digest, html.encode("utf-8"), other))
                out.write(data)
                kind = "response" if other is None else "revisit"
                found.append((name, at, len(data), page, url, digest, kind))
                at += len(data)
            names = ("archive", "offset", "length", "page_id", "url", "payload_digest")
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(column, kind)
                    for column, kind in zip(
                        zip(*found, strict=True), [*kinds, pa.string()], strict=True
                    )
                ],
                [*names, "record_type"],
            )
    finally:
        if out is not None:
            out.close()


def coalesced(
    offsets: np.ndarray, lengths: np.ndarray, gap: int = GAP_BYTES, most: int = READ_BYTES
) -> list[tuple[int, int]]:
    """Runs ``(first, last + 1)`` of sorted ranges that are read at once."""
    runs, first = [], 0
    ends = offsets + lengths
    for i in range(1, len(offsets) + 1):
        if i == len(offsets) or (
            offsets[i] - ends[i - 1] > gap or ends[i] - offsets[first] > most
        ):
            runs.append((first, i))
            first = i
    return runs


def read_ranges(
    batches: Iterator[pa.RecordBatch], folder: str, payloads: bool
) -> Iterator[pa.RecordBatch]:
    """Read the records whose places come sorted by archive and offset."""
    system, path = file_system(folder)
    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            ("payload", pa.binary()),
        ]
    )
    source, opened = None, None
    try:
        for batch in batches:
            archives = np.array(batch.column("archive").to_pylist(), object)
            offsets = batch.column("offset").to_numpy()
            lengths = batch.column("length").to_numpy()
            cuts = np.flatnonzero(archives[1:] != archives[:-1]) + 1
            edges = [0, *cuts.tolist(), len(archives)]
            for start, end in zip(edges[:-1], edges[1:], strict=True):
                if start == end:
                    continue
                if archives[start] != opened:
                    if source is not None:
                        source.close()
                    opened = archives[start]
                    source = system.open_input_file(f"{path}/{opened}")
                for first, last in coalesced(offsets[start:end], lengths[start:end]):
                    first, last = first + start, last + start
                    base = int(offsets[first])
                    size = int(offsets[last - 1] + lengths[last - 1]) - base
                    data = source.read_at(size, base)
                    found = []
                    for i in range(first, last):
                        at = int(offsets[i]) - base
                        raw = zlib.decompress(data[at : at + int(lengths[i])], 31)
                        row = parse(raw)
                        found.append(row if payloads else row | {"payload": None})
                    yield pa.RecordBatch.from_pylist(found, schema)
    finally:
        if source is not None:
            source.close()


def rows_of(pages: DataFrame) -> DataFrame:
    """The pages with a number, size and digest each, written once: two records of the same
    page and payload are told apart by the number, which must not change between uses."""
    html = F.coalesce(F.col("html"), F.lit(""))
    return written(
        pages.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("page_id").cast("long").alias("page_id"),
            F.col("url").cast("string").alias("url"),
            F.sha2(html.cast("binary"), 256).alias("digest"),
            F.octet_length(html).cast("long").alias("bytes"),
            html.alias("html"),
        ),
        "warc-pages",
    )


def write_archives(
    pages: DataFrame,
    folder: str,
    least_bytes: int = LEAST_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write every page as a record below ``folder``; the index, one row per record."""
    spark = pages.sparkSession
    rows = rows_of(pages)
    first = F.struct(F.col("page_id").isNull().alias("unknown"), "page_id", "row")
    shared = (
        rows.where(F.col("bytes") >= least_bytes)
        .groupBy("digest")
        .agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .select(
            "digest",
            F.col("first.page_id").alias("first_page"),
            F.col("first.row").alias("first_row"),
        )
    )
    marked = rows.drop("bytes").join(shared, "digest", "left")
    # Executors make no folders in a store that has any; a shared file system needs this one.
    system, path = file_system(folder)
    system.create_dir(path, recursive=True)
    step = partial(write_records, folder=folder, most=archive_bytes)
    index = on_batches(marked, step, INDEX)
    index_path = scratch_path(spark, "warc-index")
    index.write.parquet(index_path)
    return spark.read.schema(index.schema).parquet(index_path)


def read_records(
    index: DataFrame,
    folder: str,
    where: Column | None = None,
    payloads: bool = True,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """The records that ``where`` selects in the index (all without it), read by byte ranges:
    ``page_id, payload_bytes, payload_digest, record_type, refers_to, payload``."""
    chosen = (index if where is None else index.where(where)).select("archive", "offset", "length")
    total = chosen.agg(F.sum("length")).first()[0] or 0
    parts = max(1, -(-total // task_bytes))
    placed = chosen.repartitionByRange(parts, "archive", "offset").sortWithinPartitions(
        "archive", "offset"
    )
    return on_batches(placed, partial(read_ranges, folder=folder, payloads=payloads), RECORD)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``op13``: every page written as a record and read back from the archives."""
    folder = scratch_path(spark, "warc")
    index = write_archives(table(spark, sf_dir, "pages"), folder)
    return read_records(index, folder, payloads=False).drop("payload")


SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
), d AS (
  SELECT page_id, octet_length(body) AS payload_bytes, sha256(body) AS payload_digest FROM p
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_page FROM d
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_page THEN 'revisit' ELSE 'response' END
    AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_page THEN first_page END AS refers_to
FROM f
"""
