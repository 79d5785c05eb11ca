"""Operator 1: token ids as directly addressable codes.

An id is split into chunks of one byte, lowest first. The first chunks of all ids of a block
form level 0; a bitmap says of each whether the id goes on, and the chunks of those that do
form level 1 in the same order, and so on. A rank directory counts the set bits up to every
512th, so the place of an id's next chunk is found without decoding its neighbours.

A file set is a Parquet folder whose rows are blocks: ``part``, ``block`` (their order),
``offset`` (ids of the part before the block), ``docs`` (id, place in the block and number of
ids of each document) and ``codes`` (the levels, one binary). Documents lie in ascending
``doc_id`` order, so a reader prunes blocks by the statistics of ``first_doc``.

Defined results: a null text counts as empty and holds the end id alone; rows with a null
``doc_id`` come first; equal ids are ordered by text, and repeated rows are all kept; an empty
table gives an empty file set. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docintake.llm.common import (
    arrow_schema,
    binary_array,
    chunks,
    on_batches,
    table,
    whole_text,
)
from docintake.llm.fragments import text_encoder
from docintake.session import scratch_path

VOCABULARY = "byte_bpe_50k.json"

# Set bits are counted up to every so many bits.
RANK_BITS = 512

HEAD = struct.Struct("<4sIQ")
LEVEL = struct.Struct("<Q")
MAGIC = b"DAC1"

BLOCKS = """part int, block int, offset long, first_doc long, n_docs int, n_tokens long,
docs array<struct<doc_id: long, start: long, n_tokens: long>>, codes binary"""


def pack_codes(ids: np.ndarray) -> bytes:
    """The levels of a block of ids."""
    left, levels = ids.astype(np.uint64), []
    while True:
        goes_on = left >> np.uint64(8) > 0
        bits = np.packbits(goes_on, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (RANK_BITS // 8), np.uint8)])
        per_stretch = np.bitwise_count(bits.reshape(-1, RANK_BITS // 8)).sum(1, dtype=np.int64)
        rank = (np.cumsum(per_stretch) - per_stretch).astype("<u4")
        levels += [
            LEVEL.pack(len(left)),
            (left & np.uint64(255)).astype(np.uint8).tobytes(),
            bits.tobytes(),
            rank.tobytes(),
        ]
        left = left[goes_on] >> np.uint64(8)
        if not len(left):
            break
    return HEAD.pack(MAGIC, len(levels) // 4, len(ids)) + b"".join(levels)


class Codes:
    """A packed block: any id by its place, or all of them."""

    def __init__(self, data: bytes):
        magic, n_levels, self.size = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("these are not addressable codes")
        self.levels, at = [], HEAD.size
        for _ in range(n_levels):
            (n,) = LEVEL.unpack_from(data, at)
            n_stretches = -(-n // RANK_BITS)
            n_bits = n_stretches * RANK_BITS // 8
            at += LEVEL.size
            chunk = np.frombuffer(data, np.uint8, n, at)
            bits = np.frombuffer(data, np.uint8, n_bits, at + n)
            rank = np.frombuffer(data, "<u4", n_stretches, at + n + n_bits)
            self.levels.append((chunk, bits, rank))
            at += n + n_bits + 4 * n_stretches

    def __getitem__(self, place: int) -> int:
        """One id, by one byte and one rank for each of its chunks."""
        if not 0 <= place < self.size:
            raise IndexError(place)
        value = 0
        for k, (chunk, bits, rank) in enumerate(self.levels):
            value |= int(chunk[place]) << 8 * k
            byte, bit = divmod(place, 8)
            if not bits[byte] >> bit & 1:
                break
            stretch = place // RANK_BITS
            before = bits[stretch * RANK_BITS // 8 : byte]
            same_byte = int(bits[byte]) & (1 << bit) - 1
            within = int(np.bitwise_count(before).sum()) + same_byte.bit_count()
            place = int(rank[stretch]) + within
        return value

    def all(self) -> np.ndarray:
        values = np.zeros(self.size, "<u4")
        here = np.arange(self.size)
        for k, (chunk, bits, _) in enumerate(self.levels):
            values[here] |= chunk.astype("<u4") << np.uint32(8 * k)
            here = here[np.unpackbits(bits, count=len(here), bitorder="little").astype(bool)]
        return values


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end_id`` after each document's."""
    return np.insert(ids, np.cumsum(counts), end_id), counts + 1


def block_writer(path: str, end_id: int, schema: pa.Schema):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(path)
        part, offset = TaskContext.get().partitionId(), 0
        for block, chunk in enumerate(chunks(batches)):
            ids, counts = with_end(*encoder.encode(chunk.column("text")), end_id)
            starts = np.cumsum(counts) - counts
            doc_ids = chunk.column("doc_id").to_pylist()
            docs = [
                {"doc_id": d, "start": s, "n_tokens": n}
                for d, s, n in zip(doc_ids, starts.tolist(), counts.tolist(), strict=True)
            ]
            row = [part, block, offset, doc_ids[0], len(docs), len(ids), docs, pack_codes(ids)]
            offset += len(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema
            )

    return encode


def write_codes(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> None:
    """Encode every whole text, append ``end_id``, and write the blocks to ``path``.

    ``tokenizer`` is the file of a tokenizers-library tokenizer. Documents are put in
    order by a range partition on ``doc_id``; a task holds one block's arrays at a time.
    """
    spark = docs.sparkSession
    schema = arrow_schema(spark, BLOCKS)
    # Rows of one id, or of none, are cut by their texts where they are too many for a task.
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    in_order = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order, "text")
    )
    coded = on_batches(in_order, block_writer(tokenizer, end_id, schema), BLOCKS)
    coded.write.option("compression", "zstd").parquet(path)


def blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks of a file set, with ``before``: the ids of all blocks that precede each.

    What is broadcast is one pair of numbers per task that wrote the files.
    """
    read = spark.read.schema(BLOCKS).parquet(path)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per_part = read.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    starts = per_part.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("s"))
    return read.join(F.broadcast(starts), "part").withColumn("before", F.col("s") + F.col("offset"))


def read_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            docs = pa.RecordBatch.from_struct_array(batch.column("docs").slice(row, 1).flatten())
            ids = Codes(batch.column("codes")[row].as_py()).all()
            counts = docs.column("n_tokens").to_numpy()
            before = batch.column("before")[row].as_py()
            yield pa.RecordBatch.from_arrays(
                [
                    docs.column("doc_id"),
                    pa.array(docs.column("start").to_numpy() + before),
                    docs.column("n_tokens"),
                    binary_array(ids.view(np.uint8), 4 * counts),
                ],
                ["doc_id", "start", "n_tokens", "ids"],
            )


def read_codes(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """The documents of a file set: ``doc_id``, ``start`` (ids of all documents before it),
    ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit numbers).

    ``where`` is a condition on blocks, such as a range of ``first_doc``, that prunes files.
    """
    found = blocks(spark, path)
    found = found if where is None else found.where(where)
    fields = "doc_id long, start long, n_tokens long, ids binary"
    return on_batches(found.select("docs", "before", "codes"), read_blocks, fields)


def tokens_at(spark: SparkSession, path: str, places: DataFrame) -> DataFrame:
    """Single ids by their place in the whole corpus: ``places`` has a column ``place``.

    Places meet blocks by a range join on cells of a fixed width, so neither side is
    broadcast; only the asked ids are read out of a block's codes. A place outside the
    corpus, null or not, has no row.
    """
    cell = 1 << 20
    found = blocks(spark, path).withColumn("until", F.col("before") + F.col("n_tokens"))
    cells = F.sequence(F.floor(F.col("before") / cell), F.floor((F.col("until") - 1) / cell))
    asked = places.select(F.col("place").cast("long")).where("place >= 0").distinct()
    met = (
        found.where("n_tokens > 0")
        .withColumn("cell", F.explode(cells))
        .join(asked.withColumn("cell", F.floor(F.col("place") / cell)), "cell")
        .where("place >= before AND place < until")
        .groupBy("part", "block")
        .agg(
            F.first("codes").alias("codes"),
            F.first("before").alias("before"),
            F.collect_list("place").alias("asked"),
        )
    )

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes = Codes(row["codes"])
                ids = [codes[p - row["before"]] for p in row["asked"]]
                found = {"place": row["asked"], "id": pa.array(ids, pa.int64())}
                yield pa.RecordBatch.from_pydict(found)

    return on_batches(met.select("codes", "before", "asked"), pick, "place long, id long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``op1``: start, number and checksum of each document's ids, read back from the files."""
    path = scratch_path(spark, "addressable")
    write_codes(table(spark, sf_dir, "documents"), path, public_tokenizers.path(VOCABULARY))
    found = read_codes(spark, path)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
