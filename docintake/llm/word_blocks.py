"""Texts as blocks of numbered words, so that a word's value is worked out only once.

A block is some megabytes of whole texts. Its pre-tokens are numbered in order of how
often they occur; what a block keeps of its texts is the sequence of these numbers, which
is the position of every pre-token. The distinct words of all blocks are shuffled by word,
each is given its value once, and the values go back to their blocks.

Texts are cut in two passes over the table, one for the words and one for the sequences,
rather than kept on disk in between. Both name a block by a hash of its documents; if they
should not agree, because a table changed meanwhile, the job stops with an error.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docintake.llm.common import (
    arrow_schema,
    chunks,
    on_batches,
    texts_of,
    whole_text,
    written,
)
from docintake.llm.fragments import cut_pretokens, fragment_array

# Bytes of text in a block, or a little more. Larger blocks shuffle fewer distinct words
# and take more memory.
BLOCK_BYTES = 16 << 20


@dataclass
class Block:
    name: int
    doc_ids: pa.Array
    n_bytes: np.ndarray
    n_words: np.ndarray
    words: pa.Array
    slots: np.ndarray  # the number of each pre-token's word, in the order of the texts


def split_at(texts: pa.Array, special: str) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Texts in segments at each ``special`` string, which is a segment of its own:
    the segments, the text of each, and which are special."""
    parts = [re.split(f"({re.escape(special)})", t or "") for t in texts.to_pylist()]
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    flat = [s for p in parts for s in p]
    odd = np.concatenate([np.arange(len(p)) % 2 == 1 for p in parts])
    return pa.array(flat, pa.string()), owner, odd


def cut_chunk(chunk: pa.RecordBatch, special: str | None) -> tuple[pa.Array, np.ndarray]:
    """The pre-tokens of a chunk, dictionary-encoded, and how many each text has."""
    texts = chunk.column("text")
    data, bounds = texts_of(texts)
    owner = np.arange(chunk.num_rows)
    found = special and pc.any(pc.match_substring(texts, special)).as_py()
    if found:
        segments, owner, odd = split_at(texts, special)
        data, bounds = texts_of(segments)
    starts = cut_pretokens(data, bounds)
    segment = np.searchsorted(bounds, starts, "right") - 1
    if found:
        keep = ~odd[segment] | (starts == bounds[segment])
        starts, segment = starts[keep], segment[keep]
    counts = np.bincount(owner[segment], minlength=chunk.num_rows)
    return fragment_array(data, starts).dictionary_encode(), counts


def blocks_of(
    batches: Iterator[pa.RecordBatch], special: str | None, size: int
) -> Iterator[Block]:
    """Blocks of about ``size`` bytes of text, cut chunk by chunk."""
    held: list[tuple] = []
    filled = 0
    for chunk in chunks(batches):
        data, bounds = texts_of(chunk.column("text"))
        n_bytes = np.diff(bounds)
        named = xxhash.xxh3_64(np.ascontiguousarray(data))
        named.update(n_bytes)
        named.update(repr(chunk.column("doc_id").to_pylist()).encode())
        held.append((chunk.column("doc_id"), n_bytes, named.digest(), *cut_chunk(chunk, special)))
        filled += len(data)
        if filled >= size:
            yield joined(held)
            held, filled = [], 0
    if held:
        yield joined(held)


def joined(held: list[tuple]) -> Block:
    doc_ids, n_bytes, names, coded, counts = zip(*held, strict=True)
    whole = pa.chunked_array(coded).unify_dictionaries()
    words = whole.chunk(0).dictionary
    which = np.concatenate([c.indices.to_numpy() for c in whole.chunks])
    by_count = np.argsort(-np.bincount(which, minlength=len(words)), kind="stable")
    number = np.empty(len(words), np.uint32)
    number[by_count] = np.arange(len(words), dtype=np.uint32)
    return Block(
        xxhash.xxh3_64_intdigest(b"".join(names)) - (1 << 63),
        pa.concat_arrays(doc_ids),
        np.concatenate(n_bytes),
        np.concatenate(counts),
        words.take(pa.array(by_count)),
        number[which],
    )


def squeeze(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, their bytes in four planes, compressed."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def spread(data: bytes, n: int) -> np.ndarray:
    planes = pa.decompress(data, decompressed_size=4 * n, codec="zstd", asbytes=True)
    return np.frombuffer(planes, np.uint8).reshape(4, n).T.copy().view("<u4").ravel()


def through_words(
    docs: DataFrame,
    special: str | None,
    value: str,
    make_value: Callable[[], Callable[[list[str]], pa.Array]],
    keep: Callable[[Block], dict],
    kept: str,
    finish: Callable[[dict, pa.Array], Iterator[dict]],
    result: str,
    block_bytes: int = BLOCK_BYTES,
    scanned: bool = False,
) -> DataFrame:
    """Documents by way of their distinct words.

    Texts are cut into blocks twice, and must come in the same order both times, also when a
    lost executor's work is done again. A plain scan of files does that, which ``scanned``
    says; anything else is written once before.

    ``make_value`` gives, once per task, the function from distinct words to their values
    of Spark type ``value``. ``keep`` says what stays of a block (columns ``kept``), and
    ``finish`` makes the columns ``result`` from that and the values in word order, some
    documents at a time.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    texts = texts if scanned else written(texts, "texts-of-blocks")

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks_of(batches, special, block_bytes):
            n = len(block.words)
            names, slots = pa.array(np.full(n, block.name)), pa.array(np.arange(n, dtype=np.int32))
            columns = [names, slots, block.words.cast(pa.string())]
            whole = pa.RecordBatch.from_arrays(columns, ["block", "slot", "word"])
            for first in range(0, n, 50_000):
                yield whole.slice(first, 50_000)

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_words, last, last_value = make_value(), None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            coded = batch.column("word").dictionary_encode()
            words = coded.dictionary.to_pylist()
            # Rows come sorted by word, so only the first word can be known already.
            if words[0] == last:
                found = pa.concat_arrays([last_value, of_words(words[1:])])
            else:
                found = of_words(words)
            last, last_value = words[-1], found.slice(len(found) - 1)
            columns = [batch.column("block"), batch.column("slot"), found.take(coded.indices)]
            yield pa.RecordBatch.from_arrays(columns, ["block", "slot", "value"])

    def keep_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks_of(batches, special, block_bytes):
            row = {"block": block.name, "n_distinct": len(block.words), **keep(block)}
            yield pa.RecordBatch.from_pylist([row], schema=kept_schema)

    def reassemble(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = left.to_pylist()
        copies = sum(r["n_distinct"] for r in rows)
        if not rows or copies != len(right):
            raise ValueError("the documents changed between two passes over them")
        right = right.combine_chunks()
        order = np.argsort(right.column("slot").to_numpy(), kind="stable")[:: len(rows)]
        column = right.column("value")
        column = column.chunk(0) if column.num_chunks else pa.array([], column.type)
        column = column.take(pa.array(order))
        return pa.Table.from_batches(
            [
                pa.RecordBatch.from_pydict(some, schema=result_schema)
                for row in rows
                for some in finish(row, column)
            ],
            schema=result_schema,
        )

    fields = f"block long, n_distinct int, {kept}"
    kept_schema = arrow_schema(docs.sparkSession, fields)
    result_schema = arrow_schema(docs.sparkSession, result)
    words = on_batches(texts, explode, "block long, slot int, word string")
    by_word = words.repartition("word").sortWithinPartitions("word")
    word_values = on_batches(by_word, values, f"block long, slot int, value {value}")
    sequences = on_batches(texts, keep_blocks, fields)
    return (
        sequences.groupBy("block")
        .cogroup(word_values.groupBy("block"))
        .applyInArrow(reassemble, result)
    )
