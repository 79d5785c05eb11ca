"""Operator 7: byte-level BPE by a global shuffle of distinct words.

Pre-tokens are exploded with their positions, each distinct word is encoded once, its ids
are joined back, and a document's ids are reassembled by position. Decoding joins each id
with the token-byte table, which has one row per entry of the vocabulary, and concatenates.

Defined results: a null text counts as empty, with no ids and no bytes; a null ``doc_id`` is
kept; repeated rows give repeated results; an empty table gives an empty result. Columns
other than ``doc_id`` and ``text`` are not read. No string inside a text is special.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from docintake.llm.common import on_batches, ranges, table
from docintake.llm.word_blocks import Block, spread, squeeze, through_words

RANKS = "byte_bpe_50k.tiktoken"

# Bytes of text in a block; ids come back for each of its distinct words.
BLOCK_BYTES = 32 << 20

# Words that are laid out at a time.
WORDS_AT_ONCE = 400_000


@lru_cache(maxsize=2)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def encoding(path: str) -> tiktoken.Encoding:
    return tiktoken.Encoding(
        "words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(path), special_tokens={}
    )


@lru_cache(maxsize=2)
def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token-byte table: where each id's bytes start, how many they are, and the bytes."""
    by_id = sorted((number, token) for token, number in ranks(path).items())
    size = np.zeros(by_id[-1][0] + 1, np.int64)
    size[[n for n, _ in by_id]] = [len(t) for _, t in by_id]
    return np.cumsum(size) - size, size, np.frombuffer(b"".join(t for _, t in by_id), np.uint8)


def sequence(block: Block) -> dict:
    """The position of every word, document after document."""
    return {
        "doc_id": block.doc_ids.to_pylist(),
        "n_words": block.n_words.tolist(),
        "positions": squeeze(block.slots),
    }


def id_code(path: str) -> str:
    """How a word's ids travel: as 16-bit numbers where the vocabulary allows."""
    return "H" if max(ranks(path).values()) < 1 << 16 else "I"


def lay_out(kept: dict, word_ids: pa.Array, code: str) -> Iterator[dict]:
    """Ids of each document, by the positions of its words, some documents at a time."""
    width = np.dtype(code)
    _, offsets, pool = word_ids.buffers()
    ends = np.frombuffer(offsets, np.int32)[word_ids.offset : word_ids.offset + len(word_ids) + 1]
    size = np.diff(ends) // width.itemsize
    pool = np.frombuffer(pool, width) if pool is not None else np.zeros(0, width)
    words_upto = np.concatenate([[0], np.cumsum(np.array(kept["n_words"], np.int64))])
    slots = spread(kept["positions"], int(words_upto[-1]))
    first, n_docs = 0, len(kept["doc_id"])
    while first < n_docs:
        last = int(np.searchsorted(words_upto, words_upto[first] + WORDS_AT_ONCE, "right")) - 1
        last = max(first + 1, min(last, n_docs))
        upto = words_upto[first : last + 1]
        here = slots[upto[0] : upto[-1]]
        lengths = size[here].astype(np.int64)
        ids = pool[ranges((ends[:-1] // width.itemsize)[here].astype(np.int64), lengths)]
        listed = np.concatenate([[0], np.cumsum(lengths)])[upto - upto[0]].astype(np.int32)
        yield {
            "doc_id": kept["doc_id"][first:last],
            "ids": pa.ListArray.from_arrays(pa.array(listed), pa.array(ids.astype(np.int32))),
        }
        first = last


def bytes_of(lists: pa.ListArray, path: str) -> pa.Array:
    """The bytes that lists of ids decode to: each id is looked up in the token-byte table."""
    starts, size, pool = token_bytes(path)
    ids = lists.flatten().to_numpy(zero_copy_only=False)
    valid = lists.is_valid().to_numpy(zero_copy_only=False)
    upto = np.concatenate([[0], np.cumsum(size[ids])])
    ends = upto[np.cumsum(np.diff(lists.offsets.to_numpy()) * valid)]
    data = pool[ranges(starts[ids], size[ids])]
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    found = pa.Array.from_buffers(pa.binary(), len(lists), buffers)
    return pc.if_else(pa.array(valid), found, pa.scalar(None, pa.binary()))


def lay_out_and_decode(kept: dict, word_ids: pa.Array, code: str, path: str) -> Iterator[dict]:
    for some in lay_out(kept, word_ids, code):
        yield {**some, "decoded": bytes_of(some["ids"], path)}


def encode(
    docs: DataFrame, rank_file: str, decoded: bool = False, scanned: bool = False
) -> DataFrame:
    """``doc_id`` and ``ids`` of every whole text, as the tiktoken library would give them.

    With ``decoded`` also the bytes that the ids decode to, worked out where the ids are
    laid out, so that they need not travel once more. ``scanned`` says that ``docs`` is a
    plain scan of files, and need not be written once.
    """
    code = id_code(rank_file)

    def encoder():
        library = encoding(rank_file)

        def of_words(words: list[str]) -> pa.Array:
            found = [array(code, library.encode_ordinary(w)).tobytes() for w in words]
            return pa.array(found, pa.binary())

        return of_words

    finish = partial(lay_out, code=code)
    if decoded:
        finish = partial(lay_out_and_decode, code=code, path=rank_file)
    return through_words(
        docs,
        None,
        "binary",
        encoder,
        sequence,
        "doc_id array<long>, n_words array<int>, positions binary",
        finish,
        "doc_id long, ids array<int>" + ", decoded binary" * decoded,
        BLOCK_BYTES,
        scanned,
    )


def decode(encoded: DataFrame, rank_file: str) -> DataFrame:
    """Adds ``decoded``: the bytes of each row's ``ids``; null where they are null.

    The token-byte table is as large as the vocabulary and travels with each task; ids meet
    it by their number. An id outside the vocabulary is an error.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                part = batch.slice(first, 1000)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, bytes_of(part.column("ids"), rank_file)],
                    [*part.schema.names, "decoded"],
                )

    fields = [*encoded.schema.fields, StructField("decoded", BinaryType())]
    return on_batches(encoded, join, StructType(fields))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``op7``: number and checksum of each document's ids, and checksum of the bytes
    that they decode to."""
    path = public_tokenizers.path(RANKS)
    both = encode(table(spark, sf_dir, "documents"), path, decoded=True, scanned=True)
    digits = F.array_join(F.col("ids").cast("array<string>"), " ")
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(digits, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
