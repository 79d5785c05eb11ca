"""Operator 3: token counts from distinct pre-tokens.

The pieces of a pre-token do not depend on its neighbours. Each distinct pre-token of the
corpus is counted once by the library; a document's count is the sum over its pre-tokens of
frequency times pieces. No ids are made for documents.

Defined results: a null text counts as empty, with 0 bytes and 0 tokens; a null ``doc_id``
is kept; repeated rows give repeated results; an empty table gives an empty result. Columns
other than ``doc_id`` and ``text`` are not read. The string of a special token inside a text
is one token, as the library has it by default.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docintake.llm.common import table
from docintake.llm.fragments import text_encoder
from docintake.llm.word_blocks import Block, spread, squeeze, through_words

VOCABULARY = "byte_bpe_50k.json"
SPECIAL = "<|endoftext|>"

# A document with more tokens is over the limit.
LIMIT = 1024


def frequencies(block: Block) -> dict:
    """How often each word stands in each document, as pairs in document order."""
    n_docs, n_words = len(block.doc_ids), max(1, len(block.words))
    owner = np.repeat(np.arange(n_docs, dtype=np.int64), block.n_words)
    pair, count = np.unique(owner * n_words + block.slots, return_counts=True)
    return {
        "doc_id": block.doc_ids.to_pylist(),
        "n_bytes": block.n_bytes.tolist(),
        "n_pairs": np.bincount(pair // n_words, minlength=n_docs).tolist(),
        "words": squeeze(pair % n_words),
        "counts": squeeze(count),
    }


def sums(kept: dict, pieces: pa.Array) -> Iterator[dict]:
    n_pairs = np.array(kept["n_pairs"], np.int64)
    total = int(n_pairs.sum())
    per_word = pieces.to_numpy().astype(np.int64)
    counted = spread(kept["counts"], total) * per_word[spread(kept["words"], total)]
    upto = np.concatenate([[0], np.cumsum(counted)])
    ends = np.cumsum(n_pairs)
    n_tokens = upto[ends] - upto[ends - n_pairs]
    yield {"doc_id": kept["doc_id"], "n_bytes": kept["n_bytes"], "n_tokens": n_tokens}


def token_counts(
    docs: DataFrame, tokenizer: str, special: str | None = SPECIAL, scanned: bool = False
) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8) and ``n_tokens`` of every whole text.

    ``scanned`` says that ``docs`` is a plain scan of files, and need not be written once.

    ``tokenizer`` is the file of a byte-level tokenizers-library tokenizer, and ``special``
    the string of its special token.
    """

    def counter():
        encoder = text_encoder(tokenizer)

        def count(words: list[str]) -> pa.Array:
            size = encoder.dtype.itemsize
            found = [1 if w == special else len(encoder.byte_word(w)) // size for w in words]
            return pa.array(found, pa.int32())

        return count

    return through_words(
        docs,
        special,
        "int",
        counter,
        frequencies,
        "doc_id array<long>, n_bytes array<long>, n_pairs array<int>, words binary, counts binary",
        sums,
        "doc_id long, n_bytes long, n_tokens long",
        scanned=scanned,
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``op3``: bytes and tokens of each document, and whether it is over the limit."""
    docs = table(spark, sf_dir, "documents")
    counted = token_counts(docs, public_tokenizers.path(VOCABULARY), scanned=True)
    return counted.withColumn("over_limit", F.col("n_tokens") > LIMIT)
