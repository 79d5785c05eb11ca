"""The registered queries of this subpackage, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docintake.llm import (
    addressable,
    block_names,
    factorisation,
    hard_negatives,
    hilbert,
    hyperminhash,
    license_rules,
    merkle,
    packing,
    posting_lists,
    token_counts,
    warc,
    word_bpe,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_addressable_codes": addressable.query,
    "op2_retrieval_packing": packing.query,
    "op3_token_counts": token_counts.query,
    "op4_hilbert_shards": hilbert.query,
    "op5_posting_lists": posting_lists.query,
    "op6_factorisation_machine": factorisation.query,
    "op7_word_bpe": word_bpe.query,
    "op8_block_names": block_names.query,
    "op9_license_rules": license_rules.query,
    "op10_hyperminhash": hyperminhash.query,
    "op11_hard_negatives": hard_negatives.query,
    "op12_merkle_log": merkle.query,
    "op13_warc": warc.query,
}

ORACLES: dict[str, str] = {
    "op8_block_names": block_names.SQL,
    "op10_hyperminhash": hyperminhash.SQL,
    "op11_hard_negatives": hard_negatives.SQL,
    "op12_merkle_log": merkle.SQL,
    "op13_warc": warc.SQL,
}
