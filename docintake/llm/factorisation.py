"""Operator 6: a quality classifier as a factorisation machine.

A document's features are its hashed words, statistics of its structure, and its declared
length. The machine adds to a linear model the interactions of all pairs of features, with
a vector of low rank for each feature; by the identity
``sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)``
a document is scored in time linear in its features.

It is fitted on the driver, on at most ``SAMPLE`` labelled documents whose text goes through
the same features in the tasks; what reaches the driver is their features. The model has a
fixed size and travels with the tasks.

Defined results: a null text counts as empty and gets the score of an empty text; a null
``doc_id`` counts as held out; null labels are not learned from; where labels disagree on a
document all of them are learned; repeated rows give repeated results; without labels of
both kinds every score is the share of label 1, or 0.5; an empty table gives an empty
result. ``lang``, ``source``, ``doc_id`` and labels are never inputs of a score; of other
columns only ``n_chars`` is, and a null or missing one counts as the text's own length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from docintake.llm.common import chunks, fresh, on_batches, table, texts_of
from docintake.llm.fragments import starts_of_texts
from docintake.llm.shingles import STEP, mixed, words_of

# Hashed words.
WORD_BITS = 14
WORDS = 1 << WORD_BITS

# The largest number of labelled documents that the machine is fitted on.
SAMPLE = 2000

RANK = 4
EPOCHS = 60
RATE = 0.08
PENALTY = 2e-4

# Bytes of text whose features a worker works out at once, about; its arrays are many times that.
FEATURE_BYTES = 1 << 20

# A document is good from this score on.
THRESHOLD = 0.3

# A label is for testing where the remainder of the id's checksum by this is 0.
FOLDS = 5

# Signs that are counted one by one.
SIGNS = "!?.,;:|#$%&*@<>{}[]\\/_=+~^\"'()-"

N_STATS = 19 + len(SIGNS)
SIZE = WORDS + N_STATS


def distinct_counts(owner: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """Distinct pairs of owner and value: the owners, the values, how often each occurs."""
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    first = np.ones(len(owner), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(first)
    return owner[at], value[at], np.diff(np.append(at, len(owner)))


def features(texts: pa.Array, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse features of each text: how many, which, and their values.

    ``n_chars`` is the declared length, -1 where there is none.
    """
    data, bounds = texts_of(texts)
    n = len(bounds) - 1
    size = np.diff(bounds)

    def per_text(marks: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])[bounds])

    def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return part / np.maximum(whole, 1)

    words, n_words = words_of(data, bounds)
    owner = np.repeat(np.arange(n), n_words)
    inside = owner[1:] == owner[:-1] if len(owner) else np.zeros(0, bool)
    again = np.bincount(owner[1:][inside & (words[1:] == words[:-1])], minlength=n)
    pairs = mixed(words[1:][inside] * STEP + words[:-1][inside])
    pair_owner, _, pair_count = distinct_counts(owner[1:][inside], pairs, n)
    word_owner, _, word_count = distinct_counts(owner, words, n)
    n_pairs = np.maximum(n_words - 1, 0)
    most = np.zeros(n)
    np.maximum.at(most, word_owner, word_count)

    upper = per_text((data >= 0x41) & (data <= 0x5A))
    letters = upper + per_text((data >= 0x61) & (data <= 0x7A))
    digits = per_text((data >= 0x30) & (data <= 0x39))
    lines = per_text(data == 0x0A) + 1
    wide = per_text(data >= 0x80)
    starts = per_text((data & 0xC0) != 0x80)
    declared = np.where(n_chars < 0, starts, n_chars)
    doubled = np.zeros(len(data), bool)
    if len(data) > 1:
        doubled[1:] = data[1:] == data[:-1]
        doubled &= ~starts_of_texts(len(data), bounds)
    stats = np.stack(
        [
            np.ones(n),
            np.log1p(size),
            np.log1p(n_words),
            np.log1p(lines),
            np.log1p(declared),
            np.log(share(declared, starts) + 0.1),
            share(n_words, lines) ** 0.5,
            share(size, n_words) ** 0.5,
            share(upper, letters),
            share(digits, size),
            share(letters, size),
            share(wide, size),
            share(per_text(doubled), size),
            share(np.bincount(word_owner, minlength=n), n_words),
            share(most, n_words),
            share(again, n_words),
            share(np.bincount(pair_owner, minlength=n), n_pairs),
            (n_words == 0).astype(float),
            (n_words < 5).astype(float),
            *[np.sqrt(share(per_text(data == ord(s)), size)) for s in SIGNS],
        ],
        1,
    )

    bucket_owner, bucket, count = distinct_counts(owner, words >> np.uint64(64 - WORD_BITS), n)
    value = np.log1p(count)
    norm = np.sqrt(np.bincount(bucket_owner, value**2, minlength=n))
    value = value / np.maximum(norm, 1e-9)[bucket_owner]
    n_buckets = np.bincount(bucket_owner, minlength=n)
    # Each text's statistics go before its words.
    which = np.insert(
        bucket.astype(np.int64) + N_STATS,
        np.repeat(np.cumsum(n_buckets) - n_buckets, N_STATS),
        np.tile(np.arange(N_STATS), n),
    )
    values = np.insert(
        value, np.repeat(np.cumsum(n_buckets) - n_buckets, N_STATS), stats.ravel()
    )
    return n_buckets + N_STATS, which, values


@dataclass
class Machine:
    """Weights, vectors, and how the statistics are scaled; ``prior`` where it learned nothing."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(SIZE))
    vectors: np.ndarray = field(default_factory=lambda: np.zeros((SIZE, RANK)))
    mean: np.ndarray = field(default_factory=lambda: np.zeros(N_STATS))
    spread: np.ndarray = field(default_factory=lambda: np.ones(N_STATS))
    prior: float | None = 0.5

    def scaled(self, which: np.ndarray, values: np.ndarray) -> np.ndarray:
        stat = which < N_STATS
        values = values.copy()
        at = which[stat]
        values[stat] = np.clip((values[stat] - self.mean[at]) / self.spread[at], -4, 4) / 2
        values[which == 0] = 1.0
        return values

    def raw(self, sizes: np.ndarray, which: np.ndarray, values: np.ndarray) -> tuple:
        """Log-odds of each row, and the sums that their gradient needs."""
        starts = np.cumsum(sizes) - sizes
        taken = self.vectors[which]
        times = taken * values[:, None]
        sums = np.add.reduceat(times, starts, 0)
        squares = np.add.reduceat((times**2).sum(1), starts)
        linear = np.add.reduceat(self.weights[which] * values, starts)
        return linear + ((sums**2).sum(1) - squares) / 2, sums

    def scores(self, sizes: np.ndarray, which: np.ndarray, values: np.ndarray) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(sizes), self.prior)
        found, _ = self.raw(sizes, which, self.scaled(which, values))
        return 1 / (1 + np.exp(-np.clip(found, -30, 30)))


def fit(sizes: np.ndarray, which: np.ndarray, values: np.ndarray, labels: np.ndarray) -> Machine:
    """A machine for 0/1 labels, by Adam over all rows with a quadratic penalty."""
    if not len(labels) or labels.min() == labels.max():
        return Machine(prior=float(labels.mean()) if len(labels) else 0.5)
    machine = Machine(prior=None)
    stat = which < N_STATS
    columns = values[stat].reshape(-1, N_STATS)
    machine.mean, machine.spread = columns.mean(0), np.maximum(columns.std(0), 1e-3)
    x = machine.scaled(which, values).astype(np.float32)
    labels = labels.astype(np.float32)
    draw = np.random.default_rng(7)
    machine.vectors = draw.normal(0, 0.01, (SIZE, RANK)).astype(np.float32)
    machine.weights = np.zeros(SIZE, np.float32)
    row = np.repeat(np.arange(len(sizes)), sizes)
    by_feature = np.argsort(which, kind="stable")
    present, first = np.unique(which[by_feature], return_index=True)
    moments = [np.zeros((len(present), RANK + 1)) for _ in range(2)]
    for step in range(1, EPOCHS + 1):
        odds, sums = machine.raw(sizes, which, x)
        error = (1 / (1 + np.exp(-np.clip(odds, -30, 30))) - labels) / len(labels)
        gradient = np.empty((len(x), RANK + 1), np.float32)
        gradient[:, 0] = error[row] * x
        gradient[:, 1:] = gradient[:, :1] * (sums[row] - machine.vectors[which] * x[:, None])
        total = np.add.reduceat(gradient[by_feature], first, 0)
        held = np.column_stack([machine.weights[present], machine.vectors[present]])
        total += PENALTY * held
        moments[0] = 0.9 * moments[0] + 0.1 * total
        moments[1] = 0.99 * moments[1] + 0.01 * total**2
        move = moments[0] / (1 - 0.9**step) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-8)
        held = held - RATE * move
        machine.weights[present], machine.vectors[present] = held[:, 0], held[:, 1:]
    return machine


def declared_lengths(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("n_chars").fill_null(-1).to_numpy().astype(np.float64)


def with_length(docs: DataFrame) -> Column:
    own = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return F.when(own >= 0, own).alias("n_chars")


def is_held_out(doc_id: Column) -> Column:
    checksum = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(checksum % FOLDS == 0, F.lit(True))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """A machine for ``labels.quality``, from labels that are not held out.

    Of those the ``sample`` ones that come first by a hash of their id are taken, so what
    is broadcast and what comes back to the driver have a bound.
    """
    chosen = (
        labels.where(F.col("quality").isin(0, 1))
        .select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").alias("_label"))
        .where(~is_held_out(F.col("_id")))
        .orderBy(F.xxhash64("_id"), "_id", "_label")
        .limit(sample)
    )
    texts = docs.select(
        F.col("doc_id").cast("long").alias("_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        with_length(docs),
    ).join(F.broadcast(chosen), "_id")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, most=FEATURE_BYTES):
            sizes, which, values = features(chunk.column("text"), declared_lengths(chunk))
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.column("_id"),
                    chunk.column("_label").cast(pa.int32()),
                    pa.ListArray.from_arrays(offsets, pa.array(which.astype(np.int32))),
                    pa.ListArray.from_arrays(offsets, pa.array(values.astype(np.float32))),
                ],
                ["_id", "_label", "which", "values"],
            )

    fields = "_id long, _label int, which array<int>, values array<float>"
    # Repeated documents could exceed the sample; a second cut keeps the bound.
    found = on_batches(texts, extract, fields).orderBy(F.xxhash64("_id"), "_id", "_label")
    rows = found.limit(sample).toArrow().combine_chunks()
    if not rows.num_rows:
        return Machine()
    lists = [rows.column(c).combine_chunks() for c in ("which", "values")]
    sizes = np.diff(lists[0].offsets.to_numpy()).astype(np.int64)
    which = lists[0].flatten().to_numpy().astype(np.int64)
    values = lists[1].flatten().to_numpy().astype(np.float64)
    return fit(sizes, which, values, rows.column("_label").to_numpy().astype(np.float64))


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """All columns of ``docs`` and the score of every whole text, as the last column; it is
    called ``score`` unless there is such a column."""
    text, length, name = (fresh(c, docs.columns) for c in ("_text", "_length", "score"))
    held = {k: getattr(machine, k).astype(np.float32) for k in ("weights", "vectors")}
    small = Machine(held["weights"], held["vectors"], machine.mean, machine.spread, machine.prior)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, text, FEATURE_BYTES):
            lengths = chunk.column(length).fill_null(-1).to_numpy().astype(np.float64)
            found = small.scores(*features(chunk.column(text), lengths))
            kept = [c for c in chunk.schema.names if c not in (text, length)]
            columns = [chunk.column(c) for c in kept]
            columns.append(pa.array(found, pa.float64()))
            yield pa.RecordBatch.from_arrays(columns, [*kept, name])

    fields = StructType([*docs.schema.fields, StructField(name, DoubleType())])
    own = docs.withColumns({text: F.coalesce("text", F.lit("")), length: with_length(docs)})
    return on_batches(own, run, fields)


def without_poor(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier does not reject, with their columns."""
    scored = score(docs, learn(docs, labels))
    return scored.where(F.col(scored.columns[-1]) >= threshold).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``op6``: the score of each document."""
    docs = table(spark, sf_dir, "documents")
    machine = learn(docs, table(spark, sf_dir, "labels"))
    return score(docs.select("doc_id", "text", "n_chars"), machine).select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
