"""Operators 1, 2, 3 and 7 against the tokenizer libraries."""

import base64
import hashlib
import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docintake.llm import addressable, fragments, packing, seeds, token_counts, word_bpe
from docintake.llm.common import texts_of
from docintake.session import scratch_path
from llm.tables import FIELDS, frame, rows

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def ids_by_library(path: str, text: str | None) -> list[int]:
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


def ordered(values):
    return sorted(values, key=lambda r: (r[0] is not None, r[0], r[1] or ""))


signs = st.sampled_from(list("aZé1 \n'stlrevmd!$ 　中🎉́\x1cİK\x85ß"))
texts = st.lists(signs, max_size=24).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(texts, min_size=1, max_size=5))
def test_pretokens_are_the_matches_of_the_pattern(values):
    data, bounds = texts_of(pa.array(values))
    starts = fragments.cut_pretokens(data, bounds)
    found = fragments.fragment_array(data, starts).to_pylist()
    expected = [w for v in values for w in regex.findall(public_tokenizers.PATTERN, v)]
    assert found == expected


@pytest.mark.parametrize("path", [BYTES, WORDS])
@settings(max_examples=200, deadline=None)
@given(values=st.lists(texts, min_size=1, max_size=4))
def test_text_encoder_agrees_with_the_library(path, values):
    ids, counts = fragments.text_encoder(path).encode(pa.array(values))
    parts = np.split(ids, np.cumsum(counts)[:-1])
    library = fragments.library(path)
    for value, part in zip(values, parts, strict=True):
        assert part.tolist() == library.encode(value, add_special_tokens=False).ids


def test_memory_forgets_but_stays_right(monkeypatch):
    monkeypatch.setattr(fragments, "MEMORY", 5)
    encoder = fragments.TextEncoder(BYTES)
    for text in (f"one{i} two{i} three four" for i in range(30)):
        ids, _ = encoder.encode(pa.array([text]))
        assert ids.tolist() == ids_by_library(BYTES, text)
    assert len(encoder.memory.young) <= 5 + 8


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=1500))
def test_codes_give_any_id_and_all(values):
    codes = addressable.Codes(addressable.pack_codes(np.array(values, np.uint32)))
    assert codes.all().tolist() == values
    for place in range(0, len(values), 37):
        assert codes[place] == values[place]
    with pytest.raises(IndexError):
        codes[len(values)]


def test_codes_of_something_else_are_refused():
    with pytest.raises(ValueError):
        addressable.Codes(b"\0" * 64)


def test_files_of_codes(spark):
    path = scratch_path(spark, "codes")
    addressable.write_codes(frame(spark, extra=True), path, BYTES)
    found = addressable.read_codes(spark, path).collect()
    expected, start = [], 0
    for doc_id, text, *_ in ordered(rows()):
        ids = [*ids_by_library(BYTES, text), 0]
        expected.append((doc_id, start, len(ids), np.array(ids, "<u4").tobytes()))
        start += len(ids)
    key = lambda r: r[1]
    assert sorted(map(tuple, found), key=key) == expected
    every = [i for r in expected for i in np.frombuffer(r[3], "<u4").tolist()]
    asked = [0, 1, 5, len(every) - 1, len(every), -1, None, 5]
    places = spark.createDataFrame([(p,) for p in asked], "place long")
    got = {r["place"]: r["id"] for r in addressable.tokens_at(spark, path, places).collect()}
    assert got == {p: every[p] for p in (0, 1, 5, len(every) - 1)}


def test_counts_of_tokens(spark):
    found = token_counts.token_counts(frame(spark, extra=True), BYTES).collect()
    expected = [
        (d, len((t or "").encode()), len(ids_by_library(BYTES, t))) for d, t, *_ in rows()
    ]
    assert Counter(map(tuple, found)) == Counter(expected)


def tiktoken_library():
    with open(RANKS, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
    )


def test_words_encoded_once_and_decoded(spark):
    made = frame(spark, extra=True)
    both = word_bpe.decode(word_bpe.encode(made, RANKS), RANKS).collect()
    assert Counter(map(repr, both)) == Counter(map(repr, word_bpe.encode(made, RANKS, True).collect()))
    library = tiktoken_library()
    expected = [
        (d, tuple(library.encode_ordinary(t or "")), (t or "").encode()) for d, t, *_ in rows()
    ]
    assert Counter((r[0], tuple(r[1]), bytes(r[2])) for r in both) == Counter(expected)


def test_null_ids_decode_to_null(spark):
    made = spark.createDataFrame([(1, None), (2, []), (3, [464, 290])], "k int, ids array<int>")
    found = {r["k"]: r["decoded"] for r in word_bpe.decode(made, RANKS).collect()}
    library = tiktoken_library()
    assert (found[1], bytes(found[2])) == (None, b"")
    assert bytes(found[3]) == library.decode_bytes([464, 290])


def test_a_table_that_changes_is_read_once(spark):
    """What two passes would see differently is written before; a scan that lies is noticed."""
    changing = F.udf(lambda text: os.urandom(8).hex()).asNondeterministic()
    made = frame(spark).withColumn("text", changing("text"))
    found = token_counts.token_counts(made, BYTES).collect()
    assert {r["n_bytes"] for r in found} == {16} and len(found) == len(rows())
    with pytest.raises(Exception, match="changed between two passes"):
        token_counts.token_counts(made, BYTES, scanned=True).collect()


def test_rows_without_an_id_are_cut_by_their_texts(spark):
    values = [(None, f"text {i % 50} of {i % 7}", "en", "s", 1) for i in range(400)]
    path, together = scratch_path(spark, "codes"), "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(together, "false")
    try:
        addressable.write_codes(frame(spark, values), path, BYTES)
    finally:
        spark.conf.unset(together)
    found = addressable.read_codes(spark, path).collect()
    starts = sorted((r["start"], r["n_tokens"]) for r in found)
    assert [s for s, _ in starts] == [0, *np.cumsum([n for _, n in starts])[:-1].tolist()]
    expected = Counter(np.array([*ids_by_library(BYTES, t), 0], "<u4").tobytes() for _, t, *_ in values)
    assert Counter(bytes(r["ids"]) for r in found) == expected
    assert addressable.blocks(spark, path).select("part").distinct().count() > 1


def check_pieces(pieces, values, window):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
        by_doc[p["doc_id"]].append(p)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == window or at & (at - 1) == 0 and at < window
    whole = defaultdict(list)
    for doc_id, text, *_ in values:
        whole[doc_id].append([*ids_by_library(WORDS, text), 1])
    for doc_id, texts_ in whole.items():
        got = Counter()
        for p in by_doc.pop(doc_id):
            ids = np.frombuffer(p["ids"], "<u4").tolist()
            assert len(ids) == p["length"]
            got.update((p["doc_tokens"], p["start"] + k, i) for k, i in enumerate(ids))
        assert got == Counter((len(t), k, i) for t in texts_ for k, i in enumerate(t))
    assert not by_doc


@pytest.mark.parametrize("window", [16, 2048])
def test_pieces_hold_every_id_once(spark, window):
    pieces = packing.pack(frame(spark, extra=True), WORDS, window=window).collect()
    check_pieces(pieces, rows(), window)


def test_small_shards_and_one_theme(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_IDS", 64)
    values = [(i, f"same same same word{i % 5}", "en", "s", 1) for i in range(300)]
    pieces = packing.pack(frame(spark, values), WORDS, window=32).collect()
    check_pieces(pieces, values, 32)


def topics(n, seed):
    """Documents about few things each, with copies and near-copies."""
    draw = np.random.default_rng(seed)
    common = ["the", "of", "and", "to", "in", "is"]
    found = []
    for i in range(n):
        about = int(draw.integers(40))
        words = [f"topic{about}x{int(draw.integers(12))}" for _ in range(25)]
        words += [common[int(k)] for k in draw.integers(6, size=25)]
        found.append(" ".join(draw.permutation(words)))
    return [(i, t, "en", "s", 1) for i, t in enumerate(found + found[::9])]


def packed(made, **settings):
    columns = ("doc_id", "start", "length", "sequence_id", "offset")
    return Counter(tuple(p[c] for c in columns) for p in packing.pack(made, WORDS, **settings).collect())


@pytest.mark.parametrize("group", [1 << 20, 3000])
def test_packing_does_not_hang_on_the_layout(spark, monkeypatch, group):
    monkeypatch.setattr(packing, "GROUP_IDS", group)
    monkeypatch.setattr(packing, "TASK_IDS", 20_000)
    values = topics(700, 1)
    one = packed(spark.createDataFrame(values, FIELDS).coalesce(1), window=512)
    other = spark.createDataFrame(values[::-1], FIELDS).repartition(13, "text")
    assert packed(other, window=512) == one


def test_copies_from_different_files_share_a_window(spark, monkeypatch):
    """Seeds find their like in the whole input, not only in their own part of it."""
    monkeypatch.setattr(packing, "TASK_IDS", 20_000)
    values = topics(600, 2)
    parts = [spark.createDataFrame(values[k::6], FIELDS).coalesce(1) for k in range(6)]
    made = parts[0]
    for part in parts[1:]:
        made = made.union(part)
    windows = defaultdict(set)
    for p in packing.pack(made, WORDS, window=2048).collect():
        windows[p["sequence_id"]].add(p["doc_id"])
    of = defaultdict(set)
    for w, docs in windows.items():
        for doc in docs:
            of[doc].add(w)
    by_text = defaultdict(list)
    for doc_id, text, *_ in values:
        by_text[text].append(doc_id)
    copies = [ids for ids in by_text.values() if len(ids) > 1]
    together = sum(bool(of[a] & of[b]) for a, b, *_ in copies)
    assert len(copies) > 60 and together > 0.9 * len(copies)


def test_a_seed_with_too_many_documents_is_spread(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_IDS", 2000)
    monkeypatch.setattr(packing, "TASK_IDS", 4000)
    values = [(i, "one and the same text about apples " * 10, "en", "s", 1) for i in range(400)]
    pieces = packing.pack(frame(spark, values), WORDS, window=256).collect()
    check_pieces(pieces, values, 256)
    by_task = Counter(p["sequence_id"] >> 32 for p in pieces)
    assert len(by_task) > 4 and max(by_task.values()) < len(pieces) / 2


def test_every_seed_of_a_word_is_a_candidate(spark):
    """A document goes to the best of all seeds, where one word has hundreds of them."""
    draw, vocabulary, every = np.random.default_rng(3), 60, 3
    rows_ = []
    for name in range(-450, 450):
        terms = np.unique(np.append(draw.integers(1, vocabulary, 3), 0)).tolist()
        rows_.append((name, 40 + name % 7, terms, draw.integers(1, 5, len(terms)).tolist()))
    fields = "name long, n_ids long, terms array<int>, times array<int>"
    documents = spark.createDataFrame(rows_, fields).repartition(5)
    corpus = packing.Corpus(900, 900 * 43, np.linspace(0.5, 4, vocabulary).astype(np.float32))
    index = packing.seed_index(documents, corpus, vocabulary, every)
    found = documents.join(packing.nearest_seeds(documents, corpus, every), "name", "left")
    [batch] = found.orderBy("name").toArrow().combine_chunks().to_batches()
    theme, seed = index.place(corpus, batch)
    weights = {
        name: dict(zip(terms, corpus.weights(np.array(terms), np.array(times), n_ids)))
        for name, n_ids, terms, times in rows_
    }
    own = {n: min(t for t in w if w[t] == max(w.values())) for n, w in weights.items()}
    seeds = [n for n in weights if n % every == 0]
    assert sum(0 in weights[s] for s in seeds) == len(seeds) == 300
    for name, its_theme, its_seed in zip(batch.column("name").to_pylist(), theme, seed):
        def shared(s, its=weights[name]):
            return sum(w for t, w in its.items() if t in weights[s])

        if name % every == 0:
            assert its_seed == name
        else:
            assert shared(its_seed) == pytest.approx(max(shared(s) for s in seeds))
        assert its_theme == own[its_seed]


def test_seeds_are_found_by_all_words(spark):
    """Documents of some forty words each, of which many seeds share the strongest ones."""
    draw, vocabulary, every = np.random.default_rng(5), 300, 4
    names = draw.permutation(np.arange(-300, 300)).tolist()
    rows_ = []
    for name in names:
        terms = np.unique(np.append(draw.integers(4, vocabulary, 2 + draw.integers(60)), [0, 1, 2, 3]))
        rows_.append((name, 90 + name % 7, terms.tolist(), [1] * len(terms)))
    fields = "name long, n_ids long, terms array<int>, times array<int>"
    documents = spark.createDataFrame(rows_, fields).repartition(5)
    idf = np.append([6, 5, 5, 4], np.linspace(0.1, 2, vocabulary - 4)).astype(np.float32)
    corpus = packing.Corpus(600, 600 * 90, idf)
    found = packing.nearest_seeds(documents, corpus, every).collect()
    assert sorted(r["name"] for r in found) == sorted(names)
    words = {
        name: dict(zip(terms, corpus.weights(np.array(terms), np.array(times), n_ids)))
        for name, n_ids, terms, times in rows_
    }
    for name, seed, _ in found:
        def shared(s, its=words[name]):
            return sum(w for t, w in its.items() if t in words[s])

        if name % every:
            best = max(map(shared, (s for s in names if s % every == 0)))
            assert shared(seed) == pytest.approx(best, rel=1e-6)
        else:
            assert seed == name


def test_the_best_seed_of_many_blocks(monkeypatch):
    """Against brute force: ties, words that no seed holds, documents that share nothing."""
    monkeypatch.setattr(seeds, "FIRST", 3)
    draw, vocabulary = np.random.default_rng(6), 400
    held = [np.unique(draw.zipf(1.3, 5 + draw.integers(120)) % 300) for _ in range(500)]
    held.sort(key=len, reverse=True)
    names = draw.permutation(500) - 250
    docs = [np.unique(draw.zipf(1.3, 1 + draw.integers(90)) % vocabulary) for _ in range(300)]
    docs += [held[3], held[499], held[250][:5], np.array([350, 360])]
    # Weights of few values, so that many seeds are worth the same.
    weights = [1 + draw.integers(3, size=len(d)) / 2 for d in docs]
    of = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    search = seeds.Search(np.concatenate(docs), np.concatenate(weights), of, len(docs))
    for first in range(0, 500, 150):
        part = held[first : first + 150]
        sizes = np.array([len(h) for h in part])
        themes = names[first : first + 150].astype(np.int32) + 1000
        block = seeds.Block(names[first : first + 150], themes, sizes, np.concatenate(part), vocabulary)
        search.over(block)
    for k, (doc, weight) in enumerate(zip(docs, weights)):
        worth = [
            (-weight[np.isin(doc, h)].sum(), len(h), name) for h, name in zip(held, names.tolist())
        ]
        shared, _, name = min(worth)
        assert bool(search.found()[k]) == (shared < 0)
        if shared:
            assert (search.name[k], search.theme[k]) == (name, name + 1000)
    assert not search.found()[-1]


def test_windows_hold_what_shares_words():
    ids = [np.array(i) for i in ([5, 6, 7, 8], [90, 91, 92, 93], [5, 6, 7, 9], [90, 91, 94, 95])]
    counts = np.array([4] * 4)
    shard = packing.Shard(np.concatenate(ids), counts, np.ones(100, np.float32), 4.0)
    assert shard.neighbours(0, np.array([True, False, False, False])).tolist() == [2, 1, 3]
    assert list(packing.walk(shard, counts, 8, 8)) == [0, 2, 1, 3]


def test_bm25_is_the_usual_formula():
    ids, counts = np.array([1, 1, 2, 1, 3, 3]), np.array([3, 1, 2])
    idf = np.array([0, 0.5, 2, 1.5], np.float32)
    shard = packing.Shard(ids, counts, idf, 2.0)
    scale = packing.K1 * (1 - packing.B + packing.B * 3 / 2)
    assert shard.weights[0] == pytest.approx(0.5 * 2 * (packing.K1 + 1) / (2 + scale))


@pytest.mark.parametrize(
    "run",
    [
        lambda d: token_counts.token_counts(d, BYTES),
        lambda d: word_bpe.encode(d, RANKS),
        lambda d: packing.pack(d, WORDS),
    ],
)
def test_empty_tables(spark, run):
    assert run(spark.createDataFrame([], FIELDS)).collect() == []


def test_empty_file_set(spark):
    path = scratch_path(spark, "codes")
    addressable.write_codes(spark.createDataFrame([], FIELDS), path, BYTES)
    assert addressable.read_codes(spark, path).collect() == []


def test_registered_token_queries(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    library, start = tiktoken_library(), 0
    ones = {r["doc_id"]: r for r in addressable.query(spark, sf_dir).collect()}
    threes = {r["doc_id"]: r for r in token_counts.query(spark, sf_dir).collect()}
    sevens = {r["doc_id"]: r for r in word_bpe.query(spark, sf_dir).collect()}
    assert set(ones) == set(threes) == set(sevens) == set(docs)
    for doc_id in sorted(docs):
        ids = [*ids_by_library(BYTES, docs[doc_id]), 0]
        checksum = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert tuple(ones[doc_id]) == (doc_id, start, len(ids), checksum)
        start += len(ids)
        size = len(docs[doc_id].encode())
        assert tuple(threes[doc_id]) == (doc_id, size, len(ids) - 1, len(ids) - 1 > 1024)
        plain = library.encode_ordinary(docs[doc_id])
        digits = hashlib.sha256(" ".join(map(str, plain)).encode()).hexdigest()
        decoded = hashlib.sha256(docs[doc_id].encode()).hexdigest()
        assert tuple(sevens[doc_id]) == (doc_id, len(plain), digits, decoded)
