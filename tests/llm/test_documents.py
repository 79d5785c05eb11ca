"""Operators 4, 6, 8, 9 and 10 and the pipeline against plain Python."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import product
from re import _parser

import numpy as np
import pyarrow as pa
import pytest
from compare import difference, duck
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.tables import FIELDS, frame, lower_ascii, rows, shingles
from pyspark.sql import functions as F

import corpus_pipeline
from docintake.llm import (
    block_names,
    factorisation,
    hilbert,
    hyperminhash,
    license_rules,
    license_texts,
)
from docintake.llm.queries import ORACLES, QUERIES
from docintake.llm.shingles import shingle_sets
from docintake.session import scratch_path


def flat(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


# --- operator 8


def groups_by_text(values):
    found = defaultdict(list)
    for doc_id, text, *_ in values:
        found[flat(text)].append(doc_id)
    return found


@pytest.mark.parametrize("size", [1, 7, 4096])
@pytest.mark.parametrize("clash", [False, True])
def test_names_stand_for_texts(spark, size, clash):
    fingerprint = (lambda block: F.length(block).cast("long")) if clash else F.xxhash64
    values = [r for r in rows() if r[1] is None or len(r[1]) < 400]
    made = frame(spark, values, extra=True)
    found = block_names.copies(made, size=size, fingerprint=fingerprint).collect()
    expected, kept = Counter(), defaultdict(int)
    for text, ids in groups_by_text(values).items():
        least = min((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        expected.update((i, least, len(ids), sha) for i in ids)
        kept[sha] = 1
    assert Counter((r[0], r[1], r[2], r["text_sha256"]) for r in found) == expected
    assert Counter(r["text_sha256"] for r in found if r["kept"]) == kept


def test_long_texts_that_differ_in_one_block(spark):
    base = "".join(chr(97 + i % 23) for i in range(60_000))
    texts = [base, base[:-1] + "#", "#" + base[1:], base, base + base, base[:4096], base[:4097]]
    values = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    found = {r[0]: r[1] for r in block_names.copies(frame(spark, values)).collect()}
    assert found == {0: 0, 1: 1, 2: 2, 3: 0, 4: 4, 5: 5, 6: 6}


def test_one_of_each_text_stays_with_its_columns(spark):
    made = frame(spark, extra=True)
    kept = block_names.without_copies(made)
    assert kept.columns == made.columns
    texts = [flat(r["text"]) for r in kept.collect()]
    assert Counter(texts) == Counter(groups_by_text(rows()).keys())


def test_many_copies(spark):
    values = [(i, f"text {i if i % 3 else 0}", "en", "s", 1) for i in range(3000)]
    found = block_names.copies(frame(spark, values)).where("doc_id % 3 = 0").collect()
    assert {(r["keep_id"], r["group_size"]) for r in found} == {(0, 1000)}


# --- operator 4


@pytest.mark.parametrize("n, bits", [(1, 4), (2, 3), (3, 3), (4, 2)])
def test_curve_goes_from_neighbour_to_neighbour(n, bits):
    every = np.arange(1 << n * bits)
    grid = np.stack([every >> bits * i & ((1 << bits) - 1) for i in range(n)], 1)
    places = hilbert.curve_places(grid, bits)
    assert sorted(places) == list(every)
    along = grid[np.argsort(places)]
    assert (np.abs(np.diff(along, axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize("shards", [1, 40, 1000])
def test_shards_are_runs_of_equal_length(spark, shards):
    made = frame(spark, extra=True)
    files = hilbert.write_along_curve(made, scratch_path(spark, "curve"))
    placed = hilbert.shards(spark, files, shards).rows
    shard, slot = placed.columns[-2:]
    found = placed.collect()
    assert Counter(tuple(r)[:2] for r in found) == Counter(r[:2] for r in rows())
    by_shard = defaultdict(list)
    for r in found:
        by_shard[r[shard]].append((r[slot], r[files.curve]))
    sizes = [len(by_shard[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(s for s, _ in v) == list(range(len(v))) for v in by_shard.values())
    curve = [c for s in sorted(by_shard) for _, c in sorted(by_shard[s])]
    assert curve == sorted(curve)


def test_files_can_be_skipped_on_each_dimension(spark):
    values = [(i, "t", "abcd"[i * 7 % 4], f"s{i * 11 % 16:02}", i * 13 % 997) for i in range(4000)]
    files = hilbert.write_along_curve(
        frame(spark, values), scratch_path(spark, "curve"), bits=4, runs=16
    )
    runs = files.read(spark).groupBy(F.shiftright(files.position, 33)).agg(
        *[f(c) for c in hilbert.DIMENSIONS for f in (F.min, F.max)]
    )
    found = runs.collect()
    assert len(found) > 8
    for k, probe in enumerate(("a", "s03", 100)):
        assert sum(r[1 + 2 * k] <= probe <= r[2 + 2 * k] for r in found) < len(found)


def test_registered_shards(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = QUERIES["op4_hilbert_shards"](spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(docs)
    for r in found:
        data = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(data) + 16, zlib.crc32(data), "rows")
    counts = Counter(r["shard"] for r in found)
    assert set(counts) == set(range(40)) and max(counts.values()) - min(counts.values()) <= 1


CLASHING = ("slot", "shard", "curve", "position", "run", "before_run", "all_rows", "rank_of_row")


def test_clashing_columns_change_no_shard(spark):
    made = frame(spark)
    plain = hilbert.digest(spark, made)
    clashing = made.selectExpr("*", *[f"7L AS {c}" for c in CLASHING])
    assert Counter(map(tuple, hilbert.digest(spark, clashing).collect())) == Counter(
        map(tuple, plain.collect())
    )
    files = hilbert.write_along_curve(clashing, scratch_path(spark, "curve"))
    rows_ = hilbert.shards(spark, files).rows
    assert {tuple(r) for r in rows_.select(*CLASHING).distinct().collect()} == {(7,) * len(CLASHING)}


@pytest.mark.parametrize("parts", [2, 32])
def test_quantiles_cover_all_rows(spark, parts):
    draw = np.random.default_rng(parts)
    values = np.concatenate([draw.lognormal(5, 2, 5000), np.full(2000, 7.0)]).round(3)
    made = spark.createDataFrame([(float(v), "x") for v in values] + [(None, "x")], "v double, w string")
    codes = hilbert.as_codes(made, ["v", "w"])
    edges = hilbert.quantiles(made, codes, parts)
    every = np.sort(
        [r[0] for r in made.select(codes["v"].alias("c")).where("c IS NOT NULL").collect()]
    )
    ranks = [-(-i * len(every) // parts) for i in range(1, parts)]
    assert edges["v"] == sorted({int(every[r - 1]) for r in ranks})
    assert edges["w"] == [0]


@pytest.mark.parametrize(
    ("stage", "column"),
    [
        (block_names.without_copies, "sha256"),
        (block_names.without_copies, "_sha256"),
        (hyperminhash.without_near_copies, "_text_key"),
        (hyperminhash.without_near_copies, "text_key"),
    ],
)
def test_clashing_columns_stay_in_stages(spark, stage, column):
    made = frame(spark)
    with_it = stage(made.selectExpr("*", f"doc_id + 1 AS {column}"))
    assert with_it.columns == [*made.columns, column]
    kept = with_it.collect()
    assert Counter(r["doc_id"] for r in kept) == Counter(r["doc_id"] for r in stage(made).collect())
    assert all(r[column] == (None if r["doc_id"] is None else r["doc_id"] + 1) for r in kept)


# --- operator 9


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text))


LICENCE_TEXTS = [
    "Licensed under the Apache License, Version 2.0 (the License)",
    "MIT License MIT license. mit-LICENSE",
    "GNU General Public License, GNU Lesser General Public License v2.1 or later",
    "SPDX-License-Identifier: GPL-3.0-or-later",
    "CC BY 4.0 and CC-BY-SA 4.0, commit licenses",
    "Permission is hereby granted, free of charge, to any person obtaining a copy",
    "All rights reserved. Copyright (c) 2021 Ämit License",
    "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "mit",
    "license mit license",
    "Kapache license",
]


def test_base_places_and_labels(spark, tmp_path):
    texts = [t for _, t, *_ in rows()] + LICENCE_TEXTS
    values = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    frame(spark, values, extra=True).write.parquet(str(tmp_path / "documents.parquet"))
    found = {r["doc_id"]: r for r in QUERIES["op9_license_rules"](spark, str(tmp_path)).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        split, starts, labels = words(text), [], set()
        for label, phrase in license_rules.BASE:
            phrase = phrase.split()
            for at in range(len(split)):
                if split[at : at + len(phrase)] == phrase:
                    starts.append(at)
                    labels.add(label)
        r = found[i]
        base = (len(split), len(starts), min(starts, default=None), max(starts, default=None))
        assert tuple(r)[1:5] == base, text
        assert r["base_labels"] == ",".join(sorted(labels))
        listed = r["labels"].split(",") if r["labels"] else []
        assert labels <= set(listed) and listed == sorted(set(listed))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(listed)


def brute_detections(text):
    """All matches of all rules whose keyword is there, and which are not suppressed."""
    joined = "".join(f" {w}" for w in words(text)) + (" " if words(text) else "")
    each = []
    for number, label, priority, keyword, regex in license_rules.rules():
        if keyword in joined:
            for m in re.finditer(f" ({regex})(?= )", joined):
                first = joined[: m.start()].count(" ")
                each.append((first, first + m.group(1).count(" "), priority, number, label))
    kept = set()
    for a in each:
        inside = [
            b
            for b in each
            if b[0] <= a[0] and a[1] <= b[1] and b[2] <= a[2]
            and (b[0], -b[1], b[2], b[3]) < (a[0], -a[1], a[2], a[3])
        ]
        if not inside:
            kept.add(a)
    return set(each), kept


def test_detections_and_suppression(spark):
    texts = [*LICENCE_TEXTS, " ".join(LICENCE_TEXTS * 3), "", None]
    values = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    _, found = license_rules.licences(frame(spark, values))
    got = defaultdict(set)
    for r in found.collect():
        got[r["doc_id"], r["kept"]].add((r["first"], r["last"], r["priority"], r["rule"], r["label"]))
    for i, text in enumerate(texts):
        each, kept = brute_detections(text)
        assert got[i, True] == kept, text
        assert got[i, True] | got[i, False] == each


UNGATED_TEXTS = {
    "Permission is hereby granted, free of charge, to any person or organization obtaining a "
    "copy of the software and accompanying documentation": "boost",
    "X11 License": "mit",
    "under the X11 License": "mit",
    "Internet Systems Consortium License": "isc",
    "PSF License version 2": "python",
    "Open Data Commons Database License": "odbl",
    "Open Data Commons Open Database License": "odbl",
    "either version 3 of the License, or (at your option) any later version": "gpl",
}


def ungated_detections(text):
    """All matches of all rules, whatever their keyword."""
    joined = "".join(f" {w}" for w in words(text)) + (" " if words(text) else "")
    each = set()
    for number, label, priority, _, regex in license_rules.rules():
        for m in re.finditer(f" ({regex})(?= )", joined):
            first = joined[: m.start()].count(" ")
            each.add((first, first + m.group(1).count(" "), priority, number, label))
    return each


def test_no_match_waits_for_a_keyword_that_it_lacks(spark):
    texts = [*UNGATED_TEXTS, *LICENCE_TEXTS]
    values = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    _, found = license_rules.licences(frame(spark, values))
    got = defaultdict(set)
    for r in found.collect():
        got[r["doc_id"]].add((r["first"], r["last"], r["priority"], r["rule"], r["label"]))
    for i, text in enumerate(texts):
        assert got[i] == ungated_detections(text), text
        assert UNGATED_TEXTS.get(text) in {None, *(d[4] for d in got[i])}, text


def regex_strings(parsed):
    """Strings that a parsed regex matches, so that each of its alternatives, and each of its
    optional parts with and without it, is in one of them; ``.`` is a letter."""
    parts = []
    for op, value in parsed:
        name = str(op)
        if name == "LITERAL":
            parts.append([chr(value)])
        elif name == "ANY":
            parts.append(["q"])
        elif name == "IN":
            ends = [(v, v) if str(o) == "LITERAL" else v for o, v in value]
            parts.append([chr(c) for low, high in ends for c in range(low, high + 1)])
        elif name == "SUBPATTERN":
            parts.append(regex_strings(value[3]))
        elif name == "BRANCH":
            parts.append([s for branch in value[1] for s in regex_strings(branch)])
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            least, most, inside = value
            inside = regex_strings(inside)
            counts = sorted({least, min(most, least + 1)})
            parts.append(["".join(t) for n in counts for t in product(inside, repeat=n)])
        else:
            raise ValueError(f"no strings for {name}")
    return ["".join(t) for t in product(*parts)]


def test_every_match_holds_the_word_that_gates_its_keyword():
    anchored = license_rules.anchors()
    assert len(anchored) > 150
    for _, _, _, keyword, regex in license_rules.rules():
        if keyword in anchored:
            strings = list(regex_strings(_parser.parse(regex)))
            assert all(anchored[keyword] in s.split() for s in strings), regex


def test_hundreds_of_rules_are_written_one_by_one():
    written = [r for rules in license_texts.SIGNATURES.values() for *_, r in rules]
    assert len(set(written)) == len(written) >= 200


# Sentences of licence bodies as they stand in the public texts.
BODIES = {
    "apache": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND",
    "mit": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mpl": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "gpl": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY",
    "agpl": "your modified version must prominently offer all users interacting with it remotely through a computer network (if your version supports such interaction)",
    "epl": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    "bsd": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "cc-by": "You must give appropriate credit, provide a link to the license, and indicate if changes were made.",
    "cc-by-sa": "you must distribute your contributions under the same license as the original.",
    "zlib": "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.",
    "isc": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE",
    "unlicense": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software",
    "ofl": "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
    "sspl": "you must make the functionality of the Program or modified version available to third parties as a service",
    "proprietary": "No part of this publication may be reproduced without the prior written consent of the publisher",
}


def test_sentences_of_licence_bodies_are_found(spark):
    names = list(BODIES)
    values = [(i, f"Some words. {BODIES[n]} And more.", "en", "s", 1) for i, n in enumerate(names)]
    values.append((len(names), "a text about permits and commits, with nothing of the kind", "en", "s", 1))
    _, found = license_rules.licences(frame(spark, values))
    labels = defaultdict(set)
    for r in found.where("kept").collect():
        labels[r["doc_id"]].add(r["label"])
    for i, name in enumerate(names):
        assert name in labels[i], name
    assert len(names) not in labels


def test_every_match_of_a_rule_contains_its_keyword():
    for _, _, _, keyword, regex in license_rules.rules():
        strings = regex_strings(_parser.parse(regex))
        assert strings and all(re.fullmatch(regex, s) for s in strings[:50])
        assert [s for s in strings if keyword not in s] == [], regex


def test_there_are_hundreds_of_rules():
    listed = license_rules.rules()
    assert len(listed) >= 200
    assert all(re.compile(r[4]) for r in listed)
    assert [r[2] for r in listed] == sorted(r[2] for r in listed)


# --- operator 10


def brute_components(values):
    sets = [shingles(t) for _, t, *_ in values]
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return sets, [root(i) for i in range(len(values))]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "B", "b", "é", "\n", " ", "x y"]), max_size=30)))
def test_shingle_sets_have_the_right_sizes(parts):
    texts = [" ".join(p) for p in parts]
    for text, found in zip(texts, shingle_sets(pa.array(texts, pa.string())), strict=True):
        assert len(found) == len(shingles(text))


def variants(n, words_, changes, seed):
    draw = np.random.default_rng(seed)
    base = [f"w{seed}x{i}" for i in range(words_)]
    found = []
    for k in range(n):
        copy = list(base)
        for at in draw.choice(words_, changes, replace=False):
            copy[at] = f"v{k}n{at}"
        found.append(" ".join(copy))
    return found


def component_ids(values, roots):
    least = {}
    for (doc_id, *_), root in zip(values, roots, strict=True):
        known = [i for i in (least.get(root), doc_id) if i is not None]
        least[root] = min(known, default=None)
    return least


@pytest.mark.parametrize(("worth", "part"), [(0.1, 2048), (1.1, 7), (0.0, 30)])
def test_components_equal_brute_force(spark, monkeypatch, worth, part):
    monkeypatch.setattr(hyperminhash, "WORTH", worth)
    monkeypatch.setattr(hyperminhash, "PART", part)
    texts = [t for _, t, *_ in rows()]
    # Groups whose members are linked, partly linked, and hardly linked with each other.
    texts += variants(40, 120, 2, 1) + variants(40, 120, 4, 2) + variants(30, 120, 6, 3)
    chain = [f"c{i}" for i in range(200)]
    texts += [" ".join(chain[3 * k : 3 * k + 60]) for k in range(40)]
    values = [(i, t, "en", "s", 1) for i, t in enumerate(texts)] + [(None, texts[-1], "en", "s", 1)]
    found = hyperminhash.near_groups(frame(spark, values, extra=True)).collect()
    sets, roots = brute_components(values)
    least = component_ids(values, roots)
    expected = Counter(
        (v[0], len(s), least[r] if s else v[0]) for v, s, r in zip(values, sets, roots, strict=True)
    )
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == expected


def test_one_of_each_group_stays(spark):
    values = [(i, t, "en", "s", 1) for i, t in enumerate(variants(20, 100, 1, 4) + ["", None, "a"])]
    values.append(values[0])
    made = frame(spark, values, extra=True)
    kept = hyperminhash.without_near_copies(made)
    assert kept.columns == made.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 20, 21, 22]


def test_counts_in_cells_rule_out_no_link():
    draw = np.random.default_rng(7)
    base = draw.integers(0, 2**64, 300, dtype=np.uint64)
    sets = []
    for k in range(40):
        own = draw.integers(0, 2**64, 5 + 2 * k, dtype=np.uint64)
        sets.append(np.unique(np.concatenate([draw.choice(base, 300 - 3 * k, replace=False), own])))
    every, held = np.unique(np.concatenate(sets), return_counts=True)
    alone = set(every[held == 1].tolist())
    rows_ = pa.RecordBatch.from_pylist(
        [
            {
                "node": k,
                "shingles": s.tobytes(),
                "alone": np.array([x for x in s.tolist() if x in alone], np.uint64)
                .view(np.int64)
                .tolist(),
            }
            for k, s in enumerate(sets)
        ],
        pa.schema(
            [("node", pa.int64()), ("shingles", pa.binary()), ("alone", pa.list_(pa.int64()))]
        ),
    )
    (counted,) = hyperminhash.count_shared(iter([rows_]))
    cells = [np.frombuffer(c, "<i2") for c in counted.column("cells").to_pylist()]
    for i in range(40):
        for j in range(i):
            shared = len(np.intersect1d(sets[i], sets[j]))
            assert np.minimum(cells[i], cells[j]).sum() >= shared


def test_estimates_are_near_the_truth():
    draw = np.random.default_rng(1)
    for share in (0.3, 0.6, 0.9):
        errors = []
        for _ in range(30):
            every = np.unique(draw.integers(0, 2**64, 1500, dtype=np.uint64))
            both = int(len(every) * share)
            rest = (len(every) - both) // 2
            a = np.sort(np.concatenate([every[:both], every[both : both + rest]]))
            b = np.sort(np.concatenate([every[:both], every[both + rest :]]))
            kept, _ = hyperminhash.registers([a, b])
            truth = both / len(every)
            errors.append(hyperminhash.estimate(kept[0], kept[1], len(a), len(b)) - truth)
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.06


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(70)] + [(100, 101), (5, 5)]
    found = hyperminhash.components(spark.createDataFrame(links, "u long, v long")).collect()
    expected = {i: 0 for i in range(1, 71)} | {101: 100}
    assert {r["node"]: r["root"] for r in found if r["node"] != r["root"]} == expected


# --- operator 6


def plain_odds(machine, which, values):
    odds = float(machine.weights[which] @ values)
    for i in range(len(which)):
        for j in range(i):
            odds += machine.vectors[which[i]] @ machine.vectors[which[j]] * values[i] * values[j]
    return odds


def test_linear_time_identity():
    draw = np.random.default_rng(3)
    machine = factorisation.Machine(
        draw.normal(size=factorisation.SIZE),
        draw.normal(size=(factorisation.SIZE, factorisation.RANK)),
        prior=None,
    )
    sizes = np.array([4, 7, 1])
    which = draw.integers(0, factorisation.SIZE, 12)
    values = draw.normal(size=12)
    odds, _ = machine.raw(sizes, which, values)
    ends = np.cumsum(sizes)
    for found, first, last in zip(odds, ends - sizes, ends, strict=True):
        assert found == pytest.approx(plain_odds(machine, which[first:last], values[first:last]))


def test_held_out_accuracy_and_folds(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = {r[0]: r[1] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    found = QUERIES["op6_factorisation_machine"](spark, sf_dir).collect()
    assert len(found) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    right = []
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        if r["held_out"] and r["doc_id"] in labels:
            right.append(r["predicted"] == labels[r["doc_id"]])
    assert np.mean(right) > 0.9


def test_other_columns_are_no_input(spark):
    labels = spark.createDataFrame([(r[0], i % 2) for i, r in enumerate(rows()) if r[0]], "doc_id long, quality int")
    machine = factorisation.learn(frame(spark), labels)
    one = factorisation.score(frame(spark, extra=True), machine)
    changed = [(r[0], r[1], "zz", "elsewhere", r[4]) for r in rows()]
    two = factorisation.score(frame(spark, changed), machine)
    key = lambda r: (r[0] or -1, r[1] or "", r[-1])
    a, b = sorted(map(tuple, one.collect()), key=key), sorted(map(tuple, two.collect()), key=key)
    assert one.columns[-1] == "_score"
    assert [r[-1] for r in a] == pytest.approx([r[-1] for r in b])


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in factorisation.score(frame(spark), factorisation.learn(frame(spark), none)).collect()} == {0.5}
    ones = spark.createDataFrame([(3, 1), (6, 1), (9, 1), (12, 1)], "doc_id long, quality int")
    assert factorisation.learn(frame(spark), ones).prior == 1.0


def test_features_are_worked_out_in_small_chunks(spark, monkeypatch):
    """However much text an Arrow batch holds, a worker's arrays are made for a part of it."""
    sizes, steps = [], []
    features = factorisation.features

    def counted(texts, n_chars):
        sizes.append(sum(len(t) for t in texts.to_pylist()))
        return features(texts, n_chars)

    monkeypatch.setattr(factorisation, "features", counted)
    monkeypatch.setattr(factorisation, "on_batches", lambda df, step, _: steps.append(step) or df)
    factorisation.score(frame(spark), factorisation.Machine())
    texts = ["few words " * 1000] * 500
    columns = {"_text": texts, "_length": pa.array([None] * 500, pa.int64())}
    [step] = steps
    found = list(step(iter([pa.RecordBatch.from_pydict(columns)])))
    assert sum(b.num_rows for b in found) == 500
    assert sum(sizes) == 5_000_000 and max(sizes) <= 1 << 20


# --- all


@pytest.mark.parametrize(
    "run",
    [
        block_names.copies,
        block_names.without_copies,
        hyperminhash.near_groups,
        hyperminhash.without_near_copies,
        lambda d: license_rules.licences(d)[0],
        lambda d: license_rules.licences(d)[1],
        lambda d: factorisation.score(d, factorisation.Machine()),
        lambda d: hilbert.shards(
            d.sparkSession, hilbert.write_along_curve(d, scratch_path(d.sparkSession, "c"))
        ).rows,
    ],
)
def test_empty_tables(spark, run):
    assert run(spark.createDataFrame([], FIELDS)).collect() == []


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), duck(sf_dir), ORACLES[name]) is None


def test_the_pipeline_stage_by_stage(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        sizes.append(docs.count())
        if name == "quality":
            bad = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 0")
            assert docs.join(bad, "doc_id").count() < bad.count() / 2
        if name == "exact_copies":
            assert sizes[-1] == len({flat(r["text"]) for r in before.collect()})
        if name == "near_copies":
            values = [tuple(r)[:2] for r in before.orderBy("doc_id").collect()]
            sets, roots = brute_components(values)
            expected = {v[0] for i, v in enumerate(values) if roots[i] == i or not sets[i]}
            assert {r["doc_id"] for r in docs.collect()} == expected
        if name != "packing":
            assert docs.columns == before.columns
    assert {r[0] for r in docs.select("doc_id").collect()} == {r[0] for r in before.select("doc_id").collect()}
    assert corpus_pipeline.run(spark, sf_dir).count() == sizes[-1]
