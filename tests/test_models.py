"""Models and answers as they survive tasks, workers and runs."""

import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docintake.operators import pagetext, scoring, tagging
from docintake.sources.arrivals import list_files


def test_a_worker_loads_a_model_once_for_many_tasks(spark, tmp_path):
    log, artifact = str(tmp_path / "loads"), tmp_path / "model.json"
    artifact.write_text(json.dumps({"limit": 50}))

    def load(path):
        with open(log, "a") as out:
            out.write(f"{os.getpid()}\n")
        with open(path) as file:
            limit = json.load(file)["limit"]
        return lambda rows: (rows["doc_id"] < limit).astype(int) + 1

    docs = spark.range(200).withColumnRenamed("id", "doc_id").repartition(40)
    for _ in range(2):  # two jobs, one model
        scored = scoring.score_documents_with_artifact(docs, str(artifact), load, ["doc_id"])
        assert {r["doc_id"]: r["pred"] for r in scored.collect()} == {
            n: 2 if n < 50 else 1 for n in range(200)
        }
    loads = Counter(open(log).read().split())
    assert set(loads.values()) == {1} and len(loads) <= 16

    artifact.write_text(json.dumps({"limit": 100}))  # another content is another model
    scored = scoring.score_documents_with_artifact(docs, str(artifact), load, ["doc_id"])
    assert scored.where("pred = 2").count() == 100


def test_a_pinned_classifier_gives_the_best_class_after_it_was_saved(spark, tmp_path):
    models = {1: ({"a": 1.0}, 0.25), 2: ({"b": 2.0}, -1.0), 3: ({"a": -1.0, "b": 0.5}, 0.0)}
    rows = [(n, float(n % 7 - 3), float(n % 5 - 2)) for n in range(35)]
    docs = spark.createDataFrame(rows, "doc_id long, a double, b double")
    scoring.pinned_classifier(spark, models).write().save(str(tmp_path / "m"))
    found = scoring.score_documents_with_model(docs, str(tmp_path / "m"))
    assert found.columns == ["doc_id", "a", "b", "pred"]
    for r in found.collect():
        margins = {1: r["a"] + 0.25, 2: 2 * r["b"] - 1, 3: -r["a"] + 0.5 * r["b"]}
        assert margins[r["pred"]] == max(margins.values())


def prompts_of(spark, n):
    texts = spark.range(n).select(
        F.col("id").alias("doc_id"),
        F.lit(1).alias("page_num"),
        F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"),
    )
    return tagging.build_prompts(texts)


def asked_by(log):
    return Counter(open(log).read().split()) if os.path.exists(log) else Counter()


def test_a_run_that_dies_asks_again_about_its_open_buckets_only(spark, tmp_path):
    log, deadly = str(tmp_path / "asked"), str(tmp_path / "deadly")

    def complete(batch):
        import os

        texts = [json.loads(m)[-1]["content"].split()[1] for m in batch]
        with open(log, "a") as out:
            out.write("".join(f"{t}\n" for t in texts))
        if "17" in texts and not os.path.exists(deadly):
            open(deadly, "w").close()
            os._exit(1)  # the worker is lost halfway
        return [f'{{"answer":{t}}}' for t in texts]

    store = tagging.AnswerStore(spark, str(tmp_path / "answers"), buckets=8)
    prompts = prompts_of(spark, 60)
    distinct = tagging.distinct_prompts(prompts)
    with pytest.raises(Exception, match="(?i)worker|crash|exit"):
        store.ask(distinct, complete, at_once=2)
    committed = store.answers().count()
    before = asked_by(log)
    assert 0 < committed < 60
    answered, _ = tagging.complete_prompts(prompts, complete, store=store)
    found = {r["doc_id"]: json.loads(r["completion"])["answer"] for r in answered.collect()}
    assert found == {n: n for n in range(60)}
    # Only prompts of the wave that died were asked twice.
    twice = [t for t, n in asked_by(log).items() if n > 1]
    assert "17" in twice and len(twice) <= sum(before.values()) - committed
    assert all(n <= 2 for n in asked_by(log).values())


def test_failed_calls_are_rows_after_some_tries(spark, tmp_path):
    log = str(tmp_path / "asked")

    def complete(batch):
        texts = [json.loads(m)[-1]["content"].split()[1] for m in batch]
        with open(log, "a") as out:
            out.write("".join(f"{t}\n" for t in texts if len(texts) == 1))
        if any(int(t) % 10 == 3 for t in texts):
            raise ValueError("busy")
        return ["{}"] * len(texts)

    store = tagging.AnswerStore(spark, str(tmp_path / "answers"), buckets=4)
    prompts = prompts_of(spark, 30)
    answered, _ = tagging.complete_prompts(prompts, complete, store=store, tries=2)
    assert {r["doc_id"] for r in answered.where("completion IS NULL").collect()} == {3, 13, 23}
    failures = store.failures().collect()
    assert [(r["error"], r["tries"]) for r in failures] == [("ValueError: busy", 2)] * 3
    calls = asked_by(log)
    assert all(calls[t] == 2 for t in ("3", "13", "23")) and sum(calls.values()) <= 36
    # They are left alone until someone wants them asked again.
    tagging.complete_prompts(prompts, complete, store=store, tries=2)
    assert asked_by(log) == calls
    store.ask(tagging.distinct_prompts(prompts), lambda batch: ["{}"] * len(batch), again=True)
    assert store.failures().isEmpty() and store.answers().count() == 30


def test_a_model_that_returns_too_few_answers_has_failed(spark, tmp_path):
    store = tagging.AnswerStore(spark, str(tmp_path / "answers"), buckets=1)
    prompts = prompts_of(spark, 5)
    tagging.complete_prompts(prompts, lambda batch: [], store=store, tries=1)
    assert store.failures().count() == 5


def test_files_are_read_in_runs_of_pages(spark, tmp_path):
    """No task gets more than a run of a file's pages; broken files give none."""
    folder, log = tmp_path / "files", str(tmp_path / "runs")
    folder.mkdir()
    for name, n in (("a", 10), ("b", 3), ("c", 4)):
        (folder / name).write_bytes(b"".join(b"page %d of %s\n" % (k, name.encode()) for k in range(1, n + 1)))
    (folder / "broken").write_bytes(b"\xff\xfe")

    def count(file):
        data = file.read()
        data.decode("utf-8")
        return data.count(b"\n")

    def read(file, first, last):
        with open(log, "a") as out:
            out.write(f"{last - first + 1}\n")
        for number, line in enumerate(file, 1):
            if first <= number <= last:
                yield number, line.decode().strip(), ""

    files = list_files(spark, str(folder))
    found = pagetext.extract_spans(files, count, read, span=4).collect()
    pages = sorted((r["path"].rsplit("/", 1)[1], r["page_num"], r["native_text"]) for r in found)
    assert pages == sorted(
        (name, k, f"page {k} of {name}") for name, n in (("a", 10), ("b", 3), ("c", 4)) for k in range(1, n + 1)
    )
    assert sorted(open(log).read().split()) == ["2", "3", "4", "4", "4"]


def test_a_model_gets_few_rows_at_once(spark):
    """However many rows an Arrow batch holds, the model sees a bounded part of their text."""
    docs = spark.range(3000, numPartitions=1).select(
        F.col("id").alias("doc_id"), F.expr("repeat('x', 10000)").alias("text")
    )

    def load():
        return lambda rows: rows["text"].str.len() * 0 + (1 if rows["text"].str.len().sum() < 9e6 else 9)

    found = scoring.score_documents_with_function(docs, load, ["text"]).groupBy("pred").count()
    assert [tuple(r) for r in found.collect()] == [(1, 3000)]
