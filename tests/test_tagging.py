import itertools
import json

import pytest
from pyspark.sql import functions as F
from test_state import ANSWERS

from docintake.functions import tagjson
from docintake.functions.truth import non_blank
from docintake.operators import pagetext, scoring, tagging
from docintake.schemas import TAG_FIELDS

GOOD = '{"title":"T","author":"A","date":"D","sector":"S"}'
LATER = '{"title":"L","author":"A","date":"D","sector":"S"}'
BLANK = '{"title":" \\t\\u00a0","author":"A","date":"D","sector":"S"}'
KEYLESS = '{"author":"A","date":"D","sector":"S"}'
NUMBER = '{"title":5,"author":"A","date":"D","sector":"S"}'
NULL_TITLE = '{"title":null,"author":"A","date":"D","sector":"S"}'
PARTIAL = '{"title":"T"}'
BAD = '{"title":'
EMPTY = "{}"
LIST = "[1]"
TITLE_LIST = '["title"]'
WORD = '"word"'
TITLE_WORD = '"my title"'
ZERO = "0"
SKIP = None  # the page has no text

CASES = (
    GOOD, BLANK, KEYLESS, NUMBER, NULL_TITLE, PARTIAL, BAD, EMPTY, LIST, TITLE_LIST, WORD,
    TITLE_WORD, ZERO, SKIP,
)


def written(answer):
    """What writing a tagger's result to a row gives."""
    if not answer:
        return ("none", None)
    if not isinstance(answer, dict) or any(f not in answer for f in TAG_FIELDS):
        return ("failed", None)
    return ("tagged", answer["title"])


def by_hand(answers):
    """Pages in rank order: the first titled one wins, an error ends the document."""
    last = None
    try:
        for text in answers:
            if text is SKIP:
                continue
            last = json.loads(text)
            if "title" in last and last["title"].strip():
                return written(last)
        if last is None:
            return ("none", None)
        return written(last) if "title" not in last else ("none", None)
    except (ValueError, TypeError, AttributeError):
        return ("none", None)


@pytest.fixture(scope="module")
def documents():
    combos = [c for n in (1, 2) for c in itertools.product(CASES, repeat=n)]
    combos += [(a, b, GOOD) for a in CASES for b in (BLANK, KEYLESS, SKIP)]
    combos += [(SKIP, b, c) for b in CASES for c in (KEYLESS, BLANK, BAD, SKIP)]
    return dict(enumerate(combos))


def pages(documents):
    return [
        (doc, rank, rank, "" if a is SKIP else f"{doc}-{rank}", a)
        for doc, answers in documents.items()
        for rank, a in enumerate(answers, 1)
    ]


SCHEMA = "doc_id long, page_num int, rank int, text string, completion string"


def test_resolution_rules(spark, documents):
    rows = spark.createDataFrame(pages(documents), SCHEMA)
    got = {r["doc_id"]: (r["result"], r["title"]) for r in tagging.tag_resolve(rows).collect()}
    assert got == {doc: by_hand(answers) for doc, answers in documents.items()}


def test_rounds_give_the_same_and_ask_no_more_than_needed(spark, documents, tmp_path):
    answer_of = {text: a for _, _, _, text, a in pages(documents) if text}
    calls = tmp_path / "calls"
    calls.mkdir()

    def complete(batch):
        texts = [json.loads(m)[-1]["content"] for m in batch]
        for t in texts:
            with open(calls / t, "a") as f:
                f.write("x")
        return [answer_of[t] for t in texts]

    rows = spark.createDataFrame(pages(documents), SCHEMA).drop("completion")
    result, _ = tagging.tag_in_rounds(rows, complete)
    got = {r["doc_id"]: (r["result"], r["title"]) for r in result.collect()}
    result.collect()
    assert got == {doc: by_hand(answers) for doc, answers in documents.items()}
    asked = {p.name: p.read_text() for p in calls.iterdir()}
    assert set(asked.values()) == {"x"}
    needed = set()
    for doc, answers in documents.items():
        for rank, a in enumerate(answers, 1):
            if a is SKIP:
                continue
            needed.add(f"{doc}-{rank}")
            if by_hand([a, KEYLESS])[0] != "failed" or a == PARTIAL:
                break
    assert set(asked) <= set(answer_of) and needed <= set(asked)
    decided = {"titled", "abort"}
    judged = tagging.judge_pages(spark.createDataFrame(pages(documents), SCHEMA)).collect()
    closed_at = {}
    for r in judged:
        if r["verdict"] in decided:
            closed_at[r["doc_id"]] = min(r["rank"], closed_at.get(r["doc_id"], 99))
    for name in asked:
        doc, rank = map(int, name.split("-"))
        assert rank <= closed_at.get(doc, 99)


def test_same_prompt_is_asked_once(spark, tmp_path):
    calls = tmp_path / "calls"

    def complete(batch):
        with open(calls, "a") as f:
            f.write("x" * len(batch))
        return [GOOD] * len(batch)

    texts = spark.range(100).select(
        F.col("id").alias("doc_id"), F.lit(1).alias("page_num"), F.lit("same").alias("text")
    )
    prompts = tagging.build_prompts(texts)
    answered, known = tagging.complete_prompts(prompts, complete)
    assert answered.where(F.col("completion") == GOOD).count() == 100
    again, _ = tagging.complete_prompts(prompts, complete, known=known)
    assert again.count() == 100
    assert calls.read_text() == "x"


def test_first_page_takes_any_title(spark):
    want = {
        GOOD: "tagged", BLANK: "tagged", NUMBER: "tagged", NULL_TITLE: "tagged", KEYLESS: "failed",
        PARTIAL: "failed", LIST: "failed", BAD: "none", EMPTY: "none", SKIP: "none",
    }
    cases = dict(enumerate(want))
    rows = [(n, 1, 1, "" if a is SKIP else "t", a) for n, a in cases.items()]
    rows += [(n, 2, 2, "t", GOOD) for n in cases]
    got = tagging.tag_first_page(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {cases[r["doc_id"]]: r["result"] for r in got} == want


def test_answer_states(spark):
    def by_json(text):
        try:
            answer = json.loads(text)
        except (TypeError, ValueError):
            return "none"
        return {"none": "none", "failed": "broken", "tagged": "complete"}[written(answer)[0]]

    more = ("-0", "0.0", "0e5", "-0.00E+2", "0.5", "1", " null ", "\n[ ]", "[0]", '" "')
    rows = spark.createDataFrame([(a,) for a in ANSWERS + more], "a string")
    got = tagjson.parse(rows, F.col("a")).select("a", tagjson.state().alias("s")).collect()
    assert {r["a"]: r["s"] for r in got} == {a: by_json(a) for a in ANSWERS + more}


def test_blank_is_what_strip_removes(spark):
    signs = [chr(n) for n in range(0x3100) if not 0xD800 <= n < 0xE000]
    rows = spark.createDataFrame([(s,) for s in signs], "s string")
    got = {r["s"] for r in rows.where(~non_blank(F.col("s"))).collect()}
    assert got == {s for s in signs if not s.strip()}


def test_page_text_is_shortened_per_source(spark):
    rows = spark.createDataFrame(
        [(1, 1, "a" * 2500, "b" * 2001), (1, 2, None, None), (1, 3, "x", None)],
        "doc_id long, page_num int, native_text string, ocr_text string",
    )
    got = {r["page_num"]: r["text"] for r in pagetext.page_text(rows).collect()}
    assert got == {1: "a" * 2000 + "b" * 2000, 2: "", 3: "x"}
    flags = pagetext.overlong_pages(rows).collect()
    assert [(r["page_num"], r["native_overlong"], r["ocr_overlong"]) for r in flags] == [(1, True, True)]
    prompts = tagging.build_prompts(pagetext.page_text(rows)).collect()
    assert {r["page_num"] for r in prompts} == {1, 3}


def test_top_pages_ties_and_short_documents(spark):
    rows = spark.createDataFrame(
        [(1, p, 0.5) for p in range(1, 6)] + [(2, 1, 0.1), (2, 2, 0.9)],
        "doc_id long, page_num int, prob double",
    )
    got = scoring.title_page_top3(rows)
    ranks = {(r["doc_id"], r["rank"]): r["page_num"] for r in got.collect()}
    assert ranks == {(1, 1): 5, (1, 2): 4, (1, 3): 3, (2, 1): 2, (2, 2): 1}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_pages_of_one_task_are_dealt_before_they_are_sorted(spark):
    docs = [(None, p) for p in range(1, 6)] + [(7, p) for p in range(1, 2501)] + [(8, 1)]
    rows = spark.createDataFrame(
        [(d, p, p % 1250 / 1250, f"text {p}") for d, p in docs],
        "doc_id long, page_num int, prob double, text string",
    ).coalesce(1)
    got = scoring.title_page_top3(rows, keep=["text"])
    ranks = {(r["doc_id"], r["rank"]): (r["page_num"], r["text"]) for r in got.collect()}
    want = {(None, k): 6 - k for k in (1, 2, 3)} | {(7, 1): 2499, (7, 2): 1249, (7, 3): 2498, (8, 1): 1}
    assert ranks == {key: (p, f"text {p}") for key, p in want.items()}
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    below_the_cut = plan[plan.index("Partial") :]
    assert "REBALANCE_PARTITIONS" in below_the_cut


def test_extractor_failures_give_no_page(spark, tmp_path):
    for name, content in (("a.pdf", b"one\ftwo"), ("b.pdf", b"bad")):
        (tmp_path / name).write_bytes(content)

    def extract(path, content):
        if content == b"bad":
            raise ValueError("unreadable")
        for n, text in enumerate(content.decode().split("\f"), 1):
            yield n, text, ""

    from docintake.sources.arrivals import read_files

    got = pagetext.extract_pages(read_files(spark, str(tmp_path)), extract)
    rows = {(r["doc_id"], r["page_num"]): r["native_text"] for r in got.collect()}
    assert rows == {("a.pdf", 1): "one", ("a.pdf", 2): "two"}
    ranked = spark.createDataFrame([("b.pdf", 1, 1)], "doc_id string, page_num int, rank int")
    assert pagetext.title_page_text(ranked, got).first()["text"] == ""


def test_models_from_spark_ml(spark, tmp_path):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, HashingTF, Tokenizer, VectorAssembler

    docs = spark.createDataFrame(
        [
            (n, ("annual results slides", "html page", "long report slides")[n % 3], n % 3 + 1)
            for n in range(30)
        ],
        "doc_id long, text string, label int",
    )
    steps = [
        Tokenizer(inputCol="text", outputCol="words"),
        HashingTF(inputCol="words", outputCol="tf", numFeatures=64),
        IDF(inputCol="tf", outputCol="features"),
        LogisticRegression(maxIter=5),
    ]
    path = str(tmp_path / "model")
    Pipeline(stages=steps).fit(docs).save(path)
    scored = scoring.score_documents_with_model(docs, path)
    assert scored.where(F.col("pred") != F.col("label")).count() == 0

    pages = spark.range(20).select(
        F.lit(1).alias("doc_id"),
        F.col("id").alias("page_num"),
        (F.col("id") % 2).cast("double").alias("image_count"),
        (F.col("id") % 2).alias("label"),
    )
    model = Pipeline(
        stages=[VectorAssembler(inputCols=["image_count"], outputCol="features"), LogisticRegression()]
    ).fit(pages)
    probs = scoring.page_scores_with_model(pages, model)
    assert probs.where((F.col("prob") > 0.5) != (F.col("label") == 1)).count() == 0


def test_only_wanted_pages_are_read(spark):
    wanted = spark.createDataFrame([("a", 2), ("b", 1), ("c", 1)], "path string, page_num long")

    def native(path, page):
        if path == "b":
            raise OSError("no such file")
        return f"{path}{page}"

    def ocr(path, page):
        return None if path == "c" else "ocr"

    got = pagetext.read_target_pages(wanted, native, ocr).collect()
    texts = {r["path"]: (r["page_num"], r["native_text"], r["ocr_text"]) for r in got}
    assert texts == {"a": (2, "a2", "ocr"), "b": (1, "", "ocr"), "c": (1, "c1", "")}


def test_the_model_is_asked_only_for_the_class_of_a_document(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()

    def complete(batch):
        for m in batch:
            (calls / json.loads(m)[-1]["content"]).touch()
        return [GOOD] * len(batch)

    docs = spark.createDataFrame([(n, n) for n in (1, 2, 3)], "doc_id long, pred int")
    first = spark.createDataFrame(
        [(n, 1, f"first{n}") for n in (1, 2, 3)], "doc_id long, page_num int, text string"
    )
    ranked = spark.createDataFrame(
        [(n, r, r, f"ranked{n}-{r}") for n in (1, 2, 3) for r in (1, 2)],
        "doc_id long, page_num int, rank int, text string",
    )
    got = tagging.tag_documents(docs, first, ranked, complete)[0].collect()
    assert {r["doc_id"]: r["result"] for r in got} == {1: "tagged", 2: "none", 3: "tagged"}
    assert {p.name for p in calls.iterdir()} == {"first1", "ranked3-1"}


def test_a_prompt_that_classes_share_is_asked_once_and_never_again(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()

    def complete(batch):
        for m in batch:
            with open(calls / json.loads(m)[-1]["content"], "a") as f:
                f.write("x")
        return [GOOD] * len(batch)

    docs = spark.createDataFrame([(1, 1), (3, 3)], "doc_id long, pred int")
    first = spark.createDataFrame([(1, 1, "same")], "doc_id long, page_num int, text string")
    ranked = spark.createDataFrame(
        [(3, 1, 1, "same")], "doc_id long, page_num int, rank int, text string"
    )
    once, answers = tagging.tag_documents(docs, first, ranked, complete)
    again, _ = tagging.tag_documents(docs, first, ranked, complete, answers)
    assert sorted(once.collect()) == sorted(again.collect())
    assert {p.name: p.read_text() for p in calls.iterdir()} == {"same": "x"}
