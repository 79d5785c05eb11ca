"""One query per operator, over whole tables."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docintake.functions.scores import margin
from docintake.operators import (
    batches,
    browser,
    claims,
    labels,
    pagetext,
    patches,
    reconcile,
    results,
    scoring,
    state,
    tagging,
)
from docintake.operators.skew import key_join, running
from docintake.plans import fixtures as fx
from docintake.plans.lifecycle import Intake
from docintake.schemas import EXPORT_COLUMNS, LINKS, TAG_FIELDS
from docintake.session import materialize, scratch_path
from docintake.sources import archive, arrivals, csvfiles, files
from docintake.sources.links import Environment, choose, read_archive, read_links
from docintake.sources.tables import SnapshotTable, read_parts
from docintake.streaming import archives, jobs, retries
from docintake.streaming import arrivals as arriving

BATCH = 10
SEED = "run-1"
NEXT_SEED = "run-2"
BIG_BATCH = 2000  # beyond the plain top-k

# Hosts that serve the work page itself; a parameter of the tab filter.
OWN_HOSTS = ("http://localhost:5000", "http://127.0.0.1:5000")

# Coefficients of the example models.
PAGE_WEIGHTS = {"aspect_ratio": 1.2, "word_count": -0.05, "image_count": 0.4, "page_num": -0.1}
PAGE_INTERCEPT = 0.3
DOC_MODELS = {
    1: ({"words": -0.002, "lines": -0.05}, 2.0),
    2: ({"words": 0.003}, -1.0),
    3: ({"words": -0.001, "lines": 0.02}, 0.5),
}

# The same with intercepts that let no two classes be equally likely.
SAVED_MODELS = {c: (w, b + {1: 0.0012, 3: 0.0007}.get(c, 0.0)) for c, (w, b) in DOC_MODELS.items()}

ARCHIVED = batches.ARCHIVE_COLUMNS
STATE_COLUMNS = (
    "id",
    "pdf_link",
    "status",
    "classify",
    "uncertainty",
    *TAG_FIELDS,
    "filename_location",
)


def _working(spark: SparkSession, d: str) -> DataFrame:
    return batches.load(fx.links(spark, d))


def _state(spark: SparkSession, d: str) -> DataFrame:
    return state.link_state(_working(spark, d), fx.link_events(spark, d))


# --- claims -------------------------------------------------------------------


def claim_batch(spark: SparkSession, d: str) -> DataFrame:
    return claims.claim_batch(fx.links(spark, d), BATCH, SEED)


def claim_html(spark: SparkSession, d: str) -> DataFrame:
    return claims.claim_html(fx.links(spark, d), BATCH, SEED)


def claim_noext(spark: SparkSession, d: str) -> DataFrame:
    return claims.claim_no_extension(fx.links(spark, d), BATCH, SEED)


def claim_for_tagging(spark: SparkSession, d: str) -> DataFrame:
    return claims.claim_for_tagging(fx.links(spark, d), BATCH, SEED)


def claim_apply(spark: SparkSession, d: str) -> DataFrame:
    _, after = claims.claim(fx.links(spark, d), BATCH, SEED)
    return after


def batch_worklist(spark: SparkSession, d: str) -> DataFrame:
    return batches.up_to(batches.worklist(fx.links(spark, d), BATCH, SEED), BATCH)


# --- patches ------------------------------------------------------------------


def merge_patch(spark: SparkSession, d: str) -> DataFrame:
    return patches.merge_patch(fx.links(spark, d), fx.patches(spark, d))


def patch_columns(spark: SparkSession, d: str) -> DataFrame:
    """Patches that lack some columns: what is missing keeps every one of them out."""
    whole, found = fx.patches(spark, d), []
    for gone in ((), ("title",), ("author", "date"), ("pdf_link",)):
        lacking = whole.drop(*gone)
        missing = patches.missing_columns(lacking, patches.PATCH_NEEDS)
        rows = lacking.select(
            "ordinal",
            F.lit(",".join(missing)).alias("missing"),
            F.lit("merged" if not missing else "rejected").alias("outcome"),
        )
        found.append(rows)
    return reduce(DataFrame.unionByName, found)


def merge_count(spark: SparkSession, d: str) -> DataFrame:
    return patches.merge_count(fx.links(spark, d), fx.patches(spark, d))


def sparse_patch(spark: SparkSession, d: str) -> DataFrame:
    return patches.sparse_patch(fx.links(spark, d), fx.patches(spark, d))


def sparse_patch_applied(spark: SparkSession, d: str) -> DataFrame:
    flagged = patches.patch_has_data(fx.patches(spark, d))
    return flagged.select("ordinal", "pdf_link", "applied")


def release_links(spark: SparkSession, d: str) -> DataFrame:
    ids = fx.table(spark, d, "labels").select(F.col("doc_id").alias("id"))
    return patches.release_links(fx.links(spark, d), ids)


def reset_null_tags(spark: SparkSession, d: str) -> DataFrame:
    return patches.reset_null_tags(fx.links(spark, d))


def link_lookup(spark: SparkSession, d: str) -> DataFrame:
    return patches.link_lookup(fx.links(spark, d), fx.link_events(spark, d))


# --- link state ---------------------------------------------------------------


def link_state(spark: SparkSession, d: str) -> DataFrame:
    return _state(spark, d).select(*STATE_COLUMNS)


def event_outcomes(spark: SparkSession, d: str) -> DataFrame:
    rows = state.event_outcomes(_working(spark, d), fx.link_events(spark, d))
    return rows.select("event_id", "pdf_link", "kind", "outcome")


def is_processed(spark: SparkSession, d: str) -> DataFrame:
    return patches.link_checks(fx.links(spark, d), fx.link_events(spark, d))


def needs_tagging(spark: SparkSession, d: str) -> DataFrame:
    """Per download, whether its link as loaded still wants tags."""
    first = patches.first_rows(
        fx.links(spark, d), ["pdf_link"], "id", ["id", "title", "date"]
    )
    downloads = fx.link_events(spark, d).where(F.col("kind") == state.DOWNLOAD)
    rows = key_join(downloads, first, ["pdf_link"])
    known = F.col("id").isNotNull()
    return rows.select(
        "event_id",
        (known & state.is_tagged()).alias("is_tagged"),
        (known & state.needs_tagging(F.col("pred"))).alias("needs_tagging"),
    )


def partition_by_status(spark: SparkSession, d: str) -> DataFrame:
    part = F.when(F.col("status") == state.PROCESSED, "processed").otherwise("unprocessed")
    kept = _state(spark, d).where(F.col("status").isin(state.PROCESSED, state.UNPROCESSED))
    return kept.select("id", "pdf_link", "status", part.alias("part"))


def prune_batch(spark: SparkSession, d: str) -> DataFrame:
    """Rows left after done and processed rows are removed; no status stays."""
    rows = fx.links(spark, d).select("id", "pdf_link", "status")
    return batches.without_status(batches.without_status(rows, state.DONE), state.PROCESSED)


def bulk_transition(spark: SparkSession, d: str) -> DataFrame:
    rows = _state(spark, d).select("id", "pdf_link", "status", F.col("status").alias("before"))
    moved = batches.set_done(batches.set_processed(rows))
    return moved.select("id", "before", F.col("status").alias("after"))


def status_counts(spark: SparkSession, d: str) -> DataFrame:
    return batches.status_counts(_state(spark, d))


def batch_append(spark: SparkSession, d: str) -> DataFrame:
    """A worked batch gains newly claimed rows, which lack the uncertainty column."""
    rows = fx.links(spark, d)
    fresh = rows.where(claims.wants_no_extension())
    return batches.append(_state(spark, d), fresh).select(*STATE_COLUMNS)


def batch_close(spark: SparkSession, d: str) -> DataFrame:
    return batches.close_plan(_state(spark, d))


def _worked_intake(spark: SparkSession, d: str) -> Intake:
    """An intake whose first batch was claimed and worked on."""
    intake = Intake(spark, scratch_path(spark, "intake"))
    intake.links.commit(fx.links(spark, d))
    intake.start_batch(BATCH, SEED)
    intake.record(fx.link_events(spark, d), "events")
    return intake


def intake_cycle(spark: SparkSession, d: str) -> DataFrame:
    """The link table after one batch was claimed, worked and closed."""
    intake = _worked_intake(spark, d)
    intake.close_batch()
    return intake.links.read().select("id", "pdf_link", "status", "classify", "title")


def intake_cycle_archive(spark: SparkSession, d: str) -> DataFrame:
    """What the archive holds after that cycle."""
    intake = _worked_intake(spark, d)
    intake.close_batch()
    return read_archive(spark, intake.archive).select(*ARCHIVED)


def intake_cycle_batches(spark: SparkSession, d: str) -> DataFrame:
    """Every link of the table, and whether the batch held it as loaded, after it was closed, and
    after the next one was claimed."""
    intake, held = _worked_intake(spark, d), []
    for moment, step in (
        ("loaded", lambda: None),
        ("closed", intake.close_batch),
        ("next", lambda: intake.start_batch(BATCH, NEXT_SEED)),
    ):
        step()
        rows = intake.batch.read().select("id", F.lit(True).alias(moment))
        held.append(materialize(rows, "held"))
    found = intake.links.read().select("id")
    for rows in held:
        moment = rows.columns[1]
        found = found.join(rows, "id", "left").withColumn(moment, F.coalesce(moment, F.lit(False)))
    return found


def empty_batch(spark: SparkSession, d: str) -> DataFrame:
    """Batches that are asked for where links are free and where none is: what each answers."""
    answers = []
    for name, rows in (
        ("free", fx.links(spark, d)),
        ("busy", fx.links(spark, d).withColumn("status", F.lit(claims.IN_PROCESS))),
    ):
        intake = Intake(spark, scratch_path(spark, "intake"))
        intake.links.commit(rows)
        found = intake.start_batch(BATCH, SEED).agg(F.count(F.lit(1)).alias("n"))
        answer = F.when(F.col("n") == 0, "not found").otherwise("found")
        answers.append(found.select(F.lit(name).alias("links"), "n", answer.alias("answer")))
    return answers[0].unionByName(answers[1])


def environment_links(spark: SparkSession, d: str) -> DataFrame:
    """The link tables of two working environments, each read where its environment keeps it."""
    places, found = {}, []
    for name, rows in (("production", fx.links(spark, d)), ("development", fx.big_links(spark, d))):
        root = scratch_path(spark, name)
        SnapshotTable(spark, root, LINKS).commit(rows)
        places[name] = Environment(link_snapshots=root)
    for name in places:
        rows = read_links(spark, choose(places, name))
        found.append(rows.select(F.lit(name).alias("environment"), "id", "pdf_link", "status"))
    return reduce(DataFrame.unionByName, found)


# --- archive ------------------------------------------------------------------


def archive_append(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "archive")
    archive.append_archive(batches.processed_archive(_state(spark, d)), path, "run-1")
    return spark.read.parquet(path).select(*ARCHIVED)


def archive_on_download(spark: SparkSession, d: str) -> DataFrame:
    rows = state.archive_on_download(_working(spark, d), fx.link_events(spark, d))
    return rows.select("event_id", *ARCHIVED)


def archive_one(spark: SparkSession, d: str) -> DataFrame:
    """What archiving a single link writes, whatever its status."""
    link = fx.links(spark, d).where("id = 7").first()["pdf_link"]
    return batches.first_archive(_state(spark, d), link).select(*ARCHIVED)


def archive_truncate(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "archive")
    archive.append_archive(batches.archive_rows(fx.links(spark, d)), path, "run-1")
    before = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows_before")).first()
    archive.truncate_archive(spark, path)
    after = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows_after"))
    return after.select(
        F.lit(before["rows_before"]).cast("long").alias("rows_before"), "rows_after"
    )


# --- reconciliation and retries -------------------------------------------------


def reconcile_downloads(spark: SparkSession, d: str) -> DataFrame:
    rows = reconcile.reconcile_downloads(fx.link_events(spark, d), fx.links(spark, d))
    return rows.select("event_id", "pdf_link", "filename", "id", "status")


def reconcile_rejects(spark: SparkSession, d: str) -> DataFrame:
    rows = reconcile.reconcile_rejects(fx.link_events(spark, d), fx.links(spark, d))
    return rows.select("event_id", "pdf_link", "filename", "outcome")


def download_decision(spark: SparkSession, d: str) -> DataFrame:
    stopped = fx.link_events(spark, d).where(F.col("kind") == state.INTERRUPTED)
    rows = reconcile.download_decision(stopped, fx.links(spark, d))
    return rows.select(F.col("event_id").alias("download_id"), "pdf_link", "action")


def retry_sweeps(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.retry_sweeps(fx.link_events(spark, d)).select(
        "client_id", "sweep_no", "event_id"
    )


def retry_candidates(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.retry_candidates(fx.client_events(spark, d), fx.links(spark, d))


def completed_items(spark: SparkSession, d: str) -> DataFrame:
    """State changes carry only a download id; the item has the link and file."""
    events = fx.link_events(spark, d)
    changes = events.select(
        F.col("event_id").alias("download_id"),
        F.when(F.col("kind") == state.DOWNLOAD, "complete")
        .when(F.col("kind") == state.INTERRUPTED, "interrupted")
        .otherwise("in_progress")
        .alias("state"),
    )
    items = events.select(F.col("event_id").alias("download_id"), "pdf_link", "filename")
    return browser.completed_items(changes, items)


# --- URLs -----------------------------------------------------------------------


def url_route(spark: SparkSession, d: str) -> DataFrame:
    rows = browser.url_route(fx.links(spark, d))
    return rows.select(
        "id", "extension", "route", "page_type", "is_html", "no_extension", "is_pdf_file"
    )


def _tabs(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("event_id")
    return fx.link_events(spark, d).select(
        "event_id",
        F.when(n % 10 == 0, F.concat(F.lit("http://localhost:5000/"), n.cast("string")))
        .when(n % 10 == 1, "")
        .otherwise(F.col("pdf_link"))
        .alias("url"),
        F.when(n % 3 == 0, "loading").otherwise("complete").alias("load_state"),
        (n % 2).cast("int").alias("frame_id"),
    )


def tab_filter(spark: SparkSession, d: str) -> DataFrame:
    return browser.tab_filter(_tabs(spark, d), OWN_HOSTS).select("event_id", "url")


def main_frames(spark: SparkSession, d: str) -> DataFrame:
    return browser.main_frames(_tabs(spark, d)).select("event_id", "url")


# --- scoring and page text --------------------------------------------------------


def _document_features(spark: SparkSession, d: str) -> DataFrame:
    text = F.col("text")
    count = lambda mark: (
        F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit(""))) + 1
    )
    return fx.table(spark, d, "documents").select(
        "doc_id", count(" ").cast("double").alias("words"), count("\n").cast("double").alias("lines")
    )


def _scored_documents(spark: SparkSession, d: str) -> DataFrame:
    margins = {c: margin(w, b) for c, (w, b) in DOC_MODELS.items()}
    return scoring.score_documents(_document_features(spark, d), margins)


def score_documents(spark: SparkSession, d: str) -> DataFrame:
    return _scored_documents(spark, d).select("doc_id", "pred")


# Stand-in models are made inside functions, so that they travel to the executors
# with the job and need no installed module there.


def length_scorer() -> Callable:
    """Loads a stand-in Python model: short texts are presentations."""
    return lambda: lambda rows: rows["text"].str.len().map(
        lambda n: 1 if n < 500 else 3 if n < 5000 else 2
    )


def score_documents_python(spark: SparkSession, d: str) -> DataFrame:
    docs = fx.table(spark, d, "documents")
    return scoring.score_documents_with_function(docs, length_scorer(), ["text"])


def score_documents_artifact(spark: SparkSession, d: str) -> DataFrame:
    """The same model with its numbers in a file, which each worker process loads once."""
    path = scratch_path(spark, "artifact")
    numbers = spark.createDataFrame([('{"short": 500, "long": 5000}',)], "value string")
    numbers.coalesce(1).write.text(path)
    docs = fx.table(spark, d, "documents")
    return scoring.score_documents_with_artifact(docs, path, saved_length_scorer(), ["text"])


def saved_length_scorer() -> Callable:
    """Loads the numbers of a stand-in model from a file."""

    def load(path: str) -> Callable:
        import json

        with open(path) as file:
            numbers = json.load(file)
        return lambda rows: rows["text"].str.len().map(
            lambda n: 1 if n < numbers["short"] else 3 if n < numbers["long"] else 2
        )

    return load


def score_documents_saved_model(spark: SparkSession, d: str) -> DataFrame:
    """An ML pipeline with known coefficients, saved, loaded and applied."""
    path = scratch_path(spark, "model")
    scoring.pinned_classifier(spark, SAVED_MODELS).write().save(path)
    return scoring.score_documents_with_model(_document_features(spark, d), path).select(
        "doc_id", "pred"
    )


def _scored_pages(spark: SparkSession, d: str) -> DataFrame:
    return scoring.page_scores(fx.doc_pages(spark, d), PAGE_WEIGHTS, PAGE_INTERCEPT)


def page_scores(spark: SparkSession, d: str) -> DataFrame:
    return _scored_pages(spark, d).select("doc_id", "page_num", "prob")


def title_page_top3(spark: SparkSession, d: str) -> DataFrame:
    return scoring.title_page_top3(_scored_pages(spark, d)).select("doc_id", "page_num", "rank")


def _ranked_texts(spark: SparkSession, d: str) -> DataFrame:
    pages = pagetext.page_text(_scored_pages(spark, d))
    return scoring.title_page_top3(pages, keep=["text"]).drop("prob")


def title_page_text(spark: SparkSession, d: str) -> DataFrame:
    return _ranked_texts(spark, d).select("doc_id", "page_num", "rank", "text")


def title_page_text_joined(spark: SparkSession, d: str) -> DataFrame:
    """The same when the texts come from another table than the scores."""
    top = scoring.title_page_top3(_scored_pages(spark, d)).drop("prob")
    return pagetext.title_page_text(top, fx.doc_pages(spark, d))


def overlong_pages(spark: SparkSession, d: str) -> DataFrame:
    return pagetext.overlong_pages(fx.doc_pages(spark, d))


# --- tagging ------------------------------------------------------------------------


def build_prompts(spark: SparkSession, d: str) -> DataFrame:
    prompts = tagging.build_prompts(_ranked_texts(spark, d))
    return prompts.select("doc_id", "page_num", "messages", "prompt_hash")


def echo_model() -> tagging.Complete:
    """A stand-in for the completion model: the title is a hash of the user text."""

    def complete(batch: Sequence[str]) -> list[str]:
        answers = []
        for messages in batch:
            text = json.loads(messages)[-1]["content"]
            title = hashlib.md5(text.encode()).hexdigest()
            answers.append(f'{{"title":"{title}","author":"","date":"","sector":"Other"}}')
        return answers

    return complete


def complete_prompts(spark: SparkSession, d: str) -> DataFrame:
    first = pagetext.first_page_texts(fx.doc_pages(spark, d))
    prompts = tagging.build_prompts(first.select("doc_id", "page_num", "text"))
    answered, _ = tagging.complete_prompts(prompts, echo_model())
    return answered.select("doc_id", "page_num", "completion")


def refusing_model(sign: str) -> tagging.Complete:
    """The stand-in model, which refuses every call with a text whose hash begins with a sign."""
    answer = echo_model()

    def complete(batch: Sequence[str]) -> list[str]:
        found = answer(batch)
        for completion in found:
            if completion.startswith('{"title":"' + sign):
                raise ValueError("refused")
        return found

    return complete


def complete_or_fail(spark: SparkSession, d: str) -> DataFrame:
    """Every prompt about a first page with its answer, or with what became of its calls."""
    first = pagetext.first_page_texts(fx.doc_pages(spark, d))
    prompts = tagging.build_prompts(first.select("doc_id", "page_num", "text"))
    store = tagging.AnswerStore(spark, scratch_path(spark, "answers"))
    answered, _ = tagging.complete_prompts(prompts, refusing_model("0"), store=store)
    rows = answered.join(store.failures(), "prompt_hash", "left")
    return rows.select("doc_id", "page_num", "completion", "error", "tries")


def parse_tags(spark: SparkSession, d: str) -> DataFrame:
    return tagging.parse_tags(
        fx.with_answers(fx.doc_pages(spark, d).select("doc_id", "page_num"))
    ).select("doc_id", "page_num", "tag_state", *TAG_FIELDS)


def _first_answers(spark: SparkSession, d: str) -> DataFrame:
    return fx.with_answers(pagetext.first_page_texts(fx.doc_pages(spark, d))).select(
        "doc_id", "page_num", "text", "completion"
    )


def _ranked_answers(spark: SparkSession, d: str) -> DataFrame:
    return fx.with_answers(_ranked_texts(spark, d))


def tag_first_page(spark: SparkSession, d: str) -> DataFrame:
    return tagging.tag_first_page(_first_answers(spark, d))


def tag_resolve(spark: SparkSession, d: str) -> DataFrame:
    return tagging.tag_resolve(_ranked_answers(spark, d))


def tag_in_rounds(spark: SparkSession, d: str) -> DataFrame:
    """The staged form, asking the stand-in model round by round."""
    return tagging.tag_in_rounds(_ranked_texts(spark, d), echo_model())[0]


def tag_all(spark: SparkSession, d: str) -> DataFrame:
    return tagging.tag_all(
        score_documents(spark, d), _first_answers(spark, d), _ranked_answers(spark, d)
    )


def tag_documents(spark: SparkSession, d: str) -> DataFrame:
    """From texts to tags, asking the stand-in model about what each class needs."""
    first = pagetext.first_page_texts(fx.doc_pages(spark, d)).select("doc_id", "page_num", "text")
    tagged, _ = tagging.tag_documents(
        score_documents(spark, d), first, _ranked_texts(spark, d), echo_model()
    )
    return tagged


def document_events(spark: SparkSession, d: str, stride: int = 1) -> DataFrame:
    """The event log, each event with a document out of the whole table: the place of a
    document among all ids is the event's number, times ``stride``, modulo their count."""
    events = fx.link_events(spark, d).drop("pred", "tag_json")
    ids = fx.table(spark, d, "documents").select("doc_id")
    places = running(ids, [], ["doc_id"], "document-places", counts={"nth": F.lit(True)})
    places = places.select("doc_id", (F.col("nth") - 1).alias("place"))
    numbers = ids.agg(F.count(F.lit(1)).alias("n_documents"))  # one row
    placed = events.crossJoin(F.broadcast(numbers)).withColumn(
        "place", F.expr(f"CASE WHEN n_documents > 0 THEN event_id * {stride} % n_documents END")
    )
    return key_join(placed, places, ["place"]).drop("place", "n_documents")


def _worked_events(spark: SparkSession, d: str, events: DataFrame) -> DataFrame:
    """The event log, its classes and tags worked out from the documents that it names."""
    first = pagetext.first_page_texts(fx.doc_pages(spark, d)).select("doc_id", "page_num", "text")
    worked, _ = results.with_results(
        _working(spark, d),
        events,
        score_documents(spark, d),
        first,
        _ranked_texts(spark, d),
        echo_model(),
    )
    return worked


# Events name documents in two different ways, each of which reaches the whole table.
STRIDE = 7


def document_to_state(spark: SparkSession, d: str) -> DataFrame:
    """Downloaded documents scored and tagged, and what that makes of the links."""
    worked = _worked_events(spark, d, document_events(spark, d, STRIDE))
    return state.link_state(_working(spark, d), worked).select(*STATE_COLUMNS)


def document_to_archive(spark: SparkSession, d: str) -> DataFrame:
    worked = _worked_events(spark, d, document_events(spark, d, STRIDE))
    rows = state.archive_on_download(_working(spark, d), worked)
    return rows.select("event_id", *ARCHIVED)


def all_documents_to_state(spark: SparkSession, d: str) -> DataFrame:
    worked = _worked_events(spark, d, document_events(spark, d))
    return state.link_state(_working(spark, d), worked).select(*STATE_COLUMNS)


def all_documents_to_archive(spark: SparkSession, d: str) -> DataFrame:
    worked = _worked_events(spark, d, document_events(spark, d))
    rows = state.archive_on_download(_working(spark, d), worked)
    return rows.select("event_id", *ARCHIVED)


# --- files -------------------------------------------------------------------------------

# Documents in one file, each line of which is a page; pages that one task reads at once.
DOCUMENTS_PER_FILE = 10
FILE_SPAN = 16


def line_counter() -> Callable:
    """Counts the pages of a stand-in file, which end with a line break each."""
    return lambda file: sum(1 for _ in file)


def line_reader() -> Callable:
    """Reads a run of such pages; what stands for OCR takes one letter for another."""

    def read(file, first, last):
        for number, line in enumerate(file, 1):
            if number > last:
                return
            if number >= first:
                text = line.decode("utf-8").removesuffix("\n")
                yield number, text if number % 3 else "", text.replace("e", "c")

    return read


def _mixed_files(spark: SparkSession, d: str) -> DataFrame:
    """Files of which a dataset says that they are mixed: those with a document of class 3."""
    folder, dataset = scratch_path(spark, "files"), scratch_path(spark, "dataset")
    block = F.floor(F.col("doc_id") / DOCUMENTS_PER_FILE).alias("block")
    (
        fx.table(spark, d, "documents")
        .select(block, "doc_id", "text")
        .repartition("block")
        .sortWithinPartitions("block", "doc_id")
        .select("block", "text")
        .write.partitionBy("block")
        .text(folder)
    )
    classes = score_documents(spark, d).groupBy(block).agg(F.max("pred").alias("presentation"))
    name = F.concat(F.lit("block="), F.col("block").cast("string")).alias("fname")
    csvfiles.write_csv(classes.select("presentation", name), dataset)
    wanted = labels.mixed_worklist(csvfiles.read_dataset(spark, dataset), f"{folder}/")
    folders = wanted.where(F.col("fname").rlike("^block=[0-9]+$"))
    folders = folders.select(F.col("path").alias("folder"))
    return files.list_folders(folders).select("path")


def _file_pages(spark: SparkSession, d: str) -> DataFrame:
    pages = pagetext.extract_spans(
        _mixed_files(spark, d), line_counter(), line_reader(), FILE_SPAN
    )
    block = F.regexp_extract("path", "block=([0-9]+)/", 1).cast("long")
    return pages.select(block.alias("doc_id"), "page_num", "native_text", "ocr_text")


def file_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages of mixed files, several tasks to a file."""
    return _file_pages(spark, d).withColumnRenamed("doc_id", "block")


def files_to_tags(spark: SparkSession, d: str) -> DataFrame:
    """From a dataset to files, to pages, to the likeliest title pages, to tags."""
    pages = materialize(_file_pages(spark, d), "file-pages")
    words = F.size(F.split("ocr_text", " ")).cast("int")
    features = pages.withColumns(
        {
            "word_count": words,
            "image_count": ((F.col("doc_id") * 7 + F.col("page_num")) % 5).cast("int"),
            "aspect_ratio": F.when(F.col("page_num") % 2 == 0, 0.75).otherwise(1.25),
        }
    )
    scored = scoring.page_scores(features, PAGE_WEIGHTS, PAGE_INTERCEPT)
    ranked = scoring.title_page_top3(pagetext.page_text(scored), keep=["text"]).drop("prob")
    tagged, _ = tagging.tag_in_rounds(ranked, echo_model())
    return tagged.withColumnRenamed("doc_id", "block")


# --- labels and CSV -------------------------------------------------------------------


def _label_file(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "labels")
    raw = fx.labels_raw(spark, d)
    indexed = raw.select(F.xxhash64("LINK").cast("string").alias("_index"), *raw.columns)
    csvfiles.write_csv(indexed, path)
    return csvfiles.read_labels(spark, path)


def label_ingest(spark: SparkSession, d: str) -> DataFrame:
    rows = labels.ingest(_label_file(spark, d))
    return rows.select("pdf_link", F.col("`Presentation?`").alias("raw"), "classify_op")


def label_value_counts(spark: SparkSession, d: str) -> DataFrame:
    return labels.value_counts(labels.ingest(_label_file(spark, d)), "classify_op")


def label_value_counts_raw(spark: SparkSession, d: str) -> DataFrame:
    return labels.value_counts(labels.ingest(_label_file(spark, d)), labels.RAW_LABEL)


def mixed_worklist(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "dataset")
    rows = labels.ingest(fx.labels_raw(spark, d)).select(
        F.col("classify_op").alias("presentation"),
        F.concat(F.regexp_extract("pdf_link", r"(\d+)$", 1), F.lit(".pdf")).alias("fname"),
    )
    csvfiles.write_csv(rows, path)
    return labels.mixed_worklist(csvfiles.read_dataset(spark, path), "/presentations/")


def csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """The seven exported columns, read back."""
    path = scratch_path(spark, "export")
    csvfiles.export_links(fx.links(spark, d), path)
    schema = type(LINKS)([LINKS[c] for c in EXPORT_COLUMNS])
    return csvfiles.import_snapshot(spark, path, schema)


def csv_snapshot_counts(spark: SparkSession, d: str) -> DataFrame:
    """Row counts of limited snapshots after an import."""
    counts = []
    for name, rows in (("links", fx.links(spark, d)), ("big_links", fx.big_links(spark, d))):
        path = scratch_path(spark, "snapshot")
        csvfiles.export_snapshot(rows, path, "id")
        back = csvfiles.import_snapshot(spark, path, rows.schema)
        counts.append(back.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n"))
    return counts[0].unionByName(counts[1])


def csv_snapshot_rows(spark: SparkSession, d: str) -> DataFrame:
    """The rows of a limited snapshot after an import."""
    rows, path = fx.big_links(spark, d), scratch_path(spark, "snapshot")
    csvfiles.export_snapshot(rows, path, "id")
    back = csvfiles.import_snapshot(spark, path, rows.schema)
    return back.select("id", "pdf_link", "status", "classify", "filename_location")


# --- streaming ------------------------------------------------------------------------


# Portions in which rows land, each in as many files as its size asks for.
PORTIONS = 4


def _landed(spark: SparkSession, rows: DataFrame, label: str) -> tuple[str, int]:
    """Rows written as files: a pattern that finds them, and how many are half of them. Adaptive
    execution cuts portions by their measured size, so a task's work has a bound."""
    path = scratch_path(spark, label)
    portion = F.pmod(F.xxhash64(*rows.columns), F.lit(PORTIONS))
    (
        rows.withColumn("portion", portion)
        .hint("rebalance", F.col("portion"))
        .write.partitionBy("portion")
        .parquet(path)
    )
    files = len(spark.read.schema(rows.schema).parquet(path).inputFiles())
    return f"{path}/portion=*", max(1, -(-files // 2))


def _event_stream(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.link_events(spark, d)
    path, half = _landed(spark, rows, "events")
    return arrivals.event_stream(spark, path, rows.schema, files_per_trigger=half)


def _sink(spark: SparkSession) -> tuple[str, str]:
    return scratch_path(spark, "sink"), scratch_path(spark, "stream")


def stream_link_state(spark: SparkSession, d: str) -> DataFrame:
    table = jobs.writes_table(spark, scratch_path(spark, "writes"), fx.link_events(spark, d))
    _, checkpoint = _sink(spark)
    jobs.stream_link_writes(_event_stream(spark, d), table, checkpoint).awaitTermination()
    return state.apply_writes(_working(spark, d), table.read()).select(*STATE_COLUMNS)


def stream_archive(spark: SparkSession, d: str) -> DataFrame:
    """The archive rows that the stream keeps, read back."""
    source = _event_stream(spark, d)
    root, checkpoint = _sink(spark)
    store = archives.ArchiveStore(spark, root, source.schema)
    archives.stream_archive(
        source, lambda: _working(spark, d), store, checkpoint
    ).awaitTermination()
    return store.read().select("event_id", *ARCHIVED)


def stream_retry(spark: SparkSession, d: str) -> DataFrame:
    table = jobs.retry_table(spark, scratch_path(spark, "retries"))
    _, checkpoint = _sink(spark)
    jobs.stream_retry(_event_stream(spark, d), table, checkpoint).awaitTermination()
    return table.read().select("client_id", "sweeps")


def stream_retry_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Which downloads the sweeps find, and what becomes of them, from the stream."""
    rows = fx.client_events(spark, d)
    path, half = _landed(spark, rows, "client-events")
    source = arrivals.event_stream(spark, path, rows.schema, files_per_trigger=half)
    root, checkpoint = _sink(spark)
    store = retries.RetryStore(spark, root, source.schema)
    retries.stream_retry_candidates(source, store, checkpoint).awaitTermination()
    return store.candidates(fx.links(spark, d))


def stream_completed_items(spark: SparkSession, d: str) -> DataFrame:
    """Items of finished downloads, where an item is listed up to 40 minutes before or after
    the change of its download."""
    n, minutes = F.col("event_id"), F.col("event_id") % 81 - 40
    events = fx.link_events(spark, d).withColumn("ts", F.col("ts").cast("timestamp"))
    changed = events.select(
        n.alias("download_id"),
        F.when(F.col("kind") == state.DOWNLOAD, "complete")
        .when(F.col("kind") == state.INTERRUPTED, "interrupted")
        .otherwise("in_progress")
        .alias("state"),
        F.col("ts").alias("changed_at"),
    )
    listed = events.select(
        n.alias("download_id"),
        "pdf_link",
        "filename",
        (F.col("ts") + F.make_dt_interval(mins=minutes.cast("int"))).alias("listed_at"),
    )

    def stream(rows: DataFrame, at: str, label: str) -> DataFrame:
        path = scratch_path(spark, label)
        rows.repartitionByRange(4, at).write.parquet(path)
        return arrivals.event_stream(spark, path, rows.schema)

    path, checkpoint = _sink(spark)
    items = stream(listed, "listed_at", "items")
    arriving.stream_completed_items(
        stream(changed, "changed_at", "changes"), items, path, checkpoint
    ).awaitTermination()
    found = read_parts(spark, path, listed.schema)
    return found.select("download_id", "pdf_link", "filename")


def stream_rejects(spark: SparkSession, d: str) -> DataFrame:
    path, checkpoint = _sink(spark)
    jobs.stream_rejects(
        _event_stream(spark, d), lambda: fx.links(spark, d), path, checkpoint
    ).awaitTermination()
    schema = "event_id long, pdf_link string, outcome int"
    return read_parts(spark, path, T.StructType.fromDDL(schema))


# Pages in one file.
PAGES_PER_FILE = 10


def file_arrivals(spark: SparkSession, d: str) -> DataFrame:
    """The ledger of files after the web pages were dropped, some of them to a file: what
    arrived under which name, and how long it is."""
    folder = scratch_path(spark, "drop")
    pages = fx.table(spark, d, "pages").withColumn(
        "block", F.floor(F.col("page_id") / PAGES_PER_FILE)
    )
    (
        pages.repartition("block")
        .sortWithinPartitions("block", "page_id")
        .select("block", "html")
        .write.partitionBy("block")
        .text(folder)
    )
    root, checkpoint = _sink(spark)
    ledger = arriving.ledger_table(spark, root)
    files = arrivals.file_stream(spark, f"{folder}/block=*", files_per_trigger=10_000, digest=True)
    arriving.stream_ledger(files, ledger, checkpoint).awaitTermination()
    name = F.regexp_extract("path", "block=([0-9]+)", 1)
    return ledger.read().select(name.cast("long").alias("block"), "length", "sha256")


# --- the large fixtures -----------------------------------------------------------------


def big_claim(spark: SparkSession, d: str) -> DataFrame:
    return claims.claim_batch(fx.big_links(spark, d), BIG_BATCH, SEED)


def big_worklist(spark: SparkSession, d: str) -> DataFrame:
    return batches.worklist(fx.big_links(spark, d), BIG_BATCH, SEED)


def big_link_state(spark: SparkSession, d: str) -> DataFrame:
    rows = state.link_state(
        batches.load(fx.big_links(spark, d)), fx.big_events(spark, d), order=fx.BIG_ORDER
    )
    return rows.select(*STATE_COLUMNS)


def big_event_outcomes(spark: SparkSession, d: str) -> DataFrame:
    rows = state.event_outcomes(
        batches.load(fx.big_links(spark, d)), fx.big_events(spark, d), order=fx.BIG_ORDER
    )
    return rows.groupBy("kind", "outcome").agg(F.count(F.lit(1)).alias("n"))


def big_reconcile(spark: SparkSession, d: str) -> DataFrame:
    rows = reconcile.reconcile_downloads(
        fx.big_events(spark, d), fx.big_links(spark, d)
    )
    return rows.select("pdf_link", "l_linenumber", "l_partkey", "filename", "id", "status")


CLIENT_ORDER = ("ts", "pdf_link", "l_linenumber", "l_partkey", "l_extendedprice")


def big_retry_sweeps(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.retry_sweeps(fx.big_events(spark, d), CLIENT_ORDER).select(
        "client_id", "sweep_no", "pdf_link", "l_linenumber", "l_partkey"
    )


def big_retry_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Clients with many links, of which every fourth is unknown to the table."""
    events = fx.retry_events(spark, d)
    return reconcile.retry_candidates(events, fx.big_links(spark, d), CLIENT_ORDER)


def big_stream_retry_candidates(spark: SparkSession, d: str) -> DataFrame:
    """The stream of retry candidates for clients with many links, some of them unknown."""
    rows = fx.retry_events(spark, d)
    path, half = _landed(spark, rows, "retry-events")
    source = arrivals.event_stream(spark, path, rows.schema, files_per_trigger=half)
    root, checkpoint = _sink(spark)
    store = retries.RetryStore(spark, root, source.schema, CLIENT_ORDER)
    retries.stream_retry_candidates(source, store, checkpoint).awaitTermination()
    return store.candidates(fx.big_links(spark, d))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        claim_batch,
        claim_html,
        claim_noext,
        claim_for_tagging,
        claim_apply,
        batch_worklist,
        merge_patch,
        patch_columns,
        merge_count,
        sparse_patch,
        sparse_patch_applied,
        release_links,
        reset_null_tags,
        link_lookup,
        link_state,
        event_outcomes,
        is_processed,
        needs_tagging,
        partition_by_status,
        prune_batch,
        bulk_transition,
        status_counts,
        batch_append,
        batch_close,
        intake_cycle,
        intake_cycle_archive,
        intake_cycle_batches,
        empty_batch,
        environment_links,
        archive_append,
        archive_on_download,
        archive_truncate,
        reconcile_downloads,
        reconcile_rejects,
        download_decision,
        retry_sweeps,
        retry_candidates,
        completed_items,
        url_route,
        tab_filter,
        main_frames,
        score_documents,
        score_documents_python,
        score_documents_artifact,
        score_documents_saved_model,
        page_scores,
        title_page_top3,
        title_page_text,
        title_page_text_joined,
        overlong_pages,
        build_prompts,
        complete_prompts,
        complete_or_fail,
        parse_tags,
        tag_first_page,
        tag_resolve,
        tag_in_rounds,
        tag_all,
        tag_documents,
        document_to_state,
        document_to_archive,
        all_documents_to_state,
        all_documents_to_archive,
        file_pages,
        files_to_tags,
        label_ingest,
        label_value_counts,
        label_value_counts_raw,
        mixed_worklist,
        csv_roundtrip,
        csv_snapshot_counts,
        csv_snapshot_rows,
        archive_one,
        stream_link_state,
        stream_archive,
        stream_retry,
        stream_retry_candidates,
        stream_completed_items,
        stream_rejects,
        file_arrivals,
        big_claim,
        big_worklist,
        big_link_state,
        big_event_outcomes,
        big_reconcile,
        big_retry_sweeps,
        big_retry_candidates,
        big_stream_retry_candidates,
    )
}
