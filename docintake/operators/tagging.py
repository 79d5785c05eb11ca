"""Tags (title, author, date, sector) from a completion model."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docintake.functions import tagjson
from docintake.functions.truth import non_empty
from docintake.operators.scoring import TOP_PAGES
from docintake.operators.skew import key_join
from docintake.schemas import TAG_FIELDS
from docintake.session import materialize, scratch_path
from docintake.sources.tables import read_parts

# The sectors a tagger may choose from, in order.
SECTORS = (
    "Environmental",
    "Technology",
    "Industrials",
    "Basic Materials",
    "Financial Services",
    "Consumer Cyclical",
    "Healthcare",
    "Real Estate",
    "Communication Services",
    "Utilities",
    "Energy",
    "Consumer Defensive",
    "Industrial",
    "Other",
)

Complete = Callable[[Sequence[str]], Sequence[str]]


def instruction(sectors: Sequence[str] = SECTORS) -> str:
    return (
        "Below is the text of one page of a company document. Reply with one JSON "
        "object and nothing else. Its keys are title, author, date and sector, and "
        "all values are strings; use an empty string for anything the page does not "
        "say. Pick the sector from: " + ", ".join(sectors) + "."
    )


def chat_messages(text: Column, system: str) -> Column:
    message = lambda role, content: F.struct(
        F.lit(role).alias("role"), content.alias("content")
    )
    return F.to_json(F.array(message("system", F.lit(system)), message("user", text)))


def build_prompts(texts: DataFrame, system: str | None = None) -> DataFrame:
    """Chat messages per page. Pages without text are not asked about."""
    return (
        texts.where(non_empty(F.col("text")))
        .withColumn("messages", chat_messages(F.col("text"), system or instruction()))
        .withColumn("prompt_hash", F.md5("messages"))
    )


def distinct_prompts(prompts: DataFrame) -> DataFrame:
    """One row per prompt; copies collapse before the shuffle."""
    return prompts.groupBy("prompt_hash").agg(F.min("messages").alias("messages"))


# Buckets of prompts, by hash; tries for a prompt whose call fails.
BUCKETS = 64
TRIES = 3

ANSWERS = "prompt_hash string, completion string, error string, tries int"


def ask(
    distinct: DataFrame, complete: Complete, tasks: int | None = None, tries: int = TRIES
) -> DataFrame:
    """Answers of distinct prompts: ``prompt_hash, completion, error, tries``.

    ``complete`` gets a batch of message texts and returns as many answers. If the call
    fails, each prompt is asked by itself, and after ``tries`` failures has the error
    instead of an answer. ``tasks`` sets into how many tasks the calls are split, where a
    model service asks for that.
    """

    def alone(message: str) -> tuple[str | None, str | None, int]:
        error = None
        for n in range(1, tries + 1):
            try:
                (answer,) = complete([message])
                return answer, None, n
            except Exception as failed:  # whatever a model service may raise
                error = f"{type(failed).__name__}: {failed}"
        return None, error, tries

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            messages = batch["messages"].tolist()
            try:
                answers = [(answer, None, 1) for answer in complete(messages)]
            except Exception:
                answers = []
            if len(answers) != len(messages):
                answers = [alone(message) for message in messages]
            found = pd.DataFrame(answers, columns=["completion", "error", "tries"], dtype=object)
            yield found.assign(prompt_hash=batch["prompt_hash"].values)[
                ["prompt_hash", "completion", "error", "tries"]
            ]

    if tasks:
        distinct = distinct.repartition(tasks, "prompt_hash")
    return distinct.mapInPandas(run, ANSWERS)


class AnswerStore:
    """Answers as they come, below ``root``, in buckets by the hash of their prompt.

    Buckets are asked about in waves, each a job that adds its answers when it is done. A task
    that is lost asks about its own bucket again; a run that dies asks again about the buckets
    of its last wave, and the next run with the same store about what has no answer yet.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self._spark, self._root, self.buckets = spark, root, buckets

    def _rows(self) -> DataFrame:
        schema = T.StructType.fromDDL(f"{ANSWERS}, bucket int")
        return read_parts(self._spark, self._root, schema).drop("bucket")

    def answers(self) -> DataFrame:
        """``prompt_hash, completion`` of what was answered."""
        answered = self._rows().where("completion IS NOT NULL")
        return answered.groupBy("prompt_hash").agg(F.min("completion").alias("completion"))

    def failures(self) -> DataFrame:
        """``prompt_hash, error, tries`` of what was asked and never answered."""
        failed = self._rows().where("completion IS NULL")
        tried = failed.groupBy("prompt_hash").agg(
            F.max("error").alias("error"), F.sum("tries").alias("tries")
        )
        return tried.join(self.answers(), "prompt_hash", "left_anti")

    def ask(
        self,
        distinct: DataFrame,
        complete: Complete,
        tries: int = TRIES,
        at_once: int | None = None,
        again: bool = False,
    ) -> None:
        """Ask what the store has no answer for, ``at_once`` buckets to a wave (by default as many
        as there are cores). What failed before is asked again only if that is wanted."""
        known = self.answers().select("prompt_hash")
        if not again:
            known = known.union(self.failures().select("prompt_hash"))
        number = F.conv(F.substring("prompt_hash", 1, 8), 16, 10).cast("long")
        open_ = distinct.join(known, "prompt_hash", "left_anti").withColumn(
            "bucket", (number % self.buckets).cast("int")
        )
        open_ = materialize(open_, "open-prompts")
        waiting = sorted(r["bucket"] for r in open_.select("bucket").distinct().collect())
        at_once = at_once or max(1, self._spark.sparkContext.defaultParallelism)
        for first in range(0, len(waiting), at_once):
            wave = waiting[first : first + at_once]
            rows = open_.where(F.col("bucket").isin(wave)).repartition(len(wave), "bucket")
            number = F.conv(F.substring("prompt_hash", 1, 8), 16, 10).cast("long")
            answered = ask(rows.drop("bucket"), complete, tries=tries)
            answered.withColumn("bucket", (number % self.buckets).cast("int")).write.mode(
                "append"
            ).partitionBy("bucket").parquet(self._root)


def complete_prompts(
    prompts: DataFrame,
    complete: Complete,
    known: DataFrame | None = None,
    store: AnswerStore | None = None,
    tries: int = TRIES,
) -> tuple[DataFrame, DataFrame]:
    """Prompts with answers, and all answers by prompt hash.

    A prompt is asked once however many pages share it, and not at all when
    ``known`` or the ``store`` already holds its answer. New answers are written before
    they are used, so later steps never call the model again. A prompt whose calls all
    failed has no answer; the store's ``failures`` say why.
    """
    spark = prompts.sparkSession
    store = store or AnswerStore(spark, scratch_path(spark, "answers"))
    prompts = materialize(prompts, "prompts")
    new = distinct_prompts(prompts)
    if known is not None:
        new = new.join(known.select("prompt_hash"), "prompt_hash", "left_anti")
    store.ask(new, complete, tries)
    answers = store.answers()
    if known is not None:
        stored = answers.join(known.select("prompt_hash"), "prompt_hash", "left_anti")
        answers = known.select("prompt_hash", "completion").unionByName(stored)
    return key_join(prompts, answers, ["prompt_hash"]), answers


def parse_tags(answers: DataFrame) -> DataFrame:
    """Per answer, whether it can be written as tags, and the tags."""
    return (
        tagjson.parse(answers, F.col("completion"))
        .withColumn("tag_state", tagjson.state())
        .withColumn("_tags", tagjson.tags())
        .select("*", *[F.col(f"_tags.{f}").alias(f) for f in TAG_FIELDS])
        .drop("_tags", "_answer", "_text")
    )


def _as_result(doc: DataFrame, winner: Column, failed: Column) -> DataFrame:
    tagged = winner.isNotNull() & ~failed
    return doc.select(
        "doc_id",
        F.when(failed, "failed").when(tagged, "tagged").otherwise("none").alias("result"),
        *[F.when(tagged, winner[f]).alias(f) for f in TAG_FIELDS],
    )


def _has_text() -> Column:
    return non_empty(F.col("text"))


def tag_first_page(answered: DataFrame, asked: Column | None = None) -> DataFrame:
    """Tags of presentations: page 1 only, whatever its title.

    ``answered`` holds ``doc_id, page_num, completion``, and ``text`` unless
    ``asked`` says otherwise which pages were asked about.
    """
    first = answered.where(F.col("page_num") == 1)
    if asked is None:
        asked = _has_text()
    rows = (
        tagjson.parse(first, F.when(asked, F.col("completion")))
        .withColumn("_state", tagjson.state())
        .withColumn("_tags", F.when(F.col("_state") == "complete", tagjson.tags()))
    )
    return _as_result(rows, F.col("_tags"), F.col("_state") == "broken")


def judge_pages(answered: DataFrame, asked: Column | None = None) -> DataFrame:
    """``doc_id, rank, verdict, state, tags`` of ranked pages with their answers."""
    if asked is None:
        asked = _has_text()
    return tagjson.parse(answered, F.col("completion")).select(
        "doc_id",
        "rank",
        tagjson.verdict(asked).alias("verdict"),
        tagjson.state().alias("state"),
        tagjson.tags().alias("tags"),
    )


def resolve_verdicts(judged: DataFrame) -> DataFrame:
    """Tags of mixed documents from the judged pages in rank order.

    The first titled page wins and the first aborting page ends the document. With
    neither, the last page with an answer counts, and fails if it has no title key.
    """
    page = F.struct("rank", "verdict", "state", "tags")
    decisive = F.col("verdict").isin("titled", "abort")
    docs = judged.groupBy("doc_id").agg(
        F.min(F.when(decisive, page)).alias("first"),
        F.max(F.when(F.col("verdict") != "skip", page)).alias("last"),
    )
    won = F.coalesce(F.col("first.verdict") == "titled", F.lit(False))
    winner = F.when(won & (F.col("first.state") == "complete"), F.col("first.tags"))
    leftover = F.col("first").isNull() & F.coalesce(
        (F.col("last.verdict") == "untitled") & (F.col("last.state") != "none"), F.lit(False)
    )
    failed = (won & (F.col("first.state") != "complete")) | leftover
    return _as_result(docs, winner, failed)


def tag_resolve(answered: DataFrame) -> DataFrame:
    return resolve_verdicts(judge_pages(answered))


def tag_in_rounds(
    ranked_texts: DataFrame,
    complete: Complete,
    rounds: int = TOP_PAGES,
    known: DataFrame | None = None,
    store: AnswerStore | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The same result, asking about a page only if the pages before it left the
    document open. ``ranked_texts`` holds ``doc_id, rank, page_num, text``.

    Answers in ``known`` are not asked for again; all answers come back as well.
    There are as many jobs as rounds, not as many as documents, and each round's
    judged pages are written before the next one starts.
    """
    open_pages, judged = materialize(ranked_texts, "ranked"), None
    for rank in range(1, rounds + 1):
        here = open_pages.where(F.col("rank") == rank)
        answered, known = complete_prompts(build_prompts(here), complete, known, store)
        # Texts are not looked at any more, so they stay out of the join with answers.
        asked = judge_pages(answered, F.lit(True))
        empty = here.where(~_has_text()).withColumn("completion", F.lit(None).cast("string"))
        skipped = judge_pages(empty, F.lit(False))
        done = materialize(asked.unionByName(skipped), f"round-{rank}")
        judged = done if judged is None else judged.unionByName(done)
        closed = done.where(F.col("verdict").isin("titled", "abort")).select("doc_id")
        open_pages = open_pages.where(F.col("rank") > rank).join(closed, "doc_id", "left_anti")
    return resolve_verdicts(judged), known


def _of_class(rows: DataFrame, docs: DataFrame, pred: int) -> DataFrame:
    wanted = docs.where(F.col("pred") == pred).select("doc_id")
    return rows.join(wanted, "doc_id", "left_semi")


def _routed(docs: DataFrame, one: DataFrame, three: DataFrame) -> DataFrame:
    results = one.unionByName(three)
    return (
        docs.select("doc_id", "pred")
        .join(results, "doc_id", "left")
        .withColumn("result", F.coalesce("result", F.lit("none")))
    )


def tag_all(docs: DataFrame, first_page: DataFrame, ranked: DataFrame) -> DataFrame:
    """Route by class: 1 to the first-page tagger, 3 to the staged one, others get
    no tags. ``docs`` holds ``doc_id, pred``; the pages already have answers."""
    one = tag_first_page(_of_class(first_page, docs, 1))
    three = tag_resolve(_of_class(ranked, docs, 3))
    return _routed(docs, one, three)


def tag_documents(
    docs: DataFrame,
    first_page: DataFrame,
    ranked: DataFrame,
    complete: Complete,
    known: DataFrame | None = None,
    store: AnswerStore | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The same from page texts, asking the model only what each class needs, and all
    answers by prompt hash.

    A prompt is asked once, whichever classes share it; hand the answers in as ``known``
    and another run does not ask again. Leave documents that already have tags out of
    ``docs``.
    """
    prompts = build_prompts(_of_class(first_page, docs, 1))
    answered, known = complete_prompts(prompts, complete, known, store)
    three, known = tag_in_rounds(
        _of_class(ranked, docs, 3), complete, known=known, store=store
    )
    return _routed(docs, tag_first_page(answered, F.lit(True)), three), known
