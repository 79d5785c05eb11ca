"""From the documents that downloads brought to events that carry their class and tags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docintake.operators.skew import key_join
from docintake.operators.state import DOWNLOAD, KEY, first_of_batch
from docintake.operators.tagging import Complete, tag_documents
from docintake.schemas import TAG_FIELDS
from docintake.session import materialize

# What a download carries whose document could not be tagged: an answer without its keys.
FAILED = '{"failed":true}'


def with_class(events: DataFrame, scored: DataFrame) -> DataFrame:
    """Events with the class ``pred`` of the document that a download brought."""
    classes = scored.select("doc_id", F.col("pred").cast("int").alias("pred"))
    joined = key_join(events.drop("pred"), classes, ["doc_id"])
    return joined.withColumn("pred", F.when(F.col("kind") == DOWNLOAD, F.col("pred")))


def to_tag(batch: DataFrame, classed: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """``doc_id, pred`` of documents that want tags: downloads of class 1 or 3 whose link
    is in the batch and had none when it was loaded."""
    wanted = classed.where(F.col("pred").isin(1, 3))
    open_links = first_of_batch(batch, key).where("starts_open").select(*key)
    return key_join(wanted, open_links, key, "left_semi").select("doc_id", "pred").distinct()


def with_tags(classed: DataFrame, tagged: DataFrame) -> DataFrame:
    """Events with ``tag_json``: the tags of their document as the model would give them,
    null where there are none."""
    tags = F.to_json(F.struct(*TAG_FIELDS), {"ignoreNullFields": "false"})
    answer = F.when(F.col("result") == "tagged", tags).when(F.col("result") == "failed", FAILED)
    answers = tagged.select("doc_id", answer.alias("tag_json"))
    joined = key_join(classed.drop("tag_json"), answers, ["doc_id"])
    return joined.withColumn("tag_json", F.when(F.col("kind") == DOWNLOAD, F.col("tag_json")))


def with_results(
    batch: DataFrame,
    events: DataFrame,
    scored: DataFrame,
    first_page: DataFrame,
    ranked: DataFrame,
    complete: Complete,
    known: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Events as ``link_state`` and ``archive_on_download`` read them, and all answers.

    ``events`` name the document of a download in ``doc_id``; ``scored`` has the class of
    each document, and the page texts are those of ``tag_documents``. The model is asked
    only about documents whose link still wants tags.
    """
    classed = materialize(with_class(events, scored), "classed")
    wanted = materialize(to_tag(batch, classed), "to-tag")
    tagged, answers = tag_documents(wanted, first_page, ranked, complete, known)
    return with_tags(classed, materialize(tagged, "tagged")), answers
