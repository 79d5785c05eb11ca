"""Reading a tagger's JSON answer.

``from_json`` turns malformed text into a struct of NULLs, so validity and key
presence are taken from a variant instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docintake.functions.truth import is_empty, non_blank
from docintake.schemas import TAG_FIELDS


# JSON values that count as "no answer": empty containers and text, null, false, zero.
NO_ANSWER = (
    r"^[ \t\n\r]*(\{[ \t\n\r]*\}|\[[ \t\n\r]*\]|\"\"|null|false|-?0(\.0*)?([eE][-+]?[0-9]+)?)[ \t\n\r]*$"
)


def _field(name: str, as_type: str) -> Column:
    return F.try_variant_get(F.col("_answer"), f"$.{name}", as_type)


def _opens_with(sign: str) -> Column:
    """The first sign of valid JSON tells its type."""
    return F.ltrim(F.col("_text"), F.lit(" \t\n\r")).startswith(sign)


def parse(df: DataFrame, answer: Column) -> DataFrame:
    """Add ``_text`` and ``_answer``, which the functions below use.

    The parsed answer is a column of its own so that it is parsed once, however
    often it is looked at.
    """
    return df.withColumn("_text", answer).withColumn("_answer", F.try_parse_json("_text"))


def state() -> Column:
    """What writing the answer to a row does.

    ``none``: nothing to write (NULL, malformed, or an empty value);
    ``complete``: an object with all four keys; ``broken``: anything else, which
    makes the write fail.
    """
    has_all = _opens_with("{")
    for f in TAG_FIELDS:
        has_all = has_all & _field(f, "variant").isNotNull()
    return (
        F.when(F.col("_answer").isNull(), "none")
        .when(has_all, "complete")
        .when(F.col("_text").rlike(NO_ANSWER), "none")
        .otherwise("broken")
    )


def tags() -> Column:
    """The four tags as strings; NULL fields where a key is missing."""
    return F.struct(*[_field(f, "string").alias(f) for f in TAG_FIELDS])


def closes_guard(title: Column, date: Column) -> Column:
    """Writing these tags ends the wish for tags."""
    return ~is_empty(title) | (title.isNotNull() & date.isNotNull())


def verdict(asked: Column) -> Column:
    """How one page's answer counts when several pages are tried in turn.

    ``skip``: the page was not asked about, as it has no text; ``abort``: malformed, or a title
    that is not a string, which ends the document without tags; ``titled``: wins;
    ``blank``: a blank title; ``untitled``: no title key.
    """
    whole = F.col("_answer")
    title_type = F.schema_of_variant(_field("title", "variant"))
    in_list = F.array_contains(F.try_variant_get(whole, "$", "array<string>"), "title")
    in_text = F.try_variant_get(whole, "$", "string").contains("title")
    of_object = (
        F.when(title_type.isNull(), "untitled")
        .when(title_type != "STRING", "abort")
        .when(non_blank(_field("title", "string")), "titled")
        .otherwise("blank")
    )
    return (
        F.when(~asked, "skip")
        .when(whole.isNull(), "abort")
        .when(_opens_with("{"), of_object)
        .when(_opens_with("["), F.when(in_list, "abort").otherwise("untitled"))
        .when(_opens_with('"'), F.when(in_text, "abort").otherwise("untitled"))
        .otherwise("abort")
    )
