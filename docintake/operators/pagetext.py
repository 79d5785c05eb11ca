"""Text of single pages, ready for a tagger."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docintake.functions.urls import base_name
from docintake.session import materialize
from docintake.sources.files import opener

# Fixed value: characters taken from each of the two texts of a page.
MAX_CHARS = 2000

# Pages of a file that one task reads at once.
SPAN = 64

# Rows and characters of pages that go from a reader to Spark at once, about. A batch of each
# file's or run's own costs more than reading it where files are small.
BATCH_PAGES = 2000
BATCH_CHARS = 1 << 20


def page_batches() -> Callable[[Iterator[list[tuple]]], Iterator[pd.DataFrame]]:
    """A function that gathers lists of pages into frames. It needs no installed module of this
    package on the executors."""
    columns = ["path", "page_num", "native_text", "ocr_text"]
    most_pages, most_chars = BATCH_PAGES, BATCH_CHARS

    def gather(lists: Iterator[list[tuple]]) -> Iterator[pd.DataFrame]:
        held, chars = [], 0
        for pages in lists:
            held += pages
            chars += sum(len(text) for page in pages for text in page[2:] if text)
            if len(held) >= most_pages or chars >= most_chars:
                yield pd.DataFrame(held, columns=columns)
                held, chars = [], 0
        if held:
            yield pd.DataFrame(held, columns=columns)

    return gather


def extract_pages(
    files: DataFrame, extract: Callable[[str, bytes], Iterator[tuple[int, str, str]]]
) -> DataFrame:
    """Pages of binary files through a pluggable extractor.

    ``extract(path, content)`` yields ``(page_num, native_text, ocr_text)``. A file
    that cannot be read yields no page, which later reads as empty text.
    """

    gather = page_batches()

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[list[tuple]]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                try:
                    pages = [(path, *page) for page in extract(path, content)]
                except Exception:  # a bad file must not end the job
                    continue
                yield pages

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return gather(each(batches))

    pages = files.select("path", "content").mapInPandas(
        run, "path string, page_num int, native_text string, ocr_text string"
    )
    return pages.withColumn("doc_id", base_name(F.col("path"))).drop("path")


def page_spans(
    files: DataFrame, count: Callable[[BinaryIO], int], span: int = SPAN
) -> DataFrame:
    """Runs of at most ``span`` pages of each file: ``path, first_page, last_page``. ``count``
    gives the number of pages of an open file. A file that cannot be read has none."""
    open_file = opener()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pages = []
            for path in batch["path"]:
                try:
                    with open_file(path) as file:
                        pages.append(count(file))
                except Exception:  # a bad file must not end the job
                    pages.append(0)
            yield pd.DataFrame({"path": batch["path"].values, "pages": pages})

    counted = files.select("path").mapInPandas(run, "path string, pages long")
    starts = F.sequence(F.lit(1).cast("long"), F.col("pages"), F.lit(span).cast("long"))
    spans = counted.where("pages > 0").select(
        "path", "pages", F.explode(starts).alias("first_page")
    )
    last = F.least(F.col("first_page") + (span - 1), "pages")
    return spans.select("path", "first_page", last.alias("last_page"))


def extract_spans(
    files: DataFrame,
    count: Callable[[BinaryIO], int],
    read: Callable[[BinaryIO, int, int], Iterator[tuple[int, str, str]]],
    span: int = SPAN,
) -> DataFrame:
    """Pages of files that are opened where they lie: ``path, page_num, native_text, ocr_text``.

    ``files`` have a ``path``, and no content travels. ``read(file, first, last)`` yields
    ``(page_num, native_text, ocr_text)`` of a run of pages from an open file, which can be
    sought; so a file of any size is many tasks' work, each of which holds a run of its pages.
    A run that cannot be read yields no page, which later reads as empty text.
    """
    open_file, gather = opener(), page_batches()

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[list[tuple]]:
        for batch in batches:
            for path, first, last in zip(batch["path"], batch["first_page"], batch["last_page"]):
                try:
                    with open_file(path) as file:
                        pages = [(path, *page) for page in read(file, int(first), int(last))]
                except Exception:  # a bad file must not end the job
                    continue
                yield pages

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return gather(each(batches))

    spans = materialize(page_spans(files, count, span), "page-spans")
    dealt = spans.repartition("path", "first_page")
    return dealt.mapInPandas(
        run, "path string, page_num int, native_text string, ocr_text string"
    )


def read_target_pages(
    wanted: DataFrame,
    read_native: Callable[[str, int], str],
    read_ocr: Callable[[str, int], str],
) -> DataFrame:
    """Both texts of single pages, for readers that open a file themselves.

    Only the wanted pages (``path, page_num``) are rendered and no file content is
    shuffled. A page that a reader cannot read has an empty text there.
    """

    def text(read: Callable[[str, int], str], path: str, page: int) -> str:
        try:
            return read(path, page) or ""
        except Exception:  # a bad file must not end the job
            return ""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            places = list(zip(batch["path"], batch["page_num"]))
            yield batch.assign(
                native_text=[text(read_native, p, int(n)) for p, n in places],
                ocr_text=[text(read_ocr, p, int(n)) for p, n in places],
            )

    return wanted.select("path", F.col("page_num").cast("int")).mapInPandas(
        run, "path string, page_num int, native_text string, ocr_text string"
    )


def tagger_text(native: Column, ocr: Column) -> Column:
    """Both texts of a page, each shortened, joined without a separator."""
    empty = F.lit("")
    return F.concat(
        F.substring(F.coalesce(native, empty), 1, MAX_CHARS),
        F.substring(F.coalesce(ocr, empty), 1, MAX_CHARS),
    )


def page_text(pages: DataFrame) -> DataFrame:
    return pages.withColumn("text", tagger_text(F.col("native_text"), F.col("ocr_text")))


def first_page_texts(pages: DataFrame) -> DataFrame:
    return page_text(pages.where(F.col("page_num") == 1))


def title_page_text(ranked: DataFrame, pages: DataFrame) -> DataFrame:
    """Text of ranked pages when texts are a table of their own, such as the output
    of an extractor. A ranked page without a text row reads as empty."""
    texts = pages.select("doc_id", "page_num", "native_text", "ocr_text")
    return page_text(ranked.join(texts, ["doc_id", "page_num"], "left")).drop(
        "native_text", "ocr_text"
    )


def overlong_pages(pages: DataFrame) -> DataFrame:
    """Pages with more text than the tagger is given."""
    native_chars = F.coalesce(F.length("native_text"), F.lit(0))
    ocr_chars = F.coalesce(F.length("ocr_text"), F.lit(0))
    return pages.select(
        "doc_id",
        "page_num",
        (native_chars > MAX_CHARS).alias("native_overlong"),
        (ocr_chars > MAX_CHARS).alias("ocr_overlong"),
    ).where("native_overlong or ocr_overlong")
