"""URL tests and routing as plain column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def extension(url: Column) -> Column:
    """Text after the last dot, lower-cased; the whole URL when it has no dot."""
    return F.lower(F.substring_index(url, ".", -1))


def route(url: Column) -> Column:
    """What opening a link starts."""
    ext = extension(url)
    return (
        F.when(ext == "pdf", "download")
        .when(ext.isin("html", "htm"), "html_seen")
        .otherwise("maybe_pdf")
    )


def is_html_link(url: Column) -> Column:
    return url.ilike("%.htm") | url.ilike("%.html")


def is_pdf_link(url: Column) -> Column:
    return url.ilike("%.pdf")


def has_no_known_extension(url: Column) -> Column:
    return ~is_html_link(url) & ~is_pdf_link(url)


def page_type(url: Column) -> Column:
    web = url.startswith("http://") | url.startswith("https://")
    return F.when(web, "processHTML").otherwise("ignore")


def is_pdf_file(filename: Column) -> Column:
    """Case-sensitive, unlike the link tests."""
    return filename.endswith(".pdf")


def is_own_url(url: Column, own_prefixes: Sequence[str]) -> Column:
    own = F.lit(False)
    for prefix in own_prefixes:
        own = own | url.startswith(prefix)
    return own


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def link_or_hash(url: Column) -> Column:
    return F.coalesce(F.nullif(url, F.lit("")), F.lit("#"))
