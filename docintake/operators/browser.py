"""Routing of links and filtering of browser events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docintake.functions import urls
from docintake.functions.truth import non_empty


def url_route(links: DataFrame) -> DataFrame:
    url = F.col("pdf_link")
    return links.withColumns(
        {
            "extension": urls.extension(url),
            "route": urls.route(url),
            "page_type": urls.page_type(url),
            "is_html": urls.is_html_link(url),
            "no_extension": urls.has_no_known_extension(url),
            "is_pdf_file": urls.is_pdf_file(url),
        }
    )


def tab_filter(tabs: DataFrame, own_prefixes: Sequence[str]) -> DataFrame:
    """Finished page loads that are worth reporting: a URL that is not our own."""
    return tabs.where(
        (F.col("load_state") == "complete")
        & non_empty(F.col("url"))
        & ~urls.is_own_url(F.col("url"), own_prefixes)
    )


def main_frames(navigations: DataFrame) -> DataFrame:
    return navigations.where(F.col("frame_id") == 0)


def download_states(items: DataFrame, state: str) -> DataFrame:
    """Download items in one state, such as ``complete`` or ``interrupted``."""
    return items.where(F.col("state") == state)


def completed_items(changes: DataFrame, items: DataFrame) -> DataFrame:
    """The full items of downloads that have completed. Download ids are unique."""
    done = download_states(changes, "complete").select("download_id")
    return items.join(done, "download_id", "left_semi")
