"""Keyed updates of the link table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docintake.functions.truth import non_empty
from docintake.operators.claims import READY, is_stuck, set_status_by_id
from docintake.operators.skew import key_join
from docintake.operators.state import is_processed, is_tagged
from docintake.schemas import PATCH_COLUMNS

# The fields that a sparse patch may carry.
SPARSE_COLUMNS = ("title", "author", "sector", "date", "status")


# What a batch patch must name besides the values it writes.
PATCH_NEEDS = (*PATCH_COLUMNS, "pdf_link")


def missing_columns(df: DataFrame, names: Sequence[str]) -> list[str]:
    return sorted(set(names) - set(df.columns))


def require_columns(df: DataFrame, names: Sequence[str]) -> None:
    missing = missing_columns(df, names)
    if missing:
        raise ValueError(f"columns not found: {missing}")


def last_patch(patch: DataFrame, ordinal: str) -> DataFrame:
    """One row per link: the patch with the highest ordinal. Combines before the shuffle."""
    picked = F.struct(F.col(ordinal), *PATCH_COLUMNS)
    return (
        patch.groupBy("pdf_link")
        .agg(F.max(picked).alias("_p"), F.count(F.lit(1)).alias("_patches"))
        .select("pdf_link", "_patches", F.col("_p").alias("_patch"))
    )


def merge_patch(
    links: DataFrame, patch: DataFrame, ordinal: str = "ordinal", changed_only: bool = False
) -> DataFrame:
    """Overwrite six columns, also with NULL, and set the status to ready.

    Every row with a patched link is written; where several patches name the same
    link, the last one stands. ``changed_only`` leaves out the rows without a patch.
    """
    require_columns(patch, [*PATCH_NEEDS, ordinal])
    how = "inner" if changed_only else "left"
    last = last_patch(patch, ordinal)
    joined = key_join(links, last, ["pdf_link"], how)
    hit = F.col("_patch").isNotNull()
    written = {c: F.when(hit, F.col(f"_patch.{c}")).otherwise(F.col(c)) for c in PATCH_COLUMNS}
    written["status"] = F.when(hit, READY).otherwise(F.col("status"))
    return joined.withColumns(written).select(*links.columns)


def merge_count(links: DataFrame, patch: DataFrame) -> DataFrame:
    """How many link rows a batch patch changes, and how many row writes that takes
    when the patches are applied one after the other."""
    per_link = links.groupBy("pdf_link").agg(F.count(F.lit(1)).alias("_rows"))
    per_patch = patch.groupBy("pdf_link").agg(F.count(F.lit(1)).alias("_patches"))
    return per_link.join(per_patch, "pdf_link").agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows_updated"),
        F.coalesce(F.sum(F.col("_rows") * F.col("_patches")), F.lit(0)).alias("row_writes"),
    )


def sparse_patch(
    links: DataFrame, patch: DataFrame, ordinal: str = "ordinal", changed_only: bool = False
) -> DataFrame:
    """Write only the non-empty fields of each patch; later patches win per field."""
    latest = [
        F.max(F.when(non_empty(F.col(c)), F.struct(F.col(ordinal), F.col(c)))).alias(f"_p_{c}")
        for c in SPARSE_COLUMNS
    ]
    fields = patch.groupBy("pdf_link").agg(*latest)
    how = "inner" if changed_only else "left"
    joined = key_join(links, fields, ["pdf_link"], how)
    written = {c: F.coalesce(F.col(f"_p_{c}.{c}"), F.col(c)) for c in SPARSE_COLUMNS}
    return joined.withColumns(written).select(*links.columns)


def patch_has_data(patch: DataFrame) -> DataFrame:
    """Per patch row, whether it carries anything to write."""
    any_field = F.lit(False)
    for c in SPARSE_COLUMNS:
        any_field = any_field | non_empty(F.col(c))
    return patch.withColumn("applied", any_field)


def release_links(links: DataFrame, ids: DataFrame) -> DataFrame:
    return set_status_by_id(links, ids, READY)


def released(links: DataFrame, ids: DataFrame) -> DataFrame:
    """Only the rows with a listed id, as ready."""
    return links.join(ids.select("id").distinct(), "id", "left_semi").withColumn(
        "status", F.lit(READY)
    )


def reset_null_tags(links: DataFrame) -> DataFrame:
    """Free class-1 rows that got stuck in process without a title. No shuffle."""
    return links.withColumn("status", F.when(is_stuck(), READY).otherwise(F.col("status")))


def first_rows(
    rows: DataFrame, key: Sequence[str], position: str, columns: Sequence[str]
) -> DataFrame:
    """The first row per key by position, as an aggregate that combines before the shuffle."""
    picked = F.min(F.struct(F.col(position), *[c for c in columns if c != position]))
    return (
        rows.groupBy(*key)
        .agg(picked.alias("_first"))
        .select(*key, *[F.col(f"_first.{c}").alias(c) for c in columns])
    )


def look_up(links: DataFrame, urls: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The asked links, each once, with the first row of those that are known."""
    asked = urls.select("pdf_link").distinct()
    # Rows of other links go before anything is aggregated.
    known = links.join(asked, "pdf_link", "left_semi")
    return asked.join(first_rows(known, ["pdf_link"], "id", ["id", *columns]), "pdf_link", "left")


def link_lookup(links: DataFrame, urls: DataFrame) -> DataFrame:
    """``classify`` and ``title`` of asked links, and whether they are known at all."""
    return look_up(links, urls, ["classify", "title"]).select(
        "pdf_link", F.col("id").isNotNull().alias("found"), "classify", "title"
    )


def link_checks(links: DataFrame, urls: DataFrame) -> DataFrame:
    """Whether asked links are processed and tagged; unknown links are neither."""
    columns = ["classify", "title", "date", "filename_location"]
    return look_up(links, urls, columns).select(
        "pdf_link", is_processed().alias("is_processed"), is_tagged().alias("is_tagged")
    )
