"""Claiming batches from the link work queue."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docintake.functions import urls
from docintake.schemas import CLAIM_COLUMNS

IN_PROCESS = "in_process"
READY = "ready"

# ``status <> 'in_process'`` is three-valued: rows without a status are not eligible.
def not_in_process() -> Column:
    return F.col("status") != IN_PROCESS


def wants_download() -> Column:
    return not_in_process() & F.col("filename_location").isNull()


def wants_html() -> Column:
    return wants_download() & urls.is_html_link(F.col("pdf_link"))


def wants_no_extension() -> Column:
    return wants_download() & urls.has_no_known_extension(F.col("pdf_link"))


def wants_tagging() -> Column:
    return not_in_process() & (F.col("classify") == 1) & F.col("title").isNull()


def is_stuck() -> Column:
    return (F.col("status") == IN_PROCESS) & (F.col("classify") == 1) & F.col("title").isNull()


def draw_order(seed: str) -> Column:
    """A random-looking order that repeats for the same seed, so that a claim can be
    recomputed after a lost executor and still pick the same rows."""
    return F.md5(F.concat_ws("|", F.col("id").cast("string"), F.lit(seed)))


def pick(links: DataFrame, eligible: Column, batch_size: int, seed: str) -> DataFrame:
    """``batch_size`` random eligible rows without replacement, with their ``_draw`` and
    ``_turn``, counted from 1.

    The draw is a hash, so its first four hex digits split the rows evenly into 65,536
    buckets. How many rows the buckets before hold says which buckets are wanted, so only
    rows of those are shuffled, and each is put in order by itself. What is broadcast is
    one pair of numbers per bucket.
    """
    if isinstance(batch_size, bool) or not isinstance(batch_size, int) or batch_size < 1:
        raise ValueError("batch_size must be a positive integer")
    drawn = links.where(eligible).withColumn("_draw", draw_order(seed))
    drawn = drawn.withColumn("_bucket", F.conv(F.substring("_draw", 1, 4), 16, 10).cast("int"))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    wanted = (
        drawn.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_bucket", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
        .where(F.col("_before") < batch_size)
    )
    in_bucket = Window.partitionBy("_bucket").orderBy("_draw", "id")
    return (
        drawn.join(F.broadcast(wanted), "_bucket")
        .withColumn("_turn", F.col("_before") + F.row_number().over(in_bucket))
        .where(F.col("_turn") <= batch_size)
        .drop("_bucket", "_before")
    )


def claim_batch(links: DataFrame, batch_size: int, seed: str) -> DataFrame:
    return pick(links, wants_download(), batch_size, seed).select(*CLAIM_COLUMNS)


def claim_html(links: DataFrame, batch_size: int, seed: str) -> DataFrame:
    return pick(links, wants_html(), batch_size, seed).select(*CLAIM_COLUMNS)


def claim_no_extension(links: DataFrame, batch_size: int, seed: str) -> DataFrame:
    return pick(links, wants_no_extension(), batch_size, seed).select(*CLAIM_COLUMNS)


def claim_for_tagging(links: DataFrame, batch_size: int, seed: str) -> DataFrame:
    """Does not look at ``filename_location``, and returns only id and link."""
    return pick(links, wants_tagging(), batch_size, seed).select("id", "pdf_link")


def apply_claim(links: DataFrame, claimed: DataFrame) -> DataFrame:
    """The link table after the claim: claimed rows are in process."""
    return set_status_by_id(links, claimed.select("id"), IN_PROCESS)


def set_status_by_id(links: DataFrame, ids: DataFrame, status: str) -> DataFrame:
    """Set the status of the rows whose id is listed."""
    marks = ids.select("id").distinct().withColumn("_hit", F.lit(True))
    return (
        links.join(marks, "id", "left")
        .withColumn("status", F.when(F.col("_hit"), status).otherwise(F.col("status")))
        .select(*links.columns)
    )


def claim(
    links: DataFrame,
    batch_size: int,
    seed: str,
    how: Callable[[DataFrame, int, str], DataFrame] = claim_batch,
) -> tuple[DataFrame, DataFrame]:
    """Claimed rows and the new link table. Both follow from the seed, so computing
    them separately gives one consistent claim."""
    claimed = how(links, batch_size, seed)
    return claimed, apply_claim(links, claimed)
