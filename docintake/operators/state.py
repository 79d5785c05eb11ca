"""The state of each link, derived from its event log.

Every event overwrites some columns of its link, so the state is a set of
last-writer aggregates. They combine before the shuffle, which keeps a link with
very many events balanced, and the same aggregates run in batch and streaming.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docintake.functions import tagjson
from docintake.functions.truth import guard_open, is_empty, non_empty
from docintake.operators.skew import key_join, running
from docintake.schemas import TAG_FIELDS

# Event kinds and working statuses.
DOWNLOAD = "download_complete"
INTERRUPTED = "download_interrupted"
STATE_KINDS = ("html_seen", "maybe_pdf", "tab_opened", DOWNLOAD)
ORDER = ("ts", "event_id")
KEY = ("pdf_link",)

UNPROCESSED = "unprocessed"
PROCESSING = "processing"
PROCESSED = "processed"
DONE = "done"


def _is_download() -> Column:
    return F.col("kind") == DOWNLOAD


def _wants_tags() -> Column:
    """Downloads of a presentation (1) or a mixed document (3)."""
    return _is_download() & F.col("pred").isin(1, 3)


def read_answers(events: DataFrame) -> DataFrame:
    """Add ``tag_state`` and ``tags``, parsing only downloads that may be tagged."""
    parsed = tagjson.parse(events, F.when(_wants_tags(), F.col("tag_json")))
    return (
        parsed.withColumn("tag_state", tagjson.state())
        .withColumn("tags", F.when(F.col("tag_state") == "complete", tagjson.tags()))
        .drop("_answer", "_text")
    )


def writing_events(events: DataFrame) -> DataFrame:
    """Events that can change a row: known kinds, and downloads that name a file."""
    named = ~_is_download() | non_empty(F.col("filename"))
    return events.where(F.col("kind").isin(*STATE_KINDS) & non_empty(F.col("pdf_link")) & named)


def _closing() -> Column:
    """Without tags this is false."""
    return tagjson.closes_guard(F.col("tags.title"), F.col("tags.date"))


def writes_of(
    events: DataFrame, key: Sequence[str] = KEY, order: Sequence[str] = ORDER
) -> DataFrame:
    """What each event writes. All events write ``classify`` (maybe NULL) and
    ``status``; in the other columns NULL means "not written"."""
    final = F.col("pred").isin(1, 2, 3)
    no_download = ~_is_download()
    return read_answers(writing_events(events)).select(
        *key,
        *order,
        F.when(F.col("kind").isin("html_seen", "maybe_pdf"), 2)
        .when(_is_download() & final, F.col("pred"))
        .alias("classify"),
        F.when(no_download, PROCESSED).when(final, DONE).otherwise(PROCESSING).alias("status"),
        (F.col("tag_state") == "broken").alias("broken"),
        F.when(F.col("kind") != "html_seen", F.col("kind") == "maybe_pdf").alias("uncertainty"),
        F.when(_wants_tags(), F.col("filename")).alias("filename"),
        "tags",
    )


def last_writes(
    events: DataFrame, key: Sequence[str] = KEY, order: Sequence[str] = ORDER
) -> DataFrame:
    """One row per link: what the last writer of each column wrote.

    A struct that is NULL means "never written"; a struct holding NULL means
    "NULL was written".
    """

    def stamped(*payload: str) -> Column:
        return F.struct(*order, *payload)

    def written(column: str) -> Column:
        return F.when(F.col(column).isNotNull(), stamped(column))

    return (
        writes_of(events, key, order)
        .groupBy(*key)
        .agg(
            F.max(stamped("classify", "status", "broken")).alias("w_last"),
            F.max(written("uncertainty")).alias("w_uncertainty"),
            F.max(written("filename")).alias("w_filename"),
            F.min(F.when(_closing(), stamped("tags"))).alias("w_close"),
            F.max(written("tags")).alias("w_tags"),
        )
    )


def first_of_batch(batch: DataFrame, key: Sequence[str], columns: Sequence[str] = ()) -> DataFrame:
    """The first row of each key as loaded: ``starts_open``, whether it wants tags,
    and the asked columns as ``row``, if any."""
    wants = guard_open(F.col("title"), F.col("date"))
    if not columns and isinstance(batch.schema["id"].dataType, T.IntegralType):
        # One number of fixed width: the id and one bit.
        first = F.coalesce(F.col("id").cast("long"), F.lit(-(1 << 63))).cast("decimal(20,0)")
        packed = first * F.lit(Decimal(2)) + F.when(wants, 1).otherwise(0).cast("decimal(1,0)")
        least = batch.groupBy(*key).agg(F.min(packed).alias("_first"))
        return least.select(*key, (F.pmod("_first", F.lit(Decimal(2))) == 1).alias("starts_open"))
    first = F.min(F.struct("id", wants.alias("starts_open"), *columns)).alias("row")
    return batch.groupBy(*key).agg(first).withColumn("starts_open", F.col("row.starts_open"))


def _stamp(column: str, order: Sequence[str]) -> Column:
    return F.struct(*[F.col(f"{column}.{c}") for c in order])


def packed_stamp(order: Sequence[str], schema: T.StructType) -> Column | None:
    """One number of fixed width in the order of the stamps, if they are a time and an integer;
    a missing part comes first."""
    if len(order) != 2:
        return None
    at, number = (schema[c].dataType for c in order)
    if not isinstance(number, T.IntegralType):
        return None
    time = F.col(order[0])
    if isinstance(at, T.TimestampType):
        micros = F.unix_micros(time)
    elif isinstance(at, (T.TimestampNTZType, T.DateType)):
        # Without a time zone, so that no hour comes twice.
        micros = F.unix_date(time.cast("date")).cast("long") * 86_400_000_000
        if isinstance(at, T.TimestampNTZType):
            seconds = F.date_part(F.lit("SECOND"), time) * 1_000_000
            minutes = F.hour(time) * 60 + F.minute(time)
            micros = micros + minutes.cast("long") * 60_000_000 + seconds.cast("long")
    else:
        return None
    micros = F.coalesce(micros, F.lit(-(1 << 55))).cast("decimal(20,0)")
    last = F.coalesce(F.col(order[1]).cast("long"), F.lit(-(1 << 63))).cast("decimal(20,0)")
    return (micros * F.lit(Decimal(1 << 64)) + last).cast("decimal(38,0)")


# What the last event writes to class and status is a number below this.
CODES = 64
STATUSES = (PROCESSED, DONE, PROCESSING)


def _with_code(at: Column, code: Column) -> Column:
    return (at * F.lit(Decimal(CODES)) + code.cast("decimal(2,0)")).cast("decimal(38,0)")


def _code(stamped: Column) -> Column:
    return F.pmod(stamped, F.lit(Decimal(CODES))).cast("int")


def net_writes(
    events: DataFrame, key: Sequence[str] = KEY, order: Sequence[str] = ORDER
) -> DataFrame:
    """One row per link with events: what they write, in the end, to its row.

    Every event writes class and status. Where the order is a time and a number, stamp and the
    few bits of those are one number, which a hash aggregate carries. File names and tags come
    with few events, whose stamped values are aggregated by themselves. Both combine before the
    shuffle, so a link with very many events stays balanced. Other orders take ``last_writes``.
    """
    at = packed_stamp(order, events.schema)
    if at is None:
        return net_of_structs(last_writes(events, key, order), order)
    key = list(key)
    writes = writes_of(events, key, order).withColumn("at", at)
    status = sum((F.when(F.col("status") == s, n).otherwise(0) for n, s in enumerate(STATUSES)), F.lit(0))
    number = F.coalesce("classify", F.lit(0)) + 4 * status
    number = number + F.when(F.col("broken"), 16).otherwise(0)
    unsure = F.when(F.col("uncertainty").isNotNull(), F.col("uncertainty").cast("int"))
    last = writes.groupBy(*key).agg(
        F.max(_with_code(F.col("at"), number)).alias("last"),
        F.max(_with_code(F.col("at"), unsure)).alias("unsure"),
    )

    def stamped(column: str) -> Column:
        return F.when(F.col(column).isNotNull(), F.struct("at", column))

    named = writes.where(F.col("filename").isNotNull()).groupBy(*key).agg(
        F.max(stamped("filename")).alias("file"),
        F.min(F.when(_closing(), F.struct("at", "tags"))).alias("close"),
        F.max(stamped("tags")).alias("last_tags"),
    )
    code, closed_at = _code(F.col("last")), F.col("close.at") * F.lit(Decimal(CODES))
    return last.join(named, key, "left").select(
        *key,
        F.get(F.array(*[F.lit(s) for s in STATUSES]), F.shiftright(code, 2).bitwiseAND(3)).alias("w_status"),
        F.nullif(code.bitwiseAND(3), F.lit(0)).alias("w_classify"),
        (code >= 16).alias("w_broken"),
        (F.col("close").isNull() | (F.col("last") < closed_at)).alias("w_before_close"),
        (_code(F.col("unsure")) == 1).alias("w_uncertainty"),
        F.col("file.filename").alias("w_filename"),
        F.col("last_tags").isNotNull().alias("w_tagged"),
        F.when(F.col("close").isNotNull(), F.col("close.tags"))
        .otherwise(F.col("last_tags.tags"))
        .alias("w_tags"),
    )


def net_of_structs(writes: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """The same from ``last_writes``."""
    named = ("w_last", "w_uncertainty", "w_filename", "w_close", "w_tags")
    key = [c for c in writes.columns if c not in named]
    return writes.select(
        *key,
        F.col("w_last.status").alias("w_status"),
        F.col("w_last.classify").alias("w_classify"),
        F.col("w_last.broken").alias("w_broken"),
        (F.col("w_close").isNull() | (_stamp("w_last", order) < _stamp("w_close", order))).alias(
            "w_before_close"
        ),
        F.col("w_uncertainty.uncertainty").alias("w_uncertainty"),
        F.col("w_filename.filename").alias("w_filename"),
        F.col("w_tags").isNotNull().alias("w_tagged"),
        F.when(F.col("w_close").isNotNull(), F.col("w_close.tags"))
        .otherwise(F.col("w_tags.tags"))
        .alias("w_tags"),
    )


def apply_net(batch: DataFrame, writes: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """The batch after its events. Columns that no event wrote keep their value."""
    net = first_of_batch(batch, key).select(*key, "starts_open").join(writes, list(key))
    rows = key_join(batch, net, key)
    # A broken answer fails its download, unless the link wants no tags any more.
    failed = F.col("w_broken") & F.col("starts_open") & F.col("w_before_close")
    wrote_tags = F.col("starts_open") & F.col("w_tagged")
    written = {
        "status": F.when(failed, PROCESSING).otherwise(F.coalesce("w_status", "status")),
        "classify": F.when(F.col("w_status").isNull(), F.col("classify")).otherwise(
            F.col("w_classify")
        ),
        "uncertainty": F.coalesce("w_uncertainty", "uncertainty"),
        "filename_location": F.coalesce("w_filename", "filename_location"),
    }
    for f in TAG_FIELDS:
        written[f] = F.when(wrote_tags, F.col(f"w_tags.{f}")).otherwise(F.col(f))
    return rows.withColumns(written).select(*batch.columns)


def apply_writes(
    batch: DataFrame,
    writes: DataFrame,
    key: Sequence[str] = KEY,
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """The batch after the ``last_writes`` of its events."""
    return apply_net(batch, net_of_structs(writes, order), key)


def link_state(
    batch: DataFrame,
    events: DataFrame,
    key: Sequence[str] = KEY,
    order: Sequence[str] = ORDER,
) -> DataFrame:
    return apply_net(batch, net_writes(events, key, order), key)


# --- the outcome of each single event ---------------------------------------


def guard_closings(
    events: DataFrame, key: Sequence[str] = KEY, order: Sequence[str] = ORDER
) -> DataFrame:
    """Per link, the stamp and tags of the first answer that ends the wish for tags."""
    return (
        read_answers(writing_events(events).where(_wants_tags()))
        .groupBy(*key)
        .agg(F.min(F.when(_closing(), F.struct(*order, "tags"))).alias("w_close"))
    )


def _with_guard(
    batch: DataFrame,
    events: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str] = (),
    how: str = "left",
) -> DataFrame:
    """Events with ``known`` and, for known links, ``row`` and ``open``: whether the
    link still wanted tags when the event arrived."""
    closings = guard_closings(events, key, order)
    per_link = (
        first_of_batch(batch, key, columns)
        .join(closings, list(key), "left")
        .withColumn("known", F.lit(True))
    )
    joined = key_join(read_answers(events), per_link, key, how)
    here = F.struct(*order)
    return joined.withColumn("known", F.coalesce("known", F.lit(False))).withColumn(
        "open",
        F.col("starts_open")
        & (F.col("w_close").isNull() | (_stamp("w_close", order) >= here)),
    )


def _outcome() -> Column:
    download = (
        F.when(is_empty(F.col("filename")) | is_empty(F.col("pdf_link")), 400)
        .when(~F.col("known"), 422)
        .when(F.col("pred").isNull(), 500)
        .when(_wants_tags() & (F.col("tag_state") == "broken") & F.col("open"), 500)
        .otherwise(200)
    )
    return (
        F.when(_is_download(), download)
        .when((F.col("kind") == "tab_opened") & ~F.col("known"), 400)
        .otherwise(200)
    )


def event_outcomes(
    batch: DataFrame,
    events: DataFrame,
    key: Sequence[str] = KEY,
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """The answer code of every event that reaches the link table."""
    seen = events.where(F.col("kind").isin(*STATE_KINDS))
    return _with_guard(batch, seen, key, order).withColumn("outcome", _outcome())


def archive_on_download(
    batch: DataFrame,
    events: DataFrame,
    key: Sequence[str] = KEY,
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """One archive row per successful download, showing its link just after it.

    Repeated downloads of a link are archived again. The file name and tags in
    force come from this download or an earlier one of the link.
    """
    key, order = list(key), list(order)
    downloads = writing_events(events).where(_is_download())
    first = [*TAG_FIELDS, "filename_location"]
    rest = [c for c in order if c not in key]
    # Only what the archive rows are made of travels through the running values.
    writes = _with_guard(batch, downloads, key, order, first, "inner").select(
        *key,
        *rest,
        "pred",
        "row",
        _outcome().alias("outcome"),
        F.when(_wants_tags(), F.col("filename")).alias("file"),
        F.when(F.col("open"), F.col("tags")).alias("tags"),
    )
    lasts = {"file_now": F.col("file"), "tags_now": F.col("tags")}
    in_force = running(writes, key, order, "downloads", lasts=lasts)
    final = F.col("pred").isin(1, 2, 3)
    tag = {
        f: F.when(F.col("tags_now").isNotNull(), F.col(f"tags_now.{f}")).otherwise(
            F.col(f"row.{f}")
        )
        for f in TAG_FIELDS
    }
    return in_force.where(F.col("outcome") == 200).select(
        *rest,
        F.col("row.id").alias("pg_id"),
        *key,
        F.when(final, F.col("pred")).alias("classify"),
        tag["title"].alias("title"),
        F.when(final, PROCESSED).otherwise(PROCESSING).alias("status"),
        tag["sector"].alias("sector"),
        tag["author"].alias("author"),
        tag["date"].alias("date"),
        F.coalesce("file_now", "row.filename_location").alias("filename_location"),
    )


# --- predicates on a row ----------------------------------------------------


def is_processed() -> Column:
    """Class 2, or class 1/3 with title and file; unknown counts as no."""
    c = F.col("classify")
    full = F.col("title").isNotNull() & F.col("filename_location").isNotNull()
    return F.coalesce((c == 2) | (c.isin(1, 3) & full), F.lit(False))


def is_tagged() -> Column:
    return F.col("title").isNotNull() & F.col("date").isNotNull()


def needs_tagging(pred: Column) -> Column:
    return F.coalesce(
        pred.isin(1, 3) & is_empty(F.col("title")) & ~is_tagged(), F.lit(False)
    )
