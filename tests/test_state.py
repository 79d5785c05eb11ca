import datetime as dt
import random

import pytest
from fold import TAGS, Batch

from docintake.operators import batches, state
from docintake.schemas import EVENTS, LINKS

KINDS = ("html_seen", "maybe_pdf", "tab_opened", "download_complete", "download_interrupted")
ANSWERS = (
    None,
    "",
    "{",
    "{}",
    " { } ",
    "[]",
    "[1]",
    "null",
    "false",
    "true",
    "0",
    "7",
    '""',
    '"x"',
    '{"title":"T","author":"A","date":"D","sector":"S"}',
    '{"title":"U","author":"","date":"","sector":"Other"}',
    '{"title":"","author":"B","date":null,"sector":"S"}',
    '{"title":null,"author":"C","date":"2020","sector":"S"}',
    '{"title":"","author":"E","date":"","sector":"S"}',
    '{"title":5,"author":"A","date":"D","sector":"S"}',
    '{"author":"A","date":"D","sector":"S"}',
    '{"title":"V","author":"A","date":"D"}',
)
SEEN = ("id", "pdf_link", "status", "classify", "uncertainty", "filename_location", *TAGS)


def link(n, url, **values):
    row = dict.fromkeys(LINKS.names) | {"id": n, "pdf_link": url, "status": "ready"}
    return row | values


def event(n, url, kind, pred=None, filename="/f", tag_json=None, minute=None):
    ts = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=n if minute is None else minute)
    return {
        "event_id": n,
        "ts": ts,
        "client_id": 1,
        "pdf_link": url,
        "kind": kind,
        "pred": pred,
        "filename": filename,
        "tag_json": tag_json,
    }


def tables(spark, links, events):
    as_rows = lambda rows, s: [tuple(r[c] for c in s.names) for r in rows]
    return (
        batches.load(spark.createDataFrame(as_rows(links, LINKS), LINKS)),
        spark.createDataFrame(as_rows(events, EVENTS), EVENTS),
    )


def folded(links, events):
    batch, codes = Batch(links), {}
    for e in sorted(events, key=lambda e: (e["ts"], e["event_id"])):
        if e["kind"] != "download_interrupted":
            codes[e["event_id"]] = batch.apply(e)
    return batch, codes


def bag(rows, columns):
    return sorted((tuple(r[c] for c in columns) for r in rows), key=repr)


def check(spark, links, events):
    batch, codes = folded(links, events)
    rows, log = tables(spark, links, events)
    got = state.link_state(rows, log).collect()
    assert bag(got, SEEN) == bag(batch.rows, SEEN)
    outcomes = state.event_outcomes(rows, log).select("event_id", "outcome").collect()
    assert {r[0]: r[1] for r in outcomes} == codes
    archived = state.archive_on_download(rows, log).collect()
    columns = ("event_id", "pg_id", "pdf_link", "classify", "status", "filename_location", *TAGS)
    assert bag(archived, columns) == bag(batch.archive, columns)


def random_case(rnd, urls):
    links = [
        link(
            n,
            f"u{n // 2 if n % 7 == 0 else n}",
            classify=rnd.choice((None, 1, 2, 3)),
            title=rnd.choice((None, None, "", "Old")),
            date=rnd.choice((None, None, "2019")),
            filename_location=rnd.choice((None, "/old")),
        )
        for n in range(urls)
    ]
    events = []
    for n in range(urls * 5):
        url = rnd.choice((f"u{rnd.randrange(urls)}",) * 9 + ("gone", "", None))
        if url is None:
            url = "u1"
        events.append(
            event(
                n,
                url,
                rnd.choice(KINDS + ("download_complete",) * 4),
                rnd.choice((1, 1, 2, 3, 3, 0, 7, None)),
                rnd.choice((f"/f{n}", f"/f{n}", "", None)),
                rnd.choice(ANSWERS),
                minute=rnd.randrange(urls * 3),
            )
        )
    return links, events


@pytest.mark.parametrize("seed", range(3))
def test_aggregate_equals_fold(spark, seed):
    check(spark, *random_case(random.Random(seed), 400))


def test_written_null_differs_from_not_written(spark):
    links = [link(1, "a", classify=1), link(2, "b", classify=1)]
    events = [event(1, "a", "html_seen"), event(2, "a", "tab_opened")]
    check(spark, links, events)
    rows, log = tables(spark, links, events)
    got = {r["pdf_link"]: r["classify"] for r in state.link_state(rows, log).collect()}
    assert got == {"a": None, "b": 1}


def test_html_seen_leaves_uncertainty(spark):
    links = [link(1, "a")]
    events = [event(1, "a", "maybe_pdf"), event(2, "a", "html_seen")]
    rows, log = tables(spark, links, events)
    assert state.link_state(rows, log).first()["uncertainty"] is True


def test_broken_answer_counts_only_while_tags_are_wanted(spark):
    good, broken = ANSWERS[14], ANSWERS[20]
    events = [
        event(1, "open", "download_complete", 1, tag_json=broken),
        event(2, "closed", "download_complete", 1, tag_json=good),
        event(3, "closed", "download_complete", 3, tag_json=broken),
    ]
    links = [link(1, "open"), link(2, "closed")]
    check(spark, links, events)
    rows, log = tables(spark, links, events)
    got = {r["pdf_link"]: r["status"] for r in state.link_state(rows, log).collect()}
    assert got == {"open": "processing", "closed": "done"}


def test_repeated_downloads_are_archived_again(spark):
    events = [event(n, "a", "download_complete", 2) for n in range(5)]
    rows, log = tables(spark, [link(1, "a")], events)
    assert state.archive_on_download(rows, log).count() == 5


def test_key_may_include_the_batch(spark):
    from pyspark.sql import functions as F

    rows, log = tables(spark, [link(1, "a"), link(2, "a")], [event(1, "a", "html_seen")])
    rows = rows.withColumn("batch_id", F.col("id"))
    log = log.withColumn("batch_id", F.lit(2).cast("long"))
    got = state.link_state(rows, log, key=("batch_id", "pdf_link")).collect()
    assert {r["id"]: r["status"] for r in got} == {1: "unprocessed", 2: "processed"}


def test_no_python_and_no_product_in_the_plan(spark):
    rows, log = tables(spark, [link(1, "a")], [event(1, "a", "html_seen")])
    plan = state.link_state(rows, log)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan
    assert "NestedLoop" not in plan


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_class_and_status_are_hash_aggregates(spark):
    """Only events with a file name go through aggregates that sort."""
    links, events = random_case(random.Random(3), 40)
    batch, log = tables(spark, links, events)
    plan = plan_of(state.link_state(batch, log))
    assert plan.count("HashAggregate") == 4 and plan.count("SortAggregate") == 2
    assert plan_of(state.apply_writes(batch, state.last_writes(log))).count("HashAggregate") == 2


@pytest.mark.parametrize("seed", range(3))
def test_both_ways_to_the_last_writes_agree(spark, seed):
    """Also with events that are there twice, at one time, before 1970, or without a time."""
    draw = random.Random(seed)
    links, events = random_case(draw, 60)
    for e in events:
        e["ts"] = draw.choice([e["ts"], dt.datetime(1960, 1, 1, 5), dt.datetime(2024, 1, 1), None])
    events = [e | {"event_id": e["event_id"] * draw.choice([1, -1])} for e in events]
    events += draw.choices(events, k=20)
    batch, log = tables(spark, links, events)
    got = state.link_state(batch, log).collect()
    want = state.apply_writes(batch, state.last_writes(log)).collect()
    assert bag(got, SEEN) == bag(want, SEEN)
