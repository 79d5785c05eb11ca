import pytest
from test_claims import make
from test_state import event, tables

from docintake.plans.lifecycle import Intake
from docintake.sources.links import read_archive


def statuses(table):
    return {r["id"]: r["status"] for r in table.read().collect()}


def test_a_batch_from_claim_to_close(spark, tmp_path):
    intake = Intake(spark, str(tmp_path / "intake"))
    intake.links.commit(
        make(spark, [{"id": n, "pdf_link": f"u{n}", "status": "ready"} for n in range(6)])
    )
    first = sorted(r["id"] for r in intake.start_batch(4, "one").collect())
    assert len(first) == 4
    assert {n for n, s in statuses(intake.links).items() if s == "in_process"} == set(first)

    a, b, c, d = first
    tags = '{"title":"T","author":"A","date":"D","sector":"S"}'
    log = tables(
        spark,
        [],
        [
            event(1, f"u{a}", "download_complete", 1, "/f1", tags),
            event(2, f"u{b}", "html_seen"),
            event(3, f"u{c}", "download_complete", 9),
        ],
    )[1]
    intake.record(log.where("event_id < 3"), "one")
    intake.record(log.where("event_id = 3"), "two")
    intake.record(log.where("event_id = 3"), "two")
    now = {r["id"]: r["status"] for r in intake.state().collect()}
    assert now == {a: "done", b: "processed", c: "processing", d: "unprocessed"}

    second = intake.start_batch(1, "two").collect()
    archived = [(r["pg_id"], r["status"]) for r in read_archive(spark, intake.archive).collect()]
    assert sorted(archived) == sorted([(a, "processed"), (b, "processed"), (c, "processing")])
    assert intake.events().isEmpty()
    after = statuses(intake.links)
    claimed = {r["id"] for r in second}
    assert len(claimed) == 1
    for n in (a, b, c):
        assert after[n] == "in_process"
    assert after[d] == ("in_process" if d in claimed else "ready")
    assert set(statuses(intake.batch)) == claimed


def test_nothing_to_claim(spark, tmp_path):
    intake = Intake(spark, str(tmp_path / "intake"))
    intake.links.commit(make(spark, [{"id": 1, "pdf_link": "u", "status": "in_process"}]))
    assert intake.start_batch(3, "one").isEmpty()


def test_merged_patches_change_only_their_rows(spark, tmp_path):
    from test_patches import patch

    intake = Intake(spark, str(tmp_path / "intake"))
    intake.links.commit(
        make(spark, [{"id": n, "pdf_link": f"u{n}", "status": "in_process"} for n in range(4)])
    )
    intake.merge(patch(spark, {"pdf_link": "u2", "ordinal": 1, "classify": 1, "title": "T"}))
    assert statuses(intake.links) == {0: "in_process", 1: "in_process", 2: "ready", 3: "in_process"}
    assert {r["id"]: r["title"] for r in intake.links.read().collect()}[2] == "T"


class Crash(Exception):
    pass


def dying(monkeypatch, intake, after):
    """The tables of ``intake`` and its archive die after so many writes."""
    from docintake.plans import lifecycle

    left = [after]

    def counted(write):
        def run(*args):
            if left[0] == 0:
                raise Crash
            left[0] -= 1
            write(*args)

        return run

    for table in (intake.links, intake.batch):
        monkeypatch.setattr(table, "_add", counted(table._add))
    monkeypatch.setattr(lifecycle, "append_archive", counted(lifecycle.append_archive))


def worked(spark, root):
    """A batch that was claimed and worked on, below ``root``."""
    intake = Intake(spark, root)
    intake.links.commit(
        make(spark, [{"id": n, "pdf_link": f"u{n}", "status": "ready"} for n in range(6)])
    )
    first = sorted(r["id"] for r in intake.start_batch(4, "one").collect())
    log = [event(1, f"u{first[0]}", "download_complete", 2), event(2, f"u{first[1]}", "html_seen")]
    intake.record(tables(spark, [], log)[1], "one")
    return intake


def outcome(spark, intake):
    archived = read_archive(spark, intake.archive).collect()
    return (
        statuses(intake.links),
        statuses(intake.batch),
        sorted((r["pg_id"], r["status"]) for r in archived),
        intake.events().count(),
    )


@pytest.fixture(scope="module")
def undisturbed(spark, tmp_path_factory):
    intake = worked(spark, str(tmp_path_factory.mktemp("whole")))
    claimed = {r["id"] for r in intake.start_batch(3, "two").collect()}
    return claimed, outcome(spark, intake)


@pytest.mark.parametrize("after", range(5))
def test_a_crash_after_any_write_ends_in_the_same_state(
    spark, tmp_path, monkeypatch, undisturbed, after
):
    """Closing frees links, archives and empties the batch; claiming fills both tables."""
    claimed, expected = undisturbed
    hurt = worked(spark, str(tmp_path))
    with monkeypatch.context() as patch:
        dying(patch, hurt, after)
        with pytest.raises(Crash):
            hurt.start_batch(3, "two")
    again = Intake(spark, str(tmp_path))
    again.recover()
    if after < 3:  # the batch was being closed
        assert statuses(again.batch) == {}
        again.start_batch(3, "two")
    assert set(statuses(again.batch)) == claimed
    assert outcome(spark, again) == expected
