"""Every query gives the rows of its SQL oracle."""

import subprocess
import sys

import pytest
from compare import difference, duck

import __spark_entry__ as entry_point
from docintake.plans.oracles import ORACLES
from docintake.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, con, sf_dir, name):
    rows = entry_point.queries()[name](spark, sf_dir)
    assert difference(rows, con, entry_point.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_is_green_without_rows(name, larger):
    rows = larger.execute(f"SELECT count(*) FROM ({entry_point.oracle_sql()[name]})").fetchone()
    assert rows[0] > 0


@pytest.fixture(scope="module")
def larger():
    return duck("/root/testdata/sf0.01")


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).count() == 10


def test_stand_in_models_need_no_module_on_the_executors(tmp_path):
    from pyspark import cloudpickle

    from docintake.plans.queries import echo_model, length_scorer

    for model in (echo_model(), length_scorer()):
        (tmp_path / "model").write_bytes(cloudpickle.dumps(model))
        load = f"import pickle; pickle.load(open({str(tmp_path / 'model')!r}, 'rb'))"
        subprocess.run([sys.executable, "-c", load], cwd=tmp_path, check=True)


def test_sweeps_of_busy_clients_find_downloads_of_both_kinds(spark):
    rows = QUERIES["big_retry_candidates"](spark, "/root/testdata/sf0.01").collect()
    assert {r["action"] for r in rows} == {"delete", "download"}
    assert any(r["first_sweep"] < r["last_sweep"] for r in rows)
