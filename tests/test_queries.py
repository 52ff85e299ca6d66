"""Every registered query against its SQL; queries without SQL must give rows with a stable schema."""

import importlib.util
from pathlib import Path

import pytest

from abacist.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"

spec = importlib.util.spec_from_file_location("check", Path(__file__).resolve().parents[1] / "tools" / "check.py")
check = importlib.util.module_from_spec(spec)
spec.loader.exec_module(check)


@pytest.fixture(scope="module")
def con():
    return check.database(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    ok, note = check.compare(spark, con, name, SF)
    assert ok, note


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["s_suppkey", "s_name", "year", "revenue", "previous_revenue", "yoy_growth"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
