"""Every registered query against its SQL on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry  # noqa: E402
import check_queries  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check_queries.connect(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    ok, text = check_queries.compare(spark, con, name, SF)
    assert ok, text
    assert "types differ" not in text, text


def test_entry(spark):
    assert entry.entry(spark).count() == 7


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
