"""Every registered query against its DuckDB oracle (small data), and the
driver contract of __spark_entry__."""

import os
import sys

import pytest

from conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402

from martflow.plans import registry  # noqa: E402

NAMES = [n for n in registry.queries() if not n.startswith("stream_")]


@pytest.fixture(scope="module")
def duck():
    from compare import duck as make
    return make(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    from compare import compare
    sql = E.oracle_sql().get(name)
    ok, line = compare(spark, duck, name, E.queries()[name], sql, SF_SMALL)
    assert ok, line


def test_every_query_has_an_oracle():
    assert set(registry.oracle_sql()) == set(registry.queries())
    assert set(registry.queries()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["series", "hr", "n", "dau_total"]
    assert df.count() == 48
