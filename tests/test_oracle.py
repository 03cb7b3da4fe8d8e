"""Every registered query equals its DuckDB oracle on sf0.001 (rows, columns, values)."""

import os
import sys

import pytest

from conftest import ROOT, SF001

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from evhist.plans import catalog  # noqa: E402
from oracle_check import duck, frame_hash  # noqa: E402

QUERIES = E.queries()
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_an_oracle():
    """Of this library; operators that SQL cannot say are tested beside their code."""
    assert set(catalog.queries()) <= set(SQL) <= set(QUERIES)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["fetched_city", "event_date", "genre", "total_events", "unique_artists",
                          "unique_venues", "min_ticket_price", "max_ticket_price", "avg_ticket_price"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF001).toPandas()
    want = con.execute(SQL[name]).fetchdf()
    assert len(got) == len(want)
    assert sorted(got.columns) == sorted(want.columns)
    assert frame_hash(got) == frame_hash(want)
