"""Every registered query with check SQL must give the same rows on both engines."""

import pytest
from compare import compare, connect

import __spark_entry__ as entry
from hourlens.operators import models as md
from hourlens.plans.registry import QUERIES as LIBRARY

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    assert compare(df, con, entry.oracle_sql()[name]) == []


@pytest.fixture()
def small_fits(monkeypatch):
    """The registered fits with fewer trees; all rows stay."""
    monkeypatch.setattr(md.fit_gbt, "__defaults__", (6, 3, 0.1, 0.9, 42))
    monkeypatch.setattr(md.fit_surrogate, "__defaults__", (6,))
    monkeypatch.setattr(md.fit_forest, "__defaults__", (8, 5, 5, 42))


@pytest.mark.parametrize("name", sorted(set(LIBRARY) - set(entry.oracle_sql())))
def test_query_without_sql_runs(spark, small_fits, name):
    df = LIBRARY[name](spark, SF_DIR)
    rows = df.collect()
    assert rows and df.columns == list(dict.fromkeys(df.columns))
    for c, kind in df.dtypes:
        if kind == "double" and name != "stream_score":
            assert all(r[c] is not None and r[c] == r[c] for r in rows), c


def test_every_check_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
