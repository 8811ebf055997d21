"""Every registered query against its DuckDB SQL (row count, columns, values)."""

import pytest

import __spark_entry__ as E
from brisa.plans import catalog
from tests.conftest import SF_SMALL
from tests.helpers import duck, rows

SQL = catalog.ORACLE
NAMES = sorted(catalog.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_sql():
    assert set(SQL) == set(NAMES)


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas",
             "MapInArrow", "FlatMapGroups")


def assert_plain(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in FORBIDDEN if f in plan], "cross join or Python evaluation in the plan"


@pytest.fixture
def cuts(monkeypatch):
    """Every plan that ends in a checkpoint is looked at too."""
    from brisa import session
    from brisa.operators import evaluate, knn, leaves
    from brisa.plans import catalog_models, jobs, wind

    def checked(df):
        assert_plain(df)
        return session.cut_lineage(df)

    for module in (evaluate, knn, leaves, catalog_models, jobs, wind):
        monkeypatch.setattr(module, "cut_lineage", checked)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb(spark, con, cuts, name):
    df = E.queries()[name](spark, SF_SMALL)
    assert_plain(df)
    got = df.toPandas()
    want = con.sql(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["lang", "source", "flag", "n", "gid"]
    assert df.count() > 0
