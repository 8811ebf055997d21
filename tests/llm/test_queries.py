"""Queries against their DuckDB SQL, and the entry contract of the subpackage."""

import re

import pytest

import __spark_entry__ as E
from brisa.llm import catalog
from tests.conftest import SF_SMALL
from tests.helpers import duck, rows

NATIVE = ("op5_secret_scan", "op8_url_rules")


@pytest.fixture(scope="module")
def con():
    c = duck(SF_SMALL)
    c.execute("SET threads = 4")
    return c


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_matches_duckdb(spark, con, name):
    df = catalog.QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in NATIVE:
        assert not re.search("Python|Pandas|Arrow", plan)
    got, want = df.toPandas(), con.sql(catalog.ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_one_query_for_each_operator():
    names = set(E.queries())
    for n in range(1, 14):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names


def test_entry_works_without_the_subpackage(monkeypatch):
    real = E.importlib.import_module

    def missing(name, *a):
        if name.startswith("brisa.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
        return real(name, *a)

    monkeypatch.setattr(E.importlib, "import_module", missing)
    assert not [n for n in E.queries() if n.startswith("op") and n[2:3].isdigit()] and "pipeline" not in E.queries()
    assert "cube_full" in E.oracle_sql()


def test_other_import_errors_are_not_swallowed(monkeypatch):
    def broken(name, *a):
        raise ModuleNotFoundError("No module named 'numpyy'", name="numpyy")

    monkeypatch.setattr(E.importlib, "import_module", broken)
    with pytest.raises(ModuleNotFoundError):
        E.queries()
