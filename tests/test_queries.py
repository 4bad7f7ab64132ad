"""Every named query of the core beside its SQL on the smallest tables."""

from __future__ import annotations

import pytest

from jangbu.plans import catalogue
from tests.conftest import SMALL
from verify import canonical

QUERIES, SQL = catalogue.queries(), catalogue.sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(name, spark, duck):
    got, want = QUERIES[name](spark, SMALL).toPandas(), duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(name, spark):
    assert QUERIES[name](spark, SMALL).count() > 0


@pytest.mark.parametrize("name", ["p2_found", "p3_found", "p5_found", "p6_found"])
def test_each_case_once(name, spark):
    df = QUERIES[name](spark, SMALL)
    assert df.count() == df.distinct().count()


def test_gates_pass_where_they_should(spark):
    assert all(r.passed for r in QUERIES["quickstart_gates"](spark, SMALL).collect())
