"""The subpackage's named queries beside their SQL, or what they must hold without."""

from __future__ import annotations

import pytest

from jangbu.llm.queries import QUERIES, SQL
from tests.conftest import SMALL
from verify import canonical


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(name, spark, duck):
    got, want = QUERIES[name](spark, SMALL).toPandas(), duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(name, spark):
    assert QUERIES[name](spark, SMALL).count() > 0


@pytest.mark.parametrize("name", ["p4_found", "p8_found", "p9_found"])
def test_each_case_once(name, spark):
    df = QUERIES[name](spark, SMALL)
    assert df.count() == df.distinct().count()


def test_nothing_collides(spark):
    assert all(r.shared_surrogates == 0 and r.split_values == 0 for r in QUERIES["p9_surrogate_checks"](spark, SMALL).collect())


def test_containers_are_full(spark):
    r = QUERIES["p7_fill_report"](spark, SMALL).first()
    assert r.containers <= r.fewest_possible + 2 and r.fullest <= 2048
