"""Every catalogue query against its SQL twin."""

import pytest

import compare
from __spark_entry__ import entry, oracle_sql, queries
from harness import catalogue

QUERIES, TWINS = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


def test_every_query_of_the_catalogue_has_a_twin():
    assert set(catalogue.QUERIES) <= set(TWINS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_matches_twin(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = [d[0] for d in duck.execute(TWINS[name]).description]
    assert sorted(df.columns) == sorted(columns)
    assert compare.spark_rows(df) == compare.duck_rows(duck, TWINS[name])


def test_entry_returns_members(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", ["h5_fct_hrm_employees", "d9_mview_member_free_effort_reference"])
def test_runs_are_repeatable(spark, sf_dir, name):
    first, second = (compare.spark_rows(QUERIES[name](spark, sf_dir)) for _ in range(2))
    assert first == second
