"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import compare
from pagelode.plans import oracle
from pagelode.plans.queries import REGISTERED as QUERIES

FOLDER = "/root/testdata/sf0.001"
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    assert compare.spark_rows(df) == compare.sql_rows(con, ORACLE[name])


def test_entry_is_the_ranked_search(spark):
    assert entry.entry(spark).columns == ["title", "url", "rank", "word"]
