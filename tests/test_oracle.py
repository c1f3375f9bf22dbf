"""Every named query against its SQL on the same tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from dealscope.plans.catalog import QUERIES
from tests.compare import assert_same, duck

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) >= set(NAMES)


def test_entry(spark):
    rows = entry(spark).orderBy("stage_no").collect()
    assert [r.units for r in rows] == [75, 75, 75, 72, 64]


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, sf_dir, connection, name):
    assert assert_same(queries()[name](spark, sf_dir), connection, oracle_sql()[name]) > 0
