"""Every registered query against its SQL."""

import pytest

from __spark_entry__ import entry, oracle_sql
from tickspark.plans.oracle import ORACLE
from tickspark.plans.queries import QUERIES
from tests.check_oracle import compare, duck


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    ok, names, want_names, got, want, _ = compare(spark, con, name, sf_dir)
    assert names == want_names
    assert ok, (list((got - want).items())[:2], list((want - got).items())[:2])


def test_entry(spark):
    assert entry(spark).count() > 0
