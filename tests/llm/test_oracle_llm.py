"""Registered queries of the subpackage that SQL can express, against DuckDB."""

import pytest

from tests.check_oracle import compare, duck
from tickspark.llm.oracle import ORACLE


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    ok, names, want_names, got, want, _ = compare(spark, duck(sf_dir), name, sf_dir)
    assert names == want_names and ok
