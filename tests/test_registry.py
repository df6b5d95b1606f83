"""Every registered query against its DuckDB twin on the smallest tables, plus the entry point."""

import pytest

from labelsmith.plans.registry import ORACLE, QUERIES
from oracle_harness import compare

from conftest import SF_SMALL


def test_every_key_has_a_query_and_docstring():
    assert len(QUERIES) >= 60
    assert set(ORACLE) <= set(QUERIES)
    for name, fn in QUERIES.items():
        assert fn.__doc__, name


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    r = compare(spark, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert "error" not in r, r


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0


def test_entry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert set(E.oracle_sql()) <= set(E.queries())
