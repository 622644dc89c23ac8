"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from tests.oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"
_con = {}


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_matches_duckdb(spark, name):
    con = _con.setdefault("c", duck(SF))
    r = compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF, con)
    assert r["status"] == "match", r


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql())))
def test_rows_only_queries_run(spark, name):
    assert E.queries()[name](spark, SF).count() > 0
