import pytest
from oracle import assert_equal, views

from sporemill.plans import queries as q

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return views(SF)


@pytest.mark.parametrize("name", sorted(q.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    assert_equal(q.QUERIES[name](spark, SF), duck, q.ORACLE_SQL[name])


def test_entry_imports():
    import __spark_entry__ as e

    assert set(q.QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())


def test_references_of_many_parts(spark, tmp_path):
    """Part numbers of six and of seven digits: the smallest record is the first by its name, in the SQL too."""
    import duckdb

    table = "SELECT i AS l_orderkey, CAST(1 AS INTEGER) AS l_linenumber, CASE WHEN i % 2 = 0 THEN i ELSE 900000 + i END AS l_partkey, i % 50 AS l_suppkey FROM range(2000) t(i)"
    duckdb.sql(f"COPY ({table}) TO '{tmp_path}/lineitem.parquet' (FORMAT parquet)")
    name = "dereplicate_references"
    assert_equal(q.QUERIES[name](spark, str(tmp_path)), views(str(tmp_path)), q.ORACLE_SQL[name])
