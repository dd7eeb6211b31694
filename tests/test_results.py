"""Every registered query against its SQL over the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from check_results import differs, open_tables, rows_of

FOLDER = "/root/testdata/sf0.001"
SQL = entry_points.oracle_sql()
QUERIES = entry_points.queries()


@pytest.fixture(scope="module")
def tables():
    return open_tables(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, tables, name):
    df = QUERIES[name](spark, FOLDER)
    got = rows_of(df.columns, df.collect())
    if name not in SQL:
        assert entry_points.WITH_TEXT and (name == "pipeline" or name.startswith("op"))  # tested on their own
        return
    cursor = tables.execute(SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert differs(got, rows_of(names, cursor.fetchall())) is None


def test_entry_runs(spark):
    assert entry_points.entry(spark).count() > 0


def test_no_sql_without_a_query():
    assert set(SQL) <= set(QUERIES)
