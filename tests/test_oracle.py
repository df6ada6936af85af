"""Every SQL-checkable registered query against its DuckDB twin (small SF),
and the entry point's smoke contract."""

import pytest

import __spark_entry__ as E
from tools.compare import compare, duck

SQL = E.oracle_sql()
QUERIES = E.queries()
# Model fitting and file round trips have no SQL twin; a few fast ones are
# run here for shape, the rest in their own tests.
ROWS_SMOKE = ["train_logistic", "train_ridge"]


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_sql_key_is_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_duckdb(spark, sf_dir, con, key):
    df = QUERIES[key](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(SQL[key])
    msg = compare(rows, df.columns, cur.fetchall(), [d[0] for d in cur.description])
    assert msg is None, msg


@pytest.mark.parametrize("key", ROWS_SMOKE)
def test_rows_only_queries_run(spark, sf_dir, key):
    assert QUERIES[key](spark, sf_dir).count() > 0


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 7
    assert df.columns == ["step_no", "step", "records_before", "records_after", "removed", "pct_removed"]
