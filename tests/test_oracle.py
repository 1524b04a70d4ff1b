"""Every query against its SQL twin on the sf0.01 tables."""

import compare
import pytest

import __spark_entry__ as driver

QUERIES = driver.queries()
ORACLE = driver.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


def test_every_sql_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, con, sf_dir, name):
    mine_columns, sql_columns, mine, sql = compare.both(
        spark, con, QUERIES[name], ORACLE[name], sf_dir
    )
    assert mine_columns == sql_columns
    assert mine == sql


def test_entry(spark):
    df = driver.entry(spark)
    assert df.count() == 10
    assert {"segment_id", "rank", "status_label"} <= set(df.columns)
