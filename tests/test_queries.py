"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as E
from oracle import compare, duck

SF = os.environ.get("TESSERA_TEST_SF", "/root/testdata/sf0.001")
QUERIES = E.table_queries()
ORACLES = E.table_oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert compare(df, con, ORACLES[name]) is None


def test_entry(spark):
    rows = E.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"l_returnflag", "sum_price", "n_lines"}


@pytest.mark.parametrize("name", ["month_partition_counts", "hour_partition_counts",
                                  "filtered_partition_read", "replace_partition",
                                  "partition_expiry"])
def test_time_partitions_ignore_session_zone(spark, con, name):
    """timestamp_ntz partitions give the same rows in any session time zone."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = QUERIES[name](spark, SF)
        assert compare(df, con, ORACLES[name]) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
