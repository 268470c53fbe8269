"""Every registered query against its SQL, at the smallest scale."""

import datetime

import duckdb
import pytest
from conftest import DATA

import __spark_entry__ as driver
from millrace.operators.ordered import MAX_ROWS_CONF

FOLDER = f"{DATA}/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
SPLIT = ["rolling_reduce", "value_lag", "over_rows", "switch_state", "rising_alert", "cep_not_followed_by",
         "cep_global", "interval_join", "count_window_slide", "per_row_trigger", "lateness_classify"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: v.isoformat() if isinstance(v, (datetime.date, datetime.datetime)) else v
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, duck, name):
    got = driver.queries()[name](spark, FOLDER)
    want = duck.sql(driver.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    expected = canonical(want.columns, want.fetchall())
    assert expected, "the check needs rows"
    assert canonical(got.columns, [tuple(r) for r in got.collect()]) == expected


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query(spark, duck, name):
    compare(spark, duck, name)


@pytest.mark.parametrize("name", SPLIT)
def test_query_with_hot_keys(spark, duck, name):
    """The same results when keys count as hot and are split into chunks."""
    spark.conf.set(MAX_ROWS_CONF, "60")
    try:
        compare(spark, duck, name)
    finally:
        spark.conf.unset(MAX_ROWS_CONF)


def test_entry(spark):
    assert driver.entry(spark).limit(1).count() == 1


