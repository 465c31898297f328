"""Every query against its SQL oracle, and the comparison against a known difference."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from verification import catalog

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(set(ORACLES) & set(catalog.QUERIES)))
def test_matches_oracle(spark, sf_dir, con, name):
    assert differences(con, ORACLES[name], QUERIES[name](spark, sf_dir)) == []


def test_comparison_sees_a_difference(spark, sf_dir, con):
    df = QUERIES["v_fraud_by_hour"](spark, sf_dir)
    changed = df.withColumn("fraud_count", df.fraud_count + 1)
    assert differences(con, ORACLES["v_fraud_by_hour"], changed)


def test_every_ledger_query_has_an_oracle():
    assert set(catalog.QUERIES) <= set(ORACLES) <= set(QUERIES)


def test_file_listing_has_every_day(spark, sf_dir):
    rows = QUERIES["partition_file_count"](spark, sf_dir).collect()
    assert len(rows) == 30 and all(row.has_files and row.row_count for row in rows)


def test_entry(spark):
    assert entry.entry(spark).count() == 5
