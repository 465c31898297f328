"""The index of keys seen on earlier days."""

import datetime as dt

import pytest

import rows
from paytrail.sources.seen import SeenKeys

ONE, TWO, THREE = (dt.date(2024, 3, d) for d in (5, 6, 7))


@pytest.fixture
def index(spark):
    index = SeenKeys(spark, "seen_test", buckets=4)
    yield index
    spark.sql("DROP TABLE seen_test")


def steps(df):
    return sorted(r.step for r in df.collect())


def test_copies_of_earlier_days_are_found_and_reruns_change_nothing(spark, index):
    first, second = rows.silver(spark, dict(step=1), dict(step=2)), rows.silver(spark, dict(step=2), dict(step=3), dict(step=3))
    for _ in range(2):
        assert steps(index.unseen(first, ONE)) == [1, 2]
        index.record(first, ONE)
        found = index.unseen(second, TWO)
        fresh = spark.createDataFrame(found.collect(), found.schema)
        assert steps(fresh) == [3, 3]
        index.record(fresh, TWO)
    assert spark.table("seen_test").count() == 3
    assert steps(index.unseen(second, THREE)) == [] and steps(index.unseen(second, ONE)) == [2, 3, 3]


def test_a_rerun_without_rows_forgets_the_day(spark, index):
    index.record(rows.silver(spark, dict(step=1)), ONE)
    index.record(rows.silver(spark, dict(step=1)).limit(0), ONE)
    assert steps(index.unseen(rows.silver(spark, dict(step=1)), TWO)) == [1]


def test_a_missing_part_is_no_copy(spark, index):
    odd = rows.silver(spark, dict(nameDest=None))
    index.record(odd, ONE)
    assert index.unseen(odd, TWO).count() == 1


def test_the_index_is_not_shuffled(spark, index):
    index.record(rows.silver(spark, dict(step=1)), ONE)
    found = index.unseen(rows.silver(spark, dict(step=1)).repartition(2), TWO)
    text = found._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )
    assert "SortMergeJoin" in text and text.count("Exchange hashpartitioning") == 1 and "Broadcast" not in text
