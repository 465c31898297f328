import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paytrail.functions import calendar, money
from paytrail.operators.quantile import exact_quantile
from paytrail.session import prepare, shared_dir


def _total(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    return df.agg(money.total(F.col("v")).alias("t"), money.mean(F.col("v")).alias("m")).first()


def test_whole_cents_are_added_exactly(spark):
    values = [0.1, 0.2, 0.3] * 1000 + [1e12 + 0.01]
    random.Random(1).shuffle(values)
    assert _total(spark, values).t == 1000000000600.01


def test_anything_else_falls_back_to_the_double_sum(spark):
    assert _total(spark, [0.001, 0.002]).t == pytest.approx(0.003)
    assert _total(spark, [1e300, 1.0]).t == 1e300
    assert _total(spark, [9e16, 9e16]).t == 1.8e17
    assert str(_total(spark, [float("nan"), 1.0]).t) == "nan"


def test_empty_and_missing(spark):
    assert _total(spark, []).asDict() == {"t": None, "m": None}
    assert _total(spark, [None, 1.5]).asDict() == {"t": 1.5, "m": 1.5}


def test_minute_boundaries(spark):
    row = spark.sql("SELECT timestamp'2024-01-01 00:00:59' a, timestamp'2024-01-01 00:01:01' b")
    assert row.select(calendar.minutes_between(F.col("a"), F.col("b"))).first()[0] == 1


def test_day_folder():
    assert calendar.day_folder("/x", dt.date(2024, 3, 5)) == "/x/year=2024/month=03/day=05"


def _expected(values, q):
    ordered = sorted(values)
    position = (len(ordered) - 1) * q
    low, high = ordered[int(position)], ordered[min(int(position) + 1, len(ordered) - 1)]
    return low + (high - low) * (position - int(position))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(st.sampled_from("ab"), st.floats(-1e9, 1e9)), min_size=1, max_size=60),
    st.sampled_from([0.0, 0.25, 0.5, 0.9, 1.0]),
)
def test_quantile_against_brute_force(spark, data, q):
    df = spark.createDataFrame(data, "k string, v double")
    found = {r.k: r.x for r in exact_quantile(df, ["k"], "v", q, "x").collect()}
    for key in {k for k, _ in data}:
        expected = _expected([v for k, v in data if k == key], q)
        assert found[key] == pytest.approx(expected, rel=1e-12, abs=1e-9)


def test_quantile_with_repeats_missing_groups_and_values(spark):
    data = [("a", 1.0)] * 900 + [("a", 2.0)] * 100 + [(None, 4.0), (None, 5.0), ("b", None)]
    df = spark.createDataFrame(data, "k string, v double")
    found = {r.k: r.x for r in exact_quantile(df, ["k"], "v", 0.5, "x").collect()}
    assert found == {"a": 1.0, None: 4.5}


def test_quantile_of_values_that_are_no_numbers(spark):
    data = [("a", float("inf")), ("a", float("-inf")), ("a", 1.0), ("b", float("nan")), ("b", 2.0),
            ("b", 3.0)]
    df = spark.createDataFrame(data, "k string, v double")
    found = {r.k: r.x for r in exact_quantile(df, ["k"], "v", 0.5, "x").collect()}
    assert found == {"a": 1.0, "b": 3.0}


def test_shared_dir_comes_from_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark, "x").startswith(base)
    assert shared_dir(spark, "x") != shared_dir(spark, "x")
    assert prepare(spark).conf.get("spark.sql.session.timeZone") == "UTC"


def test_a_task_reads_no_more_than_bounded(spark):
    advised, split = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"
    other = spark.newSession()
    other.conf.set(advised, "64MB")
    prepare(other)
    assert (other.conf.get(advised), other.conf.get(split)) == ("16MB", "32MB")
    other.conf.set(advised, "8m")
    other.conf.set(split, str(1 << 20))
    prepare(other)
    assert (other.conf.get(advised), other.conf.get(split)) == ("8m", str(1 << 20))
