"""The batch feed of the topic, deep slices and the quality gate."""

import pytest
from pyspark.sql import functions as F

import rows
from paytrail import contract as c
from paytrail.plans import feed
from paytrail.sources.ledger_file import POSITION, ledger_slice, numbered


def _ledger(spark, *types):
    data = [rows.LEDGER | {"type": t, "step": i} for i, t in enumerate(types)]
    return spark.createDataFrame([[r[n] for n in c.LEDGER_SCHEMA.names] for r in data], c.LEDGER_SCHEMA)


def test_counts_are_those_of_the_rows_sent(spark, tmp_path):
    sent = []
    counts = feed.run_feed(
        _ledger(spark, "PAYMENT", "TRANSFER", None, "GIFT"), lambda m: sent.extend(m.collect()),
        order=["step"], skip=1,
    )
    assert (counts["sent"], counts["unknown_type"]) == (3, 2)
    assert [r.type for r in sent] == ["TRANSFER", None, "GIFT"] and sent[0].sentAt


def test_an_empty_ledger_sends_nothing(spark):
    counts = feed.run_feed(_ledger(spark, "PAYMENT").where("false"), lambda m: m.collect())
    assert counts == {"sent": 0, "fraud": 0, "unknown_type": 0}


def test_a_slice_needs_an_order(spark):
    with pytest.raises(ValueError):
        feed.run_feed(_ledger(spark, "PAYMENT"), lambda m: None, limit=1)


@pytest.mark.parametrize("skip, limit", [(0, 5), (3, None), (0, 0), (17, 40), (99, 10), (200, None), (200, 3)])
def test_deep_slices_equal_shallow_ones(spark, skip, limit):
    df = spark.range(100).select((F.col("id") * 37 % 100).alias("k"), F.col("id").alias("v")).repartition(7)
    want = sorted((r.k, r.v) for r in df.collect())[skip:][:limit]
    got = ledger_slice(df, ["k"], skip, limit, one_task=0).collect()
    assert [(r.k, r.v) for r in got] == want


def test_positions_have_no_gap_and_an_empty_table_has_none(spark):
    df = spark.range(1000).withColumn("k", F.hash("id")).repartition(9)
    found = numbered(df, ["k", "id"]).orderBy("k", "id").select(POSITION).collect()
    assert [r[0] for r in found] == list(range(1000))
    assert numbered(df.where("false"), ["k"]).isEmpty()
