"""Plans: what must hold at any scale is asserted, not hoped for."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

import rows
from paytrail.functions.calendar import day_filter, day_folder
from paytrail.operators import activity, cleaning, scoring
from paytrail.operators.quantile import exact_quantile
from paytrail.plans import views
from paytrail.plans.medallion import to_silver
from paytrail.session import prepare
from paytrail.sources import tables
from paytrail.streaming import ingest
from verification import fixture


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Silver on files, so plans start at a scan."""
    path = str(tmp_path_factory.mktemp("silver") / "t")
    rows.silver(spark, *[dict(step=i, isFraud=i % 2) for i in range(40)]).write.parquet(path)
    return spark.read.parquet(path)


def test_silver_shuffles_once_and_limits_copies_before(spark, tmp_path):
    path = str(tmp_path / "bronze")
    rows.messages(spark, {}).write.parquet(path)
    text = plan(to_silver(spark.read.parquet(path)))
    assert text.count("Exchange") == 1
    before = text[text.index("Exchange"):]
    assert re.search(r"WindowGroupLimit .*Partial", before)
    assert "Python" not in text


def test_summary_aggregates_before_its_shuffles(stored):
    text = plan(activity.summarize(stored))
    assert "Expand" not in text and "SortAggregate" not in text
    assert "ObjectHashAggregate" not in text
    assert text.count("Exchange hashpartitioning") == 2
    assert all("partial_" in part.split("Scan")[0] or "HashAggregate" in part.split("Scan")[0]
               for part in text.split("Exchange hashpartitioning")[1:])


def test_a_task_of_the_summary_reads_a_bounded_part(spark, tmp_path):
    """Account-days that compress to some 30 MB come to several tasks, however few cores there are."""
    path = str(tmp_path / "many")
    other = spark.newSession()
    other.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    other.conf.set("spark.sql.shuffle.partitions", "8")
    prepare(other)
    rows.silver(spark, {}).drop("nameOrig", "kafka_offset").crossJoin(
        spark.range(0, 300_000, 1, 4).select(F.sha2(F.col("id").cast("string"), 256).alias("nameOrig"),
                                             F.col("id").alias("kafka_offset"))
    ).write.parquet(path)
    found = activity.summarize(other.read.parquet(path)).select("nameOrig", "unique_recipients")
    assert found.rdd.getNumPartitions() > 1
    assert found.agg(F.count("*"), F.sum("unique_recipients")).first() == (300_000, 300_000)


def test_join_strategy_reads_only_what_it_needs(stored, no_broadcast):
    text = plan(scoring.alerts(stored))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    narrow = min(schemas, key=len)
    assert {part.split(":")[0] for part in narrow.split(",")} == {
        "step", "amount", "nameOrig", "transaction_date"}


def test_hot_sender_is_split_over_tasks(spark, tmp_path, no_broadcast):
    """One sender and step with most rows: adaptive execution splits its partition."""
    path = str(tmp_path / "hot")
    base = rows.silver(spark, {})
    many = base.drop("nameOrig", "kafka_offset").crossJoin(
        spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.concat(F.lit("C"), F.col("id"))).otherwise("HOT")
            .alias("nameOrig"),
            F.col("id").alias("kafka_offset"),
        )
    )
    many.write.parquet(path)
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        scored = scoring.score_all(spark.read.parquet(path))
        assert "skew=true" in executed(scored)
        counts = scored.groupBy("nameOrig").agg(F.max("sender_tx_count_in_step").alias("n"))
        assert counts.where("nameOrig = 'HOT'").first().n == 40_000
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_median_orders_no_whole_group(stored):
    text = plan(exact_quantile(stored, ["type"], "amount", 0.5, "m"))
    windows = re.findall(r"Window \[.*?\], \[([^\]]*)\], \[([^\]]*)\]", text)
    by_value = [keys for keys, order in windows if "_value" in order]
    assert by_value and all("_bucket" in keys for keys in by_value)


def test_day_filters_prune_folders(spark, tmp_path):
    root = str(tmp_path / "days")
    for day in (dt.date(2024, 3, 5), dt.date(2024, 3, 6)):
        tables.write_table(rows.ledger(spark, {}), day_folder(root, day))
    pruned = tables.read_days(spark, root).where(day_filter(day))
    assert pruned.first().month == "03"
    text = plan(pruned)
    assert "PartitionFilters: [isnotnull" in text or "PartitionFilters: [(lpad" in text
    assert len(pruned.inputFiles()) >= 1 and pruned.count() == 1
    assert all("day=06" in f for f in tables.read_day(spark, root, day).inputFiles())


def test_top_accounts_sort_no_more_than_they_keep(stored):
    summary = activity.summarize(stored).withColumnRenamed("nameOrig", "name_orig")
    assert "TakeOrderedAndProject(limit=100" in plan(views.top_risk_accounts(summary))


def test_a_key_with_very_many_copies(spark):
    copies = rows.messages(spark, {}).drop("kafka_offset").crossJoin(
        spark.range(50_000).withColumnRenamed("id", "kafka_offset"))
    kept = cleaning.latest_only(copies).collect()
    assert len(kept) == 1 and kept[0].kafka_offset == 49_999


def test_a_message_is_parsed_once(spark, sf_dir):
    routed = ingest.routed(fixture.envelope(fixture.events(spark, sf_dir)))
    optimized = routed._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("from_json(") == 1
