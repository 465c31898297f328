"""Clustered days, bucketed tables, and reports from partial aggregates."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

import rows
from paytrail.operators import activity, clustering, publishing, scoring
from paytrail.plans import partials, views
from paytrail.sources import catalog
from paytrail.sources.snapshots import DayTable

DAY, NEXT = dt.date(2024, 3, 5), dt.date(2024, 3, 6)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(4)
    changes = [
        dict(
            nameOrig="HOT" if i % 3 == 0 else f"C{rng.randint(1, 60)}", step=rng.randint(1, 48), isFraud=int(i % 11 == 0),
            amount=None if i % 97 == 0 else round(rng.lognormvariate(6, 2), 2), transaction_date=rng.choice([DAY, NEXT]),
            transaction_hour=rng.randint(0, 23), type=rng.choice(["PAYMENT", "TRANSFER", "DEBIT"]),
            dq_balance_mismatch=i % 5 == 0, dq_is_clean=i % 7 != 0,
        ) for i in range(3000)
    ]
    silver = rows.silver(spark, *changes)
    stamp = F.timestamp_add("MINUTE", F.col("step").cast("int"), F.lit("2024-03-07").cast("timestamp"))
    return {
        views.FACT: publishing.shape(silver, views.FACT, stamp),
        views.ALERTS: publishing.shape(scoring.alerts(silver), views.ALERTS, stamp),
        views.SUMMARY: publishing.shape(activity.summarize(silver), views.SUMMARY, F.lit("2024-03-07").cast("timestamp")),
    }


def content(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def _plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )


# --- partial aggregates


@pytest.mark.parametrize("name", sorted(partials.REPORTS))
def test_reports_from_partials_equal_the_views(tables, name):
    table, build = partials.REPORTS[name]
    assert content(build(partials.PARTIALS[table](tables[table]))) == content(views.build(name, tables))


def test_a_rerun_replaces_a_day_and_no_fact_is_read(spark, tables, tmp_path):
    table = DayTable(spark, str(tmp_path / "partials"))
    fact = tables[views.FACT]
    table.publish(partials.fact_partials(fact.unionByName(fact.where(F.col("transaction_date") == F.lit(DAY)))))
    table.publish(partials.fact_partials(fact), DAY)
    report = partials.daily_fraud_trend(table.read())
    assert content(report) == content(views.daily_fraud_trend(fact))
    assert all("/partials/" in f for f in report.inputFiles())


def test_no_partials_give_the_reports_of_empty_tables(tables):
    for name in ("v_kpi_fraud_rate", "v_kpi_alert_summary"):
        table, build = partials.REPORTS[name]
        none = tables[table].where(F.lit(False))
        assert content(build(partials.PARTIALS[table](none))) == content(views.build(name, {table: none}))


def test_fine_and_huge_sums_merge_as_they_add_up(spark):
    for values in ([0.1, 0.25, 1.0], [1e-11] * 10, [0.00001, 3.0], [1e300, 1e300], [None, None], [1e16, 0.01]):
        fact = rows.silver(spark, *[dict(amount=v, transaction_hour=i % 2, isFraud=0) for i, v in enumerate(values)])
        shaped = publishing.shape(fact, views.FACT, F.lit("2024-03-07").cast("timestamp"))
        merged = partials.daily_fraud_trend(partials.fact_partials(shaped)).first()
        whole = views.daily_fraud_trend(shaped).first().total_amount
        assert merged.total_amount == (whole if whole is None else pytest.approx(whole, rel=1e-12))
        assert whole is None or whole == pytest.approx(sum(values), rel=1e-12)


def test_sketched_medians_have_their_rank(tables):
    fact = tables[views.FACT]
    found = partials.within_rank(fact, partials.median_by_type(partials.fact_partials(fact))).collect()
    assert len(found) == 3 and all(r.within_bound for r in found)
    shifted = partials.median_by_type(partials.fact_partials(fact)).withColumn("median_amount", F.col("median_amount") * 1.5)
    assert not any(r.within_bound for r in partials.within_rank(fact, shifted).collect())


# --- clustering


def test_the_curve_interleaves_bits(spark):
    parts = spark.range(1).select(clustering.interleaved([F.lit(0b101), F.lit(0b011)], 3).alias("z")).first()
    assert parts.z == 0b011011


def test_a_lookup_opens_few_files_and_finds_all(spark, tables, tmp_path):
    table = DayTable(spark, str(tmp_path / "clustered"))
    fact = tables[views.FACT]
    table.publish(fact.where(F.col("transaction_date") == F.lit(NEXT)))
    table.commit(table.stage_clustered(fact, DAY, ["step", "amount", "name_orig"], 64))
    every = table.read([DAY])
    assert content(every) == content(fact.where(F.col("transaction_date") == F.lit(DAY)).select(*every.columns))
    total = len(every.inputFiles())
    assert total >= 48
    for within in ({"step": (5, 8), "amount": (100.0, 300.0)}, {"name_orig": ("C17", "C17"), "step": (1, 12)}, {"step": (99, 100)}):
        found = table.look_up(within)
        assert content(found) == content(table.read().where(clustering.inside(within)).select(*found.columns))
        opened = [f for f in table.look_up(within, [DAY]).inputFiles()]
        assert len(opened) <= total // 4, (within, len(opened))


def test_a_hot_value_is_spread_over_files(spark, tmp_path):
    table = DayTable(spark, str(tmp_path / "hot"))
    same = spark.range(4000).selectExpr("DATE'2024-03-05' AS transaction_date", "1.0D AS amount", "if(id % 3 > 0, 'HOT', 'C') AS name")
    table.commit(table.stage_clustered(same, DAY, ["amount", "name"], 16))
    sizes = [r[0] for r in table.read().groupBy("_metadata.file_path").count().select("count").collect()]
    assert len(sizes) >= 12 and max(sizes) < 1000


def test_nulls_are_kept_and_outside_every_range(spark, tmp_path):
    table = DayTable(spark, str(tmp_path / "nulls"))
    some = spark.createDataFrame([(DAY, None, "a"), (DAY, 1.0, None), (DAY, None, None)], "transaction_date date, amount double, name string")
    table.commit(table.stage_clustered(some, DAY, ["amount", "name"], 2))
    assert table.read().count() == 3 and table.look_up({"amount": (0.0, 2.0)}).count() == 1
    table.commit(table.stage_clustered(some.limit(0), DAY, ["amount", "name"], 2))
    assert table.look_up({"amount": (0.0, 2.0)}).isEmpty()


# --- buckets


def test_bucketed_tables_join_without_a_shuffle(spark, tables):
    for name, df in tables.items():
        catalog.save_bucketed(df, f"b_{name}", "name_orig", 4)
    found = views.alerts_with_history({name: spark.table(f"b_{name}") for name in tables})
    try:
        text = _plan(found)
        assert "SortMergeJoin" in text and not re.search(r"Exchange|Broadcast", text)
        assert content(found) == content(views.alerts_with_history(tables))
    finally:
        for name in tables:
            spark.sql(f"DROP TABLE b_{name}")
