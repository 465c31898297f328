import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

import rows
from paytrail import contract as c
from paytrail.operators import activity, publishing, scoring
from paytrail.plans import views
from paytrail.functions.calendar import day_folder
from paytrail.sources import catalog, tables
from paytrail.sources.snapshots import DayTable

def _stamp():
    return F.lit("2024-03-07 00:00:00").cast("timestamp")


def _md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def _shaped(spark, *changes):
    silver = rows.silver(spark, *changes)
    return {
        views.FACT: publishing.shape(silver, views.FACT, _stamp()),
        views.ALERTS: publishing.shape(scoring.alerts(silver), views.ALERTS, _stamp()),
        views.SUMMARY: publishing.shape(activity.summarize(silver), views.SUMMARY, _stamp()),
    }


def test_ids(spark):
    shaped = _shaped(spark, dict(amount=1e7, isFraud=1))
    assert shaped[views.FACT].first().transaction_id == _md5("C1-1-10000000.00-M1")
    assert shaped[views.ALERTS].first().alert_id == _md5("alert-C1-1-10000000.00")
    assert shaped[views.SUMMARY].first().summary_id == _md5("summary-C1-2024-03-05")


def test_ids_tell_apart_amounts_below_a_cent(spark):
    shaped = _shaped(spark, dict(amount=1.001), dict(amount=1.002))
    assert shaped[views.FACT].select("transaction_id").distinct().count() == 2


def test_declared_columns_in_order(spark):
    for name, df in _shaped(spark, dict(isFraud=1)).items():
        declared = c.WAREHOUSE_TABLES[name][0]
        stamps = {"silver_processed_at", "gold_processed_at"}
        assert df.columns == [n for n in declared.names if n not in stamps]
        assert {f.name: f.dataType for f in df.schema.fields}.items() <= {
            f.name: f.dataType for f in declared.fields}.items()


def test_name_helpers(spark):
    df = rows.ledger(spark, {}).select("step", "nameOrig")
    assert publishing.upper_names(df).columns == ["STEP", "NAMEORIG"]
    assert publishing.rename_present(df, c.WAREHOUSE_NAMES).columns == ["step", "name_orig"]
    assert publishing.keep_present(df, ["gone", "nameOrig"]).columns == ["nameOrig"]


def test_publish_replaces_days_and_keeps_others(spark, tmp_path):
    table = DayTable(spark, str(tmp_path / "fact"))
    two_days = _shaped(spark, {}, {}, dict(transaction_date=dt.date(2024, 3, 6)))[views.FACT]
    assert table.publish(two_days, cluster_by=["type"]) == 3
    assert table.publish(two_days, cluster_by=["type"]) == 3
    assert table.read().count() == 3
    assert table.publish(_shaped(spark, {})[views.FACT]) == 1
    assert table.read().count() == 2
    assert table.publish(two_days.limit(0)) == 0
    assert table.read().count() == 2
    day = dt.date(2024, 3, 6)
    assert table.publish(two_days.limit(0), day) == 0
    assert table.read().count() == 1
    assert table.publish(two_days, day) == 1
    assert table.read().count() == 2


def test_catalog_table_and_sql(spark, tmp_path):
    table = DayTable(spark, str(tmp_path / "fraud_alerts"))
    alerts = _shaped(spark, dict(isFraud=1))[views.ALERTS]
    table.publish(alerts, cluster_by=["alert_severity"])
    catalog.create_table(spark, "fraud_alerts", table)
    query = "SELECT NAME_ORIG FROM fraud_alerts WHERE transaction_date = :day"
    first, later = dt.date(2024, 3, 5), dt.date(2024, 3, 6)
    found = catalog.run_sql(spark, query, {"day": first})
    assert [r[0] for r in found.collect()] == ["C1"]
    assert catalog.run_sql(spark, query, {"day": later}).isEmpty()
    assert "PartitionFilters: [isnotnull(transaction_date" in _plan(found)
    table.publish(alerts.withColumn("transaction_date", F.lit(later)), later)
    catalog.show_day("fraud_alerts", table, later)
    catalog.show_day("not_declared", table, later)
    assert catalog.run_sql(spark, query, {"day": later}).count() == 1
    table.publish(alerts.unionByName(alerts).withColumn("name_orig", F.lit("C2")), first)
    catalog.show_day("fraud_alerts", table, first)
    assert [r[0] for r in catalog.run_sql(spark, query, {"day": first}).collect()] == ["C2", "C2"]
    table.publish(alerts.limit(0), first)
    catalog.show_day("fraud_alerts", table, first)
    assert catalog.run_sql(spark, query, {"day": first}).isEmpty()
    spark.sql("DROP TABLE fraud_alerts")


def _plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def test_registered_views(spark):
    names = views.register(_shaped(spark, dict(isFraud=1), {}))
    assert len(names) == 3 + len(views.VIEWS)
    assert spark.sql("SELECT fraud_count FROM v_fraud_by_type").first()[0] == 1
    for name in names:
        spark.catalog.dropTempView(name)


def test_buckets_and_missing_amount(spark):
    changes = [dict(amount=a) for a in (999.99, 1000.0, 9999.0, 50000.0, 499999.0, 5e5, None)]
    found = views.amount_distribution(_shaped(spark, *changes)[views.FACT]).collect()
    assert [(r.bucket_order, r.transaction_count) for r in found] == [
        (1, 1), (2, 2), (4, 1), (5, 1), (6, 2)]
    assert found[-1].amount_bucket == "> $500K" and found[-1].total_amount == 5e5


def test_sort_orders(spark):
    changes = [dict(step=1, isFraud=1), dict(step=2, isFraud=1, dq_balance_mismatch=True),
               dict(step=3, isFraud=1, dq_balance_mismatch=True, dq_suspicious_zero_bal=True)]
    shaped = _shaped(spark, *changes)
    order = [r.alert_severity for r in views.alert_detail(shaped[views.ALERTS]).collect()]
    assert order == ["MEDIUM", "LOW", "HIGH"]
    summary = shaped[views.SUMMARY]
    levels = ["NORMAL", "LOW", "HIGH", "MEDIUM"]
    mixed = summary.withColumn("account_risk_level", F.explode(F.array(*map(F.lit, levels))))
    found = views.account_risk_distribution(mixed).collect()
    assert [r.account_risk_level for r in found] == list(c.RISK_LEVELS)
    pattern = views.account_activity_patterns(mixed).first()
    assert (pattern.risk_level, pattern.worst_risk_level) == ("NORMAL", "HIGH")
    assert views.kpi_account_risk(mixed).first().asDict() == dict(
        total_accounts=1, high_risk_accounts=1, medium_risk_accounts=1, low_risk_accounts=1,
        normal_accounts=1)


def test_top_accounts_stop_at_a_hundred(spark):
    shaped = _shaped(spark, *[dict(nameOrig=f"C{i:03}", isFraud=1) for i in range(120)])
    top = views.top_risk_accounts(shaped[views.SUMMARY]).collect()
    assert [r.name_orig for r in top] == [f"C{i:03}" for i in range(100)]
    assert views.high_risk_accounts(shaped[views.SUMMARY]).count() == 120


def test_load_duration_counts_minute_boundaries(spark):
    fact = _shaped(spark, {}, {})[views.FACT]
    times = F.when(F.col("kafka_offset") == 1, "2024-03-07 00:00:59").otherwise(
        "2024-03-07 00:01:01").cast("timestamp")
    row = views.pipeline_load_history(fact.withColumn("loaded_at", times)).first()
    assert row.load_duration_mins == 1 and row.rows_loaded == 2


def test_rates_of_empty_tables_are_null(spark):
    fact = _shaped(spark, {})[views.FACT].limit(0)
    row = views.kpi_fraud_rate(fact).first()
    assert row.total_transactions == 0 and row.fraud_rate_pct is None


def test_gates(spark, tmp_path):
    day, root = dt.date(2024, 3, 5), str(tmp_path / "days")
    with pytest.raises(tables.DataGateError):
        tables.require_files(spark, root, day)
    tables.write_table(rows.ledger(spark, {}).coalesce(1), day_folder(root, day))
    assert tables.require_files(spark, root, day) == 1
    with pytest.raises(tables.DataGateError, match="at least 2"):
        tables.require_files(spark, root, day, 2)
    table = DayTable(spark, str(tmp_path / "table"))
    with pytest.raises(tables.DataGateError):
        tables.require_day(table, day)
    shaped = _shaped(spark, dict(isFraud=1))
    table.stage(shaped[views.FACT], day)
    with pytest.raises(tables.DataGateError):
        tables.require_day(table, day)
    table.publish(shaped[views.FACT], day)
    tables.require_day(table, day)
    tables.require_rows(shaped, day)
    with pytest.raises(tables.DataGateError, match="transaction_summary"):
        tables.require_rows(shaped, dt.date(2024, 3, 6))


def test_read_and_write_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    ledger = rows.ledger(spark, {}, dict(type="DEBIT"))
    tables.write_table(ledger, path, ["type"])
    assert tables.read_table(spark, path).count() == 2
    tables.write_table(ledger, path, ["type"], mode="append")
    narrow = tables.read_table(spark, path, c.T.StructType([c.T.StructField("step",
                                                                           c.T.LongType())]))
    assert narrow.count() == 4 and "amount" not in narrow.columns
    tables.write_table(ledger.limit(0), path)
    with pytest.raises(ValueError, match="no data"):
        tables.read_table(spark, path, c.LEDGER_SCHEMA)
