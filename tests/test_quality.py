import datetime as dt

import pytest
from pyspark.sql import Observation

import rows
from paytrail.operators import activity, metrics, quality, scoring


def _statuses(report):
    return {r["check"]: r.status for r in report.collect()}


def test_bronze(spark):
    good = _statuses(quality.check_bronze(rows.messages(spark, {}, {}), 3))
    assert set(good.values()) == {"passed", "info"} and "files_exist" in good

    changes = [{}] * 97 + [dict(amount=None, isFraud=None, type="GIFT")] * 3
    bad = _statuses(quality.check_bronze(rows.messages(spark, *changes).drop("sentAt")))
    assert bad["null_rate_amount"] == "warning" and bad["null_rate_type"] == "passed"
    assert bad["invalid_labels"] == bad["unknown_type_rate"] == "failed"
    assert bad["required_columns"] == "failed"
    worse = rows.messages(spark, {}, dict(nameDest=None))
    assert _statuses(quality.check_bronze(worse))["null_rate_nameDest"] == "failed"


def test_a_rare_null_is_not_rounded_away(spark):
    changes = [{}] * 30_000 + [dict(amount=None)]
    assert _statuses(quality.check_bronze(rows.messages(spark, *changes)))[
        "null_rate_amount"] == "warning"


def test_missing_columns_are_named(spark):
    report = quality.check_bronze(rows.messages(spark, {}).drop("sentAt", "type"))
    detail = {r["check"]: r.detail for r in report.collect()}
    assert detail["required_columns"] == "type, sentAt" and "null_rate_type" not in detail


def test_bronze_without_files_or_rows(spark):
    messages = rows.messages(spark, {})
    assert _statuses(quality.check_bronze(messages, 0)) == {"files_exist": "failed"}
    empty = _statuses(quality.check_bronze(messages.limit(0), 1))
    assert empty["files_exist"] == "passed" and empty["row_count"] == "failed"
    assert empty["null_rate_type"] == "failed"


@pytest.mark.parametrize("clean, status", [(30, "passed"), (10, "warning"), (9, "failed")])
def test_silver_clean_rate(spark, clean, status):
    changes = [dict(dq_is_clean=i < clean, step=i) for i in range(100)]
    assert _statuses(quality.check_silver(rows.silver(spark, *changes)))["clean_rate"] == status


def test_silver(spark):
    found = _statuses(quality.check_silver(rows.silver(
        spark, dict(dq_balance_mismatch=True), dict(dq_balance_mismatch=True)
    )))
    assert found["duplicates"] == found["mismatch_rate"] == "warning"
    assert found["fraud_rate"] == "passed"
    assert _statuses(quality.check_silver(rows.silver(spark, {}).limit(0))) == {
        "row_count": "failed"}


def test_gold(spark):
    silver = rows.silver(spark, dict(isFraud=1), {})
    alerts, summary = scoring.alerts(silver), activity.summarize(silver)
    report = quality.check_gold(alerts, summary)
    assert set(_statuses(report).values()) == {"passed"}
    details = {r["check"]: r.detail for r in report.collect()}
    assert details["severity_distribution"] == "HIGH=0|MEDIUM=0|LOW=1"
    assert details["score_range"] == "1-1"
    none = _statuses(quality.check_gold(alerts.limit(0), summary.limit(0)))
    assert none["alert_rows"] == none["summary_rows"] == "failed"
    assert none["score_range"] == "info"
    odd = alerts.withColumn("alert_score", alerts.alert_score + 5)
    assert _statuses(quality.check_gold(odd, summary))["score_range"] == "failed"


def test_reconcile_and_verdict(spark):
    day = dt.date(2024, 3, 6)
    silver = rows.silver(spark, {}, {}, dict(transaction_date=day))
    fact = rows.silver(spark, {})
    found = {r.transaction_date: r.status for r in quality.reconcile(silver, fact).collect()}
    assert found == {dt.date(2024, 3, 5): "warning", day: "failed"}
    tables = {"fact_transactions": fact, "fraud_alerts": fact, "transaction_summary": fact}
    report = quality.check_warehouse(silver, tables)
    assert _statuses(report)["reconcile"] == "failed"
    assert quality.verdict(report).first().verdict == "failures"
    same = quality.check_warehouse(fact, tables)
    assert quality.verdict(same).first().asDict() == dict(
        passed=1, warnings=0, failed=0, verdict="all clear")
    duplicate = quality.check_warehouse(silver.where(silver.transaction_date != day), tables)
    assert quality.verdict(duplicate).first().verdict == "warnings"
    assert quality.table_counts(tables).count() == 3


def test_choose_layers(spark):
    layers = {
        "silver": lambda: quality.check_silver(rows.silver(spark, {})),
        "bronze": lambda: quality.check_bronze(rows.messages(spark, {})),
    }
    assert {r.layer for r in quality.run_checks(layers, ["bronze"]).collect()} == {"bronze"}
    assert {r.layer for r in quality.run_checks(layers).collect()} == {"bronze", "silver"}
    with pytest.raises(ValueError):
        quality.run_checks(layers, ["gold"])


def test_assert_unique(spark):
    quality.assert_unique(rows.ledger(spark, {}, dict(step=2)), ["step"])
    with pytest.raises(ValueError, match="1 duplicate"):
        quality.assert_unique(rows.ledger(spark, {}, {}), ["step"], "ledger")


def test_observed_count(spark):
    seen = Observation()
    metrics.count_rows(rows.ledger(spark, {}, {}), seen).collect()
    assert seen.get == {"rows": 2}
