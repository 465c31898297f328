import datetime as dt

import rows
from paytrail import contract as c
from paytrail.operators import activity, scoring


def _one(spark, *changes):
    found = activity.summarize(rows.silver(spark, *changes)).collect()
    assert len(found) == 1
    return found[0]


def test_measures(spark):
    row = _one(
        spark,
        dict(step=2, amount=10.0, oldbalanceOrg=90.0, newbalanceOrig=80.0, kafka_offset=1),
        dict(step=1, amount=20.5, oldbalanceOrg=70.0, newbalanceOrig=60.0, kafka_offset=9,
             type="TRANSFER", nameDest="M2", transaction_hour=0, dq_balance_mismatch=True),
        dict(step=2, amount=30.0, oldbalanceOrg=50.0, newbalanceOrig=40.0, kafka_offset=7,
             type="GIFT", transaction_hour=23, isFraud=1, isSuspicious=True, dq_is_clean=None,
             dq_suspicious_zero_bal=True),
        dict(step=2, amount=30.0, kafka_offset=3, type="LOAN", nameDest="M2"),
    )
    assert (row.tx_count, row.total_amount_sent, row.avg_amount) == (4, 90.5, 22.625)
    assert (row.max_amount, row.min_amount, row.total_balance_drop) == (30.0, 10.0, 400.0)
    assert (row.opening_balance, row.closing_balance) == (70.0, 40.0)
    assert (row.fraud_tx_count, row.suspicious_tx_count) == (1, 1)
    assert (row.balance_mismatch_count, row.full_drain_count) == (1, 1)
    assert (row.unique_recipients, row.unique_tx_types, row.hours_active) == (2, 4, 3)
    assert (row.tx_payment_count, row.tx_transfer_count, row.tx_debit_count) == (1, 1, 0)
    assert row.clean_tx_count == 3 and row.account_risk_level == "HIGH"


def test_risk_ladder(spark):
    level = lambda **change: _one(spark, change).account_risk_level
    assert level(isFraud=1, isSuspicious=True) == "HIGH"
    assert level(isSuspicious=True) == "MEDIUM"
    assert level(dq_balance_mismatch=True) == "LOW"
    assert level(dq_balance_mismatch=None) == "NORMAL"


def test_accounts_and_days_are_apart_and_missing_dates_kept(spark):
    found = activity.summarize(rows.silver(
        spark, {}, dict(nameOrig="C2"), dict(transaction_date=dt.date(2024, 3, 6)),
        dict(transaction_date=None, transaction_hour=None),
    )).collect()
    assert len(found) == 4
    assert sum(r.tx_count for r in found) == 4
    assert next(r for r in found if r.transaction_date is None).hours_active == 0


def test_type_counts_add_up(spark):
    changes = [dict(type=kind) for kind in c.TRANSACTION_TYPES] * 2
    row = _one(spark, *changes)
    assert sum(row[f"tx_{k.lower()}_count"] for k in c.TRANSACTION_TYPES) == row.tx_count == 10
    assert row.unique_tx_types == 5


def test_alert_counts(spark):
    silver = rows.silver(
        spark, dict(isFraud=1), {}, dict(nameOrig="C2"), dict(nameOrig="C3", transaction_date=None,
                                                               isFraud=1)
    )
    counted = activity.with_alert_counts(activity.summarize(silver), scoring.alerts(silver))
    assert {r.nameOrig: r.alert_tx_count for r in counted.collect()} == {"C1": 1, "C2": 0, "C3": 1}
