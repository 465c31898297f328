import datetime as dt

import rows
from paytrail import contract as c
from paytrail.operators import cleaning, metrics
from paytrail.plans.medallion import to_silver
from pyspark.sql import functions as F


def test_cast_tidies_and_tolerates_drift(spark):
    drifted = rows.messages(spark, dict(type=" transfer ", nameOrig=" C9 ")).withColumns({
        "amount": F.lit("not a number"), "step": F.lit("12"), "isFraud": F.lit(1.0),
    })
    found = cleaning.cast_types(drifted).first()
    assert (found.type, found.nameOrig, found.amount) == ("TRANSFER", "C9", None)
    assert (found.step, found.isFraud) == (12, 1)


def test_time_is_utc_and_unreadable_text_is_null(spark):
    found = cleaning.standardize_time(rows.messages(
        spark, {}, dict(sentAt="2024-03-05T23:30:00-02:00"), dict(sentAt="soon"), dict(sentAt=None)
    )).orderBy("kafka_offset").collect()
    assert found[0].sentAt == dt.datetime(2024, 3, 5, 10, 20, 30, 123456)
    assert (found[1].transaction_date, found[1].transaction_hour) == (dt.date(2024, 3, 6), 1)
    assert found[2].sentAt is None and found[3].transaction_date is None


def _flags(spark, **change):
    return cleaning.flag_quality(rows.messages(spark, change)).first()


def test_each_flag(spark):
    assert _flags(spark).dq_is_clean is True
    assert _flags(spark, nameDest=None).dq_null_critical is True
    assert _flags(spark, amount=0.0).dq_negative_amount is True
    assert _flags(spark, type="GIFT").dq_unknown_type is True
    assert _flags(spark, isFraud=7).dq_invalid_fraud_label is True
    assert _flags(spark, balanceDropOrig=101.01).dq_balance_mismatch is True
    assert _flags(spark, balanceDropOrig=101.0).dq_balance_mismatch is False
    drained = _flags(spark, newbalanceOrig=0.0)
    assert drained.dq_suspicious_zero_bal is True and drained.dq_is_clean is True


def test_unknown_flags_stay_unknown(spark):
    found = _flags(spark, isFraud=None)
    assert found.dq_invalid_fraud_label is None and found.dq_is_clean is None
    assert _flags(spark, isFraud=None, amount=-1.0).dq_is_clean is False
    assert _flags(spark, balanceDropOrig=None).dq_balance_mismatch is None


def test_mismatch_policy(spark):
    messages = rows.messages(
        spark, dict(type="CASH_IN", balanceDropOrig=-9.0),
        dict(type="TRANSFER", balanceDropOrig=-9.0),
    )
    flagged = cleaning.flag_quality(messages, ("TRANSFER", "CASH_OUT")).orderBy("kafka_offset")
    assert [r.dq_balance_mismatch for r in flagged.collect()] == [False, True]


def test_incomplete_rows_go_and_gaps_are_filled(spark):
    gaps = {name: None for name in c.NULL_DEFAULTS}
    bad = [{name: None} for name in c.CRITICAL_COLUMNS] + [dict(amount=float("nan"))]
    messages = rows.messages(spark, gaps, *bad)
    kept = cleaning.fill_missing(cleaning.drop_incomplete(messages)).collect()
    assert len(kept) == 1
    assert {name: kept[0][name] for name in c.NULL_DEFAULTS} == c.NULL_DEFAULTS


def test_latest_copy_wins(spark):
    key = dict(amount=7.0)
    messages = rows.messages(
        spark, key | dict(kafka_offset=5), key | dict(kafka_offset=9),
        dict(amount=8.0, kafka_offset=4, kafka_partition=2),
        dict(amount=8.0, kafka_offset=4, kafka_partition=1),
    )
    kept = {r.amount: r for r in cleaning.latest_only(messages).collect()}
    assert len(kept) == 2 and kept[7.0].kafka_offset == 9 and kept[8.0].kafka_partition == 1
    assert cleaning.surplus_copies(messages).first().duplicate_rows == 2
    assert cleaning.surplus_copies(messages.limit(0)).first().duplicate_rows == 0


def test_flags_are_set_before_gaps_are_filled(spark):
    found = to_silver(rows.messages(spark, dict(balanceDropOrig=None))).first()
    assert found.balanceDropOrig == 0.0 and found.dq_balance_mismatch is None


def test_metrics(spark):
    silver = to_silver(rows.messages(
        spark, {}, dict(amount=7.0), dict(amount=8.0, isFraud=1, newbalanceOrig=0.0)
    ))
    assert metrics.silver_metrics(silver).first().asDict() == dict(
        total_rows=3, clean_rows=1, clean_pct=33.3, fraud_rows=1, mismatch_rows=2,
        zero_balance_rows=1,
    )
    assert metrics.silver_metrics(silver.limit(0)).first().clean_pct is None
