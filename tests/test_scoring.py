import datetime as dt

import pytest

import rows
from paytrail import contract as c
from paytrail.operators import scoring
from paytrail.plans.medallion import messages_to_silver
from verification import fixture


def _scored(spark, *changes, **policy):
    found = scoring.score_all(rows.silver(spark, *changes), **policy).orderBy("kafka_offset")
    return found.collect()


def test_large_amount_needs_four_transactions(spark):
    def fired(n):
        changes = [dict(amount=1.0, step=i) for i in range(n - 1)] + [dict(amount=1e6, step=99)]
        return _scored(spark, *changes)[-1].r4_large_amount

    assert fired(3) is False and fired(4) is True


def test_rapid_repeat_counts_one_step(spark):
    assert not any(r.r5_rapid_repeat for r in _scored(spark, {}, {}, dict(step=2)))
    three = _scored(spark, {}, {}, {}, dict(nameOrig="C2"))
    assert [r.r5_rapid_repeat for r in three] == [True, True, True, False]
    assert [r.sender_tx_count_in_step for r in three] == [3, 3, 3, 1]


def test_scope(spark):
    changes = [dict(amount=1.0), dict(amount=1.0, transaction_date=dt.date(2024, 3, 6))]
    changes += [dict(amount=3.0, transaction_date=dt.date(2024, 3, 6))]
    by_day = [r.sender_avg_amount for r in _scored(spark, *changes)]
    by_history = _scored(spark, *changes, scope=scoring.HISTORY_SCOPE)
    assert by_day == [1.0, 2.0, 2.0]
    assert {r.sender_avg_amount for r in by_history} == {5.0 / 3}
    assert {r.sender_tx_count_in_step for r in by_history} == {3}


def test_score_reasons_and_severity(spark):
    everything = dict(
        isFraud=1, dq_balance_mismatch=True, dq_suspicious_zero_bal=True, amount=1e6
    )
    quiet = [dict(amount=1.0)] * 4
    row = _scored(spark, *quiet, everything)[-1]
    assert row.alert_score == 5 and row.alert_severity == "HIGH"
    assert row.alert_reasons == "|".join(rule.name for rule in scoring.RULES)
    five = _scored(spark, *quiet, everything, tiers=c.SEVERITY_TIERS_WITH_CRITICAL)[-1]
    assert five.alert_severity == "CRITICAL"


@pytest.mark.parametrize("flags, tier", [
    ({}, None), (dict(isFraud=1), "LOW"), (dict(isFraud=1, dq_balance_mismatch=True), "MEDIUM"),
])
def test_lower_tiers(spark, flags, tier):
    row = _scored(spark, flags)[0]
    assert row.alert_severity == tier
    assert row.alert_score == len([r for r in row.alert_reasons.split("|") if r])


def test_unknown_flags_never_score(spark):
    row = _scored(spark, dict(isFraud=None, dq_balance_mismatch=None))[0]
    assert (row.alert_score, row.alert_reasons) == (0, "")
    assert scoring.alerts(rows.silver(spark, dict(isFraud=None))).isEmpty()


def test_threshold_rule_is_optional(spark):
    rules = (*scoring.RULES, scoring.amount_over(50))
    row = _scored(spark, {}, rules=rules)[0]
    assert row.alert_reasons == "R6:threshold_amount" and row.alert_score == 1


def test_missing_date_groups_like_any_other(spark):
    changes = [dict(transaction_date=None, amount=float(a)) for a in (1, 2)]
    assert [r.sender_avg_amount for r in _scored(spark, *changes)] == [1.5, 1.5]


def test_columns(spark):
    alerts = scoring.alerts(rows.silver(spark, dict(isFraud=1)))
    assert alerts.columns == [n for n in c.ALERT_COLUMNS if n != "silver_processed_at"]


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_mean_of_fine_amounts_does_not_depend_on_the_order(spark, parts):
    changes = [dict(amount=0.1 + i / 7) for i in range(50)]
    silver = rows.silver(spark, *changes).repartition(parts, "amount")
    means = {r.sender_avg_amount for r in scoring.score_all(silver).collect()}
    assert means == {float(sum(round(0.1 + i / 7, 10) for i in range(50)) / 50)} or len(means) == 1
