import json

import pytest
from pyspark.sql import functions as F

import rows
from paytrail.operators import routing
from paytrail.operators.enrich import enrich, observe_progress
from pyspark.sql import Observation

BAD = {
    "amount_missing": dict(amount=None),
    "amount_not_positive": dict(amount=0.0),
    "sender_missing": dict(nameOrig=None),
    "receiver_missing": dict(nameDest=None),
    "type_unknown": dict(type=" transfer "),
    "label_invalid": dict(isFraud=7),
}


def test_each_failed_check_alone_is_named(spark):
    judged = routing.judge(rows.messages(spark, {}, *BAD.values())).orderBy("kafka_offset")
    assert [r[routing.REASONS] for r in judged.collect()] == [None, *BAD]


@pytest.mark.parametrize("change, reason", [
    (dict(type=None), "type_unknown"), (dict(isFraud=None), "label_invalid"),
    (dict(amount=None, isFraud=None), "amount_missing|label_invalid"),
])
def test_unknown_verdicts_are_quarantined(spark, change, reason):
    judged = routing.judge(rows.messages(spark, change))
    assert routing.valid(judged).isEmpty()
    assert routing.quarantined(judged).first()[routing.REASONS] == reason


def test_no_row_is_lost_or_doubled(spark):
    """The plain two-way split loses rows with an unknown verdict; routing does not."""
    messages = rows.messages(spark, {}, dict(type=None), dict(isFraud=None), *BAD.values())
    judged = routing.judge(messages)
    assert routing.valid(judged).count() + routing.quarantined(judged).count() == messages.count()
    verdict = F.expr(
        "amount is not null and amount > 0 and nameOrig is not null and nameDest is not null "
        "and type in ('PAYMENT', 'TRANSFER', 'CASH_OUT', 'DEBIT', 'CASH_IN') "
        "and isFraud in (0, 1)"
    )
    split = messages.where(verdict).count() + messages.where(~verdict).count()
    assert split == messages.count() - 2


def test_parse_keeps_position_and_tolerates_bad_text(spark):
    good = json.dumps(rows.LEDGER | rows.DERIVED | {"extra": 1})
    wrong_type = json.dumps(rows.LEDGER | {"amount": "many"})
    parsed = routing.ingest(rows.envelope(spark, good, "{not json", wrong_type, '"text"'))
    found = parsed.orderBy("kafka_offset").collect()
    assert [r.kafka_offset for r in found] == [0, 1, 2, 3]
    assert found[0].amount == 100.0 and found[0][routing.REASONS] is None
    assert (found[0].year, found[0].month, found[0].day) == ("2024", "03", "05")
    assert found[1].raw_value == "{not json" and found[1].year is None
    assert found[1][routing.REASONS].startswith("amount_missing")
    assert found[2].amount is None and found[2].nameOrig == "C1"
    assert found[2][routing.REASONS] == "amount_missing|sent_at_unreadable"
    assert found[3].nameOrig is None and found[0].ingested_at is not None


def test_a_foreign_record_is_quarantined(spark):
    text = '{"transaction_id": "t1", "amount": 5.0, "type": "debit", "timestamp": "2024-01-01"}'
    reasons = routing.ingest(rows.envelope(spark, text)).first()[routing.REASONS]
    assert reasons == (
        "sender_missing|receiver_missing|type_unknown|label_invalid|sent_at_unreadable"
    )


def test_enrich(spark):
    ledger = rows.ledger(
        spark, {}, dict(amount=500.004, newbalanceOrig=0.0, isFraud=1),
        dict(oldbalanceOrg=0.0, newbalanceOrig=0.0, isFraud=None), dict(isFraud=7),
    )
    seen = Observation()
    found = observe_progress(
        enrich(ledger, F.lit("2024-03-05 10:20:30.5").cast("timestamp")), seen
    ).collect()
    first, drained, empty, odd = found
    assert (first.balanceDropOrig, first.balanceChangeDest, first.expectedDrop) == (100, 100, 100)
    assert first.dropMatchesAmount and not first.isFullDrain and not first.isSuspicious
    assert first.sentAt == "2024-03-05T10:20:30.500000+00:00"
    assert first.source == "paysim-producer"
    assert drained.isFullDrain and drained.expectedDrop == 500.0 and drained.isSuspicious
    assert drained.dropMatchesAmount
    assert not empty.isFullDrain and not empty.isSuspicious and odd.isSuspicious
    assert seen.get == {"sent": 4, "fraud": 2}


def test_cents_are_rounded_as_the_producer_does(spark):
    amounts = [1.005, 0.125, 0.285, -0.375, 12345678.905, 1e17, 0.1 + 0.2]
    ledger = rows.ledger(spark, *[dict(amount=a) for a in amounts])
    found = enrich(ledger, F.current_timestamp()).collect()
    assert [r.expectedDrop for r in found] == [round(a, 2) for a in amounts]
