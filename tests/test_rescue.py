"""What parsing loses of odd messages is kept, and named."""

import json

import pytest

import rows
from paytrail.operators import rescue, routing
from paytrail.sources.landing import Landing
from paytrail.streaming import ingest

GOOD = rows.LEDGER | rows.DERIVED


@pytest.mark.parametrize("text, fields, reason", [
    (json.dumps(GOOD), None, None),
    (json.dumps(GOOD | {"extra": [1, {"a": None}]}), {"extra": [1, {"a": None}]}, None),
    (json.dumps(GOOD | {"extra": None}), {"extra": None}, None),
    (json.dumps(GOOD | {"amount": "many"}), {"amount": "many"}, "field_mistyped:amount"),
    (json.dumps(GOOD | {"step": 1.5, "amount": {}}), {"amount": {}, "step": 1.5},
     "field_mistyped:step|field_mistyped:amount"),
    (json.dumps(GOOD | {"amount": None}), None, None),
    (json.dumps(GOOD | {"Amount": 2}), {"Amount": 2}, None),
    ("{}", None, None),
    ('{"amount": 1', None, "json_unreadable"),
    ('{"amount": 1, "amount": "u"}', None, "json_unreadable"),
    ("[1]", None, "json_unreadable"), ('"text"', None, "json_unreadable"), ("", None, "json_unreadable"),
])
def test_odd_parts_are_kept_and_named(spark, text, fields, reason):
    row = routing.ingest(rows.envelope(spark, text)).first()
    kept = row[rescue.RESCUED]
    assert (json.loads(kept) if kept else None, row[rescue.FAULTS]) == (fields, reason)


def test_a_missing_text_is_unreadable(spark):
    sent = rows.envelope(spark, "{}").selectExpr("key", "CAST(NULL AS BINARY) AS value", "topic", "partition", "offset", "timestamp")
    assert routing.ingest(sent).first()[rescue.FAULTS] == "json_unreadable"


def test_the_route_does_not_depend_on_it(spark, tmp_path):
    """A mistyped optional field stays valid, as before, and what it held is landed."""
    texts = [json.dumps(GOOD | {"isFlaggedFraud": "no"}), json.dumps(GOOD | {"amount": "many"}), json.dumps(GOOD)]
    rows.envelope(spark, *texts).write.parquet(str(tmp_path / "topic"))
    stream = spark.readStream.schema(rows.c.ENVELOPE_SCHEMA).parquet(str(tmp_path / "topic"))
    landing = str(tmp_path / "landing")
    ingest.start_ingest(stream, landing, str(tmp_path / "cp"), {"availableNow": True}).awaitTermination()
    found = {r.kafka_offset: r for r in spark.read.parquet(landing).collect()}
    assert [found[i].route for i in range(3)] == ["bronze", "quarantine", "bronze"]
    assert [found[i][rescue.RESCUED] for i in range(3)] == ['{"isFlaggedFraud":"no"}', '{"amount":"many"}', None]
    day = Landing(spark, landing, str(tmp_path / "compacted")).read_day(rows.dt.date(2024, 3, 5))
    assert day.count() == 2 and rescue.RESCUED not in day.columns
