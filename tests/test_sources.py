import csv
import logging

import pytest
from pyspark.sql import functions as F

import rows
from paytrail import contract as c
from paytrail.operators import routing
from paytrail.operators.enrich import enrich
from paytrail.sources import broker, ledger_file


def _write(path, header, *lines):
    with open(path, "w", newline="") as file:
        csv.writer(file).writerows([header, *lines])
    return str(path)


def test_ledger_file(spark, tmp_path):
    line = [1, "PAYMENT", "9839.64", "C1", 170136.0, 160296.36, "M1", 0, 0, 0, 0]
    bad = ["x", "GIFT", "", "C2", 1, 1, "M2", 0, 0, 1, 0]
    path = _write(tmp_path / "ledger.csv", c.LEDGER_SCHEMA.names, line, bad)
    ledger = ledger_file.read_ledger(spark, path)
    assert [f.dataType for f in ledger.schema.fields] == [
        f.dataType for f in c.LEDGER_SCHEMA.fields]
    first, second = ledger.orderBy("nameOrig").collect()
    assert (first.step, first.amount, first.isFraud) == (1, 9839.64, 0)
    assert (second.step, second.amount, second.isFraud) == (None, None, 1)
    assert [r.type for r in ledger_file.unknown_types(ledger).collect()] == ["GIFT"]


def test_missing_ledger_column_is_reported(spark, tmp_path, caplog):
    path = _write(tmp_path / "ledger.csv", ["step", "type"], [1, "PAYMENT"])
    with caplog.at_level(logging.WARNING):
        ledger = ledger_file.read_ledger(spark, path)
    assert set(ledger.columns) == set(c.LEDGER_SCHEMA.names) and "isFlaggedFraud" in caplog.text
    row = enrich(ledger, F.current_timestamp()).first()
    assert (row.step, row.type, row.amount, row.isSuspicious) == (1, "PAYMENT", None, False)


def test_files_with_another_header_are_refused(spark, tmp_path):
    names = c.LEDGER_SCHEMA.names
    _write(tmp_path / "a.csv", names, [1] * len(names))
    _write(tmp_path / "b.csv", names[::-1], [1] * len(names))
    with pytest.raises(Exception, match="header"):
        ledger_file.read_ledger(spark, str(tmp_path)).collect()


def test_slice(spark):
    ledger = rows.ledger(spark, *[dict(step=i) for i in range(10)])

    def steps(*args):
        return [r.step for r in ledger_file.ledger_slice(ledger, ["step"], *args).collect()]

    assert steps(3, 4) == [3, 4, 5, 6] and steps(8) == [8, 9] and steps(0, 2) == [0, 1]
    assert steps(20) == [] and steps() == list(range(10))


def test_messages_survive_encoding(spark):
    messages = rows.messages(
        spark, {}, dict(nameOrig=None, amount=None, type="é|\"{", isSuspicious=None),
        dict(amount=1e7, oldbalanceOrg=0.1 + 0.2),
    )
    encoded = broker.encode(messages)
    keys = [bytes(r.key) for r in encoded.orderBy("kafka_offset").collect()]
    assert keys == [b"C1", b"", b"C1"]
    assert '"amount":null' in bytes(encoded.orderBy("kafka_offset").collect()[1].value).decode()
    back = routing.parse(encoded.selectExpr(
        "kafka_partition AS partition", "kafka_offset AS offset",
        "kafka_timestamp AS timestamp", "value",
    )).drop("raw_value")
    assert sorted(map(repr, back.collect())) == sorted(
        map(repr, messages.select(back.columns).collect()))


def test_topic_options():
    options = broker.topic_options("host:9092", per_trigger=5)
    assert options["subscribe"] == "transactions" and options["maxOffsetsPerTrigger"] == "5"
    assert options["startingOffsets"] == "earliest" and options["failOnDataLoss"] == "true"
    assert broker.topic_options("host:9092", skip_lost=True)["failOnDataLoss"] == "false"
