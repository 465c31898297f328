"""Hand-made rows: a clean default that each test bends."""

import datetime as dt

from paytrail import contract as c

LEDGER = dict(
    step=1, type="PAYMENT", amount=100.0, nameOrig="C1", oldbalanceOrg=500.0,
    newbalanceOrig=400.0, nameDest="M1", oldbalanceDest=0.0, newbalanceDest=100.0,
    isFraud=0, isFlaggedFraud=0,
)
DERIVED = dict(
    balanceDropOrig=100.0, balanceChangeDest=100.0, expectedDrop=100.0, dropMatchesAmount=True,
    isFullDrain=False, isSuspicious=False, sentAt="2024-03-05T10:20:30.123456+00:00",
    source="paysim-producer",
)
BROKER = dict(kafka_partition=0, kafka_offset=1, kafka_timestamp=dt.datetime(2024, 3, 5, 10, 21))

MESSAGE_TYPE = c.T.StructType(c.BROKER_SCHEMA.fields + c.MESSAGE_SCHEMA.fields)
SILVER_TYPE = c.T.StructType(
    [f for f in MESSAGE_TYPE.fields if f.name != "sentAt"]
    + [
        c.T.StructField("sentAt", c.T.TimestampType()),
        c.T.StructField("transaction_date", c.T.DateType()),
        c.T.StructField("transaction_hour", c.T.IntegerType()),
    ]
    + [
        c.T.StructField(name, c.T.BooleanType())
        for name in (*c.BLOCKING_FLAGS, *c.INFORMATIVE_FLAGS, "dq_is_clean")
    ]
)
SILVER = BROKER | LEDGER | DERIVED | dict(
    sentAt=dt.datetime(2024, 3, 5, 10, 20, 30), transaction_date=dt.date(2024, 3, 5),
    transaction_hour=10, dq_null_critical=False, dq_negative_amount=False, dq_unknown_type=False,
    dq_invalid_fraud_label=False, dq_balance_mismatch=False, dq_suspicious_zero_bal=False,
    dq_is_clean=True,
)


def _frame(spark, schema, default, changes):
    rows = [
        {"kafka_offset": i} | change for i, change in enumerate(changes, 1)
    ]
    data = [tuple((default | row).get(name) for name in schema.names) for row in rows]
    return spark.createDataFrame(data, schema)


def ledger(spark, *changes):
    return _frame(spark, c.LEDGER_SCHEMA, LEDGER, changes)


def messages(spark, *changes):
    return _frame(spark, MESSAGE_TYPE, BROKER | LEDGER | DERIVED, changes)


def silver(spark, *changes):
    return _frame(spark, SILVER_TYPE, SILVER, changes)


def envelope(spark, *texts):
    data = [
        (b"C1", text.encode(), "transactions", 0, i, BROKER["kafka_timestamp"])
        for i, text in enumerate(texts)
    ]
    return spark.createDataFrame(data, c.ENVELOPE_SCHEMA)
