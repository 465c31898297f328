"""The data contract: column names, value domains and thresholds.

Everything in this module is a fixed value that data producers and report
readers rely on; the logic lives elsewhere.
"""

from pyspark.sql import types as T

_TYPES = {
    "STRING": T.StringType(), "BINARY": T.BinaryType(), "BOOLEAN": T.BooleanType(),
    "INT": T.IntegerType(), "BIGINT": T.LongType(), "DOUBLE": T.DoubleType(),
    "DATE": T.DateType(), "TIMESTAMP": T.TimestampType(),
}


def _columns(text: str) -> T.StructType:
    """Schema from ``name TYPE`` pairs; needs no running session, unlike Spark's parser."""
    pairs = (item.split() for item in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# The ledger file, in header order.
LEDGER_SCHEMA = _columns(
    "step BIGINT, type STRING, amount DOUBLE, "
    "nameOrig STRING, oldbalanceOrg DOUBLE, newbalanceOrig DOUBLE, "
    "nameDest STRING, oldbalanceDest DOUBLE, newbalanceDest DOUBLE, "
    "isFraud INT, isFlaggedFraud INT"
)

# Fields the producer adds to every ledger row.
DERIVED_SCHEMA = _columns(
    "balanceDropOrig DOUBLE, balanceChangeDest DOUBLE, expectedDrop DOUBLE, "
    "dropMatchesAmount BOOLEAN, isFullDrain BOOLEAN, isSuspicious BOOLEAN, "
    "sentAt STRING, source STRING"
)

MESSAGE_SCHEMA = T.StructType(LEDGER_SCHEMA.fields + DERIVED_SCHEMA.fields)

# The columns a message broker adds around each message.
ENVELOPE_SCHEMA = _columns(
    "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
)

BROKER_SCHEMA = _columns(
    "kafka_partition INT, kafka_offset BIGINT, kafka_timestamp TIMESTAMP"
)
DAY_PARTITION_SCHEMA = _columns("year STRING, month STRING, day STRING")

BRONZE_SCHEMA = T.StructType(
    BROKER_SCHEMA.fields
    + MESSAGE_SCHEMA.fields
    + [T.StructField("ingested_at", T.TimestampType())]
    + DAY_PARTITION_SCHEMA.fields
)

# Fixed values.
SOURCE_NAME = "paysim-producer"
TOPIC = "transactions"
TRANSACTION_TYPES = ("CASH_IN", "CASH_OUT", "DEBIT", "PAYMENT", "TRANSFER")
FRAUD_LABELS = (0, 1)
CRITICAL_COLUMNS = ("nameOrig", "nameDest", "amount", "type", "step")
DEDUP_KEY = ("nameOrig", "nameDest", "amount", "step")
DAY_PARTITION = ("year", "month", "day")

# What a missing non-critical value becomes in Silver.
NULL_DEFAULTS = {
    "oldbalanceOrg": 0.0,
    "newbalanceOrig": 0.0,
    "oldbalanceDest": 0.0,
    "newbalanceDest": 0.0,
    "balanceDropOrig": 0.0,
    "balanceChangeDest": 0.0,
    "isFlaggedFraud": 0,
    "kafka_partition": -1,
    "kafka_offset": -1,
}

# Thresholds of flags and rules.
DROP_MATCH_TOLERANCE = 0.01
BALANCE_MISMATCH_TOLERANCE = 1.0
LARGE_AMOUNT_FACTOR = 3
RAPID_REPEAT_COUNT = 3

# Quality flags that make a row unclean, then the informative one.
BLOCKING_FLAGS = (
    "dq_null_critical",
    "dq_negative_amount",
    "dq_unknown_type",
    "dq_invalid_fraud_label",
    "dq_balance_mismatch",
)
INFORMATIVE_FLAGS = ("dq_suspicious_zero_bal",)

# Fixed values: (least score, tier), highest first.
SEVERITY_TIERS = ((3, "HIGH"), (2, "MEDIUM"), (1, "LOW"))
SEVERITY_TIERS_WITH_CRITICAL = ((4, "CRITICAL"), (3, "HIGH"), (2, "MEDIUM"), (1, "LOW"))

# Account risk, worst first.
RISK_LEVELS = ("HIGH", "MEDIUM", "LOW", "NORMAL")

# Upper bound (exclusive) and label of each amount bucket; the last is open.
AMOUNT_BUCKETS = (
    (1_000, "< $1K"),
    (10_000, "$1K - $10K"),
    (50_000, "$10K - $50K"),
    (100_000, "$50K - $100K"),
    (500_000, "$100K - $500K"),
    (None, "> $500K"),
)

# Column order of the alert table before warehouse naming.
ALERT_COLUMNS = (
    "nameOrig", "nameDest", "type", "amount", "step",
    "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest",
    "isFraud", "isFlaggedFraud", "isSuspicious",
    "alert_reasons", "alert_score", "alert_severity",
    "transaction_date", "transaction_hour",
    "dq_balance_mismatch", "dq_suspicious_zero_bal",
    "r4_large_amount", "r5_rapid_repeat",
    "sender_avg_amount", "sender_tx_count_in_step",
    "sentAt", "kafka_partition", "kafka_offset", "silver_processed_at",
)

# Warehouse spelling of every column whose name changes.
WAREHOUSE_NAMES = {
    "nameOrig": "name_orig",
    "nameDest": "name_dest",
    "oldbalanceOrg": "old_balance_orig",
    "newbalanceOrig": "new_balance_orig",
    "oldbalanceDest": "old_balance_dest",
    "newbalanceDest": "new_balance_dest",
    "balanceDropOrig": "balance_drop_orig",
    "balanceChangeDest": "balance_change_dest",
    "isFraud": "is_fraud",
    "isFlaggedFraud": "is_flagged_fraud",
    "isSuspicious": "is_suspicious",
    "isFullDrain": "is_full_drain",
    "sentAt": "sent_at",
}

# Warehouse tables. Types are given where the column is declared.
FACT_TABLE = _columns(
    "transaction_id STRING, step BIGINT, type STRING, amount DOUBLE, "
    "name_orig STRING, name_dest STRING, "
    "old_balance_orig DOUBLE, new_balance_orig DOUBLE, "
    "old_balance_dest DOUBLE, new_balance_dest DOUBLE, "
    "balance_drop_orig DOUBLE, balance_change_dest DOUBLE, "
    "is_fraud INT, is_flagged_fraud INT, is_suspicious BOOLEAN, is_full_drain BOOLEAN, "
    "dq_is_clean BOOLEAN, dq_null_critical BOOLEAN, dq_negative_amount BOOLEAN, "
    "dq_unknown_type BOOLEAN, dq_invalid_fraud_label BOOLEAN, "
    "dq_balance_mismatch BOOLEAN, dq_suspicious_zero_bal BOOLEAN, "
    "sent_at TIMESTAMP, transaction_date DATE, transaction_hour INT, "
    "kafka_partition INT, kafka_offset BIGINT, "
    "silver_processed_at TIMESTAMP, loaded_at TIMESTAMP"
)
ALERT_TABLE = _columns(
    "alert_id STRING, name_orig STRING, name_dest STRING, type STRING, amount DOUBLE, step BIGINT, "
    "old_balance_orig DOUBLE, new_balance_orig DOUBLE, "
    "old_balance_dest DOUBLE, new_balance_dest DOUBLE, "
    "is_fraud INT, is_flagged_fraud INT, is_suspicious BOOLEAN, "
    "alert_reasons STRING, alert_score INT, alert_severity STRING, "
    "dq_balance_mismatch BOOLEAN, dq_suspicious_zero_bal BOOLEAN, "
    "r4_large_amount BOOLEAN, r5_rapid_repeat BOOLEAN, "
    "sender_avg_amount DOUBLE, sender_tx_count_in_step BIGINT, "
    "sent_at TIMESTAMP, transaction_date DATE, transaction_hour INT, "
    "kafka_partition INT, kafka_offset BIGINT, "
    "silver_processed_at TIMESTAMP, gold_processed_at TIMESTAMP, loaded_at TIMESTAMP"
)
SUMMARY_TABLE = _columns(
    "summary_id STRING, name_orig STRING, transaction_date DATE, "
    "tx_count BIGINT, total_amount_sent DOUBLE, avg_amount DOUBLE, "
    "max_amount DOUBLE, min_amount DOUBLE, "
    "total_balance_drop DOUBLE, opening_balance DOUBLE, closing_balance DOUBLE, "
    "fraud_tx_count BIGINT, suspicious_tx_count BIGINT, "
    "balance_mismatch_count BIGINT, full_drain_count BIGINT, account_risk_level STRING, "
    "unique_recipients BIGINT, unique_tx_types BIGINT, hours_active BIGINT, "
    "tx_transfer_count BIGINT, tx_cash_out_count BIGINT, tx_payment_count BIGINT, "
    "tx_debit_count BIGINT, tx_cash_in_count BIGINT, clean_tx_count BIGINT, "
    "gold_processed_at TIMESTAMP, loaded_at TIMESTAMP"
)

# Table name -> (schema, column that clusters rows within a day).
WAREHOUSE_TABLES = {
    "fact_transactions": (FACT_TABLE, "type"),
    "fraud_alerts": (ALERT_TABLE, "alert_severity"),
    "transaction_summary": (SUMMARY_TABLE, "account_risk_level"),
}
