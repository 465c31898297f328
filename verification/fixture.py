"""Ledger rows derived from the ``events`` table, defects and repeats included.

One ledger row per event, spread over all types, with a small share of missing,
negative, unknown and repeated values. The rules exist in both Spark and SQL
(see ``oracle.py``), and the number of rows grows with the table.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paytrail.operators.enrich import enrich
from paytrail.sources.broker import encode

REPEAT_OFFSET = 100_000_000

# Ledger columns as expressions over an event, its amount ``amt``
# and whether it is a repeat (``again`` is 0 or 1).
LEDGER_COLUMNS = {
    "step": "CAST((day(ts) - 1) * 24 + hour(ts) + 1 AS BIGINT)",
    "type": """CASE WHEN event_id % 239 = 0 THEN NULL
        WHEN event_id % 227 = 0 THEN 'UNKNOWN'
        WHEN event_id % 241 = 0 THEN ' transfer '
        WHEN event_type = 'view' THEN 'PAYMENT'
        WHEN event_type = 'click' THEN 'TRANSFER'
        WHEN event_type = 'purchase' THEN 'CASH_OUT'
        WHEN event_type = 'error' THEN 'DEBIT'
        WHEN event_type = 'signup' THEN 'CASH_IN' END""",
    "amount": "CASE WHEN event_id % 211 = 0 THEN NULL WHEN event_id % 223 = 0 THEN -amt "
              "ELSE amt END",
    "nameOrig": "concat('C', user_id)",
    "oldbalanceOrg": "CASE event_id % 5 WHEN 0 THEN amt WHEN 1 THEN 0D "
                     "ELSE amt + event_id % 1000 END",
    "newbalanceOrig": "CASE WHEN event_id % 5 IN (0, 1) OR event_id % 10 = 2 THEN 0D "
                      "ELSE CAST(event_id % 1000 AS DOUBLE) END",
    "nameDest": "CASE WHEN event_id % 233 <> 0 THEN concat('M', event_id * 31 % 97) END",
    "oldbalanceDest": "CAST(event_id % 5000 AS DOUBLE)",
    "newbalanceDest": "CAST(event_id % 5000 AS DOUBLE) + amt",
    "isFraud": """CASE WHEN event_id % 229 = 0 THEN NULL WHEN event_id % 251 = 0 THEN 7
        WHEN event_id % 53 = 0 AND event_type IN ('click', 'purchase') THEN 1 ELSE 0 END""",
    "isFlaggedFraud": "IF(event_type = 'click' AND amt > 200000, 1, 0)",
    "kafka_partition": "CAST(user_id % 4 AS INT)",
    "kafka_offset": f"event_id + again * {REPEAT_OFFSET}L",
    "kafka_timestamp": "CAST(ts AS TIMESTAMP)",
}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = events(spark, sf_dir).schema
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )


def ledger(source: DataFrame) -> DataFrame:
    """Raw ledger rows with broker position and event time; batch or stream."""
    with_repeats = source.selectExpr(
        "event_id", "ts", "user_id", "event_type", "round(value * 2000, 2) AS amt",
        "explode(IF(event_id % 101 = 0, array(0, 1), array(0))) AS again",
    )
    return with_repeats.selectExpr(*(f"{rule} AS {n}" for n, rule in LEDGER_COLUMNS.items()))


def messages(source: DataFrame) -> DataFrame:
    """Enriched messages with broker position, before validation."""
    return enrich(ledger(source), F.col("kafka_timestamp"))


def envelope(source: DataFrame) -> DataFrame:
    """The same messages as bytes, the way a broker delivers them."""
    return wrapped(messages(source))


def wrapped(enriched: DataFrame) -> DataFrame:
    """Enriched messages in the broker's envelope."""
    return encode(enriched).select(
        "key", "value", F.lit("transactions").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("kafka_timestamp").alias("timestamp"),
    )


def garbled(wrapped_messages: DataFrame) -> DataFrame:
    """Some messages cut off, some with a mistyped amount or flag, some with a field nobody knows."""
    text, n = F.col("value").cast("string"), F.col("offset")
    spoilt = (
        F.when(n % 37 == 0, F.substr(text, F.lit(1), F.length(text) - 1))
        .when(n % 41 == 0, F.regexp_replace(text, '"amount":[^,]*', '"amount":"much"'))
        .when(n % 43 == 0, F.regexp_replace(text, "^.", '{"channel":{"app":"web","hops":[1,2]},'))
        .when(n % 47 == 0, F.regexp_replace(text, '"isFlaggedFraud":[^,]*', '"isFlaggedFraud":[]'))
        .otherwise(text)
    )
    return wrapped_messages.withColumn("value", spoilt.cast("binary"))
