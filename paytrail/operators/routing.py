"""Parse broker messages, judge them, and route each to Bronze or quarantine.

A row has exactly one destination: it is valid when no check fails, else it is
quarantined with the names of the failed checks. Unknown verdicts (NULL type or
label) count as failures, so no message is lost between the two.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paytrail import contract as c
from paytrail.functions.calendar import day_parts, moment
from paytrail.functions.predicates import holds, pipe_list
from paytrail.operators.rescue import FAULTS, RESCUED, rescue

REASONS = "quarantine_reason"


def parse(envelope: DataFrame) -> DataFrame:
    """Decode message bytes into columns; keep broker position and the raw text.

    The message is a column of its own first: fields taken from the parse itself would each
    get a parse of their own in the optimizer, one of the whole text per field.
    """
    position = {name: F.col(name.removeprefix("kafka_")) for name in c.BROKER_SCHEMA.names}
    decoded = envelope.withColumn("raw_value", F.col("value").cast("string"))
    message = decoded.withColumn("_message", F.from_json("raw_value", c.MESSAGE_SCHEMA))
    return message.select(
        *(at.alias(name) for name, at in position.items()), "raw_value",
        *(F.col("_message")[name].alias(name) for name in c.MESSAGE_SCHEMA.names),
    )


def with_day_partition(parsed: DataFrame) -> DataFrame:
    return parsed.withColumns(day_parts(moment(F.col("sentAt"))))


def failed_checks() -> Column:
    """Pipe-separated names of the message checks a row fails; empty when valid."""
    amount = F.col("amount")
    return pipe_list({
        "amount_missing": amount.isNull(),
        "amount_not_positive": amount <= 0,
        "sender_missing": F.col("nameOrig").isNull(),
        "receiver_missing": F.col("nameDest").isNull(),
        "type_unknown": ~holds(F.col("type").isin(*c.TRANSACTION_TYPES)),
        "label_invalid": ~holds(F.col("isFraud").isin(*c.FRAUD_LABELS)),
        "sent_at_unreadable": moment(F.col("sentAt")).isNull(),
    })


def judge(parsed: DataFrame) -> DataFrame:
    """Add ``quarantine_reason``: NULL for a valid row."""
    return parsed.withColumn(REASONS, F.nullif(failed_checks(), F.lit("")))


def valid(judged: DataFrame) -> DataFrame:
    return judged.where(F.col(REASONS).isNull()).drop(REASONS, "raw_value", RESCUED, FAULTS)


def quarantined(judged: DataFrame) -> DataFrame:
    return judged.where(F.col(REASONS).isNotNull())


def ingest(envelope: DataFrame) -> DataFrame:
    """Parsed, stamped, partitioned and judged messages; batch or stream.

    What a row lost in parsing stays beside it, whichever route it takes.
    """
    parsed = rescue(parse(envelope)).withColumn("ingested_at", F.current_timestamp())
    return judge(with_day_partition(parsed))
