"""Activity per account and day."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paytrail import contract as c
from paytrail.functions import money

ACCOUNT_DAY = ("nameOrig", "transaction_date")


def arrival_order() -> Column:
    """Sorts a sender's rows by step, then offset.

    One decimal and not a struct, so that hash aggregation can hold it: an offset
    has at most 19 digits and the step sits above them.
    """
    step = F.col("step").cast("decimal(19,0)") * F.lit(str(10**19)).cast("decimal(20,0)")
    return (step + F.col("kafka_offset")).cast("decimal(38,0)")


def volume() -> list[Column]:
    amount = F.col("amount")
    return [
        F.count("_tx").alias("tx_count"),
        money.total(amount).alias("total_amount_sent"),
        money.mean(amount).alias("avg_amount"),
        F.max(amount).alias("max_amount"),
        F.min(amount).alias("min_amount"),
    ]


def balances() -> list[Column]:
    return [
        money.total(F.col("balanceDropOrig")).alias("total_balance_drop"),
        F.min_by("oldbalanceOrg", arrival_order()).alias("opening_balance"),
        F.max_by("newbalanceOrig", arrival_order()).alias("closing_balance"),
    ]


def risk_counts() -> list[Column]:
    return [
        F.count_if(F.col("isFraud") == 1).alias("fraud_tx_count"),
        F.count_if("isSuspicious").alias("suspicious_tx_count"),
        F.count_if("dq_balance_mismatch").alias("balance_mismatch_count"),
        F.count_if("dq_suspicious_zero_bal").alias("full_drain_count"),
    ]


def _names(silver: DataFrame) -> DataFrame:
    """Distinct recipients per account and day, and distinct types outside the known set."""

    def entry(kind: str, column: str) -> Column:
        return F.struct(F.lit(kind).alias("_kind"), F.col(column).alias("_name"))

    recipient, kind = entry("recipient", "nameDest"), entry("type", "type")
    unusual = ~F.col("type").isin(*c.TRANSACTION_TYPES)
    entries = F.when(unusual, F.array(recipient, kind)).otherwise(F.array(recipient))
    return (
        silver.select(*ACCOUNT_DAY, F.inline(entries))
        .where(F.col("_name").isNotNull())
        .distinct()
    )


def diversity() -> list[Column]:
    """Distinct counts: names arrive distinct, known types and hours fit bit masks."""
    known = F.coalesce(*(
        F.when(F.col("type") == kind, 1 << i) for i, kind in enumerate(c.TRANSACTION_TYPES)
    ))
    hour = F.expr("shiftleft(1, transaction_hour)")

    def members(mask: Column) -> Column:
        return F.coalesce(F.bit_count(F.bit_or(mask)), F.lit(0))

    def named(kind: str) -> Column:
        return F.count_if(F.col("_kind") == kind)

    return [
        named("recipient").alias("unique_recipients"),
        (members(known) + named("type")).alias("unique_tx_types"),
        members(hour).cast("bigint").alias("hours_active"),
    ]


def type_counts() -> list[Column]:
    return [
        F.count_if(F.col("type") == kind).alias(f"tx_{kind.lower()}_count")
        for kind in c.TRANSACTION_TYPES
    ]


def quality_counts() -> list[Column]:
    return [F.count_if("dq_is_clean").alias("clean_tx_count")]


def risk_level() -> Column:
    """The first level whose evidence is present; the last needs none."""
    evidence = ("fraud_tx_count", "suspicious_tx_count", "balance_mismatch_count")
    ladder = (F.when(F.col(n) > 0, level) for n, level in zip(evidence, c.RISK_LEVELS))
    return F.coalesce(*ladder, F.lit(c.RISK_LEVELS[-1]))


def account_days(silver: DataFrame, measures: list[Column], names: bool = False) -> DataFrame:
    """Measures per account and day; ``names`` are needed for ``diversity`` only.

    Several distinct counts in one aggregation would copy every row and shuffle
    all measures per distinct name. Instead the distinct names are appended to the
    rows, with every other column NULL, and one map-side combined aggregation
    takes both. An account with a large share of all rows is spread by recipient
    for the names and combined before the shuffle for the rest.
    """
    rows = silver.withColumn("_tx", F.lit(1))
    if names:
        rows = rows.unionByName(_names(silver), allowMissingColumns=True)
    return rows.groupBy(*ACCOUNT_DAY).agg(*measures)


def summarize(silver: DataFrame) -> DataFrame:
    """One row per account and day."""
    measures = (
        volume() + balances() + risk_counts() + diversity() + type_counts() + quality_counts()
    )
    return account_days(silver, measures, names=True).withColumn("account_risk_level", risk_level())


def with_alert_counts(summary: DataFrame, alerts: DataFrame) -> DataFrame:
    """Add the number of alerts per account and day. Both sides have one row per key."""
    counted = alerts.groupBy(*ACCOUNT_DAY).agg(F.count(F.lit(1)).alias("alert_tx_count"))
    renamed = counted.withColumnsRenamed({k: f"_{k}" for k in ACCOUNT_DAY})
    sender, day = ACCOUNT_DAY
    same = F.col(sender).eqNullSafe(F.col(f"_{sender}")) & F.col(day).eqNullSafe(F.col(f"_{day}"))
    return (
        summary.join(renamed, same, "left")
        .drop(f"_{sender}", f"_{day}")
        .withColumn("alert_tx_count", F.coalesce("alert_tx_count", F.lit(0)))
    )
