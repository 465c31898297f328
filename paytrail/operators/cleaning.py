"""Silver cleaning: types, time, quality flags, missing values, duplicates."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paytrail import contract as c
from paytrail.functions.calendar import moment
from paytrail.functions.predicates import any_null

# Columns re-cast against drift between producer versions.
_GUARDED = (
    "step", "amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest",
    "isFraud", "isFlaggedFraud", "balanceDropOrig", "balanceChangeDest",
)


def cast_types(bronze: DataFrame) -> DataFrame:
    """Enforce contract types (unreadable values become NULL) and tidy the keys."""
    fixed = {name: F.col(name).try_cast(c.MESSAGE_SCHEMA[name].dataType) for name in _GUARDED}
    tidy = {
        "type": F.upper(F.trim("type")),
        "nameOrig": F.trim("nameOrig"),
        "nameDest": F.trim("nameDest"),
    }
    return bronze.withColumns(fixed | tidy)


def standardize_time(df: DataFrame) -> DataFrame:
    """Turn ``sentAt`` into a timestamp and derive its UTC date and hour."""
    return df.withColumn("sentAt", moment(F.col("sentAt"))).withColumns({
        "transaction_date": F.to_date("sentAt"),
        "transaction_hour": F.hour("sentAt"),
    })


def balance_mismatch(types=None) -> Column:
    """The sender's balance did not fall by the amount.

    ``types`` limits the check to some transaction types; by default all count.
    """
    gap = F.abs(F.col("balanceDropOrig") - F.col("amount")) > c.BALANCE_MISMATCH_TOLERANCE
    return gap if types is None else gap & F.col("type").isin(*types)


def flag_quality(df: DataFrame, mismatch_types=None) -> DataFrame:
    """Add the ``dq_*`` columns. An unknown verdict stays NULL."""
    flags = {
        "dq_null_critical": any_null(c.CRITICAL_COLUMNS),
        "dq_negative_amount": F.col("amount") <= 0,
        "dq_unknown_type": ~F.col("type").isin(*c.TRANSACTION_TYPES),
        "dq_invalid_fraud_label": ~F.col("isFraud").isin(*c.FRAUD_LABELS),
        "dq_balance_mismatch": balance_mismatch(mismatch_types),
        "dq_suspicious_zero_bal": (F.col("oldbalanceOrg") > 0) & (F.col("newbalanceOrig") == 0),
    }
    dirty = reduce(lambda a, b: a | b, (F.col(name) for name in c.BLOCKING_FLAGS))
    return df.withColumns(flags).withColumn("dq_is_clean", ~dirty)


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows that lack a critical value; not-a-number counts as lacking."""
    return df.dropna(subset=list(c.CRITICAL_COLUMNS))


def fill_missing(df: DataFrame) -> DataFrame:
    return df.fillna({k: v for k, v in c.NULL_DEFAULTS.items() if k in df.columns})


def latest_only(df: DataFrame, key=c.DEDUP_KEY) -> DataFrame:
    """Keep the most recently received copy per key.

    Spark limits each key to one row per task before the shuffle, so a key with
    very many copies does not load one task. Partition breaks offset ties.
    """
    newest = Window.partitionBy(*key).orderBy(
        F.col("kafka_offset").desc(), F.col("kafka_partition").asc()
    )
    return (
        df.withColumn("_newest", F.row_number().over(newest))
        .where(F.col("_newest") == 1)
        .drop("_newest")
    )


def surplus_copies(df: DataFrame, key=c.DEDUP_KEY) -> DataFrame:
    """One row: how many rows deduplication removes."""
    return (
        df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"))
        .agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"))
    )
