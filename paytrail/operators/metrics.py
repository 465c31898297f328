"""Run metrics, as aggregates or observed for free during a write."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paytrail.functions.money import percent


def silver_columns() -> list[Column]:
    rows = F.count(F.lit(1))
    clean = F.count_if("dq_is_clean")
    return [
        rows.alias("total_rows"),
        clean.alias("clean_rows"),
        percent(clean, rows, 1).alias("clean_pct"),
        F.count_if(F.col("isFraud") == 1).alias("fraud_rows"),
        F.count_if("dq_balance_mismatch").alias("mismatch_rows"),
        F.count_if("dq_suspicious_zero_bal").alias("zero_balance_rows"),
    ]


def row_counts(read: int, complete: int, kept: int) -> dict[str, int]:
    """What a Silver run read, dropped as incomplete, and removed as duplicates."""
    return {
        "rows_read": read, "incomplete_rows": read - complete, "duplicate_rows": complete - kept,
    }


def silver_metrics(silver: DataFrame) -> DataFrame:
    return silver.agg(*silver_columns())


def alert_columns() -> list[Column]:
    severity = F.col("alert_severity")
    return [
        F.count_if(severity == "HIGH").alias("high_alerts"),
        F.count_if(severity == "MEDIUM").alias("medium_alerts"),
        F.count_if(severity == "LOW").alias("low_alerts"),
        F.count(F.lit(1)).alias("total_alerts"),
    ]


def summary_columns() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("accounts"),
        F.count_if(F.col("account_risk_level") == "HIGH").alias("high_risk_accounts"),
    ]


def gold_metrics(alerts: DataFrame, summary: DataFrame) -> DataFrame:
    """One ``(metric, value)`` row per Gold figure."""

    def long(df: DataFrame, columns: list[Column]) -> DataFrame:
        return df.agg(*columns).unpivot([], "*", "metric", "value")

    return long(alerts, alert_columns()).unionByName(long(summary, summary_columns()))


def count_rows(df: DataFrame, observation) -> DataFrame:
    """Pass rows through and count them during the action that consumes them."""
    return df.observe(observation, F.count(F.lit(1)).alias("rows"))
