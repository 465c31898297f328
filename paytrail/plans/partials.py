"""Reports from mergeable partial aggregates, kept per day beside the warehouse.

A day's rows are reduced once, when the day is loaded, to a few rows of counts, sums and a quantile
sketch that can be added up. Reports add up those rows and never read the fact or alert table;
a rerun replaces the day's partials with the day.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paytrail import contract as c
from paytrail.functions import money
from paytrail.functions.calendar import minutes_between
from paytrail.functions.money import percent
from paytrail.plans.views import ALERTS, FACT

#: Size parameter of the quantile sketches, and the rank error their quantiles stay within. A
#: sketch of this size errs by 0.3 % in 99 of 100 cases.
SKETCH_SIZE = 1000
RANK_ERROR = 0.01

# Flag counts of the quality report and the flag each counts.
FLAG_COUNTS = {
    "clean_rows": "dq_is_clean",
    "null_critical_count": "dq_null_critical",
    "balance_mismatch_count": "dq_balance_mismatch",
    "suspicious_zero_count": "dq_suspicious_zero_bal",
    "negative_amount_count": "dq_negative_amount",
    "unknown_type_count": "dq_unknown_type",
    "invalid_label_count": "dq_invalid_fraud_label",
}


def _rows():
    return F.count(F.lit(1)).alias("row_count")


def fact_partials(fact: DataFrame) -> DataFrame:
    """One row per day, hour and type."""
    amount = F.col("amount")
    stolen = F.when(F.col("is_fraud") == 1, amount).otherwise(F.lit(0.0))
    return fact.groupBy("transaction_date", "transaction_hour", "type").agg(
        _rows(), F.sum("is_fraud").alias("fraud_count"),
        *money.partial(amount, "amount"), *money.partial(stolen, "stolen"),
        *(F.count_if(flag).alias(name) for name, flag in FLAG_COUNTS.items()),
        F.min("loaded_at").alias("first_loaded_at"), F.max("loaded_at").alias("last_loaded_at"),
        F.kll_sketch_agg_double(amount, SKETCH_SIZE).alias("amounts"),
    )


def alert_partials(alerts: DataFrame) -> DataFrame:
    """One row per day and severity."""
    return alerts.groupBy("transaction_date", "alert_severity").agg(
        _rows(), *money.partial(F.col("amount"), "amount"), F.max("amount").alias("max_amount"),
        F.sum("alert_score").alias("score_sum"),
    )


#: Table -> its partials.
PARTIALS = {FACT: fact_partials, ALERTS: alert_partials}


def _count(name: str = "row_count"):
    """Sum of counts; of no partials at all it is no count but none."""
    return F.coalesce(F.sum(name), F.lit(0).cast("long"))


def _fraud():
    fraud = F.sum("fraud_count")
    return [
        _count().alias("total_transactions"), fraud.alias("fraud_count"),
        percent(fraud, _count(), 3).alias("fraud_rate_pct"),
    ]


def _severities():
    return [_count().alias("total_alerts")] + [
        F.coalesce(F.sum(F.when(F.col("alert_severity") == tier, F.col("row_count"))), F.lit(0).cast("long"))
        .alias(f"{tier.lower()}_alerts") for _, tier in c.SEVERITY_TIERS
    ]


def kpi_fraud_rate(partials: DataFrame) -> DataFrame:
    stolen, moved = money.merged("stolen"), money.merged("amount")
    return partials.agg(
        _count().alias("total_transactions"), F.sum("fraud_count").alias("total_fraud"),
        percent(F.sum("fraud_count"), _count(), 3).alias("fraud_rate_pct"),
        stolen.alias("total_fraud_amount"), moved.alias("total_transaction_amount"),
        percent(stolen, moved, 3).alias("fraud_amount_pct"),
    )


def kpi_alert_summary(partials: DataFrame) -> DataFrame:
    return partials.agg(
        *_severities(), money.merged("amount").alias("total_flagged_amount"),
        money.merged_mean("amount").alias("avg_flagged_amount"), F.max("max_amount").alias("max_flagged_amount"),
    )


def daily_fraud_trend(partials: DataFrame) -> DataFrame:
    return partials.groupBy("transaction_date").agg(
        *_fraud(), money.merged("amount").alias("total_amount"), money.merged("stolen").alias("fraud_amount"),
        money.merged_mean("amount").alias("avg_transaction_amount"),
    ).orderBy(F.asc_nulls_last("transaction_date"))


def fraud_by_hour(partials: DataFrame) -> DataFrame:
    return partials.groupBy("transaction_hour").agg(
        *_fraud(), money.merged_mean("amount").alias("avg_amount")
    ).orderBy(F.asc_nulls_last("transaction_hour"))


def daily_alert_trend(partials: DataFrame) -> DataFrame:
    return partials.groupBy("transaction_date", "alert_severity").agg(
        _count().alias("alert_count"), money.merged("amount").alias("total_amount"),
        (F.sum("score_sum") / _count()).alias("avg_alert_score"),
    ).orderBy(F.asc_nulls_last("transaction_date"), F.asc_nulls_last("alert_severity"))


def daily_fraud_summary(partials: DataFrame) -> DataFrame:
    return partials.groupBy("transaction_date").agg(
        *_severities(), money.merged("amount").alias("total_flagged_amount"),
        money.merged_mean("amount").alias("avg_flagged_amount"),
    ).orderBy(F.desc_nulls_first("transaction_date"))


def daily_dq_metrics(partials: DataFrame) -> DataFrame:
    clean, *flags = FLAG_COUNTS
    return partials.groupBy("transaction_date").agg(
        _count().alias("total_rows"), _count(clean).alias(clean), percent(_count(clean), _count(), 2).alias("clean_rate_pct"),
        *(_count(name).alias(name) for name in flags),
    ).orderBy(F.desc_nulls_first("transaction_date"))


def pipeline_load_history(partials: DataFrame) -> DataFrame:
    first, last = F.min("first_loaded_at"), F.max("last_loaded_at")
    return partials.groupBy("transaction_date").agg(
        first.alias("first_loaded_at"), last.alias("last_loaded_at"), _count().alias("rows_loaded"),
        minutes_between(first, last).alias("load_duration_mins"),
    ).orderBy(F.desc_nulls_first("transaction_date"))


def median_by_type(partials: DataFrame) -> DataFrame:
    """(type, median_amount) within RANK_ERROR of rank one half; null without any amount."""
    merged = partials.where(F.col("amount_n") > 0).groupBy("type").agg(
        F.kll_merge_agg_double("amounts").alias("amounts")
    )
    found = merged.select("type", F.kll_sketch_get_quantile_double("amounts", F.lit(0.5)).alias("median_amount"))
    types = partials.select(F.col("type").alias("_type")).distinct()
    return types.join(found, F.col("_type").eqNullSafe(F.col("type")), "left").select(
        F.col("_type").alias("type"), "median_amount"
    )


# Report names as in the catalogue of views; which partials each adds up.
REPORTS = {
    "v_kpi_fraud_rate": (FACT, kpi_fraud_rate),
    "v_kpi_alert_summary": (ALERTS, kpi_alert_summary),
    "v_daily_fraud_trend": (FACT, daily_fraud_trend),
    "v_fraud_by_hour": (FACT, fraud_by_hour),
    "v_daily_alert_trend": (ALERTS, daily_alert_trend),
    "v_daily_dq_metrics": (FACT, daily_dq_metrics),
    "v_pipeline_load_history": (FACT, pipeline_load_history),
    "v_daily_fraud_summary": (ALERTS, daily_fraud_summary),
}


def within_rank(fact: DataFrame, medians: DataFrame, error: float = RANK_ERROR) -> DataFrame:
    """(type, priced, within_bound): whether each sketched median has its rank, counted in the rows.

    Rows equal to the median hold a stretch of ranks; one of them must be near one half.
    """
    amount, guess = F.col("amount"), F.col("median_amount")
    priced = F.count(amount)
    joined = fact.select("type", "amount").join(
        medians.withColumnRenamed("type", "_type"), F.col("type").eqNullSafe(F.col("_type"))
    )
    below, upto = F.count_if(amount < guess), F.count_if(amount <= guess)
    near = [below <= (0.5 + error) * priced, upto >= (0.5 - error) * priced]
    return joined.groupBy("type").agg(
        priced.alias("priced"), reduce(lambda a, b: a & b, near).alias("within_bound")
    )
