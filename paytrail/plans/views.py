"""The report catalogue over the three warehouse tables.

Each report is a function of one table (or all three) that returns a DataFrame;
``VIEWS`` names them. Columns and sort orders are what readers of the dashboards
rely on. NULL placement is spelled out, since it differs between SQL engines.
"""

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paytrail import contract as c
from paytrail.functions.calendar import minutes_between
from paytrail.functions.money import mean, percent, total
from paytrail.operators.quantile import exact_quantile

FACT, ALERTS, SUMMARY = "fact_transactions", "fraud_alerts", "transaction_summary"


def _rows() -> Column:
    return F.count(F.lit(1))


def _amount() -> Column:
    return F.col("amount")


def _fraud_amount() -> Column:
    return total(F.when(F.col("is_fraud") == 1, F.col("amount")).otherwise(F.lit(0.0)))


def _fraud_columns(digits: int = 3) -> list[Column]:
    """Transactions, frauds and the rate between them."""
    fraud = F.sum("is_fraud")
    return [
        _rows().alias("total_transactions"),
        fraud.alias("fraud_count"),
        percent(fraud, _rows(), digits).alias("fraud_rate_pct"),
    ]


def _severity_columns() -> list[Column]:
    severity = F.col("alert_severity")
    return [_rows().alias("total_alerts")] + [
        F.count_if(severity == tier).alias(f"{tier.lower()}_alerts")
        for _, tier in c.SEVERITY_TIERS
    ]


def _risky(summary: DataFrame) -> DataFrame:
    return summary.where(F.col("account_risk_level").isin(*c.RISK_LEVELS[:2]))


def _by_fraud_then_amount() -> list[Column]:
    """Worst first; account and day make the order total."""
    return [
        F.desc_nulls_first("fraud_tx_count"), F.desc_nulls_first("total_amount_sent"),
        F.asc("name_orig"), F.asc("transaction_date"),
    ]


# --- key figures -----------------------------------------------------------


def kpi_fraud_rate(fact: DataFrame) -> DataFrame:
    return fact.agg(
        _rows().alias("total_transactions"),
        F.sum("is_fraud").alias("total_fraud"),
        percent(F.sum("is_fraud"), _rows(), 3).alias("fraud_rate_pct"),
        _fraud_amount().alias("total_fraud_amount"),
        total(_amount()).alias("total_transaction_amount"),
        percent(_fraud_amount(), total(_amount()), 3).alias("fraud_amount_pct"),
    )


def kpi_alert_summary(alerts: DataFrame) -> DataFrame:
    return alerts.agg(
        *_severity_columns(),
        total(_amount()).alias("total_flagged_amount"),
        mean(_amount()).alias("avg_flagged_amount"),
        F.max("amount").alias("max_flagged_amount"),
    )


def kpi_account_risk(summary: DataFrame) -> DataFrame:
    """Accounts per risk level; an account counts in every level it ever had.

    Accounts are reduced to one row of flags first, which replaces five distinct
    counts over expanded rows by one plain aggregation.
    """
    level = F.col("account_risk_level")
    # Column name per level.
    names = {
        "HIGH": "high_risk_accounts",
        "MEDIUM": "medium_risk_accounts",
        "LOW": "low_risk_accounts",
        "NORMAL": "normal_accounts",
    }
    accounts = (
        summary.where(F.col("name_orig").isNotNull())
        .groupBy("name_orig")
        .agg(*(F.bool_or(level == value).alias(name) for value, name in names.items()))
    )
    return accounts.agg(
        _rows().alias("total_accounts"),
        *(F.count_if(name).alias(name) for name in names.values()),
    )


# --- trends ----------------------------------------------------------------


def daily_fraud_trend(fact: DataFrame) -> DataFrame:
    return fact.groupBy("transaction_date").agg(
        *_fraud_columns(),
        total(_amount()).alias("total_amount"),
        _fraud_amount().alias("fraud_amount"),
        mean(_amount()).alias("avg_transaction_amount"),
    ).orderBy(F.asc_nulls_last("transaction_date"))


def fraud_by_hour(fact: DataFrame) -> DataFrame:
    return fact.groupBy("transaction_hour").agg(
        *_fraud_columns(), mean(_amount()).alias("avg_amount")
    ).orderBy(F.asc_nulls_last("transaction_hour"))


def daily_alert_trend(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("transaction_date", "alert_severity").agg(
        _rows().alias("alert_count"),
        total(_amount()).alias("total_amount"),
        F.avg("alert_score").alias("avg_alert_score"),
    ).orderBy(F.asc_nulls_last("transaction_date"), F.asc_nulls_last("alert_severity"))


def daily_fraud_summary(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("transaction_date").agg(
        *_severity_columns(),
        total(_amount()).alias("total_flagged_amount"),
        mean(_amount()).alias("avg_flagged_amount"),
    ).orderBy(F.desc_nulls_first("transaction_date"))


def fraud_trend_7d(fact: DataFrame) -> DataFrame:
    """Daily trend with a trailing seven-day rate. The window runs over days, not rows."""
    days = fact.groupBy("transaction_date").agg(*_fraud_columns())
    day_number = F.unix_date("transaction_date")
    week = Window.orderBy(day_number).rangeBetween(-6, 0)
    fraud = F.sum("fraud_count").over(week)
    return days.withColumns({
        "fraud_count_7d": fraud,
        "fraud_rate_7d_pct": percent(fraud, F.sum("total_transactions").over(week), 3),
    }).orderBy(F.asc_nulls_last("transaction_date"))


def fraud_heatmap(fact: DataFrame) -> DataFrame:
    return fact.groupBy("step", "type").agg(*_fraud_columns()).orderBy("step", "type")


# --- transactions ----------------------------------------------------------


def fraud_by_type(fact: DataFrame) -> DataFrame:
    return fact.groupBy("type").agg(
        *_fraud_columns(digits=2),
        mean(_amount()).alias("avg_amount"),
        total(_amount()).alias("total_amount"),
    ).orderBy(F.desc_nulls_first("fraud_count"), "type")


def fraud_by_type_detail(fact: DataFrame) -> DataFrame:
    figures = fact.groupBy("type").agg(
        *_fraud_columns(),
        mean(_amount()).alias("avg_amount"),
        total(_amount()).alias("total_amount"),
        _fraud_amount().alias("fraud_amount"),
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
    )
    medians = exact_quantile(fact, ["type"], "amount", 0.5, "median_amount")
    medians = medians.withColumnRenamed("type", "_type")
    return (
        figures.join(medians, F.col("type").eqNullSafe(F.col("_type")), "left").drop("_type")
        .orderBy(F.desc_nulls_first("fraud_count"), "type")
    )


def _bucket(position_to_value: Callable[[int, str], object]) -> Column:
    """Value for the first bucket whose bound exceeds the amount, else the last one."""
    values = [position_to_value(i, label) for i, (_, label) in enumerate(c.AMOUNT_BUCKETS, 1)]
    bounded = [
        F.when(F.col("amount") < bound, value)
        for (bound, _), value in zip(c.AMOUNT_BUCKETS, values)
        if bound is not None
    ]
    return F.coalesce(*bounded, F.lit(values[-1]))


def amount_distribution(fact: DataFrame) -> DataFrame:
    """Transactions per amount bucket; a NULL amount falls in the open last bucket."""
    return (
        fact.withColumn("bucket_order", _bucket(lambda i, label: i))
        .groupBy("bucket_order")
        .agg(
            _rows().alias("transaction_count"),
            F.sum("is_fraud").alias("fraud_count"),
            percent(F.sum("is_fraud"), _rows(), 2).alias("fraud_rate_pct"),
            total(_amount()).alias("total_amount"),
        )
        .withColumn("amount_bucket", F.element_at(
            F.array(*(F.lit(label) for _, label in c.AMOUNT_BUCKETS)), F.col("bucket_order")
        ))
        .select("amount_bucket", "bucket_order", "transaction_count", "fraud_count",
                "fraud_rate_pct", "total_amount")
        .orderBy("bucket_order")
    )


def balance_drain_analysis(fact: DataFrame) -> DataFrame:
    drained = F.count_if("is_full_drain")
    return fact.groupBy("type").agg(
        _rows().alias("total_transactions"),
        drained.alias("full_drain_count"),
        percent(drained, _rows(), 2).alias("full_drain_pct"),
        F.count_if("dq_balance_mismatch").alias("balance_mismatch_count"),
        mean(F.col("balance_drop_orig")).alias("avg_balance_drop"),
    ).orderBy(F.desc_nulls_first("full_drain_count"), "type")


# --- accounts --------------------------------------------------------------


def top_risk_accounts(summary: DataFrame) -> DataFrame:
    """The hundred worst account-days."""
    return _risky(summary).orderBy(*_by_fraud_then_amount()).limit(100).select(
        "name_orig", "transaction_date", "tx_count", "fraud_tx_count", "suspicious_tx_count",
        "total_amount_sent", "avg_amount", "max_amount", "unique_recipients", "hours_active",
        "account_risk_level", "full_drain_count", "balance_mismatch_count",
        "tx_transfer_count", "tx_cash_out_count", "opening_balance", "closing_balance",
        "total_balance_drop",
    )


def high_risk_accounts(summary: DataFrame) -> DataFrame:
    return _risky(summary).select(
        "name_orig", "transaction_date", "tx_count", "fraud_tx_count", "total_amount_sent",
        "unique_recipients", "account_risk_level",
    ).orderBy(*_by_fraud_then_amount())


def account_risk_distribution(summary: DataFrame) -> DataFrame:
    levels = F.array(*(F.lit(level) for level in c.RISK_LEVELS))
    rank = F.array_position(levels, F.col("account_risk_level"))
    return summary.groupBy("account_risk_level").agg(
        F.count_distinct("name_orig").alias("account_count"),
        F.sum("tx_count").alias("total_transactions"),
        total(F.col("total_amount_sent")).alias("total_amount"),
        F.avg("tx_count").alias("avg_tx_per_account"),
        F.avg("unique_recipients").alias("avg_unique_recipients"),
    ).orderBy(rank)


def account_activity_patterns(summary: DataFrame) -> DataFrame:
    """Per account over all days.

    ``risk_level`` is the alphabetically last level, as readers know it;
    ``worst_risk_level`` is the gravest one.
    """
    level = F.col("account_risk_level")
    gravest = F.coalesce(*(
        F.when(F.bool_or(level == value), value) for value in c.RISK_LEVELS
    ))
    return summary.groupBy("name_orig").agg(
        F.sum("tx_count").alias("total_tx"),
        total(F.col("total_amount_sent")).alias("total_amount"),
        F.sum("fraud_tx_count").alias("total_fraud"),
        F.max("unique_recipients").alias("max_unique_recipients"),
        F.max("hours_active").alias("max_hours_active"),
        F.max(level).alias("risk_level"),
        gravest.alias("worst_risk_level"),
        F.count_distinct("transaction_date").alias("active_days"),
    ).orderBy(
        F.desc_nulls_first("total_fraud"), F.desc_nulls_first("total_amount"), "name_orig"
    )


# --- alerts ----------------------------------------------------------------


def alert_detail(alerts: DataFrame) -> DataFrame:
    ratio = F.try_divide(F.col("amount"), F.col("sender_avg_amount"))
    return alerts.select(
        "alert_id", "transaction_date", "transaction_hour", "name_orig", "name_dest", "type",
        "amount", "step", "old_balance_orig", "new_balance_orig", "old_balance_dest",
        "new_balance_dest", "is_fraud", "is_suspicious", "alert_severity", "alert_score",
        "alert_reasons", "dq_balance_mismatch", "dq_suspicious_zero_bal", "r4_large_amount",
        "r5_rapid_repeat", "sender_avg_amount", "sender_tx_count_in_step",
        F.round(ratio, 2).alias("amount_vs_avg_ratio"),
        "sent_at", "loaded_at",
    ).orderBy(
        F.desc_nulls_first("alert_severity"), F.desc_nulls_first("alert_score"),
        F.desc_nulls_first("amount"),
    )


def alert_rule_breakdown(alerts: DataFrame) -> DataFrame:
    """How often each rule fired. The share's window runs over the rules, not the alerts."""
    fired = alerts.select(
        "amount", "is_fraud",
        F.explode(F.split("alert_reasons", "[|]")).alias("rule_name"),
    )
    rules = fired.groupBy(F.trim("rule_name").alias("rule_name")).agg(
        _rows().alias("trigger_count"),
        mean(_amount()).alias("avg_amount"),
        F.count_if(F.col("is_fraud") == 1).alias("confirmed_fraud_count"),
    )
    everything = F.sum("trigger_count").over(Window.partitionBy())
    return rules.select(
        "rule_name", "trigger_count",
        percent(F.col("trigger_count"), everything, 2).alias("trigger_pct"),
        "avg_amount", "confirmed_fraud_count",
    ).orderBy(F.desc("trigger_count"), "rule_name")


# --- data quality ----------------------------------------------------------


def daily_dq_metrics(fact: DataFrame) -> DataFrame:
    # Column name per flag.
    flags = {
        "null_critical_count": "dq_null_critical",
        "balance_mismatch_count": "dq_balance_mismatch",
        "suspicious_zero_count": "dq_suspicious_zero_bal",
        "negative_amount_count": "dq_negative_amount",
        "unknown_type_count": "dq_unknown_type",
        "invalid_label_count": "dq_invalid_fraud_label",
    }
    clean = F.count_if("dq_is_clean")
    return fact.groupBy("transaction_date").agg(
        _rows().alias("total_rows"),
        clean.alias("clean_rows"),
        percent(clean, _rows(), 2).alias("clean_rate_pct"),
        *(F.count_if(flag).alias(name) for name, flag in flags.items()),
    ).orderBy(F.desc_nulls_first("transaction_date"))


def pipeline_load_history(fact: DataFrame) -> DataFrame:
    first, last = F.min("loaded_at"), F.max("loaded_at")
    return fact.groupBy("transaction_date").agg(
        first.alias("first_loaded_at"),
        last.alias("last_loaded_at"),
        _rows().alias("rows_loaded"),
        minutes_between(first, last).alias("load_duration_mins"),
    ).orderBy(F.desc_nulls_first("transaction_date"))


def pipeline_health(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count and date coverage per table."""
    day = F.col("transaction_date")
    return reduce(DataFrame.unionByName, (
        df.agg(
            _rows().alias("row_count"),
            F.min(day).alias("first_date"),
            F.max(day).alias("last_date"),
            F.count_distinct(day).alias("day_count"),
        ).select(F.lit(name).alias("table_name"), "*")
        for name, df in tables.items()
    ))


def alerts_with_history(tables: dict[str, DataFrame]) -> DataFrame:
    """Each alert with what its sender has done on all days loaded.

    All three tables are reduced by, and joined on, the sender alone. Over tables in buckets of
    it (``catalog.save_bucketed``) nothing is shuffled; merging keeps it so, where a broadcast would
    send a whole side to every task.
    """
    history = tables[FACT].groupBy("name_orig").agg(
        _rows().alias("history_tx"), total(_amount()).alias("history_amount"),
        F.min("transaction_date").alias("first_seen"),
    )
    days = tables[SUMMARY].groupBy("name_orig").agg(
        _rows().alias("active_days"), F.max("hours_active").alias("most_hours_active"),
    )
    chosen = tables[ALERTS].select("alert_id", "kafka_offset", "name_orig", "amount", "alert_severity")
    return chosen.join(history.hint("merge"), "name_orig", "left").join(days.hint("merge"), "name_orig", "left")


@dataclass(frozen=True)
class View:
    table: str
    build: Callable[[DataFrame], DataFrame]


VIEWS = {
    "v_kpi_fraud_rate": View(FACT, kpi_fraud_rate),
    "v_kpi_alert_summary": View(ALERTS, kpi_alert_summary),
    "v_kpi_account_risk": View(SUMMARY, kpi_account_risk),
    "v_daily_fraud_trend": View(FACT, daily_fraud_trend),
    "v_fraud_by_hour": View(FACT, fraud_by_hour),
    "v_daily_alert_trend": View(ALERTS, daily_alert_trend),
    "v_fraud_by_type_detail": View(FACT, fraud_by_type_detail),
    "v_amount_distribution": View(FACT, amount_distribution),
    "v_balance_drain_analysis": View(FACT, balance_drain_analysis),
    "v_top_risk_accounts": View(SUMMARY, top_risk_accounts),
    "v_account_risk_distribution": View(SUMMARY, account_risk_distribution),
    "v_account_activity_patterns": View(SUMMARY, account_activity_patterns),
    "v_alert_detail": View(ALERTS, alert_detail),
    "v_alert_rule_breakdown": View(ALERTS, alert_rule_breakdown),
    "v_daily_dq_metrics": View(FACT, daily_dq_metrics),
    "v_pipeline_load_history": View(FACT, pipeline_load_history),
    "v_daily_fraud_summary": View(ALERTS, daily_fraud_summary),
    "v_high_risk_accounts": View(SUMMARY, high_risk_accounts),
    "v_fraud_by_type": View(FACT, fraud_by_type),
    "v_fraud_trend_7d": View(FACT, fraud_trend_7d),
    "v_fraud_heatmap": View(FACT, fraud_heatmap),
}


def build(name: str, tables: dict[str, DataFrame]) -> DataFrame:
    view = VIEWS[name]
    return view.build(tables[view.table])


def register(tables: dict[str, DataFrame]) -> list[str]:
    """Register the tables and all reports as temporary views of the session."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    for name in VIEWS:
        build(name, tables).createOrReplaceTempView(name)
    return [*tables, *VIEWS]
