"""Reports as SQL, for views that stay in the catalog and are read from any session.

Each gives the same columns and rows as the report of its name in ``views``. Money is added
as ``functions.money`` adds it: in whole cents where all of a group's values are such, at ten
decimals where they are finer, and as plain doubles otherwise.
"""

from paytrail import contract as c

FACT, ALERTS, SUMMARY = "fact_transactions", "fraud_alerts", "transaction_summary"


def total(value: str) -> str:
    """Aggregate: sum of a money column, whatever the order."""
    scaled = f"TRY_CAST(rint({value} * 100) AS BIGINT)"
    cents = f"CASE WHEN {scaled} / 100D = {value} THEN {scaled} END"
    fitted = f"TRY_CAST({value} AS DECIMAL(28, 10))"
    return (
        f"coalesce(CASE WHEN count({cents}) = count({value}) THEN try_sum({cents}) END / 100D, "
        f"CAST(CASE WHEN count_if(CAST({fitted} AS DOUBLE) = {value}) = count({value}) "
        f"THEN try_sum({fitted}) END AS DOUBLE), sum({value}))"
    )


def mean(value: str) -> str:
    return f"try_divide({total(value)}, count({value}))"


def percent(part: str, whole: str, digits: int) -> str:
    return f"round(try_divide(CAST({part} AS DOUBLE) * 100, CAST({whole} AS DOUBLE)), {digits})"


def _frauds(digits: int) -> str:
    return f"""count(1) AS total_transactions, sum(is_fraud) AS fraud_count,
        {percent("sum(is_fraud)", "count(1)", digits)} AS fraud_rate_pct"""


def _severities() -> str:
    levels = [tier for _, tier in c.SEVERITY_TIERS]
    counts = (f"count_if(alert_severity = '{level}') AS {level.lower()}_alerts" for level in levels)
    return ", ".join(["count(1) AS total_alerts", *counts])


def kpi_fraud_rate(database: str) -> str:
    lost, whole = total("CASE WHEN is_fraud = 1 THEN amount ELSE 0D END"), total("amount")
    return f"""SELECT count(1) AS total_transactions, sum(is_fraud) AS total_fraud,
        {percent("sum(is_fraud)", "count(1)", 3)} AS fraud_rate_pct, {lost} AS total_fraud_amount,
        {whole} AS total_transaction_amount, {percent(lost, whole, 3)} AS fraud_amount_pct
        FROM {database}.{FACT}"""


def kpi_alert_summary(database: str) -> str:
    return f"""SELECT {_severities()}, {total("amount")} AS total_flagged_amount,
        {mean("amount")} AS avg_flagged_amount, max(amount) AS max_flagged_amount
        FROM {database}.{ALERTS}"""


def daily_fraud_summary(database: str) -> str:
    return f"""SELECT transaction_date, {_severities()}, {total("amount")} AS total_flagged_amount,
        {mean("amount")} AS avg_flagged_amount FROM {database}.{ALERTS}
        GROUP BY transaction_date ORDER BY transaction_date DESC NULLS FIRST"""


def fraud_by_type(database: str) -> str:
    return f"""SELECT type, {_frauds(2)}, {mean("amount")} AS avg_amount, {total("amount")} AS total_amount
        FROM {database}.{FACT} GROUP BY type ORDER BY fraud_count DESC NULLS FIRST, type"""


def high_risk_accounts(database: str) -> str:
    levels = ", ".join(f"'{level}'" for level in c.RISK_LEVELS[:2])
    return f"""SELECT name_orig, transaction_date, tx_count, fraud_tx_count, total_amount_sent,
        unique_recipients, account_risk_level FROM {database}.{SUMMARY}
        WHERE account_risk_level IN ({levels})
        ORDER BY fraud_tx_count DESC NULLS FIRST, total_amount_sent DESC NULLS FIRST,
            name_orig, transaction_date"""


def heatmap(database: str) -> str:
    return f"""SELECT step, type, {_frauds(3)} FROM {database}.{FACT}
        GROUP BY step, type ORDER BY step, type"""


def pipeline_health(database: str) -> str:
    return " UNION ALL ".join(f"""SELECT '{table}' AS table_name, count(1) AS row_count, min(transaction_date) AS first_date,
        max(transaction_date) AS last_date, count(DISTINCT transaction_date) AS day_count
        FROM {database}.{table}""" for table in c.WAREHOUSE_TABLES)


DEFINITIONS = {
    "v_kpi_fraud_rate": kpi_fraud_rate,
    "v_kpi_alert_summary": kpi_alert_summary,
    "v_daily_fraud_summary": daily_fraud_summary,
    "v_fraud_by_type": fraud_by_type,
    "v_high_risk_accounts": high_risk_accounts,
    "v_fraud_heatmap": heatmap,
    "pipeline_health": pipeline_health,
}
