"""Quality checks as report rows: ``layer, check, status, metric, detail``."""

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paytrail import contract as c
from paytrail.functions.predicates import holds
from paytrail.operators.cleaning import surplus_copies

PASSED, WARNING, FAILED, INFO = "passed", "warning", "failed", "info"

# Columns a layer must have.
BRONZE_REQUIRED = ("nameOrig", "nameDest", "amount", "type", "isFraud", "sentAt")
BRONZE_NULL_CHECKED = ("nameOrig", "nameDest", "amount", "type")
SILVER_REQUIRED = ("dq_is_clean", "dq_balance_mismatch", "dq_suspicious_zero_bal")

# Thresholds in percent, and the legal score range.
NULL_RATE_WARNING = 5
UNKNOWN_TYPE_LIMIT = 1
CLEAN_RATE_GOOD, CLEAN_RATE_POOR = 30, 10
MISMATCH_RATE_LIMIT = 70
SCORE_RANGE = (1, 5)


def ladder(*rungs: tuple[Column, str], default: str = FAILED) -> Column:
    """Status of the first rung whose condition holds; unknown conditions do not."""
    return F.coalesce(*(F.when(cond, status) for cond, status in rungs), F.lit(default))


@dataclass(frozen=True)
class Check:
    """An aggregate over a layer and the status its value earns."""

    name: str
    metric: Column
    status: Callable[[Column, Column], Column]
    detail: Column | None = None


def _row_count(name: str = "row_count") -> Check:
    return Check(name, F.count(F.lit(1)), lambda m, d: ladder((m > 0, PASSED)))


def _percent(part: Column, whole: Column) -> Column:
    """Unrounded, so that a threshold of zero means zero."""
    return F.try_divide(part.cast("double") * 100, whole.cast("double"))


def _rate(condition: Column) -> Column:
    """Percent of all rows where the condition holds."""
    return _percent(F.count_if(condition), F.count(F.lit(1)))


def _known_rate(condition: Column) -> Column:
    """Percent of rows where the condition holds among rows where it is known."""
    return _percent(F.count_if(condition), F.count(condition))


def report(df: DataFrame, layer: str, checks: list[Check]) -> DataFrame:
    """Evaluate all checks in one aggregation and turn them into rows."""
    values, rows = [], []
    for i, check in enumerate(checks):
        values.append(check.metric.cast("double").alias(f"m{i}"))
        detail = F.lit(None) if check.detail is None else check.detail
        values.append(detail.cast("string").alias(f"d{i}"))
        rows.append(F.struct(
            F.lit(layer).alias("layer"),
            F.lit(check.name).alias("check"),
            check.status(F.col(f"m{i}"), F.col(f"d{i}")).alias("status"),
            F.col(f"m{i}").alias("metric"),
            F.col(f"d{i}").alias("detail"),
        ))
    return df.agg(*values).select(F.inline(F.array(*rows)))


def _columns_check(df: DataFrame, required) -> Check:
    missing = [name for name in required if name not in df.columns]
    return Check(
        "required_columns",
        F.lit(len(missing)),
        lambda m, d: ladder((F.lit(not missing), PASSED)),
        F.lit(", ".join(missing) or None),
    )


def _tally(column: str, values) -> Column:
    """Counts of the known values of a column, as text like ``HIGH=3|LOW=5``."""
    return F.concat_ws("|", *(
        F.concat(F.lit(f"{value}="), F.count_if(F.col(column) == value).cast("string"))
        for value in values
    ))


def files_report(file_count: int) -> Check:
    return Check("files_exist", F.lit(file_count), lambda m, d: ladder((m >= 1, PASSED)))


def absent(df: DataFrame, layer: str) -> DataFrame:
    """The report of a layer without files; no row of ``df`` is looked at."""
    missing = Check("files_exist", F.lit(0), lambda m, d: F.lit(FAILED))
    return report(df.limit(0), layer, [missing])


def check_bronze(bronze: DataFrame, file_count: int | None = None) -> DataFrame:
    """File, row, column, NULL-rate, type and label checks of raw messages.

    With no file at all, that failure is the whole report.
    """
    if file_count == 0:
        return absent(bronze, "bronze")

    checks = [] if file_count is None else [files_report(file_count)]
    checks += [_row_count(), _columns_check(bronze, BRONZE_REQUIRED)]
    for name in BRONZE_NULL_CHECKED:
        if name in bronze.columns:
            checks.append(Check(
                f"null_rate_{name}",
                _rate(F.col(name).isNull()),
                lambda m, d: ladder((m == 0, PASSED), (m < NULL_RATE_WARNING, WARNING)),
            ))
    if "type" in bronze.columns:
        checks.append(Check(
            "unknown_type_rate",
            _rate(~holds(F.col("type").isin(*c.TRANSACTION_TYPES))),
            lambda m, d: ladder((m < UNKNOWN_TYPE_LIMIT, PASSED)),
        ))
        checks.append(Check(
            "type_distribution", F.count("type"), lambda m, d: F.lit(INFO),
            _tally("type", c.TRANSACTION_TYPES),
        ))
    if "isFraud" in bronze.columns:
        valid = holds(F.col("isFraud").isin(*c.FRAUD_LABELS))
        checks.append(Check(
            "invalid_labels",
            F.count_if(~valid),
            lambda m, d: ladder((m == 0, PASSED)),
        ))
    return report(bronze, "bronze", checks)


def check_silver(silver: DataFrame) -> DataFrame:
    """Row, column, clean-rate, duplicate, fraud and mismatch checks.

    An empty layer reports that failure alone.
    """
    checks = [_row_count(), _columns_check(silver, SILVER_REQUIRED)]
    if "dq_is_clean" in silver.columns:
        checks.append(Check(
            "clean_rate",
            _known_rate(F.col("dq_is_clean")),
            lambda m, d: ladder((m >= CLEAN_RATE_GOOD, PASSED), (m >= CLEAN_RATE_POOR, WARNING)),
        ))
    if "isFraud" in silver.columns:
        label = F.col("isFraud")
        checks.append(Check(
            "fraud_rate",
            _percent(F.sum(label), F.count(label)),
            lambda m, d: F.lit(PASSED),
        ))
    if "dq_balance_mismatch" in silver.columns:
        checks.append(Check(
            "mismatch_rate",
            _known_rate(F.col("dq_balance_mismatch")),
            lambda m, d: ladder((m < MISMATCH_RATE_LIMIT, PASSED), default=WARNING),
        ))
    rows = report(silver, "silver", checks)
    if all(name in silver.columns for name in c.DEDUP_KEY):
        surplus = Check(
            "duplicates",
            F.sum("duplicate_rows"),
            lambda m, d: ladder((m == 0, PASSED), default=WARNING),
        )
        rows = rows.unionByName(report(surplus_copies(silver), "silver", [surplus]))
    return _only_failure_when_empty(rows)


def _only_failure_when_empty(rows: DataFrame) -> DataFrame:
    """Blank a report down to its failed row count. The report has a handful of rows."""
    empty = F.max(
        ((F.col("check") == "row_count") & (F.col("metric") == 0)).cast("int")
    ).over(Window.partitionBy("layer"))
    return (
        rows.withColumn("_empty", empty)
        .where((F.col("_empty") == 0) | (F.col("check") == "row_count"))
        .drop("_empty")
    )


def check_gold(alerts: DataFrame, summary: DataFrame) -> DataFrame:
    """Presence, distribution and score-range checks of both Gold tables."""
    low, high = SCORE_RANGE
    score = F.col("alert_score")
    tiers = [tier for _, tier in c.SEVERITY_TIERS]
    of_alerts = report(alerts, "gold", [
        _row_count("alert_rows"),
        Check("severity_distribution", F.count("alert_severity"),
              lambda m, d: ladder((m > 0, PASSED), default=INFO), _tally("alert_severity", tiers)),
        Check("score_range", F.count_if(~score.between(low, high)),
              lambda m, d: ladder((d.isNull(), INFO), (m == 0, PASSED)),
              F.concat(F.min(score).cast("string"), F.lit("-"), F.max(score).cast("string"))),
    ])
    of_summary = report(summary, "gold", [
        _row_count("summary_rows"),
        Check("risk_distribution", F.count("account_risk_level"),
              lambda m, d: ladder((m > 0, PASSED), default=INFO),
              _tally("account_risk_level", c.RISK_LEVELS)),
    ])
    return of_alerts.unionByName(of_summary)


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of a column."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table and day."""
    return _union([
        distribution(df, "transaction_date").withColumn("table_name", F.lit(name))
        for name, df in tables.items()
    ])


def reconcile(silver: DataFrame, fact: DataFrame) -> DataFrame:
    """Compare row counts of Silver and the fact table per day, without a join."""

    def tagged(df: DataFrame, name: str) -> DataFrame:
        counted = distribution(df, "transaction_date")
        return counted.select(
            "transaction_date",
            F.when(F.lit(name == "silver"), F.col("row_count")).otherwise(0).alias("silver_rows"),
            F.when(F.lit(name == "fact"), F.col("row_count")).otherwise(0).alias("fact_rows"),
        )

    silver_rows, fact_rows = F.col("silver_rows"), F.col("fact_rows")
    return (
        tagged(silver, "silver").unionByName(tagged(fact, "fact"))
        .groupBy("transaction_date")
        .agg(F.sum(silver_rows).alias("silver_rows"), F.sum(fact_rows).alias("fact_rows"))
        .withColumn(
            "status", ladder((fact_rows == silver_rows, PASSED), (fact_rows > 0, WARNING))
        )
    )


def check_warehouse(silver: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Row counts of the published tables, and one verdict per reconciled status."""
    counts = _union([
        report(df, "warehouse", [
            Check(f"rows_{name}", F.count(F.lit(1)), lambda m, d: F.lit(INFO)),
        ])
        for name, df in tables.items()
    ])
    days = reconcile(silver, tables["fact_transactions"])
    status = F.col("status")
    worst = F.max(F.when(status == FAILED, 2).when(status == WARNING, 1).otherwise(0))
    return counts.unionByName(report(days, "warehouse", [
        Check("reconcile", worst, lambda m, d: ladder((m == 0, PASSED), (m == 1, WARNING))),
    ]))


def verdict(rows: DataFrame) -> DataFrame:
    """One row: how many checks passed, warned and failed, and what that means."""
    status = F.col("status")
    return rows.agg(
        F.count_if(status == PASSED).alias("passed"),
        F.count_if(status == WARNING).alias("warnings"),
        F.count_if(status == FAILED).alias("failed"),
    ).withColumn(
        "verdict",
        F.when(F.col("failed") > 0, "failures")
        .when(F.col("warnings") > 0, "warnings")
        .otherwise("all clear"),
    )


def run_checks(layers: dict[str, Callable[[], DataFrame]], only=None) -> DataFrame:
    """Union of the reports of the chosen layers (all by default)."""
    unknown = set(only or ()) - set(layers)
    if unknown:
        raise ValueError(f"unknown layers: {sorted(unknown)}")
    return _union([build() for name, build in layers.items() if only is None or name in only])


def assert_unique(df: DataFrame, keys, label: str = "") -> None:
    """Raise when any key occurs more than once."""
    surplus = surplus_copies(df, keys).first()["duplicate_rows"]
    if surplus:
        raise ValueError(f"{label}: {surplus} duplicate rows on {list(keys)}")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
