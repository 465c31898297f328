"""Alert rules: score every transaction, keep those that trigger something."""

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paytrail import contract as c
from paytrail.functions import money
from paytrail.functions.predicates import pipe_list

DAY_SCOPE = ("nameOrig", "transaction_date")
HISTORY_SCOPE = ("nameOrig",)


@dataclass(frozen=True)
class Rule:
    """A named predicate over a transaction and its sender's profile."""

    name: str
    fires: Callable[[], Column]


# Rule names as reports show them, in report order.
RULES = (
    Rule("R1:fraud_label", lambda: F.col("isFraud") == 1),
    Rule("R2:balance_mismatch", lambda: F.col("dq_balance_mismatch")),
    Rule("R3:full_drain", lambda: F.col("dq_suspicious_zero_bal")),
    Rule("R4:large_amount", lambda: F.col("r4_large_amount")),
    Rule("R5:rapid_repeat", lambda: F.col("r5_rapid_repeat")),
)


def amount_over(limit: float) -> Rule:
    """Optional sixth rule: amount above a fixed limit."""
    return Rule("R6:threshold_amount", lambda: F.col("amount") > limit)


def sender_profile(silver: DataFrame, scope=DAY_SCOPE) -> DataFrame:
    """Mean amount per sender and count per sender and step, at step grain.

    Rows are aggregated to (scope, step) before any shuffle, so a sender with a
    large share of all rows is cheap. The window then runs over those aggregates:
    a sender has at most one of them per hour step of the scope.
    """
    amount = F.col("amount")
    steps = silver.groupBy(*scope, "step").agg(
        F.count(F.lit(1)).alias("sender_tx_count_in_step"),
        F.count(amount).alias("_priced"),
        money.total_cents(amount).alias("_cents"),
        money.fine(amount).alias("_fine"), F.sum(amount).alias("_sum"),
    )
    sender = Window.partitionBy(*scope)
    inexact = F.count_if(F.col("_cents").isNull() & (F.col("_priced") > 0)).over(sender)
    exact_sum = F.when(inexact == 0, F.try_sum("_cents").over(sender) / F.lit(100.0))
    unfit = F.count_if(F.col("_fine").isNull() & (F.col("_priced") > 0)).over(sender)
    fine_sum = F.when(unfit == 0, F.try_sum("_fine").over(sender).cast("double"))
    mean = F.try_divide(
        F.coalesce(exact_sum, fine_sum, F.sum("_sum").over(sender)), F.sum("_priced").over(sender)
    )
    return steps.select(*scope, "step", "sender_tx_count_in_step", mean.alias("sender_avg_amount"))


def profile_by_join(silver: DataFrame, scope=DAY_SCOPE) -> DataFrame:
    """Attach the sender profile with a join: right for any spread of senders.

    Adaptive execution broadcasts a small profile, and in a large join splits the
    partition of a hot sender over many tasks.
    """
    keys = (*scope, "step")
    profile = sender_profile(silver, scope).withColumnsRenamed({k: f"_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))
    return silver.join(profile, same, "left").drop(*(f"_{k}" for k in keys))


def with_sender_profile(silver: DataFrame, scope=DAY_SCOPE) -> DataFrame:
    """Add the sender profile and the two rules that depend on it."""
    mean = F.col("sender_avg_amount")
    return profile_by_join(silver, scope).withColumns({
        "r4_large_amount": F.col("amount") > mean * c.LARGE_AMOUNT_FACTOR,
        "r5_rapid_repeat": F.col("sender_tx_count_in_step") >= c.RAPID_REPEAT_COUNT,
    })


def reasons(rules=RULES) -> Column:
    return pipe_list({rule.name: rule.fires() for rule in rules})


def score(rules=RULES) -> Column:
    return reduce(
        lambda a, b: a + b, (F.when(rule.fires(), 1).otherwise(0) for rule in rules)
    ).cast("int")


def severity(points: Column, tiers=c.SEVERITY_TIERS) -> Column:
    """Tier of a score; NULL below the lowest tier."""
    return F.coalesce(*(F.when(points >= least, tier) for least, tier in tiers))


def score_all(
    silver: DataFrame,
    scope=DAY_SCOPE,
    rules=RULES,
    tiers=c.SEVERITY_TIERS,
) -> DataFrame:
    """Every transaction with its reasons, score and severity."""
    return (
        with_sender_profile(silver, scope)
        .withColumns({"alert_reasons": reasons(rules), "alert_score": score(rules)})
        .withColumn("alert_severity", severity(F.col("alert_score"), tiers))
    )


def alerts(silver: DataFrame, **policy) -> DataFrame:
    """The alert table: transactions that trigger at least one rule."""
    scored = score_all(silver, **policy).where(F.col("alert_score") >= 1)
    return scored.select(*(name for name in c.ALERT_COLUMNS if name in scored.columns))
