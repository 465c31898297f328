"""Row-local enrichment of raw ledger rows into messages."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paytrail import contract as c
from paytrail.functions.calendar import iso_text
from paytrail.functions.money import round_cents


def enrich(ledger: DataFrame, sent_at: Column, source: str = c.SOURCE_NAME) -> DataFrame:
    """Add the eight derived message fields. ``sent_at`` is the publish time."""
    old, new, amount = F.col("oldbalanceOrg"), F.col("newbalanceOrig"), F.col("amount")
    drop = round_cents(old - new)
    derived = {
        "balanceDropOrig": drop,
        "balanceChangeDest": round_cents(F.col("newbalanceDest") - F.col("oldbalanceDest")),
        "expectedDrop": round_cents(amount),
        "dropMatchesAmount": F.abs(drop - amount) < c.DROP_MATCH_TOLERANCE,
        "isFullDrain": (old > 0) & (new == 0),
        "isSuspicious": F.coalesce(F.col("isFraud"), F.lit(0)) != 0,
        "sentAt": iso_text(sent_at),
        "source": F.lit(source),
    }
    return ledger.withColumns(derived)


def observe_progress(messages: DataFrame, observation) -> DataFrame:
    """Count sent and fraudulent rows as a by-product of whatever action runs next."""
    return messages.observe(
        observation,
        F.count(F.lit(1)).alias("sent"),
        F.count_if(F.coalesce(F.col("isFraud"), F.lit(0)) != 0).alias("fraud"),
    )
