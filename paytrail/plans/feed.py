"""The ledger to the topic, as one batch job."""

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from paytrail.operators.enrich import enrich, observe_progress
from paytrail.sources.ledger_file import ledger_slice, unknown_type

log = logging.getLogger(__name__)


def run_feed(
    ledger: DataFrame, send: Callable[[DataFrame], None], order=None, skip: int = 0,
    limit: int | None = None, sent_at: Column | None = None,
) -> dict:
    """Slice, enrich and publish ledger rows; returns how many were sent, fraudulent and of unknown type.

    ``send`` publishes a batch of messages, such as ``partial(broker.write_topic, servers=...)``.
    Counts are observed while it does. A batch is sent whole or fails: rows of tasks that run
    again can reach the topic twice, which ingest and Silver undo. ``order`` is needed to skip or
    limit. Rows of unknown types are sent, too; an empty ledger sends nothing and counts 0.
    """
    if order is None and (skip or limit is not None):
        raise ValueError("a slice needs an order")
    rows = ledger if order is None else ledger_slice(ledger, order, skip, limit)
    progress, types = Observation(), Observation()
    messages = enrich(rows, F.current_timestamp() if sent_at is None else sent_at)
    unknown = F.count_if(unknown_type()).alias("unknown_type")
    send(observe_progress(messages.observe(types, unknown), progress))
    counts = {"sent": 0, "fraud": 0, "unknown_type": 0} | progress.get | types.get
    if counts["unknown_type"]:
        log.warning("%d rows of unknown type were sent", counts["unknown_type"])
    return counts
