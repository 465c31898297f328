"""Streaming ingest: one query parses each message once and routes it.

Valid and quarantined rows go to one file sink partitioned by route and day. The
sink commits each batch atomically, so a restart neither loses nor repeats rows,
and the topic is read and parsed once for both routes.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from paytrail import contract as c
from paytrail.operators.rescue import FAULTS, RESCUED
from paytrail.operators.routing import REASONS, ingest
from paytrail.sources.landing import BRONZE, LANDED_SCHEMA, QUARANTINE
from paytrail.sources.tables import day_text
from paytrail.streaming.batches import observe_routes

LANDED = [*LANDED_SCHEMA.names, *c.DAY_PARTITION]
#: Most tasks, and so files, that one batch spreads a route's day over once repeats are dropped.
SPREAD = 8


def append_stream(
    df: DataFrame, path: str, checkpoint: str, partition_by=c.DAY_PARTITION, trigger=None
) -> StreamingQuery:
    """Append a stream to partitioned Parquet, every 30 seconds by default."""
    return (
        df.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by)
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
        .start()
    )


def routed(envelope: DataFrame) -> DataFrame:
    """Judged messages with their route; valid rows drop the raw text."""
    good = F.col(REASONS).isNull()
    return ingest(envelope).withColumns({
        "route": F.when(good, BRONZE).otherwise(QUARANTINE),
        "raw_value": F.when(~good, F.col("raw_value")),
    }).select("route", *LANDED)


def start_ingest(
    envelope: DataFrame, landing: str, checkpoint: str, trigger=None,
    repeat_delay: str | None = None, metrics: str | None = None,
) -> StreamingQuery:
    """Land both routes of a topic.

    With ``repeat_delay``, copies of valid messages that arrive within it are not landed again. With
    ``metrics``, each batch's counts are observed under that name; see ``batches.ProgressLog``.
    """
    rows = routed(envelope)
    if repeat_delay:
        # Dropping repeats deals every day to every state partition, so each would write a file a day.
        part = F.pmod(F.xxhash64("kafka_partition", "kafka_offset"), F.lit(SPREAD))
        rows = drop_repeated_valid(rows, repeat_delay).repartition("route", *c.DAY_PARTITION, part)
    if metrics:
        rows = observe_routes(rows, metrics)
    return append_stream(rows, landing, checkpoint, ("route", *c.DAY_PARTITION), trigger)


def run_until_stopped(query: StreamingQuery) -> None:
    """Wait for the stream to end; an interrupt stops it after its current batch."""
    try:
        query.awaitTermination()
    except KeyboardInterrupt:
        query.stop()


def read_route(spark: SparkSession, landing: str, route: str) -> DataFrame:
    """Committed rows of one route; Spark prunes to its folder."""
    rows = day_text(spark.read.parquet(landing))
    chosen = rows.where(F.col("route") == route).drop("route")
    return chosen.drop(REASONS, "raw_value", RESCUED, FAULTS) if route == BRONZE else chosen


def drop_repeats(messages: DataFrame, delay: str = "1 hour", key=c.DEDUP_KEY) -> DataFrame:
    """Drop repeated messages whose copies arrive within ``delay`` of each other; keep all else.

    The watermark bounds the state: a key is forgotten ``delay`` after it arrived. It follows
    the time of arrival, as no row is late by that clock; by the time of sending a first copy
    that is late would be dropped, too.
    """
    return (
        messages.withColumn("_arrived", F.current_timestamp())
        .withWatermark("_arrived", delay)
        .dropDuplicatesWithinWatermark(list(key))
        .drop("_arrived")
    )


def drop_repeated_valid(rows: DataFrame, delay: str) -> DataFrame:
    """``drop_repeats`` among valid rows; a quarantined row is kept unless its broker position repeats."""
    held = F.col(REASONS).isNotNull()
    position = F.concat_ws(":", "kafka_partition", "kafka_offset")
    keyed = rows.withColumn("_held", F.when(held, position))
    return drop_repeats(keyed, delay, (*c.DEDUP_KEY, "_held")).drop("_held")
