"""Messages to and from the broker topic."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paytrail import contract as c


def encode(messages: DataFrame) -> DataFrame:
    """Key and value bytes: sender as key, so an account's history stays in order."""
    fields = F.struct(*c.MESSAGE_SCHEMA.names)
    return messages.withColumns({
        "key": F.coalesce("nameOrig", F.lit("")).cast("binary"),
        "value": F.to_json(fields, {"ignoreNullFields": "false"}).cast("binary"),
    })


def topic_options(
    servers: str, topic: str = c.TOPIC, per_trigger: int | None = 10_000, skip_lost: bool = False
) -> dict[str, str]:
    """Reader options: whole backlog first, bounded batches unless ``per_trigger`` is None.

    Offsets the broker has dropped are an error; ``skip_lost`` goes on without them.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": str(not skip_lost).lower(),
    }
    return options if per_trigger is None else options | {"maxOffsetsPerTrigger": str(per_trigger)}


def read_topic(spark: SparkSession, servers: str, **options) -> DataFrame:
    """Streaming envelope rows. Needs Spark's Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**topic_options(servers, **options)).load()


def write_topic(messages: DataFrame, servers: str, topic: str = c.TOPIC) -> None:
    """Publish a batch of messages. Needs Spark's Kafka connector on the class path."""
    (
        encode(messages).select("key", "value").write.format("kafka")
        .options(**{
            "kafka.bootstrap.servers": servers,
            "kafka.acks": "all",
            "kafka.compression.type": "gzip",
            "topic": topic,
        })
        .save()
    )
