"""Batches are counted once however often they are given; ingest drops repeats of valid rows only."""

import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

import rows
from paytrail.streaming import batches, ingest


def topic(spark, path, *files):
    """A stream of one file a batch."""
    for n, texts in enumerate(files):
        at = (F.col("offset") + 100 * n).alias("offset")
        sent = rows.envelope(spark, *texts).withColumn("offset", at)
        sent.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.c.ENVELOPE_SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def test_a_batch_given_again_is_not_written_again(spark, tmp_path):
    table = batches.BatchTable(spark, str(tmp_path / "t"))
    df = spark.range(3)
    assert table.read(df.schema).isEmpty() and not table.has("q", 0)
    assert table.append(df, "q", 0) and not table.append(df, "q", 0)
    assert table.append(df.limit(0), "q", 1) and table.append(df, "other", 0)
    assert table.read(df.schema).count() == 6 and table.batches().count() == 3


def test_a_batch_cut_off_is_not_read_and_its_replay_is(spark, tmp_path):
    table = batches.BatchTable(spark, str(tmp_path / "t"))
    stream = topic(spark, str(tmp_path / "topic"), ["{}"], ["{}", "{}"]).select("offset")
    fail = [True]

    def write(df, batch):
        if batch == 1 and fail.pop():
            df.write.parquet(str(tmp_path / "t" / "rows" / "query=q" / "batch=1" / "cut"))
            fail.append(False)
            raise RuntimeError("lost")
        table.append(df, "q", batch)

    def run():
        batches.start_batches(
            stream, table, "q", str(tmp_path / "cp"), {"availableNow": True}, write
        ).awaitTermination()

    with pytest.raises(StreamingQueryException):
        run()
    assert table.batches().count() == 1
    fail[:] = [False]
    run()
    assert table.batches().count() == 2 and table.read(stream.schema).count() == 3


def test_reports_hold_each_batch_once(spark, tmp_path):
    good = json.dumps(rows.LEDGER | rows.DERIVED)
    bad = json.dumps(rows.LEDGER | rows.DERIVED | {"amount": "x", "isFraud": 1})
    stream = topic(spark, str(tmp_path / "topic"), [good, bad], [bad, "{"], [good])
    log = batches.ProgressLog(spark, str(tmp_path / "log"), "routes")
    spark.streams.addListener(log)
    query = ingest.start_ingest(
        stream, str(tmp_path / "l"), str(tmp_path / "cp"), {"availableNow": True}, metrics="routes"
    )
    query.awaitTermination()
    log.wait(query)
    spark.streams.removeListener(log)
    for progress in query.recentProgress:
        log.record(progress)
    found = log.read().groupBy().sum("input_rows", "valid", "quarantined", "rescued", "fraud").first()
    assert tuple(found) == (5, 2, 3, 3, 2) and log.read().count() == 3


def test_ingest_drops_repeats_of_valid_rows_in_later_batches(spark, tmp_path):
    good = json.dumps(rows.LEDGER | rows.DERIVED)
    stream = topic(spark, str(tmp_path / "topic"), [good, "{", "{"], [good, "{"], [good])
    ingest.start_ingest(
        stream, str(tmp_path / "l"), str(tmp_path / "cp"), {"availableNow": True}, repeat_delay="1 hour"
    ).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "l")).groupBy("route").count().collect()
    assert {r.route: r["count"] for r in found} == {"bronze": 1, "quarantine": 3}


def test_ingest_without_repeats_writes_few_files_a_day(spark, tmp_path):
    """However many partitions hold the state, a batch has at most ``SPREAD`` files a route and day."""
    texts = [json.dumps(rows.LEDGER | rows.DERIVED | {"step": i}) for i in range(400)]
    stream = topic(spark, str(tmp_path / "topic"), texts)
    saved = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 24)
    try:
        ingest.start_ingest(
            stream, str(tmp_path / "l"), str(tmp_path / "cp"), {"availableNow": True}, repeat_delay="1 hour"
        ).awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", saved)
    found = spark.read.parquet(str(tmp_path / "l"))
    assert found.count() == 400 and len(found.inputFiles()) <= ingest.SPREAD
