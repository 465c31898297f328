"""Streaming ingest and the daily jobs, end to end on files."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

import rows
from paytrail import contract as c
from paytrail.plans import medallion
from paytrail.sources import tables
from paytrail.sources.snapshots import DayTable
from paytrail.streaming import ingest
from verification import fixture

NOW = {"availableNow": True}


def _land(spark, source, work):
    stream = spark.readStream.schema(c.ENVELOPE_SCHEMA).parquet(source)
    query = ingest.start_ingest(stream, f"{work}/landing", f"{work}/checkpoint", NOW)
    ingest.run_until_stopped(query)
    assert query.exception() is None


def test_restart_neither_loses_nor_repeats(spark, tmp_path):
    work, source = str(tmp_path), str(tmp_path / "topic")
    good, bad = json.dumps(rows.LEDGER | rows.DERIVED), "{broken"
    rows.envelope(spark, good, bad).write.parquet(source)
    _land(spark, source, work)
    _land(spark, source, work)
    assert ingest.read_route(spark, f"{work}/landing", ingest.BRONZE).count() == 1
    rows.envelope(spark, good).write.mode("append").parquet(source)
    _land(spark, source, work)
    bronze = ingest.read_route(spark, f"{work}/landing", ingest.BRONZE)
    assert bronze.count() == 2 and set(bronze.columns) == set(c.BRONZE_SCHEMA.names)
    row = bronze.first()
    assert (row.year, row.month, row.day) == ("2024", "03", "05") and row.sentAt.startswith("2024")
    odd = ingest.read_route(spark, f"{work}/landing", ingest.QUARANTINE).collect()
    assert [(r.raw_value, r.day) for r in odd] == [(bad, None)]


def test_repeats_are_dropped_within_the_watermark(spark, tmp_path):
    source = str(tmp_path / "topic")
    message = json.dumps(rows.LEDGER | rows.DERIVED)
    other = json.dumps(rows.LEDGER | rows.DERIVED | {"step": 2})
    rows.envelope(spark, message, message, other).write.parquet(source)

    def run():
        from paytrail.operators.routing import parse
        stream = spark.readStream.schema(c.ENVELOPE_SCHEMA).parquet(source)
        unique = ingest.drop_repeats(parse(stream)).select("step")
        ingest.append_stream(
            unique, str(tmp_path / "out"), str(tmp_path / "ck"), (), NOW
        ).awaitTermination()
        return sorted(r.step for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert run() == [1, 2]
    late = json.dumps(rows.LEDGER | rows.DERIVED | {"step": 3, "sentAt": "2000-01-01T00:00:00"})
    rows.envelope(spark, message, late).write.mode("append").parquet(source)
    assert run() == [1, 2, 3]


@pytest.fixture(scope="module")
def lake(spark, sf_dir, tmp_path_factory):
    work = str(tmp_path_factory.mktemp("lake"))
    source = f"{work}/topic"
    fixture.envelope(fixture.events(spark, sf_dir)).write.parquet(source)
    _land(spark, source, work)
    return medallion.Lake(work)


DAYS = [dt.date(2024, 1, d) for d in (3, 4)]


def _snapshot(spark, lake):
    """Everything the jobs stored, without processing stamps."""

    def content(df):
        stamps = [n for n in df.columns if n.endswith(("processed_at", "loaded_at"))]
        return sorted(map(repr, df.drop(*stamps).collect()))

    stored = [DayTable(spark, p).read() for p in (lake.silver, lake.alerts, lake.summary)]
    return [content(df) for df in (*stored, *medallion.read_warehouse(spark, lake).values())]


def _run_all(spark, lake):
    seen = {}
    for day in DAYS:
        seen[day] = tuple(medallion.run_day(spark, lake, day).values())
    return seen


def test_daily_jobs(spark, sf_dir, lake):
    seen = _run_all(spark, lake)
    whole = medallion.messages_to_silver(fixture.messages(fixture.events(spark, sf_dir)))
    for day, (silver, gold, loaded) in seen.items():
        expected = whole.where(F.col("transaction_date") == F.lit(day))
        assert silver["total_rows"] == loaded["fact_transactions"] == expected.count()
        assert gold["total_alerts"] == loaded["fraud_alerts"] > 0
        assert gold["accounts"] == loaded["transaction_summary"] > 0
        assert gold["high_alerts"] + gold["medium_alerts"] + gold["low_alerts"] == (
            gold["total_alerts"])
    before = _snapshot(spark, lake)
    _run_all(spark, lake)
    assert _snapshot(spark, lake) == before

    published = medallion.read_warehouse(spark, lake)
    tables.require_rows(published, DAYS[0])
    report = medallion.run_quality(spark, lake, DAYS[0]).collect()
    assert {r.layer for r in report} == {"bronze", "silver", "gold", "warehouse"}
    assert [r["check"] for r in report if r.status == "failed"] == []
    only = medallion.run_quality(spark, lake, DAYS[0], ["gold"]).collect()
    assert {r.layer for r in only} == {"gold"}


def test_stages_need_their_input(spark, lake):
    for stage in (medallion.run_gold, medallion.run_day):
        with pytest.raises(tables.DataGateError):
            stage(spark, lake, dt.date(2023, 1, 1))
    assert medallion.run_load(spark, lake, dt.date(2023, 1, 1)) == {
        "fact_transactions": 0, "fraud_alerts": 0, "transaction_summary": 0}


def test_a_day_without_alerts_and_a_day_emptied_by_a_rerun(spark, tmp_path):
    source, day = str(tmp_path / "topic"), dt.date(2024, 3, 5)
    message = rows.LEDGER | rows.DERIVED | {"isFraud": 0, "sentAt": "2024-03-05T10:00:00"}
    late = json.dumps(message | {"sentAt": "no time"})
    rows.envelope(spark, json.dumps(message), late).write.parquet(source)
    _land(spark, source, str(tmp_path))
    lake = medallion.Lake(str(tmp_path))
    assert ingest.read_route(spark, lake.landing, ingest.BRONZE).count() == 1
    odd = ingest.read_route(spark, lake.landing, ingest.QUARANTINE).collect()
    assert ["sent_at_unreadable" in r.quarantine_reason for r in odd] == [True]
    medallion.run_silver(spark, lake, day)
    medallion.run_gold(spark, lake, day)
    loaded = medallion.run_load(spark, lake, day)
    assert loaded["fact_transactions"] == loaded["transaction_summary"] == 1
    seen = DayTable(spark, lake.alerts).read([day]).count()
    assert loaded["fraud_alerts"] == seen
    quiet = dt.date(2024, 3, 9)
    assert medallion.run_silver(spark, lake, quiet) and medallion.run_gold(spark, lake, quiet)
    assert set(medallion.run_load(spark, lake, quiet).values()) == {0}
    silver = DayTable(spark, lake.silver)
    silver.publish(silver.read([day]).limit(0), day)
    medallion.run_gold(spark, lake, day)
    assert set(medallion.run_load(spark, lake, day).values()) == {0}
    assert all(df.count() == 0 for df in medallion.read_warehouse(spark, lake).values())
