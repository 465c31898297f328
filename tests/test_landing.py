"""The landing as its sink committed it, before and after compaction."""

import datetime as dt
import json

import pytest

import rows
from paytrail import contract as c
from paytrail.functions.calendar import day_folder
from paytrail.plans import medallion
from paytrail.sources import tables
from paytrail.streaming import ingest

DAY, NEXT = dt.date(2024, 3, 5), dt.date(2024, 3, 6)


def message(step, day=DAY):
    return json.dumps(rows.LEDGER | rows.DERIVED | {"step": step, "sentAt": f"{day}T10:20:30.000000+00:00"})


@pytest.fixture
def lake(spark, tmp_path):
    """A landing with two batches; ``land`` adds another."""
    lake = medallion.Lake(str(tmp_path))

    def land(*texts):
        rows.envelope(spark, *texts).write.mode("append").parquet(f"{lake.root}/topic")
        stream = spark.readStream.schema(c.ENVELOPE_SCHEMA).parquet(f"{lake.root}/topic")
        ingest.start_ingest(stream, lake.landing, f"{lake.root}/checkpoint", {"availableNow": True}).awaitTermination()

    land(message(1), message(2), message(3, NEXT), "{broken")
    land(message(4), message(5, NEXT))
    return lake, land


def steps(landing, day=DAY):
    return sorted(r.step for r in landing.read_day(day).collect())


def test_files_of_no_commit_are_not_there(spark, lake):
    lake, _ = lake
    landing = lake.landed(spark)
    files = landing.day_files(DAY)
    spark.read.parquet(files[0]).write.mode("append").parquet(day_folder(lake.bronze, DAY))
    assert landing.day_files(DAY) == files and landing.require_files(DAY) == len(files)
    assert steps(landing) == [1, 2, 4]
    with pytest.raises(tables.DataGateError):
        landing.require_files(dt.date(2024, 3, 9))
    with pytest.raises(tables.DataGateError):
        medallion.Lake(f"{lake.root}/none").landed(spark).require_files(DAY)


def test_a_day_lists_its_own_files_only(spark, lake):
    lake, _ = lake
    landing = lake.landed(spark)
    assert all("/month=03/day=05/" in f for f in landing.read_day(DAY).inputFiles())
    landing.compact(DAY)
    assert all("/landed_day=2024-03-05/" in f for f in landing.read_day(DAY).inputFiles())
    assert all("/month=03/day=06/" in f for f in landing.read_day(NEXT).inputFiles())


def test_late_messages_are_read_once_before_and_after_the_next_compaction(spark, lake):
    lake, land = lake
    landing = lake.landed(spark)
    assert landing.compact(DAY) == 3 and landing.compact(DAY) == 3
    assert steps(landing) == [1, 2, 4]
    land(message(6), message(1))
    assert steps(landing) == [1, 1, 2, 4, 6]
    assert landing.compact(DAY) == 5
    assert steps(landing) == [1, 1, 2, 4, 6] and len(landing.read_day(DAY).inputFiles()) == 1
    assert landing.purge(DAY) == len(landing.day_files(DAY)) and steps(landing) == [1, 1, 2, 4, 6] and steps(landing, NEXT) == [3, 5]


def test_compacted_rows_have_the_same_columns_and_jobs_read_them(spark, lake):
    lake, _ = lake
    landing = lake.landed(spark)
    before = landing.read_day(DAY)
    plain = sorted(map(repr, before.select(*sorted(before.columns)).collect()))
    landing.compact(DAY)
    after = landing.read_day(DAY)
    assert sorted(map(repr, after.select(*sorted(before.columns)).collect())) == plain
    assert medallion.run_silver(spark, lake, DAY)["total_rows"] == 3


def test_rows_without_a_time_are_listed_without_a_day(spark, lake):
    lake, _ = lake
    odd = lake.landed(spark).committed(ingest.QUARANTINE).collect()
    assert [r.day for r in odd] == [None]
    assert lake.landed(spark).compact(dt.date(2024, 3, 9)) == 0


def test_a_day_without_files_leaves_the_schema_of_the_others(spark, lake):
    lake, _ = lake
    landing = lake.landed(spark)
    before = list(ingest.LANDED_SCHEMA.names)
    assert landing.read_day(dt.date(2024, 3, 9)).isEmpty() and ingest.LANDED_SCHEMA.names == before
    assert steps(landing) == [1, 2, 4]
