"""Views in the catalog give what the reports of the same names give."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

import rows
from paytrail.plans import lasting, medallion, views
from paytrail.sources import catalog
from paytrail.sources.snapshots import DayTable

CHANGES = [
    dict(isFraud=1, amount=900.0), dict(isFraud=1, type="TRANSFER", amount=0.125),
    dict(nameOrig="C2", amount=1e-11), dict(nameOrig="C3", type="CASH_OUT", dq_balance_mismatch=True),
    dict(nameOrig="C3", transaction_date=dt.date(2024, 3, 6), isFraud=1, amount=33.33),
]


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    """A database with the three tables and the views, and the frames they hold."""
    root, database = tmp_path_factory.mktemp("lasting"), f"db_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {database}")
    frames = medallion.warehouse_frames(rows.silver(spark, *CHANGES), F.lit("2024-03-07").cast("timestamp"))
    for name, df in frames.items():
        table = DayTable(spark, str(root / name))
        table.publish(df)
        catalog.create_table(spark, f"{database}.{name}", table)
    catalog.create_views(spark, database, lasting.DEFINITIONS)
    yield database, frames
    spark.sql(f"DROP DATABASE {database} CASCADE")


@pytest.mark.parametrize("name", lasting.DEFINITIONS)
def test_view_equals_its_report(spark, warehouse, name):
    database, frames = warehouse
    expected = views.pipeline_health(frames) if name == "pipeline_health" else views.build(name, frames)
    found = spark.newSession().table(f"{database}.{name}")
    assert found.columns == expected.columns
    assert [tuple(r) for r in found.collect()] == [tuple(r) for r in expected.collect()]


def test_views_are_replaced(spark, warehouse):
    database, _ = warehouse
    assert f"{database}.v_fraud_by_type" in catalog.create_views(spark, database, lasting.DEFINITIONS)
