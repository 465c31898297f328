"""Warehouse tables and views in the session catalog."""

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from paytrail import contract as c
from paytrail.sources.snapshots import Day, DayTable


def create_table(spark: SparkSession, table: str, days: DayTable) -> None:
    """Declare an external table over the current days of a published one."""
    schema, _ = c.WAREHOUSE_TABLES[table.rpartition(".")[2]]
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) "
        f"USING parquet PARTITIONED BY ({days.column}) LOCATION '{days.root}'"
    )
    current, _ = days.snapshot()
    for day in current:
        _point(spark, table, days, day)
    spark.catalog.refreshTable(table)


def show_day(table: str, days: DayTable, day: dt.date) -> None:
    """Point a declared table's partition to the day's current version; other tables are left alone."""
    if days.spark.catalog.tableExists(table):
        current, _ = days.snapshot()
        for found in (d for d in current if d.day == day):
            _point(days.spark, table, days, found)
        days.spark.catalog.refreshTable(table)


def _point(spark: SparkSession, table: str, days: DayTable, day: Day) -> None:
    where = f"PARTITION ({days.column} = DATE '{day.day.isoformat()}')"
    if not day.row_count:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {where}")
        return
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {where} LOCATION '{days.folder(day)}'")
    spark.sql(f"ALTER TABLE {table} {where} SET LOCATION '{days.folder(day)}'")


def create_views(spark: SparkSession, database: str, definitions: dict[str, Callable[[str], str]]) -> list[str]:
    """Create or replace views in a catalog database over its declared tables.

    A definition gives a view's SELECT for a database. The views last as long as the catalog
    and are read from any session; they see a day as soon as ``show_day`` points to it.
    """
    for name, define in definitions.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {define(database)}")
    return [f"{database}.{name}" for name in definitions]


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Save a managed table in buckets of ``key``, sorted inside each.

    Tables with as many buckets of one key join and aggregate by it without a shuffle.
    """
    (
        df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
        .mode("overwrite").saveAsTable(table)
    )


def run_sql(spark: SparkSession, query: str, args: dict | None = None) -> DataFrame:
    """Run SQL with named parameters, e.g. ``WHERE transaction_date = :day``."""
    return spark.sql(query, args=args or {})
