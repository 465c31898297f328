"""Day-partitioned Parquet tables."""

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paytrail import contract as c
from paytrail.functions.calendar import day_folder
from paytrail.sources.snapshots import DayTable


class DataGateError(RuntimeError):
    """A stage's input is not there."""


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Read Parquet, optionally with an enforced schema; an empty table is an error."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    if df.isEmpty():
        raise ValueError(f"no data at {path}")
    return df


def write_table(df: DataFrame, path: str, partition_by=(), mode: str = "overwrite") -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def day_text(files: DataFrame) -> DataFrame:
    """Restore year, month and day as zero-padded text; inference makes them numbers.

    Filters on them still prune folders, as they only involve partition columns.
    """
    widths = dict(zip(c.DAY_PARTITION, (4, 2, 2)))
    return files.withColumns({
        name: F.lpad(F.col(name).cast("string"), width, "0") for name, width in widths.items()
    })


def read_days(spark: SparkSession, root: str) -> DataFrame:
    """All days of a table, with its day columns. Filters on these prune folders."""
    return day_text(spark.read.parquet(root))


def read_day(spark: SparkSession, root: str, day: dt.date) -> DataFrame:
    """One day of a table, without its day columns. Only that day's folder is listed."""
    return (
        spark.read.option("basePath", root).parquet(day_folder(root, day)).drop(*c.DAY_PARTITION)
    )


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """One row per Parquet file under a root, with its partition columns; reads no data."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .load(root)
        .drop("content")
    )


def count_files(spark: SparkSession, path: str) -> int:
    """Number of Parquet files under a path, 0 when the path does not exist."""
    try:
        return list_files(spark, path).count()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return 0
        raise


def require_files(spark: SparkSession, root: str, day: dt.date, minimum: int = 1) -> int:
    """Gate: the day has at least ``minimum`` files."""
    found = count_files(spark, day_folder(root, day))
    if found < minimum:
        raise DataGateError(f"expected at least {minimum} files for {day} in {root}, found {found}")
    return found


def require_day(table: DayTable, day: dt.date) -> None:
    """Gate: the day was committed, with rows or without. Files of no commit do not count."""
    if not table.has(day):
        raise DataGateError(f"{day} is not committed in {table.root}")


def require_rows(tables: dict[str, DataFrame], day: dt.date) -> None:
    """Gate: every table has rows for the day."""
    on_day = F.col("transaction_date") == F.lit(day)
    empty = [name for name, df in tables.items() if df.where(on_day).isEmpty()]
    if empty:
        raise DataGateError(f"no rows for {day} in {', '.join(empty)}")
