"""The ledger as a CSV file."""

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paytrail import contract as c
from paytrail.session import shared_dir

#: Rows of a slice's end up to which one task takes it.
ONE_TASK = 100_000
POSITION = "position_from_0"
_FILE, _START, _INDEX = "ordered_file", "ordered_start", "ordered_index"

log = logging.getLogger(__name__)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Read a ledger with header. Values that do not fit their type become NULL.

    A column missing from the file is reported and NULL, so that its rows are quarantined with
    a reason. Several files must agree on their header; one that differs is an error.
    """
    text = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    missing = [name for name in c.LEDGER_SCHEMA.names if name not in text.columns]
    if missing:
        log.warning("ledger columns not found: %s", ", ".join(missing))
    typed = {
        f.name: (F.lit(None) if f.name in missing else F.col(f.name)).try_cast(f.dataType)
        for f in c.LEDGER_SCHEMA.fields
    }
    return text.withColumns(typed)


def unknown_type() -> Column:
    """Whether the type is outside the known set; true for NULL."""
    return ~F.coalesce(F.col("type").isin(*c.TRANSACTION_TYPES), F.lit(False))


def unknown_types(ledger: DataFrame) -> DataFrame:
    """Distinct transaction types outside the known set; NULL counts as one."""
    return ledger.where(unknown_type()).select("type").distinct()


def ledger_slice(
    ledger: DataFrame, order, skip: int = 0, limit: int | None = None, one_task: int = ONE_TASK
) -> DataFrame:
    """Skip the first rows in the given order and keep at most ``limit`` after them.

    ``order`` names columns that tell all rows apart. A slice that ends within the first
    ``one_task`` rows is taken by one task; for a deeper or open one all rows are stored in order
    and picked by their position, so no task has more than its share. Result rows are ordered.
    """
    if limit is None and not skip:
        return ledger.orderBy(*order)
    if limit is not None and skip + limit <= one_task:
        return ledger.orderBy(*order).offset(skip).limit(limit)
    rows = numbered(ledger, order)
    kept = F.col(POSITION) >= skip
    if limit is not None:
        kept &= F.col(POSITION) < skip + limit
    return rows.where(kept).orderBy(POSITION).drop(POSITION)


def numbered(df: DataFrame, order) -> DataFrame:
    """The rows stored in the given order, with their position from 0.

    The sorted files are numbered: rows before a file (one count a file comes to the driver) plus
    the row's index in it. Partitions that a sort leaves empty have no file.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "ordered")
    df.orderBy(*order).write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    file = F.col("_metadata.file_name")
    sizes = sorted(
        (int(row.file.split("-")[1]), row.file, row.n)
        for row in stored.groupBy(file.alias("file")).agg(F.count(F.lit(1)).alias("n")).collect()
    )
    before, starts = 0, []
    for _, name, n in sizes:
        starts.append((name, before))
        before += n
    starts = spark.createDataFrame(starts, f"{_FILE} string, {_START} long")
    placed = stored.select("*", file.alias(_FILE), F.col("_metadata.row_index").alias(_INDEX)).join(starts, _FILE)
    return placed.withColumn(POSITION, F.col(_START) + F.col(_INDEX)).select(*df.columns, POSITION)
