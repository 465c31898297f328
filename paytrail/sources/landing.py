"""Landed messages as their sink committed them, one day at a time, and compacted.

The streaming sink logs every file it commits. That log is read as a table, so a file that no batch
committed is never seen, and a day costs the listing of its own files only. Finished days
are rewritten into even files under commits of their own. Each compacted row names the landed file
it came from, so a message that lands later for such a day is still read, and none is read twice.
"""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paytrail import contract as c
from paytrail.functions.calendar import day_folder
from paytrail.operators.rescue import FAULTS, RESCUED
from paytrail.operators.routing import REASONS
from paytrail.sources import files
from paytrail.sources.snapshots import DayTable, NoSnapshot
from paytrail.sources.tables import DataGateError

BRONZE, QUARANTINE = "bronze", "quarantine"
DAY, ORIGIN = "landed_day", "landed_file"

# What a landed row holds. Reason and raw text only in quarantine, rescued fields where some are.
LANDED_SCHEMA = T.StructType([
    *(f for f in c.BRONZE_SCHEMA.fields if f.name not in c.DAY_PARTITION),
    T.StructField(REASONS, T.StringType()), T.StructField("raw_value", T.StringType()),
    T.StructField(RESCUED, T.StringType()), T.StructField(FAULTS, T.StringType()),
])
# Fields of a line in the log of Spark's file sink.
_LOGGED = "path string, size long, action string"


class Landing:
    """The folder a sink writes to, and a folder for its compacted days."""

    def __init__(self, spark: SparkSession, root: str, compacted: str):
        self.spark, self.root = spark, root
        self.compacted = DayTable(spark, compacted, DAY)

    def committed(self, route: str = BRONZE) -> DataFrame:
        """(path, size, day) of each committed file of a route; day is null for rows without a time."""
        log = f"{self.root}/_spark_metadata"
        if not files.exists(self.spark, log):
            return self.spark.createDataFrame([], "path string, size long, day date")
        # Readers of files skip hidden folders, so the lines come as text of an RDD. The log's
        # version comes first in each file and is no JSON; merged logs repeat lines.
        lines = self.spark.sparkContext.textFile(f"{log}/[0-9]*")
        logged = self.spark.read.schema(_LOGGED).json(lines).where("path is not null")
        live = logged.groupBy("path").agg(
            F.max("size").alias("size"), F.count_if(F.col("action") == "delete").alias("deleted")
        ).where("deleted = 0")
        parts = [F.regexp_extract("path", rf"/{name}=(\d+)/", 1).try_cast("int") for name in c.DAY_PARTITION]
        return live.where(F.contains("path", F.lit(f"/route={route}/"))).select(
            "path", "size", F.make_date(*parts).alias("day")
        )

    def day_files(self, day: dt.date, route: str = BRONZE) -> list[str]:
        """Committed files of one day."""
        found = self.committed(route).where(F.col("day") == F.lit(day)).select("path").collect()
        return sorted(row.path for row in found)

    def require_files(self, day: dt.date, minimum: int = 1) -> int:
        """Gate: the day has at least ``minimum`` committed Bronze files."""
        found = len(self.day_files(day))
        if found < minimum:
            raise DataGateError(f"expected at least {minimum} files for {day} in {self.root}, found {found}")
        return found

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            named = T.StructType([*LANDED_SCHEMA.fields, T.StructField(ORIGIN, T.StringType())])
            return self.spark.createDataFrame([], named)
        rows = self.spark.read.schema(LANDED_SCHEMA).parquet(*paths)
        return rows.withColumn(ORIGIN, F.col("_metadata.file_name"))

    def _compacted(self, day: dt.date) -> DataFrame | None:
        try:
            rows = self.compacted.read([day]).drop(DAY)
        except NoSnapshot:
            return None
        return rows if self.compacted.has(day) else None

    def _whole(self, day: dt.date) -> DataFrame:
        """All committed Bronze rows of a day with the landed file of each."""
        done, paths = self._compacted(day), self.day_files(day)
        if done is None:
            return self._read(paths)
        covered = {row[0] for row in done.select(ORIGIN).distinct().collect()}
        late = [path for path in paths if path.rpartition("/")[2] not in covered]
        return done.unionByName(self._read(late)) if late else done

    def read_day(self, day: dt.date) -> DataFrame:
        """Bronze rows of one day, compacted or not, without its day columns."""
        return self._whole(day).drop(ORIGIN, REASONS, "raw_value", RESCUED, FAULTS)

    def compact(self, day: dt.date, cluster_by=("nameOrig",)) -> int:
        """Rewrite a day's committed rows into even files; returns the rows written.

        Run again, it takes in what landed since. Cut off, it leaves the day as it was.
        """
        return self.compacted.publish(self._whole(day).withColumn(DAY, F.lit(day)), day, cluster_by)

    def purge(self, day: dt.date) -> int:
        """Delete a day's landed files that are compacted; returns how many.

        The sink's log still names them, so from then on the day is read here only.
        """
        done = self._compacted(day)
        names = {row[0] for row in done.select(ORIGIN).distinct().collect()} if done else set()
        folder = day_folder(f"{self.root}/route={BRONZE}", day)
        return sum(files.delete(self.spark, f"{folder}/{name}") for name in names)
