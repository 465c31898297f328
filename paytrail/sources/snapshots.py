"""Day tables whose days are replaced atomically.

Every publish writes its files into a version folder of its own, where no reader looks. Then one small
file, the commit, names the days and the version that now holds each; it appears as a whole or not
at all, and makes all of the publish's days current at once. A publish cut off before its commit
changes nothing, and a rerun writes another version. Versions replaced stay readable by the number
of an earlier commit until they are vacuumed.

    root/version=<id>/transaction_date=<day>/part-*.parquet
    root/bounds/version=<id>/part-*.parquet      least and greatest values of clustered files
    root/commits/<number>-<id>/part-*.json
"""

import datetime as dt
import json
import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paytrail.operators import clustering
from paytrail.sources import files

# What a commit says of each of its days.
COMMIT = T.StructType([
    T.StructField("sequence", T.LongType()), T.StructField("day", T.DateType()),
    T.StructField("version", T.StringType()), T.StructField("row_count", T.LongType()),
    T.StructField("columns", T.StringType()),
])


class NoSnapshot(LookupError):
    """Nothing was committed."""


@dataclass(frozen=True)
class Staged:
    """Files that are written but not current: rows per day of one version."""

    version: str
    row_counts: dict[dt.date, int]
    columns: str


@dataclass(frozen=True)
class Day:
    """The current version of one day."""

    day: dt.date
    version: str
    row_count: int
    sequence: int = field(compare=False)


class DayTable:
    """A table partitioned by a date column, kept as versions of its days under ``root``."""

    def __init__(self, spark: SparkSession, root: str, column: str = "transaction_date"):
        self.spark, self.root, self.column = spark, root, column

    # --- writing

    def stage(self, df: DataFrame, day: dt.date | None = None, cluster_by=()) -> Staged:
        """Write the files of a new version; readers do not see them.

        With a ``day`` the version holds that day's rows, none included. Without, it holds the days
        present in ``df``; a row without a day is an error. Rebalancing gives files of even
        size however uneven the days are, sorting by ``cluster_by`` lets readers skip row groups.
        """
        version = uuid.uuid4().hex
        folder = f"{self.root}/version={version}"
        at = F.col(self.column)
        rows = df.where(at == F.lit(day)) if day else df
        # The day as text: a missing one becomes a folder that is found and refused below.
        spread = rows.hint("rebalance") if day else rows.hint("rebalance", self.column)
        (
            spread.sortWithinPartitions(self.column, *cluster_by)
            .write.partitionBy(self.column).parquet(folder)
        )
        counts = self._counted(folder)
        if None in counts:
            raise ValueError(f"rows without {self.column}")
        columns = T.StructType([f for f in df.schema.fields if f.name != self.column]).json()
        return Staged(version, counts if day is None else {day: counts.get(day, 0)}, columns)

    def stage_clustered(self, df: DataFrame, day: dt.date, columns: list[str], files: int) -> Staged:
        """A version of one day in about ``files`` files along the curve over ``columns``, with their bounds."""
        version = uuid.uuid4().hex
        rows = clustering.lay_out(df.where(F.col(self.column) == F.lit(day)), columns, files)
        folder = f"{self.root}/version={version}"
        rows.write.partitionBy(self.column).parquet(folder)
        counts = self._counted(folder)
        if counts:
            written = self.spark.read.parquet(folder)
            clustering.file_bounds(written, columns).write.parquet(f"{self.root}/bounds/version={version}")
        kept = T.StructType([f for f in df.schema.fields if f.name != self.column])
        return Staged(version, {day: counts.get(day, 0)}, kept.json())

    def _counted(self, folder: str) -> dict[dt.date | None, int]:
        """Rows per day of the files just written, from their footers."""
        try:
            found = self.spark.read.parquet(folder)
        except AnalysisException as error:
            # A version without rows has no files, so no columns either.
            if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
                return {}
            raise
        if self.column not in found.columns:
            return {}
        days = found.groupBy(F.col(self.column).cast("date").alias("day")).count().collect()
        return {row["day"]: row["count"] for row in days}

    def commit(self, staged: Staged) -> int:
        """Make a staged version current; returns the commit's number.

        Of two publishers of one day the later commit counts, for the whole day.
        """
        if not staged.row_counts:
            return self.sequence()
        sequence = self.sequence() + 1
        rows = [(sequence, day, staged.version, n, staged.columns) for day, n in staged.row_counts.items()]
        self._write(rows, f"{sequence:012d}-{staged.version}")
        return sequence

    def _write(self, rows: list[tuple], name: str) -> None:
        # One task and so one file, which is renamed into place when it is complete.
        self.spark.createDataFrame(rows, COMMIT).coalesce(1).write.json(f"{self.root}/commits/{name}")

    def publish(self, df: DataFrame, day: dt.date | None = None, cluster_by=()) -> int:
        """Replace ``day``, or the days present in ``df``, at once; returns the rows written."""
        staged = self.stage(df, day, cluster_by)
        self.commit(staged)
        return sum(staged.row_counts.values())

    # --- reading

    def log(self) -> DataFrame:
        """(sequence, day, version, row_count, columns) of all commits; empty before the first."""
        commits = f"{self.root}/commits"
        if not files.exists(self.spark, commits):
            return self.spark.createDataFrame([], COMMIT)
        return self.spark.read.schema(COMMIT).option("recursiveFileLookup", True).json(commits)

    def sequence(self) -> int:
        """Number of the last commit, 0 before the first."""
        return self.log().agg(F.max("sequence")).first()[0] or 0

    def snapshot(self, as_of: int | None = None) -> tuple[list[Day], T.StructType]:
        """The current version of each day and the columns; one row per day comes to the driver."""
        commits = self.log()
        if as_of is not None:
            commits = commits.where(F.col("sequence") <= as_of)
        newest = Window.partitionBy("day").orderBy(F.desc("sequence"), F.desc("version"))
        current = commits.withColumn("_place", F.row_number().over(newest)).where("_place = 1").collect()
        if not current:
            raise NoSnapshot(f"nothing committed under {self.root}")
        columns = max(current, key=lambda r: (r.sequence, r.version)).columns
        days = [Day(r.day, r.version, r.row_count, r.sequence) for r in sorted(current, key=lambda r: r.day)]
        return days, T.StructType.fromJson(json.loads(columns))

    def folder(self, day: Day) -> str:
        return f"{self.root}/version={day.version}/{self.column}={day.day.isoformat()}"

    def has(self, day: dt.date) -> bool:
        """Whether the day was ever committed, with rows or without."""
        return not self.log().where(F.col("day") == F.lit(day)).isEmpty()

    def read(self, days=None, as_of: int | None = None) -> DataFrame:
        """All current days, or the chosen ones, as of a commit; only their folders are listed.

        Columns are those of the newest of the commits read; what an older day lacks is NULL.
        """
        current, columns = self.snapshot(as_of)
        schema = columns.add(self.column, T.DateType())
        chosen = [d for d in current if d.row_count and (days is None or d.day in days)]
        return self._open(list(map(self.folder, chosen)), schema)

    def _open(self, paths: list[str], schema: T.StructType) -> DataFrame:
        """Rows of folders or files of this table, if there are any."""
        if not paths:
            return self.spark.createDataFrame([], schema)
        stored = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
        return self.spark.read.schema(stored).option("basePath", self.root).parquet(*paths).select(*schema.names)

    def look_up(self, within: dict[str, tuple], days=None) -> DataFrame:
        """Rows in all ranges (first and last value, both included) of ``within``.

        Of clustered days only files whose bounds meet the ranges are opened.
        """
        current, columns = self.snapshot()
        schema = columns.add(self.column, T.DateType())
        paths = []
        for at in (d for d in current if d.row_count and (days is None or d.day in days)):
            bounds = f"{self.root}/bounds/version={at.version}"
            if not files.exists(self.spark, bounds):
                paths.append(self.folder(at))
                continue
            held = self.spark.read.parquet(bounds)
            if set(within) <= set(held.schema["least"].dataType.names):
                paths += [r.file for r in held.where(clustering.meets(within)).select("file").collect()]
            else:
                paths.append(self.folder(at))
        return self._open(paths, schema).where(clustering.inside(within))

    # --- upkeep

    def vacuum(self, keep: int = 2) -> int:
        """Delete versions of days that none of the last ``keep`` commits needs; returns how many.

        Earlier commits can no longer be read. The rows still needed are first written again as
        one commit file; a vacuum cut off leaves them twice, which counts once. Staged files are
        no part of any commit and stay.
        """
        last = self.sequence()
        found = self.log().select("*", F.col("_metadata.file_path").alias("path")).collect()
        rows = {row[: len(COMMIT)] for row in map(tuple, found)}
        oldest = max(0, last - keep + 1)
        below = {}
        for row in sorted(r for r in rows if r[0] <= oldest):
            below[row[1]] = row
        needed = {*below.values(), *(r for r in rows if r[0] > oldest)}
        if needed == rows:
            return 0
        self._write(sorted(needed), f"{last:012d}-{uuid.uuid4().hex}")
        for folder in {row.path.rpartition("/")[0] for row in found}:
            files.delete(self.spark, folder)
        lost = {(r[2], r[1]) for r in rows - needed} - {(r[2], r[1]) for r in needed}
        for version, day in lost:
            files.delete(self.spark, f"{self.root}/version={version}/{self.column}={day.isoformat()}")
        return len(lost)
