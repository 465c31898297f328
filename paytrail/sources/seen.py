"""Keys of all days seen so far, in buckets, so that copies sent on a later day are found.

The index is a catalog table partitioned by day and bucketed by the key. A day's rows are matched
with the days before it; only they are shuffled, to the index's buckets, however long the history
is. The day's new keys then replace those of its earlier run, so a rerun finds what it found.
"""

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paytrail import contract as c

BUCKETS = 32


class SeenKeys:
    """An index of message keys in the catalog table ``name``, made if it is not there."""

    def __init__(self, spark: SparkSession, name: str, key=c.DEDUP_KEY, buckets: int = BUCKETS):
        self.spark, self.name, self.parts = spark, name, list(key)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (key STRING, seen_on DATE) USING parquet "
            f"PARTITIONED BY (seen_on) CLUSTERED BY (key) SORTED BY (key) INTO {buckets} BUCKETS"
        )

    def key(self) -> Column:
        """The key as one text: Spark would not match a bucketed number that is no integer. NULL if a part is."""
        whole = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in self.parts))
        return F.when(whole, F.to_json(F.struct(*self.parts)))

    def before(self, day: dt.date) -> DataFrame:
        return self.spark.table(self.name).where(F.col("seen_on") < F.lit(day)).select("key")

    def unseen(self, rows: DataFrame, day: dt.date) -> DataFrame:
        """Rows of a day whose key no earlier day has; keys with a missing part are never copies."""
        # Merged, as the index lies in buckets of the key already; it is never sent to every task.
        old = self.before(day).withColumnRenamed("key", "_seen").hint("merge")
        return rows.withColumn("_key", self.key()).join(old, F.col("_key") == F.col("_seen"), "left_anti").drop("_key")

    def record(self, rows: DataFrame, day: dt.date) -> None:
        """Make the keys of ``rows``, which must not be read from this index, those first seen on ``day``."""
        view = f"_seen_{self.name.replace('.', '_')}"
        rows.select(self.key().alias("key")).where("key is not null").distinct().createOrReplaceTempView(view)
        try:
            self.spark.sql(
                f"INSERT OVERWRITE TABLE {self.name} PARTITION (seen_on = DATE '{day.isoformat()}') SELECT * FROM {view}"
            )
            self.spark.catalog.refreshTable(self.name)
        finally:
            self.spark.catalog.dropTempView(view)
