"""A table filled by a stream batch by batch, each batch counted once.

The file sink does this for plain appends. Here a batch may be any DataFrame made of the stream's
rows, as ``foreachBatch`` hands it over. Its rows go to a folder of their own and then a commit names
the folder; a batch replayed after a crash finds its commit and writes nothing, or no commit
and writes its rows under a new name. So rows of a batch cut off are never read.
"""

import json
import threading
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from paytrail.sources import files

# What a commit says of a batch.
COMMIT = T.StructType([
    T.StructField("query", T.StringType()), T.StructField("batch", T.LongType()),
    T.StructField("folder", T.StringType()),
])


class BatchTable:
    """Rows of one or more queries under one root; a query goes by the name its writer gives."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _commit(self, query: str, batch: int) -> str:
        return f"{self.root}/commits/query={query}/batch={batch}"

    def has(self, query: str, batch: int) -> bool:
        return files.exists(self.spark, f"{self._commit(query, batch)}/_SUCCESS")

    def append(self, df: DataFrame, query: str, batch: int) -> bool:
        """Write a batch and commit it; False, and nothing written, if it is committed already.

        Of one query one run at a time may write, which its checkpoint sees to.
        """
        if self.has(query, batch):
            return False
        folder = f"rows/query={query}/batch={batch}/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{folder}")
        row = self.spark.createDataFrame([(query, batch, folder)], COMMIT)
        row.coalesce(1).write.mode("overwrite").json(self._commit(query, batch))
        return True

    def batches(self) -> DataFrame:
        """(query, batch, folder) of each committed batch."""
        found = f"{self.root}/commits/query=*/batch=*/*.json"
        try:
            return self.spark.read.schema(COMMIT).json(found)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return self.spark.createDataFrame([], COMMIT)
            raise

    def read(self, schema: T.StructType) -> DataFrame:
        """Rows of all committed batches. Batches without rows have files without any."""
        folders = [f"{self.root}/{row.folder}" for row in self.batches().select("folder").collect()]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)


def start_batches(
    df: DataFrame, table: BatchTable, query: str, checkpoint: str, trigger=None,
    write: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Append each batch of a stream to ``table``. ``write`` may wrap the append."""
    def append(rows: DataFrame, batch: int) -> None:
        table.append(rows, query, batch)

    return (
        df.writeStream.foreachBatch(write or append)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
        .start()
    )


class ProgressLog(StreamingQueryListener):
    """Writes the metrics observed in each batch of a stream to a table of its own.

    Register it with ``spark.streams.addListener`` and name the observation ``name`` on the stream. A row
    is keyed by query and batch, so a batch reported twice counts once. Reports come
    after the batch; one that a lost driver never sent is missing from the table.
    """

    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.root, self.name = spark, root, name
        self._ended, self._change = set(), threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def wait(self, query: StreamingQuery, seconds: float = 120) -> None:
        """Wait until all reports of a run that has ended are written; they come on a thread of their own."""
        with self._change:
            if not self._change.wait_for(lambda: str(query.runId) in self._ended, seconds):
                raise TimeoutError(f"no end of {query.runId} was reported")

    def onQueryProgress(self, event) -> None:
        self.record(event.progress)

    def record(self, progress) -> None:
        """Write the row of one batch's progress, if it has the observation."""
        counts = progress.observedMetrics.get(self.name)
        if counts is None:
            return
        row = {
            "query": str(progress.id), "batch": progress.batchId, "reported_at": progress.timestamp,
            "input_rows": progress.numInputRows, **counts.asDict(),
        }
        files.write_text(self.spark, f"{self.root}/{progress.id}-{progress.batchId:012d}.json", json.dumps(row))

    def read(self) -> DataFrame:
        """One row per batch: query, batch, reported_at, input_rows and the observed counts."""
        return self.spark.read.json(self.root)


def observe_routes(routed: DataFrame, name: str) -> DataFrame:
    """Count, in each batch, the rows of each route and those that lost something in parsing."""
    reason = F.col("quarantine_reason")
    return routed.observe(
        name,
        F.count_if(reason.isNull()).alias("valid"),
        F.count_if(reason.isNotNull()).alias("quarantined"),
        F.count_if(F.col("rescue_reason").isNotNull()).alias("rescued"),
        F.count_if(F.coalesce(F.col("isFraud"), F.lit(0)) != 0).alias("fraud"),
    )
