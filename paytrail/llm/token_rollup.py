"""Token counts kept up to date by signed changes.

A change inserts, deletes or revises the count of one document under one tokenizer version.
Each batch of changes is summed by source, language and tokenizer version before it is written, so
totals are sums of small additive tables. A batch counts once: its rows carry the name of
the attempt that wrote them, and only the first attempt in the commit log is read.
"""

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paytrail.llm.common import shipped, store
from paytrail.llm.packing import encode

DIMENSIONS = ["source", "lang", "tokenizer"]
MEASURES = ["docs", "tokens"]
DELTAS = "source string, lang string, tokenizer string, docs long, tokens long, batch_id string, attempt string"
COMMITS = "batch_id string, attempt string, at double"


def count_tokens(df: DataFrame, texts: dict[str, tuple[str, str]]) -> DataFrame:
    """Add a column for each entry name -> (text column, vocabulary file): its number of tokens.

    A null text has 0 tokens, and the text columns are dropped.
    """
    from pyspark.sql import types as T

    read = {text for text, _ in texts.values()}
    kept = [f for f in df.schema.fields if f.name not in read]
    schema = T.StructType([*kept, *(T.StructField(name, T.LongType()) for name in texts)])

    def run(batches):
        for batch in batches:
            counts = [
                pa.array([len(encode(t, vocabulary)) if t else 0 for t in batch.column(text).to_pylist()], pa.int64())
                for text, vocabulary in texts.values()
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), *counts], schema.names
            )

    return shipped(df).mapInArrow(run, schema)


def insert(rows: DataFrame, tokens) -> DataFrame:
    """Changes (source, lang, tokenizer, docs, tokens) that add documents."""
    return rows.select(*DIMENSIONS, F.lit(1).cast("long").alias("docs"), tokens.cast("long").alias("tokens"))


def delete(rows: DataFrame, tokens) -> DataFrame:
    """Changes that take documents with their last known count away."""
    return rows.select(*DIMENSIONS, F.lit(-1).cast("long").alias("docs"), (-tokens).cast("long").alias("tokens"))


def revise(rows: DataFrame, old, new) -> DataFrame:
    """Changes that put a new count in the place of the old one."""
    return rows.select(*DIMENSIONS, F.lit(0).cast("long").alias("docs"), (new - old).cast("long").alias("tokens"))


class Rollup:
    """Totals in a folder all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        for name, schema in (("deltas", DELTAS), ("commits", COMMITS)):
            spark.createDataFrame([], schema).write.mode("append").parquet(f"{path}/{name}")

    def _read(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def commit(self, batch_id: str, changes: DataFrame, attempt: str | None = None) -> bool:
        """Add a batch once; False if it was there already.

        An attempt that is cut off before its line in the log leaves rows nobody reads, and
        of two attempts at the same time the earlier line wins. Null dimensions are groups of
        their own; an empty batch is committed without rows.
        """
        if not self._read("commits", COMMITS).where(F.col("batch_id") == batch_id).isEmpty():
            return False
        attempt = attempt or uuid.uuid4().hex
        summed = changes.groupBy(*DIMENSIONS).agg(*(F.sum(m).alias(m) for m in MEASURES))
        named = summed.withColumns({"batch_id": F.lit(batch_id), "attempt": F.lit(attempt)})
        named.write.mode("append").parquet(f"{self.path}/deltas")
        line = self.spark.range(1).select(
            F.lit(batch_id).alias("batch_id"), F.lit(attempt).alias("attempt"),
            F.unix_micros(F.current_timestamp()).cast("double").alias("at"),
        )
        line.write.mode("append").parquet(f"{self.path}/commits")
        return True

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, docs, tokens) over all committed batches; zeros are left out."""
        counted = self._read("commits", COMMITS).groupBy("batch_id").agg(
            F.min_by("attempt", F.struct("at", "attempt")).alias("attempt")
        )
        rows = self._read("deltas", DELTAS).join(counted, ["batch_id", "attempt"], "left_semi")
        summed = rows.groupBy(*DIMENSIONS).agg(*(F.sum(m).alias(m) for m in MEASURES))
        return summed.where("docs <> 0 or tokens <> 0")


V1, V2 = "byte_bpe_50k", "byte_bpe_multi_50k"


def history(docs: DataFrame) -> dict[str, DataFrame]:
    """Three batches of changes derived from ``docs``: load, revision, retokenization.

    All rows are inserted under version 1. Then, by crc32 of the doc_id modulo 10, the rows
    of class 3 are deleted and those of class 5 lose the second half of their text; the
    rows of class 7 go over to version 2.
    """
    kind = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10
    half = F.substr("text", F.lit(1), (F.length("text") / 2).cast("int"))
    rows = docs.select("source", "lang", "text", kind.alias("kind")).withColumns({
        "half": F.when(F.col("kind") == 5, half), "again": F.when(F.col("kind") == 7, F.col("text")),
    })
    counted = store(count_tokens(rows, {
        "tokens": ("text", f"{V1}.tiktoken"), "revised": ("half", f"{V1}.tiktoken"),
        "second": ("again", f"{V2}.tiktoken"),
    }), "rollup-counts")
    first = counted.withColumn("tokenizer", F.lit(V1))
    moved = counted.where("kind = 7")
    return {
        "load": insert(first, F.col("tokens")),
        "revision": delete(first.where("kind = 3"), F.col("tokens")).unionByName(
            revise(first.where("kind = 5"), F.col("tokens"), F.col("revised"))
        ),
        "retokenization": delete(moved.withColumn("tokenizer", F.lit(V1)), F.col("tokens")).unionByName(
            insert(moved.withColumn("tokenizer", F.lit(V2)), F.col("second"))
        ),
    }
