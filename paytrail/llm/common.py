"""Helpers shared by the operators: stored tables, stable numbering, components."""

import os
import shutil
import tempfile
from functools import cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paytrail.session import prepare, shared_dir

#: Frees a finished job's shuffle files instead of keeping them until garbage collection.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@cache
def _ship(application: str, context) -> None:
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    name = os.path.join(tempfile.mkdtemp(), "paytrail")
    context.addPyFile(shutil.make_archive(name, "zip", root, "paytrail"))


#: Rows handed to Python at a time. Texts are long: the usual 10,000 hold too much memory.
BATCH_ROWS = 1000


def shipped(df: DataFrame) -> DataFrame:
    """The same frame, after this package has been sent to the executors' Python."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    context = df.sparkSession.sparkContext
    _ship(context.applicationId, context)
    return df


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def store(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the folder all executors share and read back: cuts lineage, survives lost executors.

    The shuffle files of the write go at once. They are kept for frames that are
    returned, as those may be run again.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    before = spark.conf.get(CLEANUP, None)
    if before is not None:
        spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is not None:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def running(
    df: DataFrame, keys: list[str], order: list[Column], weight: Column, name: str,
    bucket_rows: int = 20_000, rank: str | None = None,
) -> DataFrame:
    """Add the sum of the weights before each row of its key, never a whole key in one task.

    Rows are dealt to buckets by the hash of ``order``; a bucket begins at the prefix sum of
    the buckets before it, so sums follow the buckets and, inside a bucket, the order.
    Rows equal in all of ``order`` share a bucket and are interchangeable. With ``rank``, a
    column of whole numbers with few distinct ones, sums follow it at any size, and only the
    rows of one number are dealt by hash. Such a ``df`` must be stored, as it is read twice.
    """
    if rank is None:
        dealt, ranks = df, []
        buckets = F.lit(max(1, -(-df.count() // bucket_rows)))
    else:
        ranks = ["_rank"]
        # Numbers with more rows than a bucket holds: one row here for each full bucket at most.
        large = df.groupBy(F.col(rank).alias("_value")).agg(F.count(F.lit(1)).alias("_rows")).where(
            F.col("_rows") > bucket_rows
        ).collect()
        dealt = df.withColumn("_rank", F.col(rank))
        many = [F.lit(x) for r in large for x in (r["_value"], -(-r["_rows"] // bucket_rows))]
        buckets = F.coalesce(F.create_map(*many)[F.col("_rank")], F.lit(1)) if many else F.lit(1)
    dealt = dealt.withColumns({
        "_bucket": F.pmod(F.xxhash64(*order), buckets).cast("int"), "_weight": weight,
    })
    parts = [*keys, *ranks, "_bucket"]
    sizes = dealt.groupBy(*parts).agg(F.sum("_weight").alias("_size"))
    earlier = Window.partitionBy(*keys).orderBy(*ranks, "_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    bases = sizes.select(*parts, F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = dealt.withColumn("_at", F.sum("_weight").over(inside) - F.col("_weight"))
    same = reduce(
        lambda a, b: a & b, (F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in parts)
    )
    return local.alias("l").join(bases.alias("r"), same).select(
        *(F.col(f"l.{c}") for c in df.columns), (F.col("_base") + F.col("_at")).alias(name)
    )


def numbered(
    df: DataFrame, keys: list[str], order: list[Column], name: str, bucket_rows: int = 20_000
) -> DataFrame:
    """Number the rows of each key from 0 without gaps, in the order of ``running``."""
    return running(df, keys, order, F.lit(1).cast("long"), name, bucket_rows)


def components(edges: DataFrame, purpose: str) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): rows (node, root), root the smallest.

    Alternates large-star and small-star until the edges stop changing; every pass is
    stored. All groupings combine before their shuffle and joins are on single
    nodes, so adaptive execution can split a hub. Self loops only name a node.
    """
    def stars(pairs):
        return pairs.where("a <> b").distinct()

    now = store(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        purpose,
    )
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = stars(
            both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        )
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a")
        small = stars(
            small.select("a", F.col("low").alias("b")).unionByName(
                small.select(
                    F.greatest("b", "low").alias("a"), F.least("b", "low").alias("b")
                )
            )
        )
        now = store(small, purpose)
        found = now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
        ).first()
        if tuple(found) == mark:
            break
        mark = tuple(found)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
