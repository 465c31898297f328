"""Running sums in the true order of a key's rows, with no key in one task.

Rows are dealt to ranges of (key, order), so a key with a third of all rows lies in many ranges
one after the other. A row's sum is that of the ranges of its key before it, plus the sum inside
its range.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paytrail.llm.common import store

#: Rows of a range. One row for each range and key is what is summed over a whole key.
RANGE_ROWS = 20_000


def in_order(
    df: DataFrame, keys: list[str], order: list[str], weight: Column, purpose: str, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """``df`` with _before, _sum, _rank and _count.

    _before is the sum of the weights before a row in its key and _rank the number of rows, in
    ascending order of ``order`` (nulls first); _sum and _count are those of the whole key. Rows
    equal in ``order`` follow one another in an order that is fixed once. ``df`` must be
    stored and must not have columns that begin with an underscore.
    """
    ranges = max(1, -(-df.count() // range_rows))
    tied = df.withColumns({"_tie": F.monotonically_increasing_id(), "_weight": weight})
    dealt = store(
        tied.repartitionByRange(ranges, *keys, *order, "_tie").withColumn("_range", F.spark_partition_id()),
        purpose,
    )
    parts = [*keys, "_range"]
    one = F.lit(1).cast("long")
    sizes = dealt.groupBy(*parts).agg(F.sum("_weight").alias("_held"), F.sum(one).alias("_rows"))
    key = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    earlier = key.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(
        *parts, F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias("_base"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_base_rows"),
        F.sum("_held").over(key).alias("_sum"), F.sum("_rows").over(key).alias("_count"),
    )
    inside = Window.partitionBy(*parts).orderBy(*order, "_tie").rowsBetween(Window.unboundedPreceding, 0)
    local = dealt.withColumns({
        "_upto": F.sum("_weight").over(inside), "_row": F.sum(one).over(inside),
    })
    same = reduce(lambda a, b: a & b, (F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in parts))
    return local.alias("l").join(bases.alias("r"), same).select(
        *(F.col(f"l.`{c}`") for c in df.columns),
        (F.col("_base") + F.col("_upto") - F.col("_weight")).alias("_before"), "_sum",
        (F.col("_base_rows") + F.col("_row") - 1).alias("_rank"), "_count",
    )
