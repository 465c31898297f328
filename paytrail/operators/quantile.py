"""Exact quantiles per group, for groups far too large for one task.

Built-in exact percentiles gather all distinct values of a group in one task.
Here values are first counted, then a histogram over value buckets locates the
bucket that holds the wanted rank, and only that bucket is put in order.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS_PER_E_FOLD = 1024


def _bucket(value: Column) -> Column:
    """Non-decreasing in the value, about 0.1 % wide, so few buckets cover all doubles.

    Infinities and not-a-number go to the outermost buckets.
    """
    size = F.log1p(F.abs(value)) * BUCKETS_PER_E_FOLD
    regular = (F.signum(value) * F.rint(size)).try_cast("bigint")
    return F.coalesce(regular, F.when(value < 0, F.lit(-(2**40))).otherwise(F.lit(2**40)))


def _same(left: list[str], right: list[str]) -> Column:
    return reduce(
        lambda a, b: a & b, (F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right))
    )


def _running(window):
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def exact_quantile(
    df: DataFrame, keys: list[str], value: str, q: float, name: str
) -> DataFrame:
    """Linearly interpolated q-quantile of ``value`` per group (NULL values ignored).

    Returns one row per group with ``keys`` and ``name``. Rows are reduced to
    (group, value, count) before the first shuffle; every later step works on
    those counts, and no step puts a whole group in order.
    """
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).alias("_value"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_bucket", _bucket(F.col("_value")))
    )

    group = Window.partitionBy(*keys)
    histogram = counts.groupBy(*keys, "_bucket").agg(F.sum("_n").alias("_rows"))
    upto = F.sum("_rows").over(_running(group.orderBy("_bucket")))
    position = (F.sum("_rows").over(group) - 1) * F.lit(float(q))
    wanted = (
        histogram.select(
            *(F.col(k).alias(f"_{k}") for k in keys),
            F.col("_bucket").alias("_wanted_bucket"),
            (upto - F.col("_rows")).alias("_before"),
            upto.alias("_upto"),
            F.floor(position).alias("_low_rank"),
            F.ceil(position).alias("_high_rank"),
            (position - F.floor(position)).alias("_weight"),
        )
        .where((F.col("_before") <= F.col("_high_rank")) & (F.col("_upto") > F.col("_low_rank")))
    )

    within = _running(Window.partitionBy(*keys, "_bucket").orderBy("_value"))
    end = F.col("_before") + F.sum("_n").over(within)
    ranked = (
        counts.join(
            wanted,
            _same([*keys, "_bucket"], [*(f"_{k}" for k in keys), "_wanted_bucket"]),
        )
        .withColumn("_end", end)
        .withColumn("_start", F.col("_end") - F.col("_n"))
    )

    def value_at(rank: str) -> Column:
        inside = (F.col("_start") <= F.col(rank)) & (F.col("_end") > F.col(rank))
        return F.max(F.when(inside, F.col("_value")))

    low, high = value_at("_low_rank"), value_at("_high_rank")
    return ranked.groupBy(*keys).agg(
        (low + (high - low) * F.max("_weight")).alias(name)
    )
