"""Rows laid out along a space-filling curve over several columns.

Each column is cut into ranks at its quantiles, so skewed values spread evenly, and the bits of the
ranks are interleaved (Morton order). Rows near each other in all columns then share files, and
the least and greatest value of each file rule most of them out for a range in any of the columns.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of a column's rank: 2 ** BITS ranks, whose bounds come to the driver.
BITS = 6
ACCURACY = 10_000
#: Characters of a text that its rank looks at.
PREFIX = 7


def _number(df: DataFrame, name: str) -> Column:
    """A number that keeps the column's order; of texts the first seven bytes count."""
    if isinstance(df.schema[name].dataType, T.StringType):
        start = F.substring(F.encode(F.col(name), "UTF-8"), 1, PREFIX)
        return F.conv(F.rpad(F.hex(start), 2 * PREFIX, "0"), 16, 10).cast("double")
    if isinstance(df.schema[name].dataType, (T.DateType, T.TimestampType)):
        return F.unix_seconds(F.col(name).cast("timestamp")).cast("double")
    return F.col(name).cast("double")


def ranks(df: DataFrame, columns: list[str], bits: int = BITS) -> list[Column]:
    """Rank of each column among its quantiles, 0 for NULL; one pass over the columns."""
    shares = [i / 2**bits for i in range(1, 2**bits)]
    numbers = [_number(df, name) for name in columns]
    found = df.agg(*(F.percentile_approx(n, shares, ACCURACY).alias(f"_{i}") for i, n in enumerate(numbers))).first()

    def rank(number: Column, bounds: list[float] | None) -> Column:
        known = F.array(*map(F.lit, sorted(set(bounds or []))))
        return F.coalesce(F.size(F.filter(known, lambda b: b <= number)), F.lit(0)) if bounds else F.lit(0)

    return [rank(n, bounds) for n, bounds in zip(numbers, found, strict=True)]


def interleaved(parts: list[Column], bits: int = BITS) -> Column:
    """Morton number of the parts: their bits in turn, the highest first."""
    return reduce(lambda a, b: a.bitwiseOR(b), (
        F.shiftleft(F.shiftright(part.cast("long"), bit).bitwiseAND(F.lit(1)), bit * len(parts) + i)
        for bit in range(bits) for i, part in enumerate(parts)
    ))


def lay_out(df: DataFrame, columns: list[str], files: int) -> DataFrame:
    """``df`` in about ``files`` even ranges of the curve over ``columns``, sorted inside each.

    Ranges of equal rows are cut by a hash of the row, so no range grows with one value.
    """
    name = "_curve"
    placed = df.withColumn(name, interleaved(ranks(df, columns)))
    order = [F.col(name), F.xxhash64(*columns, F.monotonically_increasing_id())]
    return placed.repartitionByRange(files, *order).sortWithinPartitions(name, *columns).drop(name)


def file_bounds(stored: DataFrame, columns: list[str]) -> DataFrame:
    """(file, least, greatest) of stored rows: the columns' values as structs."""
    path = F.col("_metadata.file_path").alias("file")
    return stored.groupBy(path).agg(
        F.struct(*(F.min(c).alias(c) for c in columns)).alias("least"),
        F.struct(*(F.max(c).alias(c) for c in columns)).alias("greatest"),
    )


def meets(within: dict[str, tuple]) -> Column:
    """Whether a file's bounds meet all ranges (first and last value, both included)."""
    return reduce(lambda a, b: a & b, (
        (F.col(f"greatest.{name}") >= F.lit(low)) & (F.col(f"least.{name}") <= F.lit(high))
        for name, (low, high) in within.items()
    ))


def inside(within: dict[str, tuple]) -> Column:
    """Whether a row lies in all ranges."""
    return reduce(lambda a, b: a & b, (F.col(name).between(*bounds) for name, bounds in within.items()))
