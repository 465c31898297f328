"""Order-independent sums over money held in doubles.

Adding doubles gives a result that depends on the order in which partitions are
merged. Ledger amounts are whole cents, so they are added as integers, which is
exact, repeatable after a lost executor, and as cheap as adding doubles. Where a
group holds a value that is no whole number of cents, or its total leaves the
range of a long, its values are added at ten decimals, if that is what they have.
Where one has more, or is huge, the plain double sum is returned instead, which
may differ in its last digits with the order. Nothing is rounded away and nothing fails.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(value: Column) -> Column:
    """The value in cents as a long, NULL unless that is exactly the value."""
    scaled = F.rint(value * 100).try_cast("bigint")
    return F.when(scaled / F.lit(100.0) == value, scaled)


def round_cents(value: Column) -> Column:
    """Round to cents, ties to even; doubles too large to hold cents stay as they are."""
    return F.when(F.abs(value) < 7e13, F.rint(value * 100) / F.lit(100.0)).otherwise(value)


def total_cents(value: Column) -> Column:
    """Aggregate: the group's total in cents, NULL if it is not exact."""
    exact = cents(value)
    return F.when(F.count(exact) == F.count(value), F.try_sum(exact))


def fine(value: Column) -> Column:
    """Aggregate: the group's sum at ten decimals, the same in any order; NULL if one value has more."""
    fitted = value.try_cast("decimal(28,10)")
    return F.when(F.count_if(fitted.cast("double") == value) == F.count(value), F.try_sum(fitted))


def total(value: Column) -> Column:
    """Aggregate: sum of a money column, independent of the order unless values are huge or very fine."""
    return F.coalesce(total_cents(value) / F.lit(100.0), fine(value).cast("double"), F.sum(value))


def mean(value: Column) -> Column:
    """Aggregate: mean of a money column, NULL for an empty group."""
    return F.try_divide(total(value), F.count(value))


def partial(value: Column, name: str) -> list[Column]:
    """Aggregates from which ``merged`` adds up the sums of several groups."""
    return [
        F.count(value).alias(f"{name}_n"), total_cents(value).alias(f"{name}_cents"),
        fine(value).alias(f"{name}_fine"), F.sum(value).alias(f"{name}_sum"),
    ]


def merged(name: str) -> Column:
    """Aggregate: what ``total`` gives of all rows, from the ``partial`` of their groups."""
    held = F.col(f"{name}_n") > 0

    def exact(part: str) -> Column:
        return F.when(F.count_if(held & F.col(part).isNull()) == 0, F.try_sum(part))

    return F.coalesce(
        exact(f"{name}_cents") / F.lit(100.0), exact(f"{name}_fine").cast("double"), F.sum(f"{name}_sum")
    )


def merged_mean(name: str) -> Column:
    return F.try_divide(merged(name), F.sum(f"{name}_n"))


def percent(part: Column, whole: Column, digits: int) -> Column:
    """Share in percent, NULL when there is no whole."""
    return F.round(F.try_divide(part.cast("double") * 100, whole.cast("double")), digits)
