"""Small boolean helpers for three-valued logic."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_null(names) -> Column:
    """TRUE when at least one of the columns is NULL, else FALSE."""
    return reduce(lambda a, b: a | b, (F.col(n).isNull() for n in names))


def holds(condition: Column) -> Column:
    """The condition with an unknown verdict counted as FALSE."""
    return F.coalesce(condition, F.lit(False))


def pipe_list(labelled: dict[str, Column]) -> Column:
    """Labels of all conditions that hold, in order, joined by a pipe."""
    return F.concat_ws("|", *(F.when(cond, label) for label, cond in labelled.items()))
