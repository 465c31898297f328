"""Time parsing and day partitions. All calendar columns are UTC."""

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_text(moment: Column) -> Column:
    """ISO-8601 text with microseconds and zone offset, as producers send it."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def moment(text: Column) -> Column:
    """Timestamp from ISO text (or a timestamp already), NULL when unreadable."""
    return F.try_to_timestamp(text.cast("string"))


def day_parts(at: Column) -> dict[str, Column]:
    """Zero-padded text columns naming the day partition of a timestamp."""
    return {
        "year": F.date_format(at, "yyyy"),
        "month": F.date_format(at, "MM"),
        "day": F.date_format(at, "dd"),
    }


def day_filter(day: dt.date) -> Column:
    """Predicate on the partition columns alone, so Spark prunes directories."""
    return (
        (F.col("year") == f"{day:%Y}")
        & (F.col("month") == f"{day:%m}")
        & (F.col("day") == f"{day:%d}")
    )


def day_folder(root: str, day: dt.date) -> str:
    return f"{root}/year={day:%Y}/month={day:%m}/day={day:%d}"


def minutes_between(start: Column, end: Column) -> Column:
    """Number of minute boundaries crossed from start to end."""
    return F.timestamp_diff("MINUTE", F.date_trunc("minute", start), F.date_trunc("minute", end))
