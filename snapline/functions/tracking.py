"""Column expressions over tracking frames."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Position groups.
RECEIVERS = ["WR", "TE", "RB"]
DEFENDERS = ["DE", "DT", "LB", "DB"]


def gap(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Straight-line distance."""
    return F.sqrt((x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2))


def seconds_between(start: Column, end: Column) -> Column:
    """Fractional seconds, to the microsecond; whole seconds would make every 10-20 Hz step zero.

    The difference as an interval: ``timestamp_diff`` gives the same, but first casts times without a zone to the session's.
    """
    return (end - start).cast("interval second").cast("decimal(18, 6)").cast("double")


def per_second(amount: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, amount / seconds).otherwise(0.0)


def is_receiver() -> Column:
    return F.col("position").isin(RECEIVERS)


def is_defender() -> Column:
    return F.col("position").isin(DEFENDERS)
