"""Aggregate building blocks shared by the daily features, the marts and the checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rows() -> Column:
    return F.count(F.lit(1))


def hits(condition: Column) -> Column:
    """Number of rows where the condition holds; unknown does not count."""
    return F.count_if(condition)


def sum_where(measure: Column, condition: Column) -> Column:
    """Sum over the rows where the condition holds; the other rows add zero."""
    return F.sum(F.when(condition, measure).otherwise(F.lit(0.0)))


def share(part: Column, whole: Column) -> Column:
    """part / whole, zero for an empty whole."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def carried(column: str) -> Column:
    """An attribute that depends on the grain. The maximum is the same on every run; first() is not."""
    return F.max(column)


def metric_value(metric: str) -> Column:
    """The event's value where its metric is the named one, else zero."""
    return F.when(F.col("metric") == metric, F.coalesce("value", F.lit(0.0))).otherwise(F.lit(0.0))
