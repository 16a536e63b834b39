"""Pairs of a Spark query and the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .oracle import with_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None):
    """Register a query under a name, with its SQL."""

    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_ctes(sql)
        return run

    return register


def rounded(names: str, digits: int = 6) -> list[Column]:
    """Columns rounded under their own names: sums of doubles depend on the order of the rows."""
    return [F.round(name, digits).alias(name) for name in names.split()]


def rounded_sql(names: str, digits: int = 6) -> str:
    return ", ".join(f"round({name}, {digits}) AS {name}" for name in names.split())
