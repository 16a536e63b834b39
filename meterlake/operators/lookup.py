"""Joins of a fact table to a table with one row per key, safe for large tables and hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.measures import rows
from ..session import Measured, settle, total_bytes

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
ROWS_PER_TASK = 4_000_000
MAX_HOT = 100_000
SALTS = "_salts"


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that have all keys. Spelled so that the condition reaches the file reader (dropna does not)."""
    return df.where(reduce(and_, [F.col(k).isNotNull() for k in keys]))


def measure(dim: DataFrame) -> Measured:
    """Measure a dimension that is cheap to read, with one aggregate over it."""
    return Measured(dim, dim.agg(total_bytes(dim)).first()[0])


def lookup_join(
    facts: DataFrame,
    dim: DataFrame | Measured,
    on: Sequence[str],
    *,
    spread_by: Sequence[str],
    count_in: DataFrame | None = None,
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Left join. The dimension is measured: small enough, it is broadcast and the facts stay where they
    are; otherwise both sides are shuffled with hot and null keys salted (``salted_join``)."""
    table, size = dim if isinstance(dim, Measured) else measure(dim)
    if size <= limit_bytes:
        return facts.join(F.broadcast(table), list(on), "left")
    return salted_join(facts, table, on, spread_by=spread_by, count_in=count_in)


def hot_keys(facts: DataFrame, on: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys of more than ``rows_per_task`` rows, with the number of tasks for each (SALTS). Of more than
    MAX_HOT of them the most frequent: those left out hold less than a share of 1 / MAX_HOT each."""
    counts = with_keys(facts.select(*on), on).groupBy(*on).agg(rows().alias("_n"))
    most = counts.where(F.col("_n") > rows_per_task).orderBy(F.desc("_n")).limit(MAX_HOT)
    return most.select(*on, F.ceil(F.col("_n") / rows_per_task).cast("int").alias(SALTS))


def salted_join(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    *,
    spread_by: Sequence[str],
    count_in: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Left join by shuffle in which a key that holds much of the facts is dealt over many tasks: as many as
    its rows fill at ``rows_per_task`` each. The dimension's row is repeated once per task, so it grows by
    one row per ``rows_per_task`` facts at most.

    Keys are counted in ``count_in``, the facts before other joins, or in the facts. Facts with a null key
    match nothing and are dealt out too, instead of meeting in one task. ``spread_by`` must tell copies of a
    row apart (ROW_ID does).
    """
    on = list(on)
    counted = facts if count_in is None else count_in
    # Bounded: MAX_HOT rows of a key and a number.
    hot = F.broadcast(settle(hot_keys(counted, on, rows_per_task), "hot-keys"))
    no_key = reduce(or_, [F.col(c).isNull() for c in on])
    dealt = F.xxhash64(*spread_by)
    left = (
        facts.join(hot, on, "left")
        .withColumn(
            "_salt",
            F.when(no_key, dealt).otherwise(F.coalesce(F.pmod(dealt, F.col(SALTS)), F.lit(0))).cast("bigint"),
        )
        .drop(SALTS)
    )
    right = (
        dim.join(hot, on, "left")
        .withColumn(
            "_salt",
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col(SALTS), F.lit(1)).cast("bigint") - 1)),
        )
        .drop(SALTS)
    )
    return left.join(right, [*on, "_salt"], "left").drop("_salt")


def without_match(facts: DataFrame, dim: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key the dimension lacks; a null key is one of them."""
    return facts.join(dim.select(*on), list(on), "left_anti")
