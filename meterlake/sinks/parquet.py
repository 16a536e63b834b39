"""Parquet and generic sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation

from ..functions.measures import rows


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    *,
    files: int | None = None,
    arranged: bool = False,
    mode: str = "errorifexists",
    metrics: Mapping[str, Column] | None = None,
) -> dict:
    """Write a hive-partitioned Parquet folder; give the number of ``rows`` written and the aggregates that
    ``metrics`` names, all taken in the tasks that write.

    By default the rows are rebalanced on the partition columns: adaptive execution merges small pieces
    and splits a value that holds too much, so a hot day or org becomes several files instead of one
    slow task. ``files`` fixes the number of pieces instead; ``arranged`` writes the frame as it is.
    """
    if arranged:
        out = df
    elif files is not None:
        out = df.repartition(files, *partition_by) if partition_by else df.coalesce(files)
    else:
        out = df.hint("rebalance", *partition_by)
    # Counted after the shuffle, in the tasks that write: a map task that runs again is not counted twice.
    counted = Observation()
    taken = {"rows": rows(), **(metrics or {})}
    writer = out.observe(counted, *[value.alias(name) for name, value in taken.items()]).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return dict(counted.get)


def save_to(
    df: DataFrame, data_format: str, options: Mapping[str, str] | None = None, mode: str = "append"
) -> None:
    """Write through any Spark data source, such as a store's connector: executors write their rows."""
    df.write.format(data_format).options(**(options or {})).mode(mode).save()
