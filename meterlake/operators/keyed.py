"""Whole-table forms of keyed writes: upsert, partition replace, and the layout for key lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedupe import keep_latest


def upsert(
    existing: DataFrame, changes: DataFrame, keys: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Existing rows whose key did not change, plus the latest change of each key."""
    latest = keep_latest(changes, keys, order_by)
    untouched = existing.join(latest.select(*keys), list(keys), "left_anti")
    return untouched.unionByName(latest.select(*existing.columns))


def replace_partitions(existing: DataFrame, incoming: DataFrame, partition_key: Sequence[str]) -> DataFrame:
    """Existing rows of other partitions, plus all incoming rows: nothing stale stays in a partition."""
    replaced = incoming.select(*partition_key).distinct()
    untouched = existing.join(replaced, list(partition_key), "left_anti")
    return untouched.unionByName(incoming.select(*existing.columns))


BUCKET = "bucket"


def bucket_of(partition_key: Sequence[str], buckets: int) -> Column:
    """The bucket of a row. All rows of a partition key are in one, so a change of it touches no other."""
    return F.pmod(F.xxhash64(*partition_key), F.lit(buckets)).cast("int").alias(BUCKET)


def arrange_by_key(
    df: DataFrame,
    partition_key: Sequence[str],
    clustering: Sequence[tuple[str, str]],
    first: Sequence[str] = (),
) -> DataFrame:
    """Range-partition and sort by the full key, after the columns ``first``. A lookup then skips all files
    and row groups whose bounds exclude it, and a partition key that holds much of the table spans many
    files."""
    order = [F.col(c).asc() for c in (*first, *partition_key)] + [
        F.col(c).desc() if way == "desc" else F.col(c).asc() for c, way in clustering
    ]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)
