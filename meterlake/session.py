"""Session settings and the shared work folder."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import remove

# Settings this library is tuned for. Operators never set them; a job's entry point may.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # (org_id, service) groups must not inherit a hash on org_id alone: one org may hold a third of the rows.
    "spark.sql.requireAllClusterKeysForDistribution": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Streaming dedupe remembers ids: on disk, and checkpointed by their changes.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def tune(builder: SparkSession.Builder, shuffle_partitions: int | None = None) -> SparkSession.Builder:
    """Add the settings to a session builder. Leave ``shuffle_partitions`` out to keep the cluster's."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder


@functools.cache
def _fallback_folder() -> str:
    return tempfile.mkdtemp(prefix="meterlake-")


def work_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Where it is unset, a temporary one, but only
    if driver and executors are one process; on a cluster the others would not see it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
    return _fallback_folder()


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{work_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


_scope: ContextVar[list[str] | None] = ContextVar("scope", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete what is settled inside the block when it ends. Publish first: frames built on it die too."""
    paths: list[str] = []
    outer = _scope.set(paths)
    try:
        yield
    finally:
        _scope.reset(outer)
        for path in paths:
            remove(spark, path)


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write a frame that several later steps read to the shared folder, and read it back.

    The lineage is cut at files that outlive any executor, so nothing before it runs again, and readers
    get column pruning and exact sizes. A few megabytes of statistics or terabytes of events alike.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    scope = _scope.get()
    if scope is not None:
        scope.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Measured(NamedTuple):
    """A frame and the size of its values."""

    df: DataFrame
    bytes: int


def _value_bytes(value: Column, kind: T.DataType) -> Column:
    """Size of a value: text and binary by length, arrays, maps and structs by what is in them, anything else
    by a fixed width; 16 bytes more for its place in a row."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        inside = F.octet_length(value)
    elif isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, T.NumericType):
            inside = 8 * F.size(value)
        else:
            sizes = F.transform(value, lambda x: _value_bytes(x, kind.elementType))
            inside = F.aggregate(sizes, F.lit(0).cast("bigint"), lambda total, n: total + n)
    elif isinstance(kind, T.MapType):
        inside = _value_bytes(F.map_keys(value), T.ArrayType(kind.keyType)) + _value_bytes(
            F.map_values(value), T.ArrayType(kind.valueType)
        )
    elif isinstance(kind, T.StructType):
        inside = sum((_value_bytes(value[f.name], f.dataType) for f in kind), F.lit(0))
    else:
        inside = F.lit(0)
    return F.lit(16).cast("bigint") + F.coalesce(F.when(value.isNotNull(), inside), F.lit(0)).cast("bigint")


def total_bytes(df: DataFrame) -> Column:
    """Aggregate: size of the frame's values, nested ones included."""
    sizes = [_value_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema]
    return F.coalesce(F.sum(sum(sizes, F.lit(0).cast("bigint"))), F.lit(0)).cast("bigint")


def settle_observed(df: DataFrame, label: str, metrics: dict[str, Column]) -> tuple[DataFrame, dict]:
    """``settle``, with aggregates of the rows taken while they are written, in the tasks that write."""
    seen = Observation()
    stored = settle(df.observe(seen, *[value.alias(name) for name, value in metrics.items()]), label)
    return stored, dict(seen.get)


def settle_measured(df: DataFrame, label: str) -> Measured:
    """``settle``, with the size taken while the rows are written."""
    seen = Observation()
    stored = settle(df.observe(seen, total_bytes(df).alias("bytes")), label)
    return Measured(stored, seen.get["bytes"])
