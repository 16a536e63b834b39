"""Streaming load of mart files into keyed serving tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedupe import content_order
from ..operators.keyed import BUCKET, bucket_of, replace_partitions, upsert
from ..plans.serving import REFUSED, ServingTable, judged, laid_out, refused_schema
from ..session import scratch, settle_measured
from ..sources.versioned import Part, Version, VersionedTable, within
from .counters import counted, finish, listen


@dataclass(frozen=True)
class LoadResult:
    table: str
    input_rows: int
    served_rows: int
    refused_rows: int = 0


# Rows of a serving table lie in buckets of about this size by their partition key; a load rewrites those it
# touches. Tables are bucketed anew when they have grown four times beyond it.
BUCKET_BYTES = 128 << 20
MAX_BUCKETS = 4096

# When a mart was built, and when a row's load was; the second is the first where a mart has it.
STAMP, LOADED = "gold_ts", "_loaded"
# What a load counts: rows read.
READ = "read"


def refused_table(target: VersionedTable, table: ServingTable) -> VersionedTable:
    """Rows that loads of a serving table have refused, with the columns that are null in them."""
    return VersionedTable(target.spark, f"{target.root}/refused", refused_schema(table))


def _load_time(batch: DataFrame, table: ServingTable) -> Column:
    """The stamp of the mart. Without one, upserts go by the time of the row's file; the files of one load
    differ in it, so a batch of whole partitions counts as one load."""
    if STAMP in batch.columns:
        return F.col(STAMP).cast("timestamp")
    if LOADED in batch.columns and not table.replaces_partitions:
        return F.col(LOADED)
    return F.lit(None).cast("timestamp")


def _newest_load(changes: DataFrame, partition_key: Sequence[str]) -> DataFrame:
    """Of each partition the rows of its newest load."""
    newest = changes.groupBy(*partition_key).agg(F.max(LOADED).alias("_newest"))
    return changes.join(newest, list(partition_key)).where(F.col(LOADED).eqNullSafe(F.col("_newest")))


def _wanted_buckets(size: int) -> int:
    return min(MAX_BUCKETS, max(1, -(-size // BUCKET_BYTES)))


def _buckets(last: Version | None, size: int, whole: bool) -> tuple[int, bool]:
    """How many buckets the table has or gets, and whether all of it is written anew: by a load of all there
    is, into a table that lies in no buckets, or once the table has outgrown them."""
    if last is None or whole or not last.in_cells or BUCKET not in last.note:
        return _wanted_buckets(size), True
    stored = sum(part.bytes for part in last.parts)
    if _wanted_buckets(stored + size) >= 4 * last.note[BUCKET]:
        return _wanted_buckets(stored + size), True
    return last.note[BUCKET], False


def merge_batch(
    target: VersionedTable,
    table: ServingTable,
    batch: DataFrame,
    *,
    order_by: Sequence[str] = (),
    token: str | None = None,
    whole: bool = False,
    buckets: int | None = None,
) -> None:
    """Bring one batch into the table as a new version. A token seen before makes it a no-op, so a batch
    that a restart replays counts once. Executors do all of it; the driver sees no rows.

    Rows lie in buckets by partition key. Only buckets that the batch has keys of are read and written; the
    new version keeps the files of all others. ``buckets`` fixes their number for a table that is new or
    written as a whole; else it goes by size.

    If a batch holds several loads, the last one wins: for each key, or for each partition where the table
    replaces those. ``whole``: the batch is all there is, and what it lacks goes. Rows with a null in a
    required column are refused and written to ``refused_table``."""
    if token is not None and target.committed(token):
        return
    with scratch(batch.sparkSession):
        loaded = _load_time(batch, table).alias(LOADED)
        stored, size = settle_measured(judged(batch, table, loaded), f"serving-{table.name}")
        _keep_refused(target, table, stored.where(F.size(REFUSED) > 0), token, whole)
        changes = stored.where(F.size(REFUSED) == 0).drop(REFUSED)
        last = target.current()
        n, anew = _buckets(last, size, whole)
        n = buckets if buckets and anew else n
        of = bucket_of(table.partition_key, n)
        # At most MAX_BUCKETS numbers.
        touched = set() if anew else {f"{BUCKET}={r[0]}" for r in changes.select(of).distinct().collect()}
        hit = lambda part: within(part.cell, touched)
        if last is None or whole:
            existing = target.read_or_empty().where(F.lit(False))
        else:
            existing = target.read(only=None if anew else hit)
        if table.replaces_partitions:
            changes = _newest_load(changes, table.partition_key)
            merged = replace_partitions(existing, changes, table.partition_key)
        else:
            merged = upsert(existing, changes, table.keys, content_order(changes, [LOADED, *order_by]))
        keep: Callable[[Part], bool] | None = None if anew else lambda part: not hit(part)
        target.publish(
            laid_out(merged.select("*", of), table, first=[BUCKET]),
            partition_by=(BUCKET,),
            arranged=True,
            in_cells=True,
            keep=keep,
            token=token,
            note={BUCKET: n},
        )


def _keep_refused(
    target: VersionedTable, table: ServingTable, refused: DataFrame, token: str | None, whole: bool
) -> None:
    kept = refused_table(target, table)
    if token is not None and kept.committed(token):
        return
    if refused.isEmpty() and not (whole and kept.current()):
        return
    kept.publish(refused.select(*kept.schema.names), append=not whole, token=token)


def load_stream(
    spark: SparkSession,
    source: str,
    target: VersionedTable,
    table: ServingTable,
    checkpoint: str,
    *,
    order_by: Sequence[str] = (),
    transform: Callable[[DataFrame], DataFrame] | None = None,
    schema: T.StructType | None = None,
    whole: bool = False,
    buckets: int | None = None,
) -> LoadResult:
    """Stream a mart's Parquet files into its serving table; only files not loaded before are read.

    Without a cap on files per trigger all new files form one batch, so a load writes one version. The
    schema is taken from the files unless given. ``transform`` changes a batch before it is merged.
    """
    schema = schema or spark.read.parquet(source).schema

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch) if transform else batch
        token = f"{checkpoint}#{batch_id}"
        merge_batch(target, table, rows, order_by=order_by, token=token, whole=whole, buckets=buckets)

    listen(spark)
    files = spark.readStream.schema(schema).parquet(source)
    query = (
        counted(files.select("*", F.col("_metadata.file_modification_time").alias(LOADED)), READ)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    return load_result(target, table, finish(spark, query)[READ])


def load_result(target: VersionedTable, table: ServingTable, input_rows: int) -> LoadResult:
    served, refused = target.current(), refused_table(target, table).current()
    return LoadResult(
        table.name, input_rows, served.rows if served else 0, refused.rows if refused else 0
    )


def load_frame(
    df: DataFrame, staging: str, target: VersionedTable, table: ServingTable, checkpoint: str
) -> LoadResult:
    """Stage a frame as files of their own, stamped with the time, then load them as a stream."""
    stamped = df if STAMP in df.columns else df.withColumn(STAMP, F.current_timestamp())
    stamped.write.mode("append").parquet(staging)
    return load_stream(df.sparkSession, staging, target, table, checkpoint)
