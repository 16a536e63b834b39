"""Streaming ingest of usage events into an append-only bronze table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import catalog as fixed
from ..plans.events import to_bronze
from ..sources.tables import KEEP_BROKEN, unreadable_lines, with_broken_lines
from .counters import counted, listen

# What an ingest counts: rows read with and without an event id, and rows let through.
NAMED, UNNAMED, PASSED = "named", "unnamed", "passed"


def event_stream(
    spark: SparkSession,
    path: str,
    *,
    files_per_trigger: int = fixed.FILES_PER_TRIGGER,
    folder_label: str = "landing/usage_events_stream",
) -> DataFrame:
    """JSON-lines files as a stream, each row stamped with the file it came from. Lines that cannot be read
    are rows without an id that hold their text."""
    landed = (
        spark.readStream.schema(with_broken_lines(fixed.EVENT_LANDING))
        .options(maxFilesPerTrigger=files_per_trigger, **KEEP_BROKEN)
        .json(path)
    )
    label = F.concat(F.lit(folder_label + "/"), F.col("_metadata.file_name"))
    return unreadable_lines(landed.select("*", label.alias("source_file")), ["source_file", "event_id"])


def dedupe_stream(
    events: DataFrame, *, watermark: str, mode: str = "bounded", spread_copies: int = 1
) -> DataFrame:
    """Each event id once. Rows without an id, and lines that cannot be read, are not copies of one another: they pass beside the operator
    that remembers ids and leave nothing in its state. Silver quarantines them.

    ``bounded`` forgets an id when it has not come in for as long as ``watermark``, so state stays small; an
    id that returns later is let in again, and silver removes it then. ``global`` keeps every id seen,
    forever. The clock of the watermark is the time at which a batch is read, never the event's own: no row
    is ever late by it, and an event from the future moves nothing.

    The copies of one id meet in one task. Where an id may hold much of a batch, ``spread_copies`` deals
    them over that many tasks first, each of which lets one through; ids are then remembered twice.
    """
    if mode not in ("global", "bounded"):
        raise ValueError(f"mode is global or bounded, not {mode}")
    # One source feeds both branches, and each counts what it takes. The reader tests simple conditions while
    # it parses: on the id alone, it would drop a line that breaks off behind the id from both.
    no_id = F.col("event_id").isNull() | F.col(fixed.UNREADABLE).isNotNull()
    named, unnamed = counted(events.where(~no_id), NAMED), counted(events.where(no_id), UNNAMED)
    distinct = DataFrame.dropDuplicates
    if mode == "bounded":
        named = named.withColumn("_read_at", F.current_timestamp()).withWatermark("_read_at", watermark)
        distinct = DataFrame.dropDuplicatesWithinWatermark
    if spread_copies > 1:
        dealt = named.withColumn("_deal", F.floor(F.rand() * spread_copies))
        named = distinct(dealt, ["event_id", "_deal"]).drop("_deal")
    once = distinct(named, ["event_id"])
    return once.select(*events.columns).unionByName(unnamed)


def start_ingest(
    spark: SparkSession,
    landing: str,
    bronze: str,
    checkpoint: str,
    *,
    ingest_ts: Column | None = None,
    watermark: str = fixed.REPLAY_WATERMARK,
    dedupe: str = "bounded",
    spread_copies: int = 1,
    every: str | None = None,
    files_per_trigger: int = fixed.FILES_PER_TRIGGER,
) -> StreamingQuery:
    """Start the query. It takes what has landed and stops, or runs on with a trigger ``every`` interval."""
    stream = event_stream(spark, landing, files_per_trigger=files_per_trigger)
    events = dedupe_stream(
        to_bronze(stream, ingest_ts), watermark=watermark, mode=dedupe, spread_copies=spread_copies
    )
    columns = [f.name for f in fixed.EVENT_BRONZE]
    listen(spark)
    writer = (
        counted(events.select(*columns), PASSED)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .partitionBy("ingest_date")
    )
    timed = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return timed.start(bronze)
