"""Re-layout of the stream's bronze files for range scans.

The stream's own folder is only read, so its commit log and checkpoint stay good. Each call re-lays the
files that came since the last one, as one more folder of the current version. Dates that have gathered many
small files are merged, all other files stay. The work grows with what is new, not with the table.
"""

from __future__ import annotations

from collections import Counter, defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..catalog import EVENT_BRONZE
from ..sources.versioned import Part, Version, VersionedTable
from ..streaming.counters import counted, finish, listen

LAYOUT = ("usage_date", "service")
LAID = "laid"
# What a version says about where its rows come from: the checkpoint of the run that brought them.
RUN = "run"
# A file below this size is small. A date with more small files than this is merged.
SMALL_FILE_BYTES = 32 << 20
MERGE_AFTER = 24


def start_relayout(
    spark: SparkSession, bronze: str, target: VersionedTable, checkpoint: str, *, every: str | None = None
) -> StreamingQuery:
    """Bring the new files of a bronze folder into ``target``, by usage date and service: what is there, then
    stop, or on and on with a trigger ``every`` interval. The first batch of a checkpoint starts the table
    anew, later ones add to it. Files that an earlier run has brought are known by the checkpoint, so running
    it with nothing new costs little. A batch is read once; a write that fails publishes nothing."""

    def lay(batch: DataFrame, batch_id: int) -> None:
        token = f"{checkpoint}#{batch_id}"
        if target.committed(token):
            return
        target.publish(
            batch.withColumn("usage_date", F.to_date("event_ts")),
            partition_by=LAYOUT,
            append=batch_id > 0,
            in_cells=True,
            token=token,
            note={RUN: checkpoint},
        )
        merge_small_files(target)

    listen(spark)
    writer = (
        counted(spark.readStream.schema(EVENT_BRONZE).parquet(bronze), LAID)
        .writeStream.foreachBatch(lay)
        .option("checkpointLocation", checkpoint)
    )
    timed = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return timed.start()


def relayout(spark: SparkSession, bronze: str, target: VersionedTable, checkpoint: str) -> int:
    """Re-lay what has come since the last call; give its rows."""
    return finish(spark, start_relayout(spark, bronze, target, checkpoint))[LAID]


def is_small(part: Part, small_bytes: int = SMALL_FILE_BYTES) -> bool:
    """Whether the files of a load in a cell are small, on average. Such a part is mostly one file."""
    return part.bytes < small_bytes * part.files


def scattered_parts(
    version: Version, after: int = MERGE_AFTER, small_bytes: int = SMALL_FILE_BYTES
) -> list[Part]:
    """The small parts of all dates that have more than ``after`` small files, by the inventory that was
    taken when they were written."""
    by_date: dict[str, list[Part]] = defaultdict(list)
    for part in version.parts:
        if part.cell and is_small(part, small_bytes):
            by_date[part.cell.split("/")[0]].append(part)
    crowded = [parts for parts in by_date.values() if sum(p.files for p in parts) > after]
    return [part for parts in crowded for part in parts]


def merge_small_files(
    target: VersionedTable, after: int = MERGE_AFTER, small_bytes: int = SMALL_FILE_BYTES
) -> int:
    """Write the small files of crowded dates as fewer ones; give the number of dates. Large files of those
    dates, and all files of other dates, stay as they are. A merged file counts as small until it has grown,
    so each row is merged again only after as many new files."""
    version = target.current()
    crowded = scattered_parts(version, after, small_bytes) if version else []
    files: Counter[str] = Counter()
    for part in crowded:
        files[part.cell] += part.files
    # A cell of one file is as good as merged.
    parts = {part for part in crowded if files[part.cell] > 1}
    if not parts:
        return 0
    target.publish(
        target.read(only=lambda part: part in parts),
        partition_by=LAYOUT,
        in_cells=True,
        keep=lambda part: part not in parts,
        expect_rows=sum(part.rows for part in parts),
        note=version.note,
    )
    return len({part.cell.split("/")[0] for part in parts})
