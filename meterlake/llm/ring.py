"""Sharding by a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle

POSITIONS = 1 << 14  # places on the ring
VIRTUAL_NODES = 64  # places of each shard
ROWS_PER_DEAL = 1 << 20  # rows of one place that are ranked together


def nodes(shards: int, virtual: int = VIRTUAL_NODES) -> dict[int, list[int]]:
    """The shards that have a virtual node at each place, in the order in which they take keys. A shard's
    places do not depend on how many others there are."""
    places: dict[int, list[int]] = {}
    for shard in range(shards):
        for copy in range(virtual):
            name = hashlib.blake2b(f"{shard}/{copy}".encode(), digest_size=8).digest()
            places.setdefault(int.from_bytes(name, "big") % POSITIONS, []).append(shard)
    return {p: list(dict.fromkeys(s)) for p, s in places.items()}


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """Most rows of each shard. Without slack they sum up to the rows and differ by one at most."""
    if slack:
        return [-(-int(rows * (1 + slack)) // shards)] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def assign(
    counts: Sequence[int], shards: int, slack: float = 0.0, virtual: int = VIRTUAL_NODES
) -> list[tuple[int, int, int, int, int]]:
    """Where the keys of each place go: (place, first rank, end rank, shard, first slot).

    Going clockwise, keys wait until a virtual node whose shard is not full; it takes those that waited
    longest. After a full turn only keys are left that met full shards, and they go on clockwise. Works on
    counts alone: at most one range per place and one more per virtual node and turn.
    """
    at = nodes(shards, virtual)
    room = capacities(sum(counts), shards, slack)
    used = [0] * shards
    out: list[tuple[int, int, int, int, int]] = []
    waiting: deque[list[int]] = deque()  # [place, first rank, end rank], oldest first
    turn = 0
    while turn == 0 or waiting:
        for place in range(len(counts)):
            if turn == 0 and counts[place]:
                waiting.append([place, 0, counts[place]])
            for shard in at.get(place, ()):
                while waiting and used[shard] < room[shard]:
                    origin, low, high = waiting[0]
                    n = min(high - low, room[shard] - used[shard])
                    out.append((origin, low, low + n, shard, used[shard]))
                    used[shard] += n
                    if low + n == high:
                        waiting.popleft()
                    else:
                        waiting[0][1] += n
        turn += 1
    return out


def shard(
    docs: DataFrame,
    shards: int,
    *,
    slack: float = 0.0,
    row_id: Sequence[str],
    key: str = "doc_id",
    virtual: int = VIRTUAL_NODES,
) -> DataFrame:
    """All columns, and ``shard`` and ``slot`` (gapless from 0 within a shard); these names take the place
    of columns that have them. A shard holds at most (1 + slack) times its part of the rows; without slack,
    the numbers of rows differ by one at most.

    A row's place on the ring is the hash of its key. Within a place, rows are ranked by the hash of
    ``row_id`` in as many parts as their number fills at ``ROWS_PER_DEAL``, so a key that many rows share is
    not sorted in one task. The driver sees POSITIONS counts, whatever the input, and gives back ranges, which
    are bounded by the ring and so are broadcast. ``row_id`` must tell rows apart and be the same when a task
    runs again. Rows with a null key share a place.
    """
    columns = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    ids = [f"id{i}" for i in range(len(row_id))]
    # The user's columns travel as one, so theirs and these cannot clash.
    placed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        F.pmod(F.xxhash64(key), F.lit(POSITIONS)).cast("int").alias("place"),
        F.xxhash64(*row_id, F.lit(1)).alias("hash"),
        *[F.col(c).alias(i) for c, i in zip(row_id, ids, strict=True)],
    )
    found = settle(placed.groupBy("place").agg(F.count("*").alias("n")), "ring-places").collect()
    counts = [0] * POSITIONS
    for row in found:
        counts[row["place"]] = row["n"]
    spark = docs.sparkSession
    # Both have at most POSITIONS rows and a few for each virtual node.
    deals = spark.createDataFrame(
        [(place, -(-n // ROWS_PER_DEAL)) for place, n in enumerate(counts) if n > ROWS_PER_DEAL],
        "place int, deals bigint",
    )
    ranges = spark.createDataFrame(
        assign(counts, shards, slack, virtual) or [(-1, 0, 0, 0, 0)],
        "of int, low bigint, high bigint, shard int, first bigint",
    )
    dealt = placed.join(F.broadcast(deals), "place", "left").withColumn(
        "deal", F.pmod("hash", F.coalesce("deals", F.lit(1))).cast("int")
    )
    sizes = settle(dealt.groupBy("place", "deal").agg(F.count("*").alias("n")), "ring-counts")
    before = F.sum("n").over(
        Window.partitionBy("place").orderBy("deal").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = sizes.select("place", "deal", F.coalesce(before, F.lit(0)).alias("before"))
    rank: Column = F.row_number().over(Window.partitionBy("place", "deal").orderBy(*ids)) - 1
    ranked = (
        dealt.withColumn("nth", rank)
        .join(starts, ["place", "deal"])
        .withColumn("rank", F.col("before") + F.col("nth"))
    )
    owned = ranked.join(
        F.broadcast(ranges),
        (F.col("place") == F.col("of")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")),
    )
    slot = (F.col("first") + F.col("rank") - F.col("low")).cast("bigint")
    return owned.select(*[F.col("row")[c].alias(c) for c in columns], "shard", slot.alias("slot"))
