"""Keep-latest and duplicate marking. Ties never depend on the order in which rows arrive."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.measures import rows
from ..session import Measured, settle_measured
from ..sources.tables import ROW_ID
from .lookup import BROADCAST_LIMIT_BYTES, MAX_HOT, ROWS_PER_TASK, lookup_join, with_keys

SURPLUS = "_surplus"


def latest_first(order_by: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in order_by]


def keep_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order_by``. Null keys form a group of their own.

    The rank filter lets Spark drop losers before the shuffle (WindowGroupLimit), so a key that holds
    much of the data sends one row per input split to its task.
    """
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*latest_first(order_by)))
    return df.withColumn("_nth", nth).where("_nth = 1").drop("_nth")


def content_order(df: DataFrame, first: Sequence[str]) -> list[str]:
    """``first``, then every other column: a total order up to byte-identical rows."""
    return [*first, *[c for c in df.columns if c not in first]]


def drop_copies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per value of those ``columns`` that the frame has."""
    present = [c for c in columns if c in df.columns]
    return df.dropDuplicates(present) if present else df


def _hashed(df: DataFrame, keys: Sequence[str], columns: Sequence[str] = ()) -> DataFrame:
    """Rows that have all keys, with a hash of them."""
    narrow = df.select(*dict.fromkeys([*keys, *columns]))
    return with_keys(narrow, keys).withColumn("_hash", F.xxhash64(*keys))


def _repeated_hashes(df: DataFrame, keys: Sequence[str]) -> Measured:
    """Hashes of the keys that more than one row has, and their rows."""
    counted = _hashed(df, keys).groupBy("_hash").agg(rows().alias("_repeated")).where("_repeated > 1")
    return settle_measured(counted, "repeated-keys")


def _latest(
    copies: DataFrame, keys: Sequence[str], order_by: Sequence[str], row_id: Sequence[str], label: str
) -> Measured:
    winners = (
        copies.groupBy(*keys)
        .agg(rows().alias("n"), F.max(F.struct(*order_by, *row_id)).alias("top"))
        .where("n > 1")  # a hash may stand for two keys
        .select(*keys, *[F.col(f"top.{c}").alias(f"_keep{c}") for c in row_id])
    )
    return settle_measured(winners, label)


def _kept(
    df: DataFrame, repeated: Measured, keys: Sequence[str], order_by: Sequence[str], row_id: Sequence[str], limit_bytes: int
) -> Measured:
    narrow = _hashed(df, keys, [*order_by, *row_id])
    if repeated.bytes <= limit_bytes:
        narrow = lookup_join(narrow, repeated, ["_hash"], spread_by=row_id, limit_bytes=limit_bytes).where("_repeated > 1")
    return _latest(narrow, keys, order_by, row_id, "kept-copies")


def kept_copies(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    *,
    row_id: Sequence[str] = ROW_ID,
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
) -> Measured:
    """Of each repeated key its latest row: the keys and that row's identity, under the names of ``row_id``
    with ``_keep`` in front. A key with a null is not repeated.

    No window over the key, since all copies of one key would sort in one task. Hashes of the keys alone are
    counted; only the rows whose hash is repeated, few columns of them, are ranked, by a partial aggregate
    over the keys themselves. If there are too many such hashes to broadcast, picking those rows would shuffle
    all of them, so all are ranked, in one shuffle. A frame that is dear to make should be stored first: it is
    read twice.
    """
    return _kept(df, _repeated_hashes(df, keys), keys, order_by, row_id, limit_bytes)


def with_surplus(
    df: DataFrame,
    kept: Measured,
    keys: Sequence[str],
    *,
    row_id: Sequence[str] = ROW_ID,
    looked_up: str | None = None,
) -> DataFrame:
    """Add the flag SURPLUS: true on each row of a repeated key but the one that ``kept_copies`` names; and,
    under the name ``looked_up``, whether the key is one of those."""
    marked = lookup_join(df, kept, keys, spread_by=row_id)
    same = reduce(and_, [F.col(c) == F.col(f"_keep{c}") for c in row_id])
    marks = {SURPLUS: F.coalesce(~same, F.lit(False))}
    if looked_up is not None:
        marks[looked_up] = F.col(f"_keep{row_id[0]}").isNotNull()
    return marked.withColumns(marks).drop(*[f"_keep{c}" for c in row_id])


def mark_surplus(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    *,
    row_id: Sequence[str] = ROW_ID,
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add the flag SURPLUS: true on each row of a repeated key but its latest. A key with a null is not
    marked. Full rows only look up whether they are the winner, while the repeated keys fit a broadcast; else
    they are shuffled once (``_ranked``)."""
    repeated = _repeated_hashes(df, keys)
    if repeated.bytes <= limit_bytes:
        kept = _kept(df, repeated, keys, order_by, row_id, limit_bytes)
        if kept.bytes <= limit_bytes:
            return with_surplus(df, kept, keys, row_id=row_id)
    return _ranked(df, repeated.df, keys, order_by, row_id, rows_per_task)


def _ranked(
    df: DataFrame,
    repeated: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    row_id: Sequence[str],
    rows_per_task: int,
) -> DataFrame:
    """``mark_surplus`` by rank within the key, in one shuffle of the rows. A key of more than
    ``rows_per_task`` rows is not ranked in one task: its winner comes from a partial aggregate and is looked
    up, as are at most MAX_HOT such keys. Their rows, and those without a key, are dealt over all tasks."""
    many = repeated.where(F.col("_repeated") > rows_per_task).orderBy(F.desc("_repeated")).limit(MAX_HOT)
    hot = settle_measured(many, "hot-keys")
    dealt = reduce(or_, [F.col(k).isNull() for k in keys])
    surplus = F.lit(False)
    marked = df
    if hot.bytes:
        copies = _hashed(df, keys, [*order_by, *row_id]).join(F.broadcast(hot.df), "_hash", "left_semi")
        winners = _latest(copies, keys, order_by, row_id, "kept-hot-copies")
        marked = with_surplus(df, winners, keys, row_id=row_id, looked_up="_looked_up")
        dealt, surplus = dealt | F.col("_looked_up"), F.col(SURPLUS)
    salted = marked.withColumn("_salt", F.when(dealt, F.xxhash64(*row_id)).otherwise(F.lit(0).cast("bigint")))
    rank = F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*latest_first([*order_by, *row_id])))
    ranked = salted.withColumn("_nth", rank).withColumn(SURPLUS, F.when(dealt, surplus).otherwise(F.col("_nth") > 1))
    rest = [c for c in df.columns if c not in keys]
    return ranked.select(*keys, *rest, SURPLUS)
