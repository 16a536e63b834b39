"""How text filters interact: what each removes, and what it would have, in every order of applying them.

Word counts come from a sparse document-term matrix. Tasks cut texts into shards of bounded size and encode
each with a dictionary of its own; the distinct words of all shards get global numbers, which replace the
local ones. The shards are compressed sparse rows (CSR): a document's words are the sum of its row, its
distinct words the number of its entries.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..operators.lookup import lookup_join
from ..session import settle, settle_measured
from ..sources.tables import ROW_ID, with_row_id
from .text import NOT_SPACE, spans, text_blocks, unused

SHARD_BYTES = 16 << 20  # text of a shard; a longer text is a shard of its own


class Matrix(NamedTuple):
    """``shards``: one row a shard, with the kept columns as arrays, one element a document, and the rows as
    ``indptr``, ``terms`` (global numbers) and ``counts``. ``dictionary``: word and term."""

    shards: DataFrame
    dictionary: DataFrame


class _Shard:
    """Texts of a shard as they come: the bytes of all words on end, and how they are cut."""

    def __init__(self):
        self.size, self.rows, self.words, self.lengths, self.per_text = 0, [], [], [], []

    def add(self, rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> None:
        starts, ends, first = spans(data, offsets, NOT_SPACE)
        self.rows.append(rows)
        self.words.append(data[NOT_SPACE[data]])
        self.lengths.append(ends - starts)
        self.per_text.append(np.diff(first))
        self.size += len(data)

    def encoded(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
        """indptr, local numbers, counts, and the words under those numbers."""
        lengths, per_text = np.concatenate(self.lengths), np.concatenate(self.per_text)
        cuts = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
        flat = np.concatenate(self.words)
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(lengths), [None, pa.py_buffer(cuts), pa.py_buffer(flat)]
        ).dictionary_encode()
        of_text = np.repeat(np.arange(len(per_text), dtype=np.int64), per_text)
        cells = (of_text << 32) | words.indices.to_numpy().astype(np.int64)
        cells, counts = np.unique(cells, return_counts=True)
        indptr = np.searchsorted(cells >> 32, np.arange(len(per_text) + 1))
        return indptr, cells & 0xFFFFFFFF, counts, words.dictionary


def _one_list(values: pa.Array | pa.ChunkedArray, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values.cast(kind))


def local_shards(docs: DataFrame, keep: Sequence[str], text: str, shard_bytes: int) -> DataFrame:
    """Shards under their own dictionaries: kept columns as arrays, indptr, indices, counts, words."""
    fields = [T.StructField(c, T.ArrayType(docs.schema[c].dataType)) for c in keep]
    csr = "indptr array<bigint>, indices array<int>, counts array<int>, words array<binary>"
    schema = T.StructType(fields + T.StructType.fromDDL(csr).fields)
    arrow = to_arrow_schema(schema)
    sent = unused("_text", keep)

    def write(shard: _Shard) -> pa.RecordBatch:
        rows = pa.Table.from_batches(shard.rows)
        indptr, indices, counts, words = shard.encoded()
        values = [rows.column(c) for c in keep] + [pa.array(indptr), pa.array(indices), pa.array(counts), words]
        lists = [_one_list(v, f.type.value_type) for v, f in zip(values, arrow, strict=True)]
        return pa.RecordBatch.from_arrays(lists, schema=arrow)

    def run(batches):
        shard = _Shard()
        for batch in batches:
            for rows, data, offsets in text_blocks(batch, sent, min(shard_bytes, 1 << 22)):
                shard.add(rows.select(list(keep)), data, offsets)
                if shard.size >= shard_bytes:
                    yield write(shard)
                    shard = _Shard()
        if shard.rows:
            yield write(shard)

    picked = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).alias(sent))
    return picked.mapInArrow(run, schema)


def numbered(words: DataFrame) -> DataFrame:
    """Distinct words with the numbers 0, 1, 2, ... as ``term``: a word's place among the files that it is
    stored in. Only the files are counted in one task."""
    stored = with_row_id(settle(words.select("word").distinct(), "dictionary"))
    file, row = ROW_ID
    sizes = stored.groupBy(file).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy(file).rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select(file, F.coalesce(before, F.lit(0)).alias("start"))
    return stored.join(F.broadcast(starts), file).select("word", (F.col("start") + F.col(row)).alias("term"))


def term_matrix(
    docs: DataFrame, *, keep: Sequence[str], text: str = "text", shard_bytes: int = SHARD_BYTES
) -> Matrix:
    """The document-term matrix of all texts; a null text is an empty row. Words are maximal runs of bytes
    but ASCII space, in their own case.

    A shard names each of its words once, so a word can hold at most one of the many thousand entries of
    each shard: no word is a hot key, and what is shuffled are distinct words per shard, not words.
    """
    local = settle(local_shards(docs, keep, text, shard_bytes), "term-shards")
    shard = [F.col(c).alias(f"_shard{c}") for c in ROW_ID]
    stored = with_row_id(local)
    entries = stored.select(*shard, F.posexplode("words").alias("at", "word"))
    dictionary = settle(numbered(entries), "terms")
    same = [f"_shard{c}" for c in ROW_ID]
    mapped = (
        entries.join(dictionary, "word")
        .groupBy(*same)
        .agg(F.array_sort(F.collect_list(F.struct("at", "term")))["term"].alias("_terms"))
    )
    # A shard without any word has no entries.
    joined = stored.select(*local.columns, *shard).join(mapped, same, "left")
    terms = F.transform("indices", lambda i: F.get("_terms", i))
    shards = joined.select(*[f"`{c}`" for c in keep], "indptr", terms.alias("terms"), "counts")
    return Matrix(shards, dictionary)


def row_sums(shards: DataFrame, keep: Sequence[str]) -> DataFrame:
    """For each document its kept columns, ``n_words`` (sum of its row) and ``n_distinct`` (entries)."""
    fields = [T.StructField(c, shards.schema[c].dataType.elementType) for c in keep]
    schema = T.StructType(fields + T.StructType.fromDDL("n_words bigint, n_distinct bigint").fields)
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for shard in range(batch.num_rows):
                row = batch.slice(shard, 1)
                indptr = row.column("indptr").values.to_numpy()[_span(row.column("indptr"))]
                counts = row.column("counts").values.to_numpy()[_span(row.column("counts"))]
                sums = np.concatenate(([0], np.cumsum(counts)))
                values = [row.column(c).flatten() for c in keep]
                values += [pa.array(sums[indptr[1:]] - sums[indptr[:-1]]), pa.array(np.diff(indptr))]
                cast = [v.cast(f.type) for v, f in zip(values, arrow, strict=True)]
                for part in pa.Table.from_arrays(cast, schema=arrow).to_batches(10_000):
                    yield part

    return shards.select(*[f"`{c}`" for c in keep], "indptr", "counts").mapInArrow(run, schema)


def _span(lists: pa.ListArray) -> slice:
    low, high = lists.offsets.to_numpy()[:2]
    return slice(int(low), int(high))


# Filters ----------------------------------------------------------------------------------------------
def audit(flagged: DataFrame, filters: str, *, part: str, good: str, toxic: str) -> DataFrame:
    """Effects of filters in every order, per part. ``filters`` are one-letter names of boolean columns that
    are true where a filter would remove a row; ``good`` and ``toxic`` are boolean columns. At most six
    filters: there are as many orders as permutations.

    One row per part, ``filter_order`` and ``step``, of the step's filter: rows kept after it, removed by
    it, redundant (it would, but an earlier one did), unique_fails (it alone would), good_lost and toxic_lost
    (of those removed), and shapley (removed by it, summed over all orders). Only counts per part and set of
    failing filters are expanded, at most 2 ** filters rows a part.
    """
    bits = {name: 1 << i for i, name in enumerate(filters)}
    fails = sum((F.when(F.col(name), bit).otherwise(0) for name, bit in bits.items()), F.lit(0))
    cells = flagged.groupBy(F.col(part).alias("part"), fails.alias("fails")).agg(
        F.count("*").alias("n"), F.count(F.when(F.col(good), 1)).alias("good"), F.count(F.when(F.col(toxic), 1)).alias("toxic")
    )
    orders = F.split(F.lit(" ".join("".join(p) for p in permutations(filters))), " ")
    steps = (
        cells.withColumn("filter_order", F.explode(orders))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(filters)))))
        .withColumn("_filter", F.expr("substring(filter_order, step, 1)"))
        .withColumn("_before", F.expr("substring(filter_order, 1, step - 1)"))
    )
    of = lambda names: sum((F.when(F.contains(names, F.lit(n)), b).otherwise(0) for n, b in bits.items()), F.lit(0))
    steps = steps.withColumn("_own", of(F.col("_filter"))).withColumn("_earlier", of(F.col("_before")))
    own = F.col("fails").bitwiseAND(F.col("_own")) > 0
    earlier = F.col("fails").bitwiseAND(F.col("_earlier")) > 0
    removed = own & ~earlier
    # Of the filters that a row fails each comes first in an equal share of the orders.
    turns = F.size(orders) / F.greatest(F.bit_count("fails"), F.lit(1))
    total = lambda which, n: F.sum(F.when(which, n).otherwise(0)).cast("bigint")
    return steps.groupBy("part", "filter_order", "step").agg(
        total(~own & ~earlier, F.col("n")).alias("kept"),
        total(removed, F.col("n")).alias("removed"),
        total(own & earlier, F.col("n")).alias("redundant"),
        total(F.col("fails") == F.col("_own"), F.col("n")).alias("unique_fails"),
        total(removed, F.col("good")).alias("good_lost"),
        total(removed, F.col("toxic")).alias("toxic_lost"),
        total(own, F.col("n") * turns.cast("bigint")).alias("shapley"),
    )


def flags(docs: DataFrame, labels: DataFrame, *, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """For each document ``part`` (its lang, null: empty), the filters it fails, and ``good`` and ``toxic``:

    A: fewer than 100 words. B: distinct words below 80 % of the words. C: capital letters above 10 % of the
    code points. D: any of ``#$%&*|``. E: the text of a document with a smaller id. A null text is empty; a
    null id is neither smaller nor greater, and a repeated row is no copy of itself. A document is good or
    toxic if any of its labels says so.

    Texts are read once and not shuffled; all joins are of ids, hashes and flags.
    """
    text = F.coalesce("text", F.lit(""))
    points = F.length(text)
    named = docs.select(
        F.col("doc_id"),
        F.coalesce("lang", F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("said"),
        (100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * points).alias("C"),
        text.rlike("[#$%&*|]").alias("D"),
        text.alias("text"),
    )
    keep = ["doc_id", "part", "said", "C", "D"]
    matrix = term_matrix(named, keep=keep, shard_bytes=shard_bytes)
    narrow = with_row_id(settle(row_sums(matrix.shards, keep), "row-sums"))
    copied = (
        narrow.where("doc_id IS NOT NULL")
        .groupBy("said")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where("first < last")
        .select("said", "first")
    )
    judged = (
        labels.where("doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    )
    known = lookup_join(narrow, settle_measured(copied, "copied-texts"), ["said"], spread_by=ROW_ID)
    known = lookup_join(known, settle_measured(judged, "labels"), ["doc_id"], spread_by=ROW_ID)
    yes = lambda c: F.coalesce(c, F.lit(False))
    return known.select(
        "doc_id",
        "part",
        (F.col("n_words") < 100).alias("A"),
        (100 * F.col("n_distinct") < 80 * F.col("n_words")).alias("B"),
        "C",
        "D",
        yes(F.col("doc_id") > F.col("first")).alias("E"),
        yes(F.col("good")).alias("good"),
        yes(F.col("toxic")).alias("toxic"),
    )
