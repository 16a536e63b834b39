"""Sum-of-squares online packing of token sequences into windows of fixed length."""

from __future__ import annotations

import base64
import functools
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Fixed value: the rule by which the public byte-level vocabulary cuts text before merging, in the
# possessive form that its tokenizer library gives for it.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


@functools.cache
def encoder(ranks_path: str, special: tuple[tuple[str, int], ...] = ()):
    """The byte-level tokenizer of a rank file and of special tokens. One per worker process."""
    import tiktoken

    with open(ranks_path, "rb") as file:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=dict(special))


class Window:
    """A partially filled window: its pieces as (row, start, ids)."""

    __slots__ = ("fill", "pieces")

    def __init__(self) -> None:
        self.fill = 0
        self.pieces: list[tuple[int, int, np.ndarray]] = []

    def add(self, piece: tuple[int, int, np.ndarray]) -> None:
        self.pieces.append(piece)
        self.fill += len(piece[2])

    def take(self, most: int) -> tuple[int, int, np.ndarray]:
        """Remove and return the last piece, or its end if it has more than ``most`` ids."""
        row, start, ids = self.pieces.pop()
        over = len(ids) - most
        if over > 0:
            self.pieces.append((row, start, ids[:over]))
            start, ids = start + over, ids[over:]
        self.fill -= len(ids)
        return row, start, ids


class SumOfSquares:
    """Places pieces one after the other, each into the fill level that leaves the smallest sum of squared
    counts of partially filled windows. ``counts`` is the level array: open windows by fill."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, np.int64)
        self.levels: list[list[Window]] = [[] for _ in range(capacity + 1)]

    def level_for(self, length: int) -> int:
        """The fill (0: a new window) to which a piece is added. Ties go to the fullest window."""
        c, counts = self.capacity, self.counts
        if length == c:
            return 0
        # A window leaves level h (2 * counts[h] - 1 less) and enters h + length (2 * counts + 1 more),
        # unless it is full then and counts no longer.
        top = c - length
        change = np.full(top + 1, np.iinfo(np.int64).max)
        open_ = np.flatnonzero(counts[1 : top + 1]) + 1
        change[open_] = 1 - 2 * counts[open_]
        change[open_] += np.where(open_ < top, 2 * counts[open_ + length] + 1, 0)
        change[0] = 2 * counts[length] + 1
        return top - int(np.argmin(change[::-1]))

    def place(self, piece: tuple[int, int, np.ndarray]) -> Window | None:
        """Place a piece; returns the window if that filled it."""
        level = self.level_for(len(piece[2]))
        window = Window()
        if level:
            window = self.levels[level].pop()
            self.counts[level] -= 1
        window.add(piece)
        if window.fill == self.capacity:
            return window
        self.levels[window.fill].append(window)
        self.counts[window.fill] += 1
        return None

    def rest(self) -> Iterator[Window]:
        """Close what is open when the input ends: the emptiest windows are cut up to fill the others, and
        the last one is cut into lengths that are powers of two, so nothing needs padding."""
        open_ = [w for level in reversed(self.levels) for w in level]
        self.levels, self.counts[:] = [[] for _ in self.levels], 0
        first, last = 0, len(open_) - 1
        while first < last:
            taker, giver = open_[first], open_[last]
            while giver.fill and taker.fill < self.capacity:
                taker.add(giver.take(self.capacity - taker.fill))
            if taker.fill == self.capacity:
                yield taker
                first += 1
            if not giver.fill:
                last -= 1
        if first == last:
            whole = open_[first]
            while whole.fill:
                part = Window()
                size = 1 << (whole.fill.bit_length() - 1)
                while part.fill < size:
                    part.add(whole.take(size - part.fill))
                yield part


# Token ids in one batch that a task gives back.
BATCH_IDS = 1 << 18


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """Arrays as one list array, without a Python object per number."""
    cuts = np.concatenate(([0], np.cumsum([len(a) for a in arrays])))
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat.astype(np.int32)), type=kind)


PIECES = (
    "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
)


def pack(
    docs: DataFrame,
    ranks_path: str,
    *,
    capacity: int = 2048,
    end_id: int = 1,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
    special: Mapping[str, int] | None = None,
) -> DataFrame:
    """Pack documents into sequences of ``capacity`` tokens; one row per piece of a document.

    Each input partition is packed for itself, in one pass and without a shuffle: whole multiples of the
    capacity are sequences of their own, what is left of a document is placed by the sum-of-squares rule.
    Windows still open at the end are completed by cutting the emptiest ones; at most one sequence of each
    power of two per partition is shorter than the capacity. Memory holds the open windows only. Sequence
    ids carry the partition's number, so a task that runs again gives the same ids.

    A null or empty text is the end id alone. Rows with equal keys, or none, are packed each for itself.
    Other columns are ignored. No rows give no pieces. ``with_ids`` adds the token ids of each piece.
    ``special`` has the ids of strings that are one token wherever a text holds them; other strings are
    ordinary text.
    """
    fields = PIECES + (", ids array<int>" if with_ids else "")
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType)] + T.StructType.fromDDL(fields).fields)
    arrow = to_arrow_schema(schema)
    end = np.array([end_id], np.uint32)
    tokens = tuple((special or {}).items())

    def run(batches):
        encode = functools.partial(encoder(ranks_path, tokens).encode, allowed_special="all")
        base = TaskContext.get().partitionId() << 33
        packer = SumOfSquares(capacity)
        # Of documents with a piece in an open window: key, tokens, pieces not yet written.
        open_rows: dict[int, list] = {}
        out: list[tuple] = []
        sequence = row = waiting = 0

        def write(window: Window) -> None:
            nonlocal sequence, waiting
            offset = 0
            for number, start, ids in window.pieces:
                entry = open_rows[number]
                crc = zlib.crc32(ids.astype("<u4").tobytes())
                piece = (entry[0], start, len(ids), crc, entry[1], base + sequence, offset)
                out.append((*piece, ids) if with_ids else piece)
                waiting += len(ids)
                offset += len(ids)
                entry[2] -= len(ids)
                if not entry[2]:
                    del open_rows[number]
            sequence += 1

        def full_enough() -> bool:
            return len(out) >= 10_000 or (with_ids and waiting >= BATCH_IDS)

        def flush():
            nonlocal waiting
            columns = list(zip(*out, strict=True)) if out else [[] for _ in arrow]
            out.clear()
            waiting = 0
            lists = [_lists(columns.pop(), arrow[-1].type)] if with_ids else []
            values = [pa.array(c, f.type) for c, f in zip(columns, arrow, strict=False)]
            return pa.RecordBatch.from_arrays(values + lists, schema=arrow)

        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.concatenate((np.array(encode(value.as_py() or ""), np.uint32), end))
                open_rows[row] = [name, len(ids), len(ids)]
                whole = len(ids) - len(ids) % capacity
                for start in range(0, whole, capacity):
                    full = Window()
                    full.add((row, start, ids[start : start + capacity]))
                    write(full)
                if whole < len(ids):
                    # A copy, so that a short rest does not hold all of a long document.
                    filled = packer.place((row, whole, ids[whole:].copy()))
                    if filled is not None:
                        write(filled)
                row += 1
                if full_enough():
                    yield flush()
        for window in packer.rest():
            write(window)
            if full_enough():
                yield flush()
        yield flush()

    return docs.select(key, F.col(text).alias("_text")).mapInArrow(run, schema)
