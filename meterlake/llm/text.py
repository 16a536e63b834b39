"""Texts of an Arrow batch as byte arrays: words, hashes and n-grams without a Python object per word.

Texts are UTF-8, and all separators are ASCII bytes, so words can be cut at the byte level. Work goes
block by block: a block holds whole texts of about ``BLOCK_BYTES`` (a longer text is a block of its own),
which bounds memory by the block or the longest text and not by the batch.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

BLOCK_BYTES = 1 << 19

ASCII_SPACE = frozenset([0x20, *range(0x09, 0x0E)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
NOT_SPACE = np.array([b not in ASCII_SPACE for b in range(256)])

Texts = tuple[np.ndarray, np.ndarray]


def fold(row_key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo a number; -1 for a null key."""
    return F.coalesce(F.crc32(F.col(row_key).cast("string").cast("binary")) % modulus, F.lit(-1))


def text_blocks(
    batch: pa.RecordBatch, column: str, limit: int = BLOCK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch, each with the bytes of its texts and their offsets (one more than rows). A null
    text is empty."""
    texts = pc.fill_null(batch.column(column), "").cast(pa.large_binary())
    n = len(texts)
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, n)
        low, high = offsets[first], offsets[last]
        yield batch.slice(first, last - first), whole[low:high], offsets[first : last + 1] - low
        first = last


def unused(name: str, taken: Sequence[str]) -> str:
    """A column name that is not among those taken: ``name``, with underscores in front where needed."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def map_texts(
    docs: DataFrame,
    score: Callable[[np.ndarray, np.ndarray], Sequence],
    added: str,
    *,
    keep: Sequence[str],
    text: str = "text",
    where: Callable[[Sequence], np.ndarray] | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Columns ``keep`` and what ``score`` gives for each block of texts. Nothing is shuffled.

    ``added`` is the DDL of the new columns; one that has the name of a kept column takes its place. With
    ``where``, which turns what ``score`` gives into a mask of rows to keep, ``added`` may be empty. A text
    that is kept is sent to Python once.
    """
    fields = T.StructType.fromDDL(added) if added else T.StructType()
    names = {f.name.lower() for f in fields}
    kept = [c for c in keep if c.lower() not in names]
    schema = T.StructType([docs.schema[c] for c in kept] + fields.fields)
    arrow = to_arrow_schema(schema)
    sent = text if text in kept else unused("_text", kept)
    extra = [] if text in kept else [F.col(text).alias(sent)]
    source = docs.select(*[F.col(f"`{c}`") for c in kept], *extra)

    def run(batches):
        for batch in batches:
            for rows, data, offsets in text_blocks(batch, sent, block_bytes):
                new = score(data, offsets)
                columns = [rows.column(c) for c in kept]
                columns += [
                    v if isinstance(v, pa.Array) else pa.array(v, arrow.field(f.name).type)
                    for v, f in zip(new, fields, strict=False)
                ]
                out = pa.RecordBatch.from_arrays(
                    [c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
                )
                yield out if where is None else out.filter(pa.array(where(new)))

    return source.mapInArrow(run, schema)


# Words ------------------------------------------------------------------------------------------------
def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, ...]:
    """Maximal runs of bytes of a class, never across texts: starts, ends, and for each text the index of
    its first run (one more than texts)."""
    flag = inside[data]
    before = np.zeros(len(data), bool)
    before[1:] = flag[:-1]
    cuts = offsets[:-1]
    before[cuts[cuts < len(data)]] = False
    after = np.zeros(len(data), bool)
    after[:-1] = flag[1:]
    cuts = offsets[1:] - 1
    after[cuts[cuts >= 0]] = False
    starts = np.flatnonzero(flag & ~before)
    ends = np.flatnonzero(flag & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64, fixed constants)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, for blocks up to n bytes."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES) + 1
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            tables.append(np.cumprod(table))
        _powers[:] = tables
    return _powers[0], _powers[1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span, equal for equal bytes: differences of a running polynomial."""
    n = len(data)
    power, inverse = _power_tables(n)
    running = np.zeros(n + 1, np.uint64)
    # Adding a large odd number to each byte keeps short words apart.
    np.cumsum((data.astype(np.uint64) + np.uint64(0x1000193)) * power[:n], out=running[1:])
    return mix((running[ends] - running[starts]) * inverse[starts])


def ngram_hashes(words: np.ndarray, of_text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n consecutive words of one text, and the index of each one's first word.
    ``of_text``: the text of each word, ascending."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(of_text[:count] == of_text[n - 1 :])
    total = np.zeros(len(at), np.uint64)
    for j in range(n):
        total = total * np.uint64(_BASE) + words[at + j]
    return mix(total + np.uint64(n)), at


def text_of(first: np.ndarray) -> np.ndarray:
    """The text of each item, from the index of each text's first item."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def code_points(data: np.ndarray) -> np.ndarray:
    """Code points before each byte, and in all (one more than bytes)."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out


def sums_by_text(values: np.ndarray, of_text: np.ndarray, texts: int) -> np.ndarray:
    return np.bincount(of_text, weights=values, minlength=texts)


def unique_by_text(buckets: np.ndarray, of_text: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Each bucket (a number of at most ``bits`` bits) once per text: buckets and their texts."""
    keys = np.sort((of_text.astype(np.int64) << bits) | buckets.astype(np.int64))
    if len(keys):
        keys = keys[np.concatenate(([True], keys[1:] != keys[:-1]))]
    return keys & ((1 << bits) - 1), keys >> bits


# Code points ------------------------------------------------------------------------------------------
@functools.cache
def letter_table() -> np.ndarray:
    """For each code point its lower-case letter, or 0 if it is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            low = char.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def as_code_points(data: np.ndarray, offsets: np.ndarray) -> Texts:
    """Code points of the texts and their offsets. Broken UTF-8 becomes the replacement character."""
    raw = data.tobytes()
    parts = [
        np.frombuffer(raw[a:b].decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
    ]
    lengths = np.array([len(p) for p in parts], np.int64)
    at = np.concatenate(([0], np.cumsum(lengths)))
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint32)), at


# Labelled samples -------------------------------------------------------------------------------------
def hash_sample(rows: DataFrame, by: str, key: Sequence[str], most: int) -> DataFrame:
    """At most ``most`` rows of each value of ``by``: those with the least hashes of their keys, which must
    differ from row to row. Which rows these are depends on the rows alone, not on files or tasks.

    Rows are counted first. Only those below a cut that lets somewhat more than ``most`` through are ranked,
    so the task of a class ranks about ``most`` rows however many there are. The cut is five standard
    deviations above what is needed, so a sample is not short but by rare chance, and then the same each time.
    """
    from pyspark.sql import Window

    at = F.shiftrightunsigned(F.xxhash64(*key), 11) / float(1 << 53)
    name = unused("_at", rows.columns)
    total, nth = unused("_of", rows.columns), unused("_nth", rows.columns)
    counts = rows.groupBy(by).agg(F.count("*").alias(total))
    wanted = most + 5 * most**0.5 + 10
    # One row a class.
    low = rows.withColumn(name, at).join(F.broadcast(counts), by).where(F.col(name) * F.col(total) < wanted)
    rank = F.row_number().over(Window.partitionBy(by).orderBy(name, *key))
    return low.withColumn(nth, rank).where(F.col(nth) <= most).select(*rows.columns)


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    *,
    per_class: int,
    max_chars: int,
    held_out: Column,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """At most ``per_class`` labelled rows of each class (0 and 1), outside the held-out fold, of texts no
    longer than ``max_chars``: the bounded sample a classifier is fitted on. Keys are taken in the order of
    their hash (``hash_sample``), and of rows that repeat a key with other texts the one with the least hash
    of its text, so the sample does not depend on how rows lie in files. Columns: key, label, text.
    """
    judged = (
        labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
        .where("key IS NOT NULL AND label IN (0, 1)")
        .where(~held_out)
        .distinct()
    )
    chosen = hash_sample(judged, "label", ["key"], per_class)
    texts = docs.select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    # chosen has at most 2 * per_class rows of two numbers.
    joined = texts.where(F.length("text") <= max_chars).join(F.broadcast(chosen), "key")
    return first_texts(joined, ["key", "label"])


def first_texts(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row of each key: that with the least hash of its ``text``. A partial aggregate, so a key that many
    rows repeat is reduced where they lie."""
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")
    return rows.groupBy(*keys).agg(least).select(*keys, "least.text")
