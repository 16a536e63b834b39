"""Quality rules: base counts of each text, and the log-likelihood ratio of its hashed n-grams between a
trusted target and the raw corpus."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .text import (
    NOT_SPACE,
    code_points,
    map_texts,
    ngram_hashes,
    span_hashes,
    spans,
    sums_by_text,
    text_blocks,
    text_of,
)

BITS = 16
REPEAT_WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
NOT_NEWLINE = np.array([b != 0x0A for b in range(256)])
IS_SYMBOL = np.array([chr(b) in "#*$%&|<>" for b in range(256)])


def hashed_ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and word pairs of each text, repeats included, and their texts."""
    starts, ends, first = spans(data, offsets, NOT_SPACE)
    words, owner = span_hashes(data, starts, ends), text_of(first)
    pairs, at = ngram_hashes(words, owner, 2)
    buckets = np.concatenate((words, pairs)) >> np.uint64(64 - BITS)
    return buckets.astype(np.int64), np.concatenate((owner, owner[at]))


def repeated_words(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each text, the words in windows of REPEAT_WINDOW that occur twice or more in it."""
    owner = text_of(first)
    windows, at = ngram_hashes(words, owner, REPEAT_WINDOW)
    cuts = np.searchsorted(at, first)
    covered = np.zeros(len(words) + 1, np.int64)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if b - a < 2:
            continue
        order = np.argsort(windows[a:b], kind="stable")
        values = windows[a:b][order]
        same = values[1:] == values[:-1]
        if not same.any():
            continue
        repeated = np.zeros(b - a, bool)
        repeated[order[1:][same]] = True
        repeated[order[:-1][same]] = True
        begin = at[a:b][repeated]
        covered[begin] += 1
        covered[begin + REPEAT_WINDOW] -= 1
    inside = np.cumsum(covered[:-1]) > 0
    return sums_by_text(inside, owner, len(first) - 1).astype(np.int64)


def duplicate_lines(data: np.ndarray, offsets: np.ndarray, word_starts: np.ndarray) -> np.ndarray:
    """For each text, the lines with a word that equal an earlier line."""
    starts, ends, first = spans(data, offsets, NOT_NEWLINE)
    filled = np.searchsorted(word_starts, ends) > np.searchsorted(word_starts, starts)
    hashes, owner = span_hashes(data, starts[filled], ends[filled]), text_of(first)[filled]
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    again = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    return sums_by_text(again, owner[1:], len(offsets) - 1).astype(np.int64)


class Base(NamedTuple):
    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    base_failed: np.ndarray


def base_counts(data: np.ndarray, offsets: np.ndarray) -> Base:
    starts, ends, first = spans(data, offsets, NOT_SPACE)
    points = code_points(data)
    owner, texts = text_of(first), len(offsets) - 1
    n_words = np.diff(first)
    chars = sums_by_text(points[ends] - points[starts], owner, texts).astype(np.int64)
    symbols = np.concatenate(([0], np.cumsum(IS_SYMBOL[data])))
    repeats = repeated_words(span_hashes(data, starts, ends), first)
    failed = (n_words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n_words)
    lines = duplicate_lines(data, offsets, starts)
    return Base(n_words, chars, symbols[offsets[1:]] - symbols[offsets[:-1]], lines, repeats, failed)


def count_buckets(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Occurrences of each bucket over all rows. Tasks send one row per 1,024 buckets, which Spark adds up;
    the driver gets 2 ** BITS numbers whatever the input."""
    per_row = 1024
    chunks = (1 << BITS) // per_row

    def count(batches):
        total = np.zeros(1 << BITS, np.int64)
        for batch in batches:
            for _, data, offsets in text_blocks(batch, "text"):
                total += np.bincount(hashed_ngrams(data, offsets)[0], minlength=1 << BITS)
        if total.any():
            yield rows(np.arange(chunks), total.reshape(chunks, per_row))

    def rows(chunk, values):
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(len(chunk) + 1) * per_row, pa.int32()), pa.array(values.ravel())
        )
        return pa.RecordBatch.from_arrays([pa.array(chunk, pa.int64()), lists], names=["chunk", "n"])

    counted = docs.select(F.col(text).alias("text")).mapInArrow(count, "chunk bigint, n array<bigint>")
    # Element by element, so that the sums are partial aggregates too.
    added = (
        counted.select((F.col("chunk")).alias("chunk"), F.posexplode("n").alias("at", "n"))
        .groupBy((F.col("chunk") * per_row + F.col("at")).alias("bucket"))
        .agg(F.sum("n").alias("n"))
    )
    found = added.where("n > 0").toArrow()
    out = np.zeros(1 << BITS, np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def log_ratios(target: np.ndarray, raw: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    """Log-likelihood ratio of each bucket between two smoothed multinomials."""
    p, q = target + smoothing, raw + smoothing
    return np.log(p / p.sum()) - np.log(q / q.sum())


def mean_ratio(ratios: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Ratio per n-gram of each text; 0 for a text without words."""
    buckets, owner = hashed_ngrams(data, offsets)
    texts = len(offsets) - 1
    n = np.bincount(owner, minlength=texts)
    return sums_by_text(ratios[buckets], owner, texts) / np.maximum(n, 1)


def mean_ratio_without_itself(
    target: np.ndarray, raw: np.ndarray, data: np.ndarray, offsets: np.ndarray, smoothing: float = 1.0
) -> np.ndarray:
    """``mean_ratio`` of texts that are part of the target, each as if the target lacked it. So they compare
    to texts that never were in the target."""
    buckets, owner = hashed_ngrams(data, offsets)
    texts = len(offsets) - 1
    n = np.bincount(owner, minlength=texts)
    keys, counts = np.unique((owner << BITS) | buckets, return_counts=True)
    buckets, owner = keys & ((1 << BITS) - 1), keys >> BITS
    p = np.log(target[buckets] - counts + smoothing)
    q = raw + smoothing
    sums = sums_by_text(counts * (p - np.log(q[buckets] / q.sum())), owner, texts)
    rest = np.log(np.maximum(target.sum() - n, 0) + smoothing * len(target))
    return np.where(n > 0, sums / np.maximum(n, 1) - rest, 0.0)


def order_statistic(values: DataFrame, column: str, rank: int, most: int = 10_000) -> float | None:
    """The value at a place (from 1) in ascending order, exactly; null if there are fewer values. Values are
    narrowed down to a stretch around the place, by approximate quantiles and exact counts, until there are
    at most ``most`` different ones; only those and their numbers come to the driver."""
    left, below = values.select(F.col(column).alias("v")).where("v IS NOT NULL"), 0
    while True:
        counted = left.groupBy("v").agg(F.count("*").alias("n"))
        size = counted.agg(F.count("*").alias("kinds"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
        if size["n"] < rank - below:
            return None
        if size["kinds"] <= most:
            for row in sorted(counted.collect()):
                below += row["n"]
                if below >= rank:
                    return row["v"]
        at = (rank - below) / size["n"]
        # Quantiles are off by 1 in 10,000 of the rows; ten times that on either side holds the place.
        around = [max(0.0, at - 0.001), min(1.0, at + 0.001)]
        low, high = left.agg(F.percentile_approx("v", around, 10_000).alias("q")).first()["q"]
        below += left.where(F.col("v") < low).count()
        left = left.where(F.col("v").between(low, high))


class Rule(NamedTuple):
    ratios: np.ndarray
    threshold: float


def fit(
    docs: DataFrame, trusted: DataFrame, *, pass_share: float = 0.99, text: str = "text"
) -> Rule:
    """Multinomials over all rows of ``docs`` and of ``trusted``. The threshold is the mean ratio that the
    share ``pass_share`` of the trusted texts with enough words reaches, each left out of the target. No
    trusted text: nothing is rejected by the ratio."""
    target = count_buckets(trusted, text)
    if not target.any():
        return Rule(np.zeros(1 << BITS), 0.0)
    raw = count_buckets(docs, text)

    def score(data, offsets):
        n_words = np.diff(spans(data, offsets, NOT_SPACE)[2])
        return mean_ratio_without_itself(target, raw, data, offsets), n_words

    scored = map_texts(trusted, score, "ratio double, n_words bigint", keep=(), text=text)
    enough = settle(scored.where(F.col("n_words") >= MIN_WORDS).select("ratio"), "trusted-ratios")
    rank = max(1, math.ceil(round((1.0 - pass_share) * enough.count(), 6)))
    return Rule(log_ratios(target, raw), order_statistic(enough, "ratio", rank) or 0.0)


COLUMNS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, ratio double, kept boolean"
)


def apply(docs: DataFrame, rule: Rule, *, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """Columns ``keep``, the base counts, the mean ratio and the verdict of every row. ``kept`` is false
    where the base rules fail, else true where the ratio reaches the threshold. A null text has no words,
    so it fails. Equal texts get equal rows."""

    def score(data, offsets):
        base = base_counts(data, offsets)
        ratio = mean_ratio(rule.ratios, data, offsets)
        return *base, ratio, ~base.base_failed & (ratio >= rule.threshold)

    return map_texts(docs, score, COLUMNS, keep=keep, text=text)
