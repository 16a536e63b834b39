"""Language identification by rank-order profiles of character n-grams."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text import as_code_points, first_texts, hash_sample, letter_table, map_texts, text_blocks

UNDETERMINED = "und"
BREAK = 1  # stands for a stretch without letters; no letter has this code point
MAX_N = 3
LETTER_BITS = 21  # every code point fits, and three letters fit in a signed number of 64 bits


class Profiles(NamedTuple):
    """``grams``: all profile n-grams, ascending; ``ranks``: the rank of each in each language, or ``size``
    where the language's profile lacks it."""

    languages: list[str]
    grams: np.ndarray
    ranks: np.ndarray
    size: int


def letters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters of all texts, with one BREAK before, after and for each stretch of others; and for
    each text the place of the BREAK before it (one more than texts)."""
    points, at = as_code_points(data, offsets)
    low = letter_table()[points]
    joined = np.insert(low, at, 0)
    blank = joined == 0
    kept = ~blank
    kept[1:] |= blank[1:] & ~blank[:-1]
    kept[0] = True
    joined[blank] = BREAK
    place = np.cumsum(kept) - 1
    return joined[kept], place[at + np.arange(len(at))]


def grams(codes: np.ndarray) -> np.ndarray:
    """All n-grams of 1 to MAX_N within words, BREAK only at either end; each as one number."""
    wide = codes.astype(np.uint64)
    inner = codes != BREAK
    out = [wide[inner]]
    for n in range(2, MAX_N + 1):
        count = len(wide) - n + 1
        if count <= 0:
            break
        value = np.zeros(count, np.uint64)
        for j in range(n):
            value = (value << np.uint64(LETTER_BITS)) | wide[j : j + count]
        good = np.ones(count, bool)
        for j in range(1, n - 1):
            good &= inner[j : j + count]
        if n == 2:
            good = inner[:count] | inner[1:]
        out.append(value[good])
    return np.concatenate(out)


def ranked(codes: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent n-grams, most frequent first; ties by the n-gram."""
    values, counts = np.unique(grams(codes), return_counts=True)
    if len(values) > size:
        # Only those at or above the size-th count can be among them.
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        some = counts >= least
        values, counts = values[some], counts[some]
    return values[np.argsort(-counts, kind="stable")][:size]


def fit(
    docs: DataFrame,
    learn: Column,
    *,
    per_language: int = 1000,
    max_chars: int = 50_000,
    size: int = 400,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> Profiles:
    """Profiles of all languages found in ``lang`` where ``learn`` holds.

    They are learned from at most ``per_language`` texts of each language of no more than ``max_chars``
    (whole texts, taken in the order of a hash of their key; of texts under one key the one with the least
    hash). N-grams are counted in the tasks and summed
    by Spark; only the ``size`` most frequent of each language come to the driver.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    usable = rows.where(learn & F.col("lang").isNotNull()).where(
        (F.length("text") > 0) & (F.length("text") <= max_chars)
    )
    chosen = hash_sample(usable.select("key", "lang").distinct(), "lang", ["key"], per_language)
    # Bounded: per_language rows of a number and a short name for each language.
    sample = first_texts(usable.join(F.broadcast(chosen), ["key", "lang"]), ["key", "lang"])

    def count(batches):
        for batch in batches:
            found: dict[str, list[np.ndarray]] = {}
            names = batch.column(0).to_pylist()
            row = 0
            for part, data, offsets in text_blocks(batch, "text"):
                codes, at = letters(data, offsets)
                for i in range(part.num_rows):
                    found.setdefault(names[row], []).append(grams(codes[at[i] : at[i + 1] + 1]))
                    row += 1
            for name, lists in found.items():
                values, counts = np.unique(np.concatenate(lists), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * len(values), pa.string()),
                        pa.array(values.view(np.int64)),
                        pa.array(counts.astype(np.int64)),
                    ],
                    names=["lang", "gram", "n"],
                )

    counted = (
        sample.select("lang", "text")
        .mapInArrow(count, "lang string, gram bigint, n bigint")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    top = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = counted.withColumn("place", top).where(F.col("place") <= size).collect()
    languages = sorted({r["lang"] for r in best})
    all_grams = np.unique(np.array([r["gram"] for r in best], np.int64).view(np.uint64))
    ranks = np.full((len(all_grams), len(languages)), size, np.int32)
    for r in best:
        where = np.searchsorted(all_grams, np.uint64(r["gram"] & 0xFFFFFFFFFFFFFFFF))
        ranks[where, languages.index(r["lang"])] = r["place"] - 1
    return Profiles(languages, all_grams, ranks, size)


def classify(codes: np.ndarray, profiles: Profiles) -> tuple[str, float]:
    """The language whose profile is nearest by the out-of-place distance, and 1 minus that distance as a
    share of the greatest possible one. Ties go to the first language by name."""
    if not len(codes) or not (codes != BREAK).any() or not profiles.languages:
        return UNDETERMINED, 0.0
    found = ranked(codes, profiles.size)
    if len(profiles.grams):
        where = np.minimum(np.searchsorted(profiles.grams, found), len(profiles.grams) - 1)
        known = profiles.grams[where] == found
    places = np.arange(len(found))[:, None]
    theirs = np.where(known[:, None], profiles.ranks[where], profiles.size)
    away = np.where(theirs == profiles.size, profiles.size, np.abs(theirs - places)).sum(axis=0)
    best = int(np.argmin(away))
    return profiles.languages[best], 1.0 - float(away[best]) / (profiles.size * len(found))


def predict(
    docs: DataFrame, profiles: Profiles, *, keep: Sequence[str] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """Columns ``keep``, ``lang_pred`` and ``score`` for every row, from its whole text. A text that is
    null or has no letter is ``und`` with score 0, as is every text if no language was learned."""

    def score(data, offsets):
        codes, at = letters(data, offsets)
        found = [classify(codes[at[i] : at[i + 1] + 1], profiles) for i in range(len(offsets) - 1)]
        return [f[0] for f in found], [f[1] for f in found]

    return map_texts(docs, score, "lang_pred string, score double", keep=keep, text=text)
