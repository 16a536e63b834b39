"""Quality classifier: a linear support vector machine on n-gram indicators scaled by naive Bayes log-count
ratios, fitted by dual coordinate descent."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame

from .text import (
    NOT_SPACE,
    labelled_sample,
    map_texts,
    mix,
    ngram_hashes,
    span_hashes,
    spans,
    sums_by_text,
    text_blocks,
    text_of,
    unique_by_text,
)

BITS = 18  # n-grams are hashed into 2 ** BITS indicators


class Model(NamedTuple):
    """``weights``: for each indicator its hyperplane weight times its log-count ratio; ``ratios``: the
    log-count ratios, which also give the length by which a text's indicators are normalised. The margin
    becomes a probability by ``slope`` and ``shift``."""

    weights: np.ndarray
    ratios: np.ndarray
    bias: float
    slope: float
    shift: float


def indicators(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashed n-grams of each text, and their texts: words, word pairs and byte trigrams."""
    starts, ends, first = spans(data, offsets, NOT_SPACE)
    words = span_hashes(data, starts, ends)
    owner = text_of(first)
    pairs, at = ngram_hashes(words, owner, 2)
    of_byte = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    wide = data.astype(np.uint64)
    inside = np.flatnonzero(of_byte[2:] == of_byte[:-2]) if len(data) > 2 else np.zeros(0, np.int64)
    trigrams = mix(wide[inside] << np.uint64(16) | wide[inside + 1] << np.uint64(8) | wide[inside + 2])
    hashes = np.concatenate((words, pairs, trigrams)) >> np.uint64(64 - BITS)
    return unique_by_text(hashes, np.concatenate((owner, owner[at], of_byte[inside])), BITS)


def margins(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    buckets, owner = indicators(data, offsets)
    texts = len(offsets) - 1
    dots = sums_by_text(model.weights[buckets], owner, texts)
    lengths = np.sqrt(sums_by_text(model.ratios[buckets] ** 2, owner, texts))
    return dots / np.maximum(lengths, 1e-12) + model.bias


def probability(margin: np.ndarray, slope: float, shift: float) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(slope * margin + shift, -35, 35)))


def log_count_ratios(rows: Sequence[np.ndarray], labels: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    counts = np.full((2, 1 << BITS), smoothing)
    for buckets, label in zip(rows, labels, strict=True):
        counts[label][buckets] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def dual_coordinate_descent(
    rows: Sequence[np.ndarray], labels: np.ndarray, ratios: np.ndarray, *, cost: float, rounds: int
) -> tuple[np.ndarray, float]:
    """Linear hinge-loss model on normalised scaled indicators. Both classes weigh the same in total.
    Returns weights (already times the ratios) and bias. A row's values are looked up when it is its turn;
    those of all rows are never held."""
    rng = np.random.default_rng(0)
    lengths = [max(float(np.sqrt(v @ v)), 1e-12) for v in (ratios[b] for b in rows)]
    squares = np.array([v @ v + 1.0 for v in (ratios[b] / n for b, n in zip(rows, lengths, strict=True))])
    signs = np.where(labels == 1, 1.0, -1.0)
    most = np.where(labels == 1, cost / max(1, (labels == 1).sum()), cost / max(1, (labels == 0).sum()))
    weights, bias, alphas = np.zeros(1 << BITS), 0.0, np.zeros(len(rows))
    for _ in range(rounds):
        for i in rng.permutation(len(rows)):
            at = rows[i]
            x = ratios[at] / lengths[i]
            gradient = signs[i] * (weights[at] @ x + bias) - 1.0
            new = min(max(alphas[i] - gradient / squares[i], 0.0), most[i])
            if new != alphas[i]:
                step = (new - alphas[i]) * signs[i]
                weights[at] += step * x
                bias += step
                alphas[i] = new
    return weights * ratios, bias


def platt(margin: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through margins that the model was not fitted on (Newton)."""
    positive, negative = (labels == 1).sum(), (labels == 0).sum()
    target = np.where(labels == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    x = np.stack([margin, np.ones_like(margin)], axis=1)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = probability(margin, *theta)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (p - target) + 1e-3 * (theta - [1.0, 0.0]))
        theta = theta - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return float(theta[0]), float(theta[1])


def fit_rows(
    rows: Sequence[np.ndarray], labels: np.ndarray, *, cost: float, rounds: int, folds: int = 3
) -> Model:
    """Fit on rows of indicators. Without both classes, every score is the share of the class seen (0.5 if
    there are no rows at all)."""
    share = float(labels.mean()) if len(labels) else 0.5
    if share in (0.0, 1.0) or len(labels) < 2 * folds:
        empty = np.zeros(1 << BITS)
        odds = np.log((share * len(labels) + 1) / ((1 - share) * len(labels) + 1))
        return Model(empty, empty, 0.0, 0.0, float(odds))

    def solve(some):
        part, of = [rows[i] for i in some], labels[some]
        ratios = log_count_ratios(part, of)
        return ratios, *dual_coordinate_descent(part, of, ratios, cost=cost, rounds=rounds)

    margin = np.zeros(len(rows))
    for fold in range(folds):
        ratios, weights, bias = solve(np.flatnonzero(np.arange(len(rows)) % folds != fold))
        for i in range(fold, len(rows), folds):
            length = np.sqrt((ratios[rows[i]] ** 2).sum())
            margin[i] = weights[rows[i]].sum() / max(length, 1e-12) + bias
    slope, shift = platt(margin, labels)
    ratios, weights, bias = solve(np.arange(len(rows)))
    return Model(weights.astype(np.float32), ratios.astype(np.float32), float(bias), slope, shift)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    held_out: Column,
    *,
    label: str = "quality",
    per_class: int = 2000,
    max_chars: int = 50_000,
    cost: float = 1000.0,
    rounds: int = 10,
    key: str = "doc_id",
    text: str = "text",
) -> Model:
    """Fit on at most ``per_class`` labelled texts of each class outside the held-out fold (see
    ``labelled_sample``); their indicators are made in the tasks and come to the driver."""
    sample = labelled_sample(
        docs, labels, label, per_class=per_class, max_chars=max_chars, held_out=held_out, key=key, text=text
    )

    def features(batches):
        for batch in batches:
            for part, data, offsets in text_blocks(batch, "text"):
                buckets, owner = indicators(data, offsets)
                cuts = np.searchsorted(owner, np.arange(part.num_rows + 1))
                lists = pa.ListArray.from_arrays(
                    pa.array(cuts, pa.int32()), pa.array(buckets.astype(np.int32))
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), lists], names=["key", "label", "buckets"]
                )

    key_type = sample.schema["key"].dataType.simpleString()
    made = sample.select("key", "label", "text").mapInArrow(
        features, f"key {key_type}, label int, buckets array<int>"
    )
    found = made.toArrow()
    order = pc.sort_indices(found.select(["key", "label"]), [("key", "ascending"), ("label", "ascending")]).to_numpy()
    of = found.column("label").to_numpy()[order]
    lists = found.column("buckets").combine_chunks()
    del found
    flat, at = lists.values.to_numpy(), lists.offsets.to_numpy()
    model = fit_rows([flat[at[i] : at[i + 1]] for i in order], of, cost=cost, rounds=rounds)
    # The driver lives on: what the sample took goes back to the system.
    del lists, flat, at
    pa.default_memory_pool().release_unused()
    return model


def scorer(model: Model, threshold: float) -> Callable:
    def score(data, offsets):
        p = probability(margins(model, data, offsets), model.slope, model.shift)
        return p, (p >= threshold).astype(np.int32)

    return score


def classify(
    docs: DataFrame, model: Model, *, threshold: float = 0.7, keep: Sequence[str] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """Columns ``keep``, ``score`` (0 to 1, higher for better texts) and ``predicted`` for every row, from
    its whole text. A null or empty text has no indicators and gets the score of the bias."""
    return map_texts(docs, scorer(model, threshold), "score double, predicted int", keep=keep, text=text)


def keep_good(docs: DataFrame, model: Model, *, threshold: float = 0.7, text: str = "text") -> DataFrame:
    """The rows with a score of at least the threshold, all columns as they are, whatever their names."""
    return map_texts(
        docs.select("*"),
        scorer(model, threshold),
        "",
        keep=docs.columns,
        text=text,
        where=lambda new: np.asarray(new[1]) == 1,
    )
