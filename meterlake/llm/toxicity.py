"""Toxicity: a bidirectional gated recurrent network with attention pooling over word and character inputs,
written and trained in numpy. A text's score is that of its worst window."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import LOWER, labelled_sample, map_texts, mix, span_hashes, spans, text_of

WINDOW, STRIDE = 32, 16  # words; a passage of up to 17 words is whole in some window
WORD_BITS, CHAR_BITS = 12, 14  # rows of the two embedding tables
WORD_DIM, CHAR_DIM, HIDDEN = 8, 8, 8
GRAM_SIZES = (3, 4)
SCORE_BYTES = 1 << 20  # texts scored together; a word they share is looked up once
MIN_TEXTS = 5  # words and character n-grams in fewer labelled texts have no row of their own
PAD_GATE = 30.0  # update gate of a padding word: the state passes through unchanged

# Letters, digits and all bytes of non-ASCII characters.
IS_WORD = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])
F32 = np.float32


class Words(NamedTuple):
    """The words of a block: ``unique`` ones as (row of the word table, rows of the character table), each
    text word as an index into them, and each text's first word."""

    word_rows: np.ndarray
    gram_rows: np.ndarray
    gram_first: np.ndarray
    index: np.ndarray
    first: np.ndarray


def read_words(data: np.ndarray, offsets: np.ndarray, known: np.ndarray) -> Words:
    """Words and their character n-grams (of padded words, hashed). Words that are not ``known`` (a sorted
    array of hashes) share row 0 of the word table, so only their characters tell."""
    low = LOWER[data]
    starts, ends, first = spans(low, offsets, IS_WORD)
    hashes = span_hashes(low, starts, ends)
    unique, sample, index = np.unique(hashes, return_index=True, return_inverse=True)
    grams, owners = [], []
    lengths = ends[sample] - starts[sample] + 2
    # Unique words, each between two marks, side by side.
    at = np.concatenate(([0], np.cumsum(lengths)))
    padded = np.full(at[-1], 1, np.uint64)
    inner = np.repeat(starts[sample] - at[:-1] - 1, lengths) + np.arange(at[-1])
    edge = np.zeros(at[-1], bool)
    edge[at[:-1]] = True
    edge[at[1:] - 1] = True
    padded[~edge] = low[inner[~edge]]
    owner = np.repeat(np.arange(len(unique)), lengths)
    for n in GRAM_SIZES:
        count = len(padded) - n + 1
        if count <= 0:
            continue
        keep = np.flatnonzero(owner[:count] == owner[n - 1 :])
        value = np.zeros(len(keep), np.uint64)
        for j in range(n):
            value = (value << np.uint64(8)) | padded[keep + j]
        grams.append((mix(value + np.uint64(n << 56)) >> np.uint64(64 - CHAR_BITS)).astype(np.int64))
        owners.append(owner[keep])
    gram_rows = np.concatenate(grams) if grams else np.zeros(0, np.int64)
    gram_owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    order = np.argsort(gram_owner, kind="stable")
    gram_first = np.searchsorted(gram_owner[order], np.arange(len(unique) + 1))
    place = np.minimum(np.searchsorted(known, unique), max(0, len(known) - 1))
    hit = known[place] == unique if len(known) else np.zeros(len(unique), bool)
    return Words(np.where(hit, place + 1, 0), gram_rows[order], gram_first, index.ravel(), first)


def windows_of(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All overlapping windows of all texts: their first word, their number of words, and their text. The
    last window of a text ends with it. A text without words has none."""
    counts = np.diff(first)
    per_text = np.where(counts > 0, np.maximum(0, -(-(counts - WINDOW) // STRIDE)) + 1, 0)
    owner = np.repeat(np.arange(len(counts)), per_text)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    begin = first[:-1][owner] + nth * STRIDE
    length = np.minimum(WINDOW, first[1:][owner] - begin)
    return begin, length, owner


def sigmoid(x: np.ndarray) -> np.ndarray:
    return F32(1) / (F32(1) + np.exp(-x))


class Network:
    """Parameters by name; gradients and Adam moments have the same names.

    A word's input is its row of the word table beside the mean of its characters' rows. Each direction has
    a GRU whose input weights are stacked as update, reset and candidate gates.
    """

    def __init__(self, seed: int = 0) -> None:
        rng = np.random.default_rng(seed)
        width, gates = WORD_DIM + CHAR_DIM, 3 * HIDDEN

        def start(rows: int, columns: int, scale: float) -> np.ndarray:
            return (rng.standard_normal((rows, columns)) * scale).astype(F32)

        self.p = {
            "words": start(1 << WORD_BITS, WORD_DIM, 0.1),
            "chars": start(1 << CHAR_BITS, CHAR_DIM, 0.3),
            "attention": start(2 * HIDDEN, 1, 0.3),
            "out": start(2 * HIDDEN, 1, 0.3),
            "out_bias": np.zeros((1, 1), F32),
        }
        for side in "fb":
            self.p[f"in_{side}"] = start(width, gates, width**-0.5)
            self.p[f"bias_{side}"] = np.zeros((1, gates), F32)
            self.p[f"state_{side}"] = start(HIDDEN, gates, HIDDEN**-0.5)

    # Forward ------------------------------------------------------------------------------------------
    def inputs(self, words: Words) -> np.ndarray:
        """Input vector of each unique word."""
        n = len(words.word_rows)
        sums = np.zeros((n, CHAR_DIM), F32)
        sizes = np.diff(words.gram_first)
        filled = np.flatnonzero(sizes)
        step = 1 << 15  # unique words at a time, to bound the gathered rows
        for low in range(0, len(filled), step):
            some = filled[low : low + step]
            a, b = words.gram_first[some[0]], words.gram_first[some[-1] + 1]
            rows = self.p["chars"][words.gram_rows[a:b]]
            sums[some] = np.add.reduceat(rows, words.gram_first[some] - a, axis=0)
        sums /= np.maximum(sizes, 1)[:, None].astype(F32)
        return np.concatenate((self.p["words"][words.word_rows], sums), axis=1)

    def gate_inputs(self, x: np.ndarray, side: str) -> np.ndarray:
        """Gate inputs of each word, and of padding as one row more."""
        made = x @ self.p[f"in_{side}"] + self.p[f"bias_{side}"]
        pad = np.zeros((1, 3 * HIDDEN), F32)
        pad[0, :HIDDEN] = PAD_GATE
        return np.concatenate((made, pad))

    def run(self, gates: np.ndarray, index: np.ndarray, side: str, trace: list | None = None) -> np.ndarray:
        """States of one direction over windows of word indices (time first)."""
        u = self.p[f"state_{side}"]
        steps, n = index.shape
        out = np.empty((steps, n, HIDDEN), F32)
        h = np.zeros((n, HIDDEN), F32)
        zr, c = np.empty((n, 2 * HIDDEN), F32), np.empty((n, HIDDEN), F32)
        u_zr, u_c = np.ascontiguousarray(u[:, : 2 * HIDDEN]), np.ascontiguousarray(u[:, 2 * HIDDEN :])
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            g = gates[index[t]]
            # In place: sigmoid of the update and reset gates, then tanh of the candidate.
            np.matmul(h, u_zr, out=zr)
            zr += g[:, : 2 * HIDDEN]
            np.negative(zr, out=zr)
            np.exp(zr, out=zr)
            zr += F32(1)
            np.reciprocal(zr, out=zr)
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            np.matmul(r * h, u_c, out=c)
            c += g[:, 2 * HIDDEN :]
            np.tanh(c, out=c)
            new = c + z * (h - c)
            if trace is not None:
                trace.append((t, h, z.copy(), r.copy(), c.copy()))
            h = out[t] = new
        return out

    def pool(self, states: np.ndarray, filled: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logits of windows: attention weights over their words, weighted mean of states, output."""
        a = (states @ self.p["attention"])[:, :, 0]
        a = np.where(filled, a, F32(-1e9))
        a = np.exp(a - a.max(axis=0))
        a /= a.sum(axis=0)
        mean = (a[:, :, None] * states).sum(axis=0)
        return (mean @ self.p["out"] + self.p["out_bias"])[:, 0], a, mean

    def index_of(self, words: Words, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        places = np.arange(WINDOW)[:, None]
        filled = places < length
        at = np.minimum(begin + places, len(words.index) - 1)
        return np.where(filled, words.index[at], len(words.word_rows)), filled

    def logits(self, words: Words, begin: np.ndarray, length: np.ndarray, step: int = 1024) -> np.ndarray:
        x = self.inputs(words)
        gates = {side: self.gate_inputs(x, side) for side in "fb"}
        out = np.empty(len(begin), F32)
        for low in range(0, len(begin), step):
            part = slice(low, low + step)
            index, filled = self.index_of(words, begin[part], length[part])
            states = np.concatenate([self.run(gates[s], index, s) for s in "fb"], axis=2)
            out[part] = self.pool(states, filled)[0]
        return out

    # Backward -----------------------------------------------------------------------------------------
    def gradients(
        self, words: Words, begin: np.ndarray, length: np.ndarray, target: np.ndarray, weight: np.ndarray
    ) -> tuple[dict[str, np.ndarray], float]:
        """Gradients of the weighted cross-entropy of a batch of windows, and its value."""
        index, filled = self.index_of(words, begin, length)
        used, index = np.unique(index, return_inverse=True)
        index = index.reshape(filled.shape)
        pads = used == len(words.word_rows)
        used = used[~pads]
        sizes = np.diff(words.gram_first)[used]
        rows = np.concatenate([np.arange(words.gram_first[w], words.gram_first[w + 1]) for w in used])
        small = Words(
            words.word_rows[used],
            words.gram_rows[rows],
            np.concatenate(([0], np.cumsum(sizes))),
            words.index,
            words.first,
        )
        x = self.inputs(small)
        gates, traces, states = {}, {"f": [], "b": []}, []
        for s in "fb":
            gates[s] = self.gate_inputs(x, s)
            states.append(self.run(gates[s], index, s, traces[s]))
        states = np.concatenate(states, axis=2)
        logit, a, mean = self.pool(states, filled)
        p = sigmoid(logit)
        loss = -(weight * np.where(target == 1, np.log(p + 1e-7), np.log(1 - p + 1e-7))).sum()
        g = {}
        d_logit = ((p - target) * weight)[:, None].astype(F32)
        g["out"], g["out_bias"] = mean.T @ d_logit, d_logit.sum(axis=0, keepdims=True)
        d_mean = d_logit @ self.p["out"].T
        d_states = a[:, :, None] * d_mean
        d_a = (states * d_mean).sum(axis=2)
        d_score = a * (d_a - (a * d_a).sum(axis=0))
        g["attention"] = np.einsum("tnh,tn->h", states, d_score)[:, None]
        d_states += d_score[:, :, None] * self.p["attention"][:, 0]
        d_x = np.zeros_like(x)
        for k, s in enumerate("fb"):
            d_gates, g[f"state_{s}"] = self.backward(
                traces[s], index, gates[s], d_states[:, :, k * HIDDEN : (k + 1) * HIDDEN], s
            )
            d_gates = d_gates[: len(used)]
            g[f"in_{s}"], g[f"bias_{s}"] = x.T @ d_gates, d_gates.sum(axis=0, keepdims=True)
            d_x += d_gates @ self.p[f"in_{s}"].T
        g["words"] = np.zeros_like(self.p["words"])
        np.add.at(g["words"], small.word_rows, d_x[:, :WORD_DIM])
        g["chars"] = np.zeros_like(self.p["chars"])
        share = d_x[:, WORD_DIM:] / np.maximum(sizes, 1)[:, None].astype(F32)
        np.add.at(g["chars"], small.gram_rows, np.repeat(share, sizes, axis=0))
        return g, float(loss)

    def backward(self, trace, index, gates, d_out, side) -> tuple[np.ndarray, np.ndarray]:
        """Back through time: gradients of the gate inputs (per word) and of the state weights."""
        u = self.p[f"state_{side}"]
        d_u, d_gates = np.zeros_like(u), np.zeros_like(gates)
        d_h = np.zeros(d_out.shape[1:], F32)
        h2 = 2 * HIDDEN
        for t, h, z, r, c in reversed(trace):
            d = d_h + d_out[t]
            d_c = d * (1 - z) * (1 - c * c)
            d_rh = d_c @ u[:, h2:].T
            d_zr = np.concatenate((d * (h - c) * z * (1 - z), d_rh * h * r * (1 - r)), axis=1)
            d_u[:, h2:] += (r * h).T @ d_c
            d_u[:, :h2] += h.T @ d_zr
            d_h = d * z + d_rh * r + d_zr @ u[:, :h2].T
            np.add.at(d_gates, index[t], np.concatenate((d_zr, d_c), axis=1))
        return d_gates, d_u


class Adam:
    """With weight decay."""

    def __init__(self, network: Network, rate: float, decay: float = 0.3) -> None:
        self.network, self.rate, self.decay, self.steps = network, rate, decay, 0
        self.m = {k: np.zeros_like(v) for k, v in network.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in network.p.items()}

    def step(self, g: dict[str, np.ndarray]) -> None:
        self.steps += 1
        norm = np.sqrt(sum(float((v**2).sum()) for v in g.values()))
        scale = F32(min(1.0, 5.0 / max(norm, 1e-9)))
        for k, v in g.items():
            v = v * scale
            self.m[k] += F32(0.1) * (v - self.m[k])
            self.v[k] += F32(0.001) * (v * v - self.v[k])
            rate = self.rate * np.sqrt(1 - 0.999**self.steps) / (1 - 0.9**self.steps)
            p = self.network.p[k]
            p -= F32(rate) * self.m[k] / (np.sqrt(self.v[k]) + F32(1e-8))
            p *= F32(1 - self.rate * self.decay)


class Model(NamedTuple):
    """``known``: hashes of the words that have a row of their own. ``network`` is None if there was nothing
    to learn from; every score is then ``share``."""

    known: np.ndarray
    network: Network | None
    share: float


def joined(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode("utf-8", "replace") for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate(
        ([0], np.cumsum([len(r) for r in raw]))
    ).astype(np.int64)


def evidence(words: Words, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How much each word's character n-grams speak for class 1: the greatest lower-bound log-odds among
    them, by the number of texts that hold each. Used only to find the window a label is about. Also the
    rows of the character table that are in too few texts to be learned."""
    seen = np.full((2, 1 << CHAR_BITS), 1.0)
    for i, label in enumerate(labels):
        some = np.unique(words.index[words.first[i] : words.first[i + 1]])
        parts = [words.gram_rows[words.gram_first[w] : words.gram_first[w + 1]] for w in some]
        if parts:
            seen[label][np.unique(np.concatenate(parts))] += 1
    totals = [max(1, int((labels == k).sum())) for k in (0, 1)]
    odds = np.log(seen[1] / totals[1]) - np.log(seen[0] / totals[0]) - 2.0 / np.sqrt(seen.sum(axis=0))
    out = np.zeros(len(words.word_rows))
    some = np.flatnonzero(np.diff(words.gram_first))
    if len(some):
        out[some] = np.maximum.reduceat(odds[words.gram_rows], words.gram_first[some])
    return out, np.flatnonzero(seen.sum(axis=0) - 2 < MIN_TEXTS)


def fit_texts(texts: Sequence[str], labels: np.ndarray, *, steps: int = 300, rate: float = 0.01, batch: int = 128) -> Model:
    """Train on labelled texts. A label belongs to a text, so of each toxic text the window with the most
    evidence is the example at first, and later the one the network itself scores highest; of each other
    text its highest window and a random one. Training makes ``steps`` steps, however few texts there are."""
    share = float(labels.mean()) if len(labels) else 0.0
    data, offsets = joined(texts)
    if share in (0.0, 1.0):
        return Model(np.zeros(0, np.uint64), None, share)
    low = LOWER[data]
    starts, ends, first = spans(low, offsets, IS_WORD)
    hashes, owner = span_hashes(low, starts, ends), text_of(first)
    # Words of the most texts get rows of the word table; row 0 is for all others.
    each = np.unique(np.stack([hashes, owner.astype(np.uint64)]), axis=1)[0]
    values, counts = np.unique(each, return_counts=True)
    values, counts = values[counts >= MIN_TEXTS], counts[counts >= MIN_TEXTS]
    known = np.sort(values[np.lexsort((values, -counts))][: (1 << WORD_BITS) - 1])
    words = read_words(data, offsets, known)
    begin, length, of = windows_of(words.first)
    if not len(begin):
        return Model(np.zeros(0, np.uint64), None, share)
    rng = np.random.default_rng(0)
    clue, rare = evidence(words, labels)
    clue = clue[words.index]
    index = np.minimum(begin[:, None] + np.arange(WINDOW), len(clue) - 1)
    scores = np.where(np.arange(WINDOW) < length[:, None], clue[index], -1e9).max(axis=1)
    network = Network()
    network.p["chars"][rare] = 0
    adam = Adam(network, rate)
    while adam.steps < steps:
        if adam.steps >= steps // 2:
            scores = network.logits(words, begin, length)
        noise = rng.random(len(begin))
        by_score, by_chance = np.lexsort((noise, -scores, of)), np.lexsort((noise, of))
        cuts = np.flatnonzero(np.concatenate(([True], of[by_score][1:] != of[by_score][:-1])))
        best, other = by_score[cuts], by_chance[cuts]
        examples = np.concatenate((best, other[labels[of[other]] == 0]))
        target = labels[of[examples]].astype(F32)
        weight = np.where(target == 1, 0.5 / max(1, (target == 1).sum()), 0.5 / max(1, (target == 0).sum()))
        weight *= len(examples) / batch
        order = rng.permutation(len(examples))
        for a in range(0, len(order), batch):
            some = examples[order[a : a + batch]]
            g, _ = network.gradients(
                words, begin[some], length[some], target[order[a : a + batch]],
                weight[order[a : a + batch]].astype(F32),
            )
            g["chars"][rare] = 0
            adam.step(g)
    return Model(known, network, share)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    held_out: Column,
    *,
    label: str = "toxic",
    per_class: int = 1200,
    max_chars: int = 12_000,
    key: str = "doc_id",
    text: str = "text",
) -> Model:
    """Train on at most ``per_class`` labelled texts of each class outside the held-out fold, none longer
    than ``max_chars`` (see ``labelled_sample``)."""
    sample = labelled_sample(
        docs, labels, label, per_class=per_class, max_chars=max_chars, held_out=held_out, key=key, text=text
    )
    rows = sample.select(F.xxhash64("key").alias("h"), "label", "text").toArrow()
    rows = rows.sort_by([("h", "ascending"), ("label", "ascending")])
    return fit_texts(rows.column("text").to_pylist(), rows.column("label").to_numpy())


def score_block(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Of each text the probability of its highest window; 0 for a text without words."""
    out = np.zeros(len(offsets) - 1)
    if model.network is None:
        return np.full(len(out), model.share)
    words = read_words(data, offsets, model.known)
    begin, length, owner = windows_of(words.first)
    if len(begin):
        np.maximum.at(out, owner, sigmoid(model.network.logits(words, begin, length)))
    return out


def classify(
    docs: DataFrame, model: Model, *, threshold: float = 0.3, keep: Sequence[str] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """Columns ``keep``, ``score`` (0 to 1) and ``predicted`` for every row, from all overlapping windows of
    its whole text. A null text or one without words scores 0."""

    def score(data, offsets):
        p = score_block(model, data, offsets)
        return p, (p >= threshold).astype(np.int32)

    return map_texts(
        docs, score, "score double, predicted int", keep=keep, text=text, block_bytes=SCORE_BYTES
    )
