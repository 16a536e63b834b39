"""URL filters: rules of hosts and paths, and boosted trees on lexical features for URLs that no rule fits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..operators.lookup import lookup_join
from ..session import settle, settle_measured
from .text import hash_sample, sums_by_text, text_blocks, text_of

ALLOW, BLOCK = "allow", "block"


# Rules ------------------------------------------------------------------------------------------------
class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to a slash, question mark, hash or the end, A-Z in lower case. Path:
    from there up to a question mark, hash or the end. Both are empty for a null URL or one without ``://``."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def fitting_rule(rules: Sequence[Rule], host: str = "host", path: str = "path") -> Column:
    """The name of the longest rule that fits, or null. A rule fits its host and all subdomains of it, where
    the path starts with the rule's. Of rules of one length the first by name counts."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (-len(r.name), r.name), reverse=True):
        same = (F.col(host) == rule.host) | F.col(host).endswith(f".{rule.host}")
        found = F.when(same & F.col(path).startswith(rule.path), rule.name).otherwise(found)
    return found


def verdict_of(rules: Sequence[Rule], name: Column) -> Column:
    blocked = [name == r.name for r in rules if r.verdict == BLOCK]
    return F.when(name.isNull(), None).when(reduce(or_, blocked, F.lit(False)), BLOCK).otherwise(ALLOW)


# Trees ------------------------------------------------------------------------------------------------
class Trees(NamedTuple):
    """Complete binary trees of one depth. ``feature`` and ``cut`` per tree and inner node (a value above the
    cut goes right), ``leaf`` per tree and leaf; ``base`` is the log-odds before any tree."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    base: float


def probability(trees: Trees, x: np.ndarray) -> np.ndarray:
    odds = np.full(len(x), trees.base)
    inner = trees.feature.shape[1] if trees.feature.size else 0
    rows = np.arange(len(x))
    for feature, cut, leaf in zip(trees.feature, trees.cut, trees.leaf, strict=True):
        node = np.zeros(len(x), np.int64)
        while inner and node[:1].size and node[0] < inner:  # all rows are at one depth
            node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
        odds += leaf[node - inner]
    return 1 / (1 + np.exp(-np.clip(odds, -35, 35)))


def boost(
    x: np.ndarray,
    y: np.ndarray,
    *,
    rounds: int = 60,
    depth: int = 4,
    rate: float = 0.2,
    bins: int = 64,
    ridge: float = 1.0,
    least: float = 5.0,
) -> Trees:
    """Gradient boosting of the logistic loss. Cuts are quantiles of each feature; each level of a tree picks
    for each node the cut that gains most by gradients and curvatures, summed up per bin. A node without a
    cut of positive gain, or with less curvature than ``least`` on a side, keeps its rows together. Ties go to
    the first feature and the lowest cut."""
    share = (y.sum() + 1) / (len(y) + 2)
    base, inner = float(np.log(share / (1 - share))), 2**depth - 1
    if len(y) == 0 or y.min() == y.max():
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), base)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in x.T]
    # Bin b holds the values above edge b - 1, up to edge b; a cut at edge b sends bins above b right.
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)], axis=1)
    width = bins + 1
    odds = np.full(len(y), base)
    features, cuts, leaves = [], [], []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-odds))
        gradient, curve = y - p, p * (1 - p)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            at = node - first
            best = np.full(count, 1e-9)
            sums = lambda w, key, n: np.bincount(key, weights=w, minlength=n)
            whole_g, whole_c = sums(gradient, at, count), sums(curve, at, count)
            before = whole_g**2 / (whole_c + ridge)
            for f, edge in enumerate(edges):
                key = at * width + binned[:, f]
                left_g = np.cumsum(sums(gradient, key, count * width).reshape(count, width), axis=1)[:, : len(edge)]
                left_c = np.cumsum(sums(curve, key, count * width).reshape(count, width), axis=1)[:, : len(edge)]
                right_g, right_c = whole_g[:, None] - left_g, whole_c[:, None] - left_c
                gain = left_g**2 / (left_c + ridge) + right_g**2 / (right_c + ridge) - before[:, None]
                gain[(left_c < least) | (right_c < least)] = 0
                top = gain.argmax(axis=1)
                won = gain[np.arange(count), top] > best + 1e-12
                best = np.where(won, gain[np.arange(count), top], best)
                feature[first : first + count][won] = f
                cut[first : first + count][won] = edge[top[won]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > cut[node])
        at = node - inner
        leaf = rate * np.bincount(at, weights=gradient, minlength=inner + 1)
        leaf /= np.bincount(at, weights=curve, minlength=inner + 1) + ridge
        odds += leaf[at]
        features.append(feature)
        cuts.append(cut)
        leaves.append(leaf)
    return Trees(np.array(features), np.array(cuts), np.array(leaves), base)


# Features ---------------------------------------------------------------------------------------------
# Parts of a URL of which it is counted how many there are and which share the rules block.
PARTS = ("suffix", "domain", "head")
SMOOTHING = 20.0
LEXICAL = ("length", "host_length", "labels", "path_length", "depth", "digit_ratio", "entropy", "params", "hyphens")


def _parts() -> dict[str, Column]:
    """The last label of the host, its last two, and the first segment of the path."""
    return {
        "suffix": F.substring_index("host", ".", -1),
        "domain": F.substring_index("host", ".", -2),
        "head": F.substring_index(F.ltrim("path", F.lit("/")), "/", 1),
    }


def part_statistics(parsed: DataFrame) -> DataFrame:
    """(kind, value, n, share) over all URLs: how many have the part, and which share of those that a rule
    judges is blocked, drawn to the overall share where there are few. Counts add up before they are
    shuffled, so a common suffix does not gather in one task."""
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("value")) for k, v in _parts().items()])
    blocked = F.count(F.when(F.col("ruled") == BLOCK, 1))
    counted = (
        parsed.select(F.explode(pairs).alias("p"), "ruled")
        .groupBy("p.kind", "p.value")
        .agg(F.count("*").alias("n"), F.count("ruled").alias("judged"), blocked.alias("blocked"))
    )
    stored = settle(counted, "url-parts")
    # Each URL has one part of each kind, so one kind gives the overall share.
    overall = (
        stored.where(F.col("kind") == "suffix")
        .agg(((F.sum("blocked") + 1) / (F.sum("judged") + 2)).alias("prior"))
        .select(F.coalesce("prior", F.lit(0.5)).alias("prior"))
        .first()["prior"]
    )
    share = (F.col("blocked") + SMOOTHING * F.lit(float(overall))) / (F.col("judged") + SMOOTHING)
    return stored.select("kind", "value", "n", share.alias("share"))


def lexical(data: np.ndarray, offsets: np.ndarray, hosts: pa.Array, paths: pa.Array) -> np.ndarray:
    """One row a URL, columns LEXICAL: lengths in bytes, labels of the host, segments of the path, share of
    digits, entropy of the bytes in bits, parameters after the question mark, and hyphens."""
    texts = len(offsets) - 1
    owner, length = text_of(offsets), np.diff(offsets).astype(float)
    seen = np.bincount(owner * 256 + data, minlength=texts * 256).reshape(texts, 256)
    p = seen / np.maximum(length, 1)[:, None]
    entropy = -(p * np.log2(np.where(p > 0, p, 1))).sum(axis=1)
    digits = seen[:, ord("0") : ord("9") + 1].sum(axis=1)
    # Parameters: one for the first question mark, one for each ampersand behind it.
    marks = np.flatnonzero(data == ord("?"))
    first = np.full(texts, len(data))
    np.minimum.at(first, owner[marks], marks)
    ands = np.flatnonzero(data == ord("&"))
    params = (first < len(data)) + sums_by_text((ands > first[owner[ands]]).astype(float), owner[ands], texts)
    hosts, paths = hosts.to_pylist(), paths.to_pylist()
    depth = [sum(map(bool, path.split("/"))) for path in paths]
    sizes = [len(h.encode()) for h in hosts], [h.count(".") + bool(h) for h in hosts], [len(p.encode()) for p in paths]
    return np.stack(
        [length, *map(np.asarray, sizes), np.asarray(depth), digits / np.maximum(length, 1), entropy, params, seen[:, ord("-")]],
        axis=1,
    ).astype(float)


def _known(parsed: DataFrame, statistics: dict[str, DataFrame], spread_by: Sequence[str]) -> DataFrame:
    """Add the logarithm of the count and the blocked share of each part."""
    out = parsed
    for kind, value in _parts().items():
        out = out.withColumn(f"_{kind}", value)
        out = lookup_join(out, statistics[kind], [f"_{kind}"], spread_by=spread_by).drop(f"_{kind}")
    return out


def _numbers() -> list[str]:
    return [f"_{kind}_{what}" for kind in PARTS for what in ("n", "share")]


def _matrix(rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    words = lexical(data, offsets, rows.column("host"), rows.column("path"))
    counted = [rows.column(c).to_numpy(zero_copy_only=False) for c in _numbers()]
    return np.column_stack([words, *counted])


class Model(NamedTuple):
    trees: Trees
    statistics: dict


def parse(pages: DataFrame, rules: Sequence[Rule], *, key: str = "page_id", url: str = "url") -> DataFrame:
    """key, url (null: empty), host, path, rule and ``ruled``, the rule's verdict. Other columns stay behind."""
    host, path = host_and_path(F.col(url))
    cut = pages.select(F.col(key).alias("key"), F.coalesce(url, F.lit("")).alias("url"), host.alias("host"), path.alias("path"))
    ruled = cut.withColumn("rule", fitting_rule(rules))
    return ruled.withColumn("ruled", verdict_of(rules, F.col("rule")))


def fit(parsed: DataFrame, *, per_class: int = 10_000, max_bytes: int = 4096, **boosting) -> Model:
    """Statistics of parts over all URLs, and trees fitted on the distinct URLs that a rule judges: at most
    ``per_class`` of each verdict, those with the least hashes, no longer than ``max_bytes``. Their features
    are made in the tasks; only those numbers come to the driver. Without URLs of both verdicts the trees say
    the same for all: the verdict seen, or allow."""
    counted = part_statistics(parsed)
    statistics = {}
    for kind in PARTS:
        of = counted.where(F.col("kind") == kind).select(
            F.col("value").alias(f"_{kind}"),
            F.log1p("n").alias(f"_{kind}_n"),
            F.col("share").alias(f"_{kind}_share"),
        )
        statistics[kind] = settle_measured(of, f"url-{kind}")
    judged = parsed.where(F.col("ruled").isNotNull() & (F.octet_length("url") <= max_bytes))
    distinct = judged.select("url", "host", "path", "ruled").distinct()
    sample = hash_sample(distinct, "ruled", ["url"], per_class)
    known = _known(sample, statistics, ["url"])

    def features(batches):
        for batch in batches:
            for rows, data, offsets in text_blocks(batch, "url"):
                x = _matrix(rows, data, offsets)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([rows.column("url"), rows.column("ruled"), lists], names=["url", "ruled", "x"])

    made = known.mapInArrow(features, "url string, ruled string, x array<double>").toArrow().sort_by("url")
    x = np.array(made.column("x").to_pylist(), float).reshape(made.num_rows, len(LEXICAL) + len(_numbers()))
    y = np.array([v == BLOCK for v in made.column("ruled").to_pylist()], float)
    return Model(boost(x, y, **boosting), statistics)


def judge(
    parsed: DataFrame, rules: Sequence[Rule], model: Model, *, threshold: float = 0.5, keep: Sequence[str] = ("key",)
) -> DataFrame:
    """Columns ``keep``, host, path, rule, verdict (the rule's, else the trees') and score (the trees'
    probability of block) for every URL. An empty URL is judged by the features of an empty text."""
    known = _known(parsed, model.statistics, ["url", *keep])
    out = [*dict.fromkeys([*keep, "host", "path", "rule"])]
    schema = T.StructType(
        [known.schema[c] for c in out] + T.StructType.fromDDL("verdict string, score double").fields
    )
    arrow, trees = to_arrow_schema(schema), model.trees

    def run(batches):
        for batch in batches:
            for rows, data, offsets in text_blocks(batch, "url"):
                score = probability(trees, _matrix(rows, data, offsets))
                ruled = rows.column("ruled").to_pylist()
                verdict = [r or (BLOCK if s >= threshold else ALLOW) for r, s in zip(ruled, score, strict=True)]
                columns = [rows.column(c) for c in out] + [pa.array(verdict, pa.string()), pa.array(score)]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return known.select(*dict.fromkeys([*out, "url", "ruled", *_numbers()])).mapInArrow(run, schema)
