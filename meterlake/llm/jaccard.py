"""Exact Jaccard join of documents on word shingles, with adaptive multi-match prefixes.

A set of n tokens can only be similar to sets that share t = ceil(n * threshold) of its tokens. In any fixed
order of tokens, two similar sets share l tokens within their first n - t + l, for every l. Each set chooses
its own l. Of a pair that needs an overlap of o, the set whose prefix ends first has all it shares there in
the other's prefix too, and t - l tokens after it; so both prefixes share at least o - (t - l) tokens.

1. Equal sets form a class; all further work is on classes.
2. With tokens in hash order, a class counts the tokens of its prefix that no other class has in its prefix.
   If too few are left, it has no partner. That needs only a fifth of all tokens and one partial aggregate,
   and it leaves the classes that have near copies, or are made of common passages.
3. Of the classes left, tokens are ordered by their frequency among them, rare ones first. Each class
   lengthens its prefix as long as that lowers its estimated cost: entries to be read plus expected
   verifications, of which there are at most entries / l.
4. Members of a posting list are verified against one member of it (its pivot), which unites large groups of
   near copies without their pairs. Then all candidates between different components are verified. Tokens
   that only one class has bound the similarity of each pair from above; what cannot link is no candidate.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle, settle_measured
from .text import LOWER, NOT_SPACE, map_texts, ngram_hashes, span_hashes, spans, text_of

BROADCAST_BYTES = 32 << 20
PIVOTS = 2
VERIFY_COST = 0.05  # of one token of a set, in posting entries


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """For each text its distinct hashed k-word shingles in hash order. A text of fewer words has its whole
    sequence as one; a text without words has none. A-Z count as a-z."""
    low = LOWER[data]
    starts, ends, first = spans(low, offsets, NOT_SPACE)
    words = span_hashes(low, starts, ends)
    hashes, at = ngram_hashes(words, text_of(first), k)
    cuts = np.searchsorted(at, first)
    out = []
    for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
        if a == b and first[i] < first[i + 1]:
            short = words[first[i] : first[i + 1]]
            out.append(ngram_hashes(short, np.zeros(len(short), np.int64), len(short))[0])
        else:
            out.append(np.unique(hashes[a:b]))
    return out


def digest(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def as_lists(arrays: list[np.ndarray]) -> pa.Array:
    at = np.concatenate(([0], np.cumsum([len(a) for a in arrays])))
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat.view(np.int64)))


class Threshold:
    """Jaccard similarity of at least num / den, in whole numbers; Columns of a set size."""

    def __init__(self, num: int, den: int) -> None:
        if not 0 < num <= den:
            raise ValueError("the threshold is over 0 and at most 1")
        self.num, self.den = num, den

    def needed(self, n):
        """t: tokens that a similar set shares."""
        return (n * self.num + self.den - 1) // self.den

    def needed_sql(self, n: str) -> str:
        return f"(({n} * {self.num} + {self.den - 1}) div {self.den})"

    def may_link(self, a: str, b: str) -> Column:
        """False for sets that cannot be similar, by ``n_x`` and by ``own_x``, the tokens that no other set
        has: these are in the union and not in the intersection."""
        n, own = (lambda x: F.col(f"n_{x}")), (lambda x: F.col(f"own_{x}"))
        shared = [n(x) - own(x) for x in (a, b)]
        whole = own(a) + own(b) + F.greatest(*shared)
        return F.least(*shared) * self.den >= whole * self.num

    def light(self, side: str = "") -> Column:
        """Whether a set has so few private tokens (``own`` of ``n``) that a set of as many may be similar.
        Similar sets have private tokens of at most den / num - 1 times the smaller rest in all, so at least
        one of the two is light."""
        n, own = F.col(f"n{side}"), F.col(f"own{side}")
        return own * (2 * self.num) <= (n - own) * (self.den - self.num)

    def prefix_overlap(self, a: str, b: str) -> Column:
        """Tokens that the chosen prefixes of two similar sets share at least."""
        both = F.expr(
            f"((n_{a} + n_{b}) * {self.num} + {self.num + self.den - 1}) div {self.num + self.den}"
        )
        after = [F.expr(f"{self.needed_sql(f'n_{x}')} - l_{x}") for x in (a, b)]
        return F.greatest(both - F.greatest(*after), F.lit(1))

    def similar(self, both: Column, a: str, b: str) -> Column:
        return both * self.den >= (F.col(a) + F.col(b) - both) * self.num


def matches(n):
    """l of the filter in hash order: a twentieth of the size."""
    return np.maximum(1, (n + 19) // 20)


def matches_sql(n: str) -> str:
    return f"greatest(1, ({n} + 19) div 20)"


def token_sets(docs: DataFrame, k: int, limit: Threshold, key: str, text: str) -> DataFrame:
    """For each row: key, ``digest`` of its set, ``c`` (the class as a number), ``n``, and the prefix of the
    filter. A row without words gets a digest of its own key."""

    def score(data, offsets):
        sets = shingle_sets(data, offsets, k)
        n = np.array([len(s) for s in sets], np.int64)
        digests = [digest(s) for s in sets]
        lengths = np.minimum(n, n - limit.needed(n) + matches(n))
        prefixes = [s[:m] for s, m in zip(sets, lengths.tolist(), strict=True)]
        c = [int.from_bytes(d[:8], "little", signed=True) for d in digests]
        return digests, c, n, as_lists(prefixes)

    made = map_texts(
        docs.select(F.col(key).alias("key"), F.col(text).alias("text")),
        score,
        "digest binary, c bigint, n bigint, prefix array<bigint>",
        keep=["key"],
    )
    own = F.concat(F.lit("without words: "), F.coalesce(F.col("key").cast("string"), F.lit(""))).cast("binary")
    empty = F.col("n") == 0
    return made.withColumn("digest", F.when(empty, own).otherwise(F.col("digest"))).withColumn(
        "c", F.when(empty, F.xxhash64("digest")).otherwise(F.col("c"))
    )


def with_partners(sets: DataFrame, classes: DataFrame, limit: Threshold) -> DataFrame:
    """Classes whose prefix in hash order shares enough tokens with other classes."""
    tokens = sets.where("n > 0").select("c", F.explode("prefix").alias("token"))
    private = (
        tokens.groupBy("token")
        .agg(F.min("c").alias("c"), F.max("c").alias("other"))
        .where("c = other")
        .groupBy("c")
        .agg(F.count("*").alias("private"))
    )
    t = limit.needed_sql("n")
    length = f"least(n, n - {t} + {matches_sql('n')})"
    return (
        classes.where("n > 0")
        .join(private, "c", "left")
        .where(F.expr(f"{length} - coalesce(private, 0) >= {matches_sql(t)}"))
        .select("c", "rep", "n")
    )


def full_sets(docs: DataFrame, chosen: DataFrame, k: int, key: str, text: str) -> DataFrame:
    """The whole token set of each chosen class, from the text of its representative."""
    stored, size = settle_measured(chosen, "classes-with-partners")
    if size <= BROADCAST_BYTES:
        stored = F.broadcast(stored)
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    found = texts.join(stored, F.col("key").eqNullSafe(F.col("rep")))

    def score(data, offsets):
        sets = shingle_sets(data, offsets, k)
        c = [int.from_bytes(digest(s)[:8], "little", signed=True) for s in sets]
        return c, as_lists(sets)

    made = map_texts(found, score, "own bigint, tokens array<bigint>", keep=["c", "n"])
    # Rows with the key of a representative but another text are not it; repeated rows count once.
    return made.where("own = c").select("c", "n", "tokens").dropDuplicates(["c"])


def postings(sets: DataFrame, limit: Threshold) -> DataFrame:
    """Tokens in each class's adaptive prefix that another class has too: ``token, c, n``, ``l``, the
    class's choice, ``own``, how many of its tokens no other class has, and ``common``, the mean frequency of
    its tokens."""
    rows = sets.select("c", "n", F.explode("tokens").alias("token"))
    frequency = rows.groupBy("token").agg(F.count("*").alias("df"))
    order = Window.partitionBy("c").orderBy("df", "token")
    t = limit.needed_sql("n")
    level = F.col("place") - F.expr(f"n - {t}")
    cost = F.col("entries") * (1 + VERIFY_COST * F.col("n") / F.col("level"))
    placed = (
        rows.join(frequency, "token")
        .withColumn("place", F.row_number().over(order))
        .withColumn(
            "entries", F.sum(F.col("df") - 1).over(order.rowsBetween(Window.unboundedPreceding, 0))
        )
        .withColumn("level", F.greatest(level, F.lit(1)))
    )
    whole = F.when((level >= 1) & (level <= F.expr(t)), F.struct(cost.alias("cost"), level.alias("l")))
    of_class = Window.partitionBy("c")
    chosen = (
        placed.withColumn("l", F.min(whole).over(of_class).getField("l"))
        .withColumn("common", F.avg("df").over(of_class))
        .withColumn("own", F.sum((F.col("df") == 1).cast("int")).over(of_class))
    )
    return chosen.where(F.expr(f"place <= n - {t} + l AND df > 1")).select(
        "token", "c", "n", "l", "own", "common"
    )


def verified(pairs: DataFrame, sets: DataFrame, limit: Threshold) -> DataFrame:
    """The pairs (a, b) that are similar, by their whole sets."""
    side = lambda x: sets.select(
        F.col("c").alias(x), F.col("n").alias(f"n_{x}"), F.col("tokens").alias(f"tokens_{x}")
    )
    both = F.size(F.array_intersect("tokens_a", "tokens_b"))
    return (
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .where(limit.similar(both, "n_a", "n_b"))
        .select("a", "b")
    )


def pivot_pairs(entries: DataFrame, limit: Threshold) -> DataFrame:
    """Each class with the pivots it shares most tokens with. A posting list's pivot is the member whose
    tokens are the most common: of a text and its variants it is the text, which is nearer to each of them
    than they are to one another."""
    pivots = entries.groupBy("token").agg(
        F.max(
            F.struct("common", F.col("c").alias("b"), F.col("n").alias("n_b"), F.col("own").alias("own_b"))
        ).alias("p")
    )
    shared = (
        entries.join(pivots, "token")
        .select(F.col("c").alias("a"), F.col("n").alias("n_a"), F.col("own").alias("own_a"), "p.*")
        .where((F.col("a") != F.col("b")) & limit.may_link("a", "b"))
        .groupBy("a", "b")
        .agg(F.count("*").alias("shared"))
    )
    best = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("shared"), "b"))
    return shared.withColumn("nth", best).where(F.col("nth") <= PIVOTS).select("a", "b")


def meeting(entries: DataFrame, limit: Threshold) -> DataFrame:
    """Pairs of entries of one list of which the first is light (``Threshold.light``): ``token`` and the
    columns of each under ``_a`` and ``_b``. Two light ones meet once, in the order of their classes."""
    columns = [c for c in entries.columns if c != "token"]
    side = lambda x, rows: rows.select("token", *[F.col(c).alias(f"{c}_{x}") for c in columns])
    light = side("a", entries.where(limit.light()))
    every = side("b", entries).withColumn("light_b", limit.light("_b"))
    once = ~F.col("light_b") | (F.col("c_a") < F.col("c_b"))
    return light.join(every, "token").where(once).drop("light_b")


def candidate_pairs(entries: DataFrame, limit: Threshold, united: DataFrame | None = None) -> DataFrame:
    """Pairs whose prefixes share as many tokens as similar sets must. With ``united`` (``c``,
    ``component``), only pairs of different components: lists that lie within one are dropped first.

    An entry carries its class's prefix, so the join counts the shared tokens itself and gives a pair once,
    at the smallest of them.

    Of two classes that meet, one has few private tokens (``meeting``). So pages that share a template, but
    each have too much of their own to be similar, do not meet in pairs.
    """
    if united is not None:
        entries = entries.join(united, "c", "left").withColumn("component", F.coalesce("component", "c"))
        mixed = (
            entries.groupBy("token")
            .agg(F.min("component").alias("low"), F.max("component").alias("high"))
            .where("low <> high")
        )
        entries = entries.join(mixed.select("token"), "token", "left_semi")
    else:
        entries = entries.withColumn("component", F.col("c"))
    prefixes = entries.groupBy("c").agg(F.collect_list("token").alias("prefix"))
    entries = entries.join(prefixes, "c").select("token", "c", "n", "l", "own", "component", "prefix")
    shared = F.array_intersect("prefix_a", "prefix_b")
    return (
        meeting(entries, limit)
        .where(F.col("component_a") != F.col("component_b"))
        .where(limit.may_link("a", "b"))
        .where(F.size(shared) >= limit.prefix_overlap("a", "b"))
        .where(F.array_min(shared) == F.col("token"))
        .select(F.least("c_a", "c_b").alias("a"), F.greatest("c_a", "c_b").alias("b"))
    )


def components(edges: DataFrame) -> DataFrame:
    """``c`` and ``component``, the smallest number reachable, for every node of the edges (a, b).

    Labels and edges stay distributed. In each round a node takes the smallest label among its own, its
    neighbours' and its label's label, which halves the way to go.
    """
    both = settle(
        edges.union(edges.select("b", "a")).toDF("a", "b").distinct(), "edges"
    )
    labels = settle(
        both.groupBy("a").agg(F.min("b").alias("low")).select(
            F.col("a").alias("c"), F.least("a", "low").alias("component"), F.lit(True).alias("moved")
        ),
        "labels",
    )
    while not labels.where("moved").isEmpty():
        near = (
            both.join(labels.select(F.col("c").alias("b"), F.col("component").alias("low")), "b")
            .groupBy(F.col("a").alias("c"))
            .agg(F.min("low").alias("low"))
        )
        next_ = labels.select(F.col("c").alias("component"), F.col("component").alias("far"))
        new = F.least("component", "low", "far")
        labels = settle(
            labels.select("c", "component")
            .join(near, "c")
            .join(next_, "component")
            .select("c", new.alias("component"), (new != F.col("component")).alias("moved")),
            "labels",
        )
    return labels.select("c", "component")


def similar_pairs(
    docs: DataFrame, *, k: int = 5, num: int = 4, den: int = 5, key: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """All links between classes of equal sets, as pairs (a, b) of classes, and the members: key, class
    ``c``, set size ``n``. Their number is quadratic in a group of near copies; ``join`` avoids that."""
    limit = Threshold(num, den)
    members = settle(token_sets(docs, k, limit, key, text), "token-sets")
    sets = settle(full_sets(docs, with_partners(members, _classes(members), limit), k, key, text), "sets")
    pairs = candidate_pairs(settle(postings(sets, limit), "postings"), limit)
    return verified(pairs, sets, limit), members.select(F.col("key").alias(key), "c", "n")


def _classes(members: DataFrame) -> DataFrame:
    return members.groupBy("digest").agg(
        F.min("key").alias("rep"), F.min("c").alias("c"), F.min("n").alias("n")
    )


def join(
    docs: DataFrame, *, k: int = 5, num: int = 4, den: int = 5, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """For every row: key, ``n_shingles``, and ``component_id``, the smallest key of all documents that are
    reachable by links. Documents link when the Jaccard similarity of their shingle sets is at least
    num / den.

    Documents without words (null text included) link with nothing but rows of the same key. Repeated rows
    get equal results. Rows with a null key take part; a component of nothing else has a null id. Other
    columns are ignored. Sets are compared as 64-bit hashes of their shingles.
    """
    limit = Threshold(num, den)
    members = settle(token_sets(docs, k, limit, key, text), "token-sets")
    classes = settle(_classes(members), "classes")
    sets = settle(full_sets(docs, with_partners(members, classes, limit), k, key, text), "sets")
    entries = settle(postings(sets, limit), "postings")
    near = components(verified(pivot_pairs(entries, limit), sets, limit))
    more = verified(candidate_pairs(entries, limit, near), sets, limit)
    # Links between components unite them.
    named = lambda x: near.select(F.col("c").alias(x), F.col("component").alias(f"of_{x}"))
    across = (
        more.join(named("a"), "a", "left")
        .join(named("b"), "b", "left")
        .select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    )
    wide = components(across).select(F.col("c").alias("part"), F.col("component").alias("whole"))
    linked = (
        near.select("c", F.col("component").alias("part"))
        .unionByName(wide.select(F.col("part").alias("c"), "part"))
        .distinct()
        .join(wide, "part", "left")
        .select("c", F.coalesce("whole", "part").alias("component"))
    )
    united = classes.join(linked, "c", "left").withColumn("component", F.coalesce("component", "c"))
    smallest = united.groupBy("component").agg(F.min("rep").alias("component_id"))
    named_classes = united.select("digest", "component").join(smallest, "component").drop("component")
    return (
        members.select(F.col("key").alias(key), "digest", F.col("n").alias("n_shingles"))
        .join(named_classes, "digest")
        .drop("digest")
    )
