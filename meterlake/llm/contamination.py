"""Benchmark decontamination with a positional inverted index, in DataFrame operations only.

A window is 13 consecutive words of a test item, or the whole item if it is shorter. The index holds the
postings (term, document, position) of every word of the corpus that some test item has. A window occurs where
the posting lists of its terms meet at their offsets in it. Lists are intersected from the rarest term: its
postings say where a window would lie, those of the next rarest leave few of these places, and only there the
other lists are asked. Texts are read once, to make the index; all else reads postings.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lookup import measure
from ..session import settle

WINDOW = 13
BROADCAST_BYTES = 16 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Fixed value: everything in ASCII that is no letter and no digit.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def raw_words(text: Column) -> Column:
    """Words as they are written; an empty string stands before or after a separator at either end."""
    return F.split(F.coalesce(text, F.lit("")), SEPARATORS, -1)


def folded(word: Column) -> Column:
    """A-Z as a-z, and nothing else. In a word of ASCII alone (as many bytes as characters) ``lower`` does the
    same and is much faster; elsewhere it would depend on the letters around, and change others too."""
    ascii_alone = F.octet_length(word) == F.char_length(word)
    return F.when(ascii_alone, F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def n_words(words: str) -> Column:
    """Number of words in what ``raw_words`` gives."""
    size = F.size(words)
    ends = (F.element_at(words, 1) == "").cast("int") + (F.element_at(words, -1) == "").cast("int")
    return F.when((size == 1) & (F.element_at(words, 1) == ""), F.lit(0)).otherwise(size - ends)


def bounded(df: DataFrame) -> DataFrame:
    """With a broadcast hint if it is small by measure; otherwise Spark shuffles."""
    return F.broadcast(df) if measure(df).bytes <= BROADCAST_BYTES else df


def item_words(items: DataFrame, item: str, text: str) -> DataFrame:
    """Distinct items with at least one word: ``item`` and its lower-cased ``words``."""
    words = F.filter(F.transform(raw_words(F.col(text)), folded), lambda w: w != "")
    return items.select(F.col(item).alias("item"), words.alias("words")).where("size(words) > 0").distinct()


def index(docs: DataFrame, terms: DataFrame, keys: list[Column], text: str) -> DataFrame:
    """Postings of the terms (``word`` and its number ``term``): the keys of the document, ``term``, and
    ``at``, the place of the word in its document. Words are folded one by one, as those of items are."""
    cut = docs.select(*keys, raw_words(F.col(text)).alias("words"))
    names = cut.drop("words").columns
    # An empty string stands before a separator at the beginning; it is no word.
    lead = (F.element_at("words", 1) == "").cast("int")
    placed = cut.select(*names, lead.alias("lead"), F.posexplode("words").alias("at", "word"))
    words = placed.select(*names, (F.col("at") - F.col("lead")).alias("at"), folded(F.col("word")).alias("word"))
    return words.join(bounded(terms), "word").select(*names, "term", "at")


def term_counts(terms: DataFrame, postings: DataFrame) -> DataFrame:
    """``term, word, n``: the length of each term's posting list, 0 included."""
    counted = postings.groupBy("term").agg(F.count("*").alias("n"))
    return terms.join(counted, "term", "left").select("term", "word", F.coalesce("n", F.lit(0)).alias("n"))


def placed_terms(tests: DataFrame, counts: DataFrame) -> DataFrame:
    """Each place of each test: ``test, size, q, term, word, n``."""
    placed = tests.select("test", F.size("words").alias("size"), F.posexplode("words").alias("q", "word"))
    return placed.join(counts, "word").select("test", "size", "q", "term", "word", "n")


def windows_of(placed: DataFrame, window: int = WINDOW) -> DataFrame:
    """The windows of each test that have a term of the corpus: ``test``, first place ``s``, ``need`` (their
    words), ``exact`` (the corpus has all of their terms, so they may occur), and place and number of their
    rarest term (``q1, term1``) and the next (``q2, term2``; the same in a window of one such term)."""
    need = F.least("size", F.lit(window))
    ahead = Window.partitionBy("test").orderBy("q").rowsBetween(0, window - 1)
    ranked = F.array_sort(F.filter(F.col("terms"), lambda t: t["n"] > 0))
    return (
        placed.withColumn("terms", F.collect_list(F.struct("n", "word", "q", "term")).over(ahead))
        .withColumn("least", F.min("n").over(ahead))
        .where(F.col("q") + need <= F.col("size"))
        .select("test", F.col("q").alias("s"), need.alias("need"), (F.col("least") > 0).alias("exact"), ranked.alias("r"))
        .where(F.size("r") > 0)
        .withColumn("next", F.get("r", F.least(F.size("r") - 1, F.lit(1))))
        .select(
            "test",
            "s",
            "need",
            "exact",
            F.col("r")[0]["q"].alias("q1"),
            F.col("r")[0]["term"].alias("term1"),
            F.col("next.q").alias("q2"),
            F.col("next.term").alias("term2"),
        )
    )


def _same(a: DataFrame, b: DataFrame, names: list[str], *also: str) -> Column:
    on = [a[c].eqNullSafe(b[c]) for c in names] + [a[c] == b[c] for c in also]
    return reduce(and_, on)


def matches(postings: DataFrame, placed: DataFrame, windows: DataFrame, names: list[str]) -> DataFrame:
    """Exact phrase matches: the document's keys, ``test``, and the ``first`` and ``last`` place in the
    document of a run of words that windows of the test cover.

    ``off`` is where the test would begin in the document, so a term at place q of the test is at off + q.
    """
    may = windows.where("exact")
    rarest = may.select("test", "q1", F.col("term1").alias("term")).distinct()
    begun = postings.join(bounded(rarest), "term").select(
        *names, "test", "q1", (F.col("at") - F.col("q1")).alias("off")
    )
    # The next rarest, at its place: its list alone is read.
    pairs = may.select("test", "q1", "q2", F.col("term2").alias("term")).distinct()
    seconds = postings.join(bounded(pairs.select("term").distinct()), "term", "left_semi")
    asked = begun.join(bounded(pairs), ["test", "q1"]).withColumn("at", F.col("off") + F.col("q2"))
    left = settle(
        asked.join(seconds, _same(asked, seconds, names, "term", "at"), "left_semi")
        .select(*names, "test", "off", "q1", "q2")
        .distinct(),
        "phrase-candidates",
    )
    # All other terms of the windows that are left, at their places.
    places = (
        left.join(bounded(may), ["test", "q1", "q2"])
        .select(*names, "test", "off", F.explode(F.expr("sequence(s, s + need - 1)")).alias("q"))
        .distinct()
    )
    expected = places.join(bounded(placed.select("test", "q", "term")), ["test", "q"]).withColumn("at", F.col("off") + F.col("q"))
    held = bounded(left.select(*names).distinct())
    there = postings.join(held, _same(postings, held, names), "left_semi")
    found = expected.join(there, _same(expected, there, names, "term", "at"), "left_semi")
    # Places that follow one another without a gap form a run.
    of_test = Window.partitionBy(*names, "test", "off").orderBy("q")
    needed = bounded(may.select("test", "need").distinct())
    return (
        found.withColumn("run", F.col("q") - F.row_number().over(of_test))
        .groupBy(*names, "test", "off", "run")
        .agg(F.min("at").alias("first"), F.max("at").alias("last"))
        .join(needed, "test")
        .where(F.col("last") - F.col("first") + 1 >= F.col("need"))
        .select(*names, "test", "first", "last")
    )


def near_matches(postings: DataFrame, windows: DataFrame, names: list[str], span: int = WINDOW) -> DataFrame:
    """Proximity matches: documents that have at least two of a test's rarest terms about as far apart as the
    test has them, in any order: the keys, ``test`` and the number of places (``anchors``) found. Where the
    test would begin by each of them must lie in one or in neighbouring stretches of ``span`` words."""
    anchored = windows.select("test", "q1", F.col("term1").alias("term")).distinct()
    # Tests with one anchor cannot have two, and their anchor may be a frequent word.
    several = anchored.groupBy("test").agg(F.count("*").alias("n")).where("n >= 2").select("test")
    hits = postings.join(bounded(anchored.join(several, "test", "left_semi")), "term")
    cell = F.floor((F.col("at") - F.col("q1")) / span)
    # An offset counts for its own stretch of the document and the next, so neighbours meet in one.
    return (
        hits.select(*names, "test", "q1", F.explode(F.array(cell, cell + 1)).alias("cell"))
        .groupBy(*names, "test", "cell")
        .agg(F.countDistinct("q1").alias("anchors"))
        .where("anchors >= 2")
        .groupBy(*names, "test")
        .agg(F.max("anchors").alias("anchors"))
    )


def search(
    docs: DataFrame,
    items: DataFrame,
    *,
    window: int = WINDOW,
    key: str = "doc_id",
    item: str = "item_id",
    text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Exact and proximity matches of test items in documents: documents are named by ``_key`` and
    ``_text_hash``, so rows that repeat a key with another text are apart, and equal rows have equal
    matches. Both results have ``item``."""
    numbered = item_words(items, item, text).withColumn("test", F.monotonically_increasing_id())
    tests = settle(numbered, "test-items")
    names = ["_key", "_text_hash"]
    keys = [F.col(key).alias("_key"), F.xxhash64(text).alias("_text_hash")]
    words = tests.select(F.explode("words").alias("word")).distinct()
    terms = settle(words.withColumn("term", F.monotonically_increasing_id()), "test-terms")
    postings = settle(index(docs, terms, keys, text), "positional-index")
    placed = settle(placed_terms(tests, term_counts(terms, postings)), "test-places")
    windows = settle(windows_of(placed, window), "test-windows")
    named = bounded(tests.select("test", "item"))
    return (
        matches(postings, placed, windows, names).join(named, "test").drop("test"),
        near_matches(postings, windows, names, window).join(named, "test").drop("test"),
    )


def report(
    docs: DataFrame,
    items: DataFrame,
    *,
    window: int = WINDOW,
    share_of: int = 20,
    key: str = "doc_id",
    item: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """For every document: its key, ``n_words``, ``n_hit`` (words inside a window's occurrence), ``n_items``
    and ``items_sha256`` (items with an occurring window, as sorted text, joined by commas),
    ``contaminated`` (some word hit, and at least one word in ``share_of``), and ``n_near`` (items with a
    proximity match).

    Words are runs of letters, digits and non-ASCII characters; A-Z count as a-z. Null or empty texts have
    no words and no hits; null or empty items have no window. Repeated rows get equal results; other columns
    are ignored. No items: nothing is hit.
    """
    exact, near = search(docs, items, window=window, key=key, item=item, text=text)
    names = ["_key", "_text_hash"]
    found = settle(exact.distinct(), "phrase-matches")
    hit = (
        found.select(*names, F.explode(F.sequence("first", "last")).alias("at"))
        .distinct()
        .groupBy(*names)
        .agg(F.count("*").alias("n_hit"))
    )
    # At most as many names as the benchmark has items.
    which = (
        found.select(*names, F.col("item").cast("string").alias("item"))
        .distinct()
        .groupBy(*names)
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
    )
    close = near.select(*names, "item").distinct().groupBy(*names).agg(F.count("*").alias("n_near"))
    totals = docs.select(
        F.col(key).alias("_key"), F.xxhash64(text).alias("_text_hash"), raw_words(F.col(text)).alias("words")
    ).select(*names, n_words("words").cast("bigint").alias("n_words"))
    same = lambda a, b: a["_key"].eqNullSafe(b["_key"]) & (a["_text_hash"] == b["_text_hash"])
    marks = which.join(hit, same(which, hit)).select(which["_key"], which["_text_hash"], "n_hit", "items")
    marks = marks.join(close, same(marks, close), "full").select(
        F.coalesce(marks["_key"], close["_key"]).alias("_key"),
        F.coalesce(marks["_text_hash"], close["_text_hash"]).alias("_text_hash"),
        "n_hit",
        "items",
        "n_near",
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    joined = totals.join(marks, same(totals, marks), "left").select(
        totals["_key"].alias(key),
        "n_words",
        zero("n_hit").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("_items"),
        zero("n_near").alias("n_near"),
    )
    return joined.select(
        key,
        "n_words",
        "n_hit",
        F.size("_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("_items", ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * share_of >= F.col("n_words"))).alias("contaminated"),
        "n_near",
    )
