"""Line dedup by site-relative frequency: lines on too large a share of a host's pages are boilerplate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle

# Boilerplate lines are broadcast up to this many rows of 16 bytes and a host name; beyond, the join
# shuffles and adaptive execution splits a hot host.
BROADCAST_ROWS = 500_000

# The white space at a line's ends that does not count.
_BLANKS = " \t\r\x0b\x0c"


def line_key(line: Column) -> Column:
    """What makes two lines equal: their text without white space at either end."""
    return F.xxhash64(F.trim(line, F.lit(_BLANKS)))


_EMPTY = ""


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _said(text: str) -> Column:
    """The lines of a text that are not blank."""
    return F.filter(lines_of(F.col(f"`{text}`")), lambda x: F.trim(x, F.lit(_BLANKS)) != _EMPTY)


def page_lines(pages: DataFrame, host: str, text: str, page: str) -> DataFrame:
    """The distinct lines of each page: host, page, line (its key), length, and total, the length of them all."""
    trimmed = F.array_distinct(F.transform(_said(text), lambda x: F.trim(x, F.lit(_BLANKS))))
    rows = pages.select(
        F.col(f"`{host}`").alias("host"),
        F.col(f"`{page}`").alias("page"),
        F.transform(
            trimmed, lambda x: F.struct(line_key(x).alias("line"), F.length(x).cast("bigint").alias("length"))
        ).alias("said"),
    )
    total = F.aggregate("said.length", F.lit(0).cast("bigint"), lambda n, x: n + x)
    each = rows.select("host", "page", total.alias("total"), F.explode("said").alias("of"))
    return each.select("host", "page", "of.line", "of.length", "total").distinct()


def near_pages(said: DataFrame, alike: float) -> DataFrame:
    """Pages (host, page) that are nearly copies, each with ``copy_of``: the longest line that it shares.

    ``said`` is what ``page_lines`` gives. A page is nearly a copy if the lines that other pages of its host
    have too make up so much of it that two such pages of one length have a similarity of at least
    ``alike``, shared length by joint length.

    Only keys and lengths are shuffled. Lines on two pages or more are written first, so that both sides of
    the join are read as they lie, and adaptive execution splits a line that very many pages share.
    """
    shared = settle(
        said.groupBy("host", "line").agg(F.count("*").alias("n")).where("n > 1").select(
            F.col("host").alias("at"), F.col("line").alias("common")
        ),
        "shared-lines",
    )
    of_page = (
        said.join(shared, F.col("host").eqNullSafe(F.col("at")) & (F.col("line") == F.col("common")))
        .groupBy("host", "page")
        .agg(
            F.sum("length").alias("shared"),
            F.first("total").alias("total"),
            F.max(F.struct("length", "line"))["line"].alias("copy_of"),
        )
    )
    return of_page.where(F.col("shared") * (1 + alike) >= F.col("total") * (2 * alike)).select(
        "host", "page", "copy_of"
    )


def boilerplate(
    pages: DataFrame,
    *,
    host: str,
    text: str = "text",
    ratio: float = 0.02,
    min_pages: int = 5,
    page: str | None = None,
    alike: float | None = None,
) -> DataFrame:
    """For each host (a null host is one) the keys of its boilerplate lines, in an array: lines that are on
    more than the share ``ratio`` of its pages, and on at least ``min_pages``. A page counts once however
    often it repeats a line; blank lines are never boilerplate. Rows of a host with one value of the column
    ``page`` (not null) are one page, in the lines' counts and in the host's; without it each row is a page.
    With ``alike``, which needs ``page``, near copies (``near_pages``) that share their longest line are one
    page too.

    Each page sends its distinct line keys; Spark adds them up before they are shuffled, so neither a
    host nor a line that many pages share gathers in one task.
    """
    if alike is not None and page is None:
        raise ValueError("alike needs page")
    rows = pages.select(
        F.col(f"`{host}`").alias("host"),
        (F.lit(0) if page is None else F.col(f"`{page}`")).alias("page"),
        F.array_distinct(F.transform(_said(text), line_key)).alias("keys"),
    )
    if alike is None:
        said = rows.select("host", "page", F.explode("keys").alias("line"))
        if page is not None:
            rows, said = rows.select("host", "page").distinct(), said.distinct()
    else:
        said = settle(page_lines(pages, host, text, page), "page-lines")
        near = settle(near_pages(said, alike), "near-pages").toDF("at", "copy", "copy_of")
        same = F.col("host").eqNullSafe(F.col("at")) & (F.col("page") == F.col("copy"))
        once = F.struct("copy_of", F.when(F.col("copy_of").isNull(), F.col("page")).alias("own")).alias("page")
        said = said.join(near, same, "left").select("host", once, "line").distinct()
        rows = rows.select("host", "page").distinct().join(near, same, "left").select("host", once).distinct()
    totals = rows.groupBy("host").agg(F.count("*").alias("pages"))
    counts = said.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    often = counts.join(totals, counts["host"].eqNullSafe(totals["host"])).where(
        F.col("n") > F.col("pages") * ratio
    )
    return often.groupBy(counts["host"]).agg(F.collect_set("line").alias("drop"))


def clean(
    pages: DataFrame,
    *,
    host: str,
    text: str = "text",
    ratio: float = 0.02,
    min_pages: int = 5,
    page: str | None = None,
    alike: float | None = None,
) -> DataFrame:
    """All rows and columns, with ``text`` freed of its host's boilerplate lines, and two columns more:
    ``n_lines`` (lines before) and ``n_dropped``; these names take the place of columns that have them.
    A null text stays null with no lines; a text of boilerplate alone becomes empty. The lines kept keep
    their order and their bytes.

    A host has at most (lines per page) / ratio boilerplate lines, so the array per host is small.
    """
    found = boilerplate(pages, host=host, text=text, ratio=ratio, min_pages=min_pages, page=page, alike=alike)
    found = settle(found.select(F.col("host").alias("of"), "drop"), "boilerplate")
    columns = [c for c in pages.columns if c.lower() not in ("n_lines", "n_dropped")]
    if found.agg(F.coalesce(F.sum(F.size("drop")), F.lit(0))).first()[0] <= BROADCAST_ROWS:
        found = F.broadcast(found)
    # The user's columns travel as one, so theirs and these cannot clash.
    rows = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in columns if c != text]).alias("row"),
        F.col(f"`{host}`").alias("host"),
        F.col(f"`{text}`").alias("text"),
    )
    joined = rows.join(found, F.col("host").eqNullSafe(F.col("of")), "left")
    kept = F.filter(lines_of(F.col("text")), lambda x: ~F.array_contains("drop", line_key(x)))
    marked = joined.withColumn(
        "kept", F.when(F.col("drop").isNotNull() & F.col("text").isNotNull(), kept)
    ).withColumn("before", F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(lines_of(F.col("text")))))
    cleaned = F.when(F.col("kept").isNotNull(), F.array_join("kept", "\n")).otherwise(F.col("text"))
    return marked.select(
        *[cleaned.alias(c) if c == text else F.col("row")[c].alias(c) for c in columns],
        F.col("before").cast("bigint").alias("n_lines"),
        F.when(F.col("kept").isNotNull(), F.col("before") - F.size("kept"))
        .otherwise(F.lit(0))
        .cast("bigint")
        .alias("n_dropped"),
    )
