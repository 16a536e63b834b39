"""The registered queries of the operators, each over its whole tables, and SQL where SQL can say the same."""

from __future__ import annotations

import functools
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path, scratch
from ..sources.tables import ROW_ID, read_parquet, with_row_id
from . import (
    automaton,
    contamination,
    conversations,
    interactions,
    jaccard,
    language,
    likelihood,
    lines,
    packing,
    quality,
    ring,
    toxicity,
    urls,
)
from .text import fold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
# Fixed value: the special token that the tokenizer file adds to the vocabulary.
SPECIAL = {"<|endoftext|>": 50256}


def query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


@functools.cache
def _package() -> str:
    """This library as an archive that Spark can hand to its executors."""
    root = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="package-")) / f"{root.name}.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    return str(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let the executors import this library, also where it is not installed. Once per application."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        spark.sparkContext.addPyFile(_package())
        _shipped.add(application)


# Texts travel to Python workers in batches of this size. Spark's own bound of 64 MB, held several times
# over (writer, worker, result), is most of an executor's memory beside the heap.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table of the folder. Makes the session ready for the operators: the library on the executors, and
    small Arrow batches unless the job has set their size."""
    ship(spark)
    key, size = BATCH_BYTES
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, size)
    return read_parquet(spark, f"{sf}/{name}.parquet")


def held_out(modulus: int, remainder: int, key: str = "doc_id") -> Column:
    """True for rows that must not be learned from; a null key is one."""
    return fold(key, modulus).isin(-1, remainder)


def in_fold(modulus: int, remainder: int) -> Column:
    return (fold("doc_id", modulus) == remainder).alias("held_out")


def finished(spark: SparkSession, make: Callable[[], DataFrame], label: str) -> DataFrame:
    """Write the result, then delete what it was made from."""
    with scratch(spark):
        made = make()
        path = fresh_path(spark, label)
        made.write.parquet(path)
    return spark.read.schema(made.schema).parquet(path)


@query
def op1_packing(spark: SparkSession, sf: str) -> DataFrame:
    """The rank file holds the vocabulary of the tokenizer file; with its special token, ids are the same."""
    return packing.pack(table(spark, sf, "documents"), RANKS, special=SPECIAL)


@query
def op2_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    profiles = language.fit(docs, ~held_out(3, 1))
    found = language.predict(docs, profiles)
    return found.select("doc_id", in_fold(3, 1), "lang_pred", "score")


@query
def op3_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = quality.fit(docs, table(spark, sf, "labels"), held_out(4, 2, "key"))
    found = quality.classify(docs, model)
    return found.select("doc_id", in_fold(4, 2), "score", "predicted")


@query
def op4_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Target: the texts that are labelled as good. Raw: all texts."""
    docs = table(spark, sf, "documents")
    good = table(spark, sf, "labels").where("quality = 1").select("doc_id").distinct()
    # Up to a measured size the ids go to the texts, not the texts to the ids.
    rule = likelihood.fit(docs, docs.join(contamination.bounded(good), "doc_id", "left_semi"))
    return likelihood.apply(docs, rule)


@query
def op5_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Hosts are the sources of the documents."""
    return lines.clean(
        table(spark, sf, "documents").select("doc_id", "source", "text"), host="source"
    )


ORACLES["op5_lines"] = """
WITH cut AS (
  SELECT doc_id, source, text, string_split(text, chr(10)) AS parts FROM documents
), said AS (
  SELECT DISTINCT source, doc_id, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS line
  FROM (SELECT source, doc_id, unnest(parts) AS line FROM cut)
), totals AS (
  SELECT source, count(*) AS pages FROM documents GROUP BY source
), often AS (
  SELECT source, line FROM said JOIN totals USING (source) WHERE line <> ''
  GROUP BY source, line, pages HAVING count(*) >= 5 AND count(*) > pages * 0.02
), placed AS (
  SELECT doc_id, source, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM cut
), marked AS (
  SELECT p.*, o.line IS NOT NULL AS gone FROM placed p LEFT JOIN often o
  ON o.source = p.source AND o.line = trim(p.line, ' ' || chr(9) || chr(13) || chr(11) || chr(12))
)
SELECT doc_id, source,
       coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text,
       count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped
FROM marked GROUP BY doc_id, source
"""


@query
def op6_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = toxicity.fit(docs, table(spark, sf, "labels"), held_out(4, 2, "key"))
    found = toxicity.classify(docs, model)
    return found.select("doc_id", in_fold(4, 2), "score", "predicted")


@query
def op7_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return finished(spark, lambda: jaccard.join(docs, k=4, num=85, den=100), "op7")


ORACLES["op7_jaccard"] = r"""
WITH RECURSIVE cut AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [md5(array_to_string(w, ' '))]
    ELSE list_distinct([md5(array_to_string(w[i:i + 3], ' ')) FOR i IN range(1, len(w) - 2)]) END AS s FROM cut
), one AS (
  SELECT min(doc_id) AS rep, list_sort(s) AS s FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)
), tokens AS (
  SELECT rep, len(s) AS n, unnest(s) AS t FROM one
), links AS (
  SELECT a.rep AS a, b.rep AS b FROM tokens a JOIN tokens b ON a.t = b.t AND a.rep <> b.rep
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach(a, b) AS (
  SELECT rep, rep FROM one UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), comp AS (
  SELECT a AS rep, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, len(sets.s) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM sets LEFT JOIN one ON len(sets.s) > 0 AND list_sort(sets.s) = one.s LEFT JOIN comp USING (rep)
"""


@query
def op8_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return automaton.scan(table(spark, sf, "documents"))


@query
def op9_ring(spark: SparkSession, sf: str) -> DataFrame:
    """Bounded loads without slack: the numbers of rows differ by one at most."""
    docs = with_row_id(table(spark, sf, "documents"))
    binary = F.coalesce("text", F.lit("")).cast("binary")
    small = docs.select(
        "doc_id",
        (F.octet_length(binary) + 16).cast("bigint").alias("size"),
        F.crc32(binary).alias("text_crc32"),
        *ROW_ID,
    )
    placed = ring.shard(small, 40, row_id=ROW_ID)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op10_contamination(spark: SparkSession, sf: str) -> DataFrame:
    docs, items = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    return finished(spark, lambda: contamination.report(docs, items), "op10")


ORACLES["op10_contamination"] = r"""
WITH cut AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
  SELECT DISTINCT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT item_id, least(13, len(w)) AS n, unnest([array_to_string(w[i:i + least(13, len(w)) - 1], ' ')
    FOR i IN range(1, len(w) - least(13, len(w)) + 2)]) AS p FROM items WHERE len(w) > 0
), found AS (
  SELECT DISTINCT doc_id, item_id, pos, n FROM (
    SELECT doc_id, k.n AS n, unnest([{'p': array_to_string(w[i:i + k.n - 1], ' '), 'pos': i}
      FOR i IN range(1, len(w) - k.n + 2)], recursive := true)
    FROM cut, (SELECT DISTINCT n FROM windows) k WHERE len(w) >= k.n
  ) JOIN windows USING (p, n)
), hit AS (
  SELECT doc_id, count(DISTINCT hit) AS n_hit
  FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS hit FROM found) GROUP BY doc_id
), which AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
), said AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS here FROM cut
), counts AS (
  SELECT word, count(*) AS n FROM said GROUP BY word
), tests AS (
  SELECT item_id, w, row_number() OVER () AS test FROM items WHERE len(w) > 0
), placed AS (
  SELECT item_id, test, len(w) AS size, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS q FROM tests
), ranked AS (
  SELECT p.item_id, p.test, s.q AS s, p.q, p.word,
         row_number() OVER (PARTITION BY p.test, s.q ORDER BY n, p.word, p.q) AS nth
  FROM placed s JOIN placed p ON p.test = s.test AND p.q >= s.q AND p.q < s.q + least(13, s.size)
  JOIN counts ON counts.word = p.word WHERE s.q + least(13, s.size) <= s.size
), anchors AS (
  SELECT DISTINCT item_id, test, q, word FROM ranked WHERE nth = 1
), several AS (
  SELECT * FROM anchors WHERE test IN (SELECT test FROM anchors GROUP BY test HAVING count(*) >= 2)
), cells AS (
  SELECT doc_id, item_id, test, q, floor((here - q) / 13.0) + step AS cell
  FROM said JOIN several USING (word), (VALUES (0), (1)) k(step)
), close AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_near FROM (
    SELECT doc_id, item_id FROM cells GROUP BY doc_id, item_id, test, cell HAVING count(DISTINCT q) >= 2
  ) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
       coalesce(n_near, 0) AS n_near
FROM cut LEFT JOIN hit USING (doc_id) LEFT JOIN which USING (doc_id) LEFT JOIN close USING (doc_id)
"""


CONVERSATION_ROW = (*ROW_ID, "copy")


def conversation_report(spark: SparkSession, sf: str, **options) -> DataFrame:
    """Damage, repair and report; every conversation has a row, also one that lost all of its own."""
    rows = with_row_id(table(spark, sf, "conversations").select("conv_id", "turn", "role", "text"))
    marked = conversations.mark(conversations.damaged(rows), row_id=CONVERSATION_ROW)
    report = conversations.repair(marked, **options).report.withColumnRenamed("conv", "conv_id")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    bare = rows.select("conv_id").distinct()
    both = report.unionByName(bare, allowMissingColumns=True).groupBy("conv_id")
    found = both.agg(*[F.max(c).alias(c) for c in (*counts, "audit", "repaired_sha256")], F.count("cost").alias("_has"))
    given = F.col("_has") > 0  # gaps beyond a long stay null
    return found.select(
        "conv_id",
        *[F.when(given, F.col(c)).otherwise(F.lit(0)).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


@query
def op11_conversations(spark: SparkSession, sf: str) -> DataFrame:
    return finished(spark, lambda: conversation_report(spark, sf), "op11")


@query
def op12_filters(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")

    def made() -> DataFrame:
        flagged = interactions.flags(docs, table(spark, sf, "labels"))
        return interactions.audit(flagged, "ABCDE", part="part", good="good", toxic="toxic")

    return finished(spark, made, "op12")


ORACLES["op12_filters"] = r"""
WITH cut AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
), counted AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS least FROM cut
), judged AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), failing AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         (CASE WHEN len(w) < 100 THEN 'A' ELSE '' END)
         || (CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END)
         || (CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) THEN 'C' ELSE '' END)
         || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END)
         || (CASE WHEN doc_id > least THEN 'E' ELSE '' END) AS fails
  FROM counted LEFT JOIN judged USING (doc_id)
), cells AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM failing GROUP BY part, fails
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
), orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), steps AS (
  SELECT part, fails, n, good, toxic, o, s::INT AS s, o[s:s] AS f,
         regexp_matches(fails, o[s:s]) AS own, s > 1 AND regexp_matches(fails, '[' || o[1:s-1] || 'x]') AS earlier
  FROM cells, orders, range(1, 6) r(s)
), summed AS (
  SELECT part, o, s, f, coalesce(sum(n) FILTER (WHERE NOT own AND NOT earlier), 0) AS kept,
         coalesce(sum(n) FILTER (WHERE own AND NOT earlier), 0) AS removed,
         coalesce(sum(n) FILTER (WHERE own AND earlier), 0) AS redundant,
         coalesce(sum(n) FILTER (WHERE fails = f), 0) AS unique_fails,
         coalesce(sum(good) FILTER (WHERE own AND NOT earlier), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (WHERE own AND NOT earlier), 0) AS toxic_lost
  FROM steps GROUP BY part, o, s, f
)
SELECT part, o AS filter_order, s AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM summed
"""


# Rules on hosts and paths.
URL_RULES = [
    urls.Rule(urls.ALLOW, "org", "/"),
    urls.Rule(urls.BLOCK, "example.org", "/es/"),
    urls.Rule(urls.BLOCK, "example.org", "/en/1"),
    urls.Rule(urls.ALLOW, "com", "/fr/"),
    urls.Rule(urls.BLOCK, "com", "/de/"),
]


@query
def op13_urls(spark: SparkSession, sf: str) -> DataFrame:
    """Labels are the verdicts of the rules; the trees judge the rest."""

    def made() -> DataFrame:
        pages = urls.parse(table(spark, sf, "pages"), URL_RULES)
        return urls.judge(pages, URL_RULES, urls.fit(pages)).withColumnRenamed("key", "page_id")

    return finished(spark, made, "op13")
