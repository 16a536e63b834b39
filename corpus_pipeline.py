"""From raw documents to packed sequences: one stage after the other, each written as Parquet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm import contamination, jaccard, lines, packing, quality
from meterlake.llm.queries import RANKS, SPECIAL, held_out, table
from meterlake.llm.text import unused
from meterlake.operators.lookup import measure
from meterlake.session import fresh_path, scratch, settle

BROADCAST_BYTES = 32 << 20


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """Documents that are not among the rejected, which have ``doc_id`` and ``text_hash``."""
    stored = settle(rejected.select("doc_id", "text_hash").distinct(), "rejected")
    return docs.join(*_matching(docs, stored), "left_anti")


def _matching(docs: DataFrame, named: DataFrame) -> tuple[DataFrame, Column]:
    """Rows that name documents, under column names that the documents lack, and the condition that joins
    them. Up to a measured size they are broadcast, and texts stay where they are."""
    fresh = {c: unused(f"_{c}", docs.columns) for c in named.columns}
    renamed = named.toDF(*fresh.values())
    if measure(named).bytes <= BROADCAST_BYTES:
        renamed = F.broadcast(renamed)
    same = F.col("doc_id").eqNullSafe(F.col(fresh["doc_id"])) & (F.xxhash64("text") == F.col(fresh["text_hash"]))
    return renamed, same


def _named(docs: DataFrame) -> DataFrame:
    """Documents under a key that tells texts with the same id apart; rows without an id come last."""
    key = F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64("text").alias("text_hash")
    )
    return docs.select(key.alias("id"), "text")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. It is fitted on the labels of these documents."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), held_out(4, 2, "key"))
    return quality.keep_good(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the boilerplate of their source; ``n_chars`` follows. All documents stay. Copies of a
    document, and near copies by their lines, are still there, so they count as one page: their lines are no
    boilerplate."""
    page = unused("page", docs.columns)
    cleaned = lines.clean(docs.withColumn(page, F.xxhash64("text")), host="source", page=page, alike=0.8)
    length = F.when(F.col("n_dropped") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", length).select(*[f"`{c}`" for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that are linked by five-word shingles with a similarity of 0.8 or more,
    the one with the smallest id; of repeated rows one."""
    linked = jaccard.join(_named(docs), key="id", k=5, num=4, den=5)
    found = settle(linked.where("n_shingles > 0"), "near-duplicates")
    kept = _without(docs, found.where("id <> component_id").select("id.*"))
    repeated = settle(
        found.where("id = component_id").groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id.doc_id", "id.text_hash"),
        "repeated-rows",
    )
    if repeated.isEmpty():
        return kept
    copies = kept.join(*_matching(kept, repeated), "left_semi")
    return _without(kept, repeated).unionByName(copies.dropDuplicates(["doc_id", "text"]))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth are passages of the benchmark."""
    found = contamination.report(_named(docs), table(spark, sf_dir, "benchmark"), key="id")
    return _without(docs, found.where("contaminated").select("id.*"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences of 2,048 tokens, with their token ids."""
    return packing.pack(docs, RANKS, with_ids=True, special=SPECIAL)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_quality),
    ("lines", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("packing", pack),
]

# The classifier and the tokenizer have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage. What earlier stages wrote is deleted as soon as the next has written."""
    docs = table(spark, sf_dir, "documents")
    with scratch(spark):
        for name, stage in STAGES[:-1]:
            docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
        name, stage = STAGES[-1]
        made = stage(spark, docs, sf_dir)
        path = fresh_path(spark, f"pipeline-{name}")
        made.write.parquet(path)
    return spark.read.schema(made.schema).parquet(path)
