"""Master tables: landing CSV -> bronze (typed, latest per key) -> silver and quarantine."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..catalog import NULL_KEY, UNKNOWN_ORG, UNREADABLE, MasterTable
from ..functions.parse import typed
from ..functions.text import conform
from ..operators.dedupe import content_order, keep_latest
from ..operators.lookup import lookup_join
from ..operators.rules import Rule, apply_rules, unreadable_rule
from ..sources.tables import read_landing_csv

_KNOWN = "_known_org"


def with_lineage(df: DataFrame, source_file: Column, ingest_ts: Column | None = None) -> DataFrame:
    """Add source_file, ingest_ts (now, unless given) and ingest_date."""
    clock = F.current_timestamp() if ingest_ts is None else ingest_ts
    return df.withColumns(
        {"source_file": source_file, "ingest_ts": clock, "ingest_date": F.to_date(clock)}
    )


def landed_master(
    spark: SparkSession, table: MasterTable, path: str, ingest_ts: Column | None = None
) -> DataFrame:
    """The CSV typed and stamped, before the dedupe."""
    label = F.lit("landing/" + path.rstrip("/").rsplit("/", 1)[-1])
    kept = T.StructType([*table.typed.fields, T.StructField(UNREADABLE, T.StringType())])
    landed = with_lineage(typed(read_landing_csv(spark, table, path), kept), label, ingest_ts)
    return landed.select(*table.bronze.names)


def bronze_master(landed: DataFrame, table: MasterTable) -> DataFrame:
    """The latest row per key. All rows of one load share a stamp, so content decides between them. Rows with
    a null in the key are not copies of one another: all of them stay, and silver quarantines each."""
    keyed = landed.where(~_without_key(table))
    latest = keep_latest(keyed, table.keys, content_order(landed, ["ingest_ts"]))
    return latest.unionByName(landed.where(_without_key(table)))


def _without_key(table: MasterTable) -> Column:
    return reduce(or_, [F.col(k).isNull() for k in table.keys])


def classify_master(bronze: DataFrame, table: MasterTable, customers: DataFrame | None = None) -> DataFrame:
    """Conformed text plus the reason, if any, to quarantine the row: a line that could not be read, a null
    key, or an unknown org."""
    rows = conform(bronze, table.conform)
    rules = [*unreadable_rule(rows), Rule(NULL_KEY, _without_key(table))]
    if not table.owned_by_org or customers is None:
        return apply_rules(rows, rules)
    orgs = customers.select("org_id").distinct().withColumn(_KNOWN, F.lit(True))
    rules.append(Rule(UNKNOWN_ORG, F.col(_KNOWN).isNull()))
    owned = lookup_join(rows, orgs, ["org_id"], spread_by=table.keys)
    return apply_rules(owned, rules).drop(_KNOWN)
