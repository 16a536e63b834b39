"""Data-quality checks. Each gives one row (table, check, expected, actual, ok), so a suite is a union."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import catalog as fixed
from ..functions.measures import hits, rows
from ..operators.rules import REASON

# Columns that later layers rely on.
REQUIRED_BRONZE_EVENTS = (
    "event_id",
    "event_ts",
    "ingest_ts",
    "ingest_date",
    "source_file",
    "is_late_arrival",
    "schema_version",
    "carbon_kg",
    "genai_tokens",
)
REQUIRED_SILVER_EVENTS = (
    "cost_usd_increment",
    *fixed.METRIC_FEATURES,
    "genai_tokens",
    "carbon_kg",
    "org_user_count",
    "org_active_user_count",
    "resource_service",
    "resource_region",
    *fixed.ANOMALY_FLAGS,
)
REQUIRED_SERVICE_DAILY = ("daily_cost_usd", *fixed.METRIC_FEATURES, "genai_tokens", "carbon_kg")
REQUIRED_ORG_DAILY = (*[f"total_{c}" for c in REQUIRED_SERVICE_DAILY], "event_count")


def _check(one_row: DataFrame, table: str, check: str, tolerance: float | None = None) -> DataFrame:
    expected, actual = F.col("expected").cast("double"), F.col("actual").cast("double")
    same = expected == actual if tolerance is None else F.abs(expected - actual) < tolerance
    return one_row.select(
        F.lit(table).alias("table"),
        F.lit(check).alias("check"),
        expected.alias("expected"),
        actual.alias("actual"),
        F.coalesce(same, F.lit(False)).alias("ok"),
    )


def key_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: total_rows, distinct_keys (exact, nulls included), is_unique."""
    counted = df.agg(rows().alias("total_rows"), F.count_distinct(F.struct(*keys)).alias("distinct_keys"))
    return counted.withColumn("is_unique", F.col("total_rows") == F.col("distinct_keys"))


def unique(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    one = key_report(df, keys).withColumnsRenamed({"total_rows": "expected", "distinct_keys": "actual"})
    return _check(one, table, f"unique by {', '.join(keys)}")


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def has_columns(df: DataFrame, table: str, required: Sequence[str]) -> DataFrame:
    found = len(required) - len(missing_columns(df, required))
    one = df.agg(F.lit(len(required)).alias("expected"), F.lit(found).alias("actual"))
    return _check(one, table, "required columns")


def balance(whole: DataFrame, parts: Sequence[DataFrame], table: str) -> DataFrame:
    """Rows in = rows out, over all outputs."""
    out = reduce(add, [part.agg(rows()).scalar() for part in parts])
    return _check(whole.agg(rows().alias("expected")).withColumn("actual", out), table, "row balance")


def identical(source: DataFrame, target: DataFrame, table: str) -> DataFrame:
    """Rows that only one of the two has, by all columns of the source: none."""
    stored = target.select(*source.columns)
    differing = source.exceptAll(stored).unionAll(stored.exceptAll(source))
    counted = differing.agg(F.lit(0).alias("expected"), rows().alias("actual"))
    return _check(counted, table, "same rows")


def observed(
    spark: SparkSession, table: str, check: str, expected: float | None, actual: float | None, tolerance: float | None = None
) -> DataFrame:
    """A check of two values that were taken while the tables were written; nothing counts as zero."""
    values = {"expected": expected, "actual": actual}
    one = spark.range(1).select(*[F.lit(float(value or 0)).alias(name) for name, value in values.items()])
    return _check(one, table, check, tolerance)


def suite(checks: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, checks)


def failed(checks: DataFrame) -> DataFrame:
    return checks.where(~F.col("ok"))


# Counters ---------------------------------------------------------------------------------------------
def event_counters(classified: DataFrame) -> DataFrame:
    """One row: all counters of the silver event step, from one aggregate."""
    valid = F.col(REASON).isNull()
    flags = {
        "cost_anomalies_flagged": "is_cost_anomaly",
        "cost_anomalies_zscore": "is_cost_anomaly_zscore",
        "cost_anomalies_mad": "is_cost_anomaly_mad",
        "cost_anomalies_percentile": "is_cost_anomaly_percentile",
        "cost_anomalies_p99_x": "is_cost_anomaly_p99_x",
        "late_arrivals_flagged": "is_late_arrival",
    }
    reasons = {
        "negative_cost_quarantined": fixed.COST_BELOW_MINIMUM,
        "invalid_service_quarantined": fixed.UNKNOWN_SERVICE,
        "invalid_region_quarantined": fixed.UNKNOWN_REGION,
        "late_arrivals_quarantined": fixed.TOO_LATE,
        "future_event_ts_quarantined": fixed.IN_THE_FUTURE,
    }
    return classified.agg(
        rows().alias("raw_count"),
        hits(valid).alias("valid_count"),
        hits(~valid).alias("quarantine_count"),
        *[hits(valid & F.col(flag)).alias(name) for name, flag in flags.items()],
        *[hits(F.col(REASON) == reason).alias(name) for name, reason in reasons.items()],
    )


def reason_counts(quarantined: DataFrame) -> DataFrame:
    return quarantined.groupBy(REASON).agg(rows().alias("n"))


def quarantine_sample(quarantined: DataFrame, n: int = 5) -> DataFrame:
    """A few rows to look at: the first by event id, then by the other columns shown."""
    shown = ("event_id", "org_id", "metric", "value", "unit", REASON)
    return quarantined.select(*shown).orderBy(*shown).limit(n)


def ingest_counters(landed: DataFrame, kept: DataFrame, dataset: str) -> DataFrame:
    """One row: rows landed, kept and removed as duplicates."""
    counted = landed.agg(F.lit(dataset).alias("dataset"), rows().alias("raw_count"))
    counted = counted.withColumn("deduped_count", kept.agg(rows()).scalar())
    return counted.withColumn("removed_duplicates", F.col("raw_count") - F.col("deduped_count"))


def counted_snapshot(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    """(metric, n) of counts that are known already, such as those that versions carry."""
    pairs = [F.struct(F.lit(m).alias("metric"), F.lit(n).cast("bigint").alias("n")) for m, n in counts.items()]
    return spark.range(1).select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def compare_snapshots(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two (metric, n) snapshots side by side; a metric that only one side has is not ok."""
    left, right = before.withColumnRenamed("n", "before"), after.withColumnRenamed("n", "after")
    return left.join(right, "metric", "full").withColumn(
        "ok", F.coalesce(F.col("before") == F.col("after"), F.lit(False))
    )
