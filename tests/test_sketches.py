"""Statistics carried on by days against those of all rows at once."""

import math
import random
from datetime import date, timedelta

import pytest
from landing import FIRST, add_events, event, write_landing
from pyspark.sql import functions as F

from meterlake.operators import anomaly, sketches
from meterlake.plans.pipeline import Lake
from meterlake.session import Measured, total_bytes
from meterlake.sources.versioned import VersionedTable

SCHEMA = "org_id string, service string, usage_date date, cost_usd_increment double"


def costs(spark, n_days=6, per_day=40, seed=1, scale=1.0):
    rng = random.Random(seed)
    rows = []
    for d in range(n_days):
        day = date(2025, 8, 1) + timedelta(d) if d else None
        for org, service in (("o1", "compute"), ("o1", "storage"), ("o2", "compute"), (None, "x"), ("o3", None)):
            rows += [(org, service, day, scale * rng.lognormvariate(0, 2)) for _ in range(rng.randint(0, per_day))]
        rows.append(("o4", "storage", day, None))
    rows += [("o5", "genai", date(2025, 8, 2), 1e9 + i) for i in range(3)]
    return spark.createDataFrame(rows, SCHEMA)


def by_group(df):
    return {(r["org_id"], r["service"]): [r[c] for c in anomaly.STATISTICS] for r in df.collect()}


def exact(spark, df):
    kept = df.where("cost_usd_increment IS NOT NULL").withColumns({"_row_file": F.lit(1), "_row_number": F.monotonically_increasing_id()})
    return by_group(anomaly.cost_profile(kept).df)


def same(a, b):
    assert a.keys() == b.keys()
    for group in a:
        assert a[group] == pytest.approx(b[group], rel=1e-9, abs=1e-9), group


@pytest.fixture()
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "summaries"))


def test_summaries_of_days_equal_all_rows_at_once(spark, table):
    df = costs(spark)
    sketches.carry_on(table, df, ())
    same(by_group(sketches.merged_profile(table.read())), exact(spark, df))


def test_adding_a_day_reads_and_writes_that_day_only(spark, table):
    df = costs(spark)
    last = df.agg(F.max("usage_date")).first()[0]
    is_last = F.coalesce(F.col("usage_date") == F.lit(last), F.lit(False))
    sketches.carry_on(table, df.where(~is_last), ())
    before = table.current()
    sketches.carry_on(table, df.where(is_last), {sketches.day_cell(last)})
    after = table.current()
    assert set(before.parts) < set(after.parts)
    assert {p.cell for p in set(after.parts) - set(before.parts)} == {f"usage_date={last}"}
    same(by_group(sketches.merged_profile(table.read())), exact(spark, df))


def test_a_day_with_late_events_and_the_day_without_a_date_are_replaced(spark, table):
    df = costs(spark, seed=2)
    sketches.carry_on(table, df.limit(60), ())
    cells = {sketches.day_cell(r[0]) for r in df.select("usage_date").distinct().collect()}
    assert "usage_date=__HIVE_DEFAULT_PARTITION__" in cells
    sketches.carry_on(table, df, cells)
    same(by_group(sketches.merged_profile(table.read())), exact(spark, df))


def test_ranks_of_large_groups_are_within_the_stated_error(spark, table):
    """Small sketches, so that they must compress: k = 200 allows 1.65 % of the rows at most (99 %)."""
    n = 60_000
    df = spark.range(n).select(
        F.lit("o").alias("org_id"),
        F.lit("s").alias("service"),
        F.date_add(F.lit("2025-08-01").cast("date"), (F.col("id") % 30).cast("int")).alias("usage_date"),
        ((F.col("id") * 7919) % n).cast("double").alias("cost_usd_increment"),
    )
    days = sketches.daily_summary(df, k=200)
    (row,) = sketches.merged_profile(days, k=200, points=512).collect()
    allowed = 0.0165 * n + n / 512
    for name, q in (("p01_cost", 0.01), ("median_cost", 0.5), ("p99_cost", 0.99)):
        assert abs(row[name] - q * n) <= allowed
    assert abs(row["mad_cost"] - n / 4) <= 2 * allowed
    assert row["mean_cost"] == pytest.approx((n - 1) / 2)
    assert row["std_cost"] == pytest.approx(math.sqrt((n * n - 1) / 12))


@pytest.mark.parametrize("n", [1, 2, 7, 63, 64, 65, 500])
def test_points_are_the_values_up_to_their_number(spark, n):
    df = spark.range(n).select(F.kll_sketch_agg_double(F.col("id").cast("double"), 512).alias("s"), F.count("*").alias("n"))
    found = df.select(sketches._points(F.col("s"), F.col("n"), 64)).first()[0]
    assert len(found) == min(n, 64)
    if n <= 64:
        assert found == [float(i) for i in range(n)]


def test_no_rows(spark, table):
    sketches.carry_on(table, costs(spark).limit(0), ())
    assert sketches.merged_profile(table.read()).collect() == []


def test_the_lake_carries_its_statistics(spark, tmp_path, rows):
    write_landing(tmp_path)
    lake = Lake(spark, str(tmp_path))
    as_of = F.lit("2025-08-20 00:00:00").cast("timestamp")
    lake.ingest_masters()
    lake.ingest_events()
    flags = ["event_id", "error_reason", "is_cost_anomaly", "is_cost_anomaly_mad", "is_cost_anomaly_percentile"]
    judged = lambda: rows(lake.silver_table("usage_events").read(), *flags)
    lake.build_silver(as_of)
    full = judged()
    assert len(full) == len(FIRST)
    lake.build_silver(as_of, statistics="carried")
    assert judged() == full
    kept = set(lake.summaries_table().current().parts)
    assert lake.refresh_summaries() == []
    add_events(tmp_path, "new-day", [event(f"n{i}", timestamp="2025-08-15T10:00:00", cost_usd_increment=float(i)) for i in range(9)])
    lake.ingest_events()
    assert lake.refresh_summaries() == ["usage_date=2025-08-15"]
    assert kept < set(lake.summaries_table().current().parts)
    lake.build_silver(as_of, statistics="carried")
    carried = judged()
    lake.build_silver(as_of)
    assert judged() == carried and len(carried) == len(full) + 9
    with pytest.raises(ValueError, match="recomputed or carried"):
        lake.build_silver_events(statistics="other")


def test_sizes_count_nested_values(spark):
    df = spark.createDataFrame(
        [(["abcdefgh"] * 100, ("x" * 500, [1, 2]), {"k" * 50: "v" * 70}, b"1" * 30, [[1.0] * 10]), (None,) * 5],
        "words array<string>, s struct<a:string,b:array<int>>, m map<string,string>, raw binary, deep array<array<double>>",
    )
    size = df.agg(total_bytes(df)).first()[0]
    assert 100 * 8 + 500 + 120 + 30 + 80 <= size <= 5_000
    assert isinstance(Measured(df, size), tuple)
