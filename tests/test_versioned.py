"""Versions in cells, commits that survive a crash, loads that leave untouched files alone."""

import os
import time

from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_serving import DAY, TICKETS, row, tickets

from meterlake.catalog import EVENT_BRONZE, EVENT_RELAID
from meterlake.files import write_new
from meterlake.plans import layout
from meterlake.plans.serving import SERVING
from meterlake.schemas import columns
from meterlake.sources.versioned import Part, Version, VersionedTable, within
from meterlake.streaming.publish import merge_batch


def files(table):
    """Data files of the current version."""
    found = table.read().select(F.input_file_name().alias("f")).distinct().collect()
    return {r["f"].removeprefix("file://") for r in found}


@pytest.fixture()
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "t"), columns("id bigint, p string"))


def numbers(spark, n, p="a"):
    return spark.range(n).withColumn("p", F.lit(p))


# Commits ----------------------------------------------------------------------------------------------
def test_a_crash_in_the_commit_leaves_the_table_usable(spark, table, rows):
    """What a writer leaves that dies at any point: a hidden line, a half-written folder, data of no version."""
    table.publish(numbers(spark, 3))
    commits, data = Path(table.root) / "commits", Path(table.root) / "data"
    (commits / "_half").write_text('{"version": 2, "par')
    (data / "load=dead" / "_temporary").mkdir(parents=True)
    (data / "load=dead" / "part-0.parquet").write_bytes(b"half")
    assert rows(table.read(), "id") == [(0,), (1,), (2,)]
    assert table.publish(numbers(spark, 1)).version == 2
    assert rows(table.read(), "id") == [(0,)]


def test_old_folders_of_broken_loads_go_and_young_ones_stay(spark, table):
    table.publish(numbers(spark, 3))
    data, commits = Path(table.root) / "data", Path(table.root) / "commits"
    for name, age in (("load=old", 48), ("load=young", 1)):
        (data / name).mkdir()
        os.utime(data / name, (time.time() - age * 3600,) * 2)
    (commits / "_old").write_text("x")
    os.utime(commits / "_old", (time.time() - 48 * 3600,) * 2)
    assert table.expire(keep=1) == 1
    assert not (data / "load=old").exists() and (data / "load=young").exists() and not (commits / "_old").exists()
    assert table.read().count() == 3
    assert table.expire(keep=1, orphans_after_hours=0.5) == 1


def test_a_line_is_never_replaced(spark, tmp_path):
    path = str(tmp_path / "commits" / "1.json")
    assert write_new(spark, path, "first é")
    assert not write_new(spark, path, "second")
    assert Path(path).read_text() == "first é"
    assert os.listdir(tmp_path / "commits") == ["1.json"] or all(f.startswith((".", "1")) for f in os.listdir(tmp_path / "commits"))


def test_expire_keeps_what_later_versions_share(spark, table, rows):
    for n, p in ((2, "a"), (1, "b"), (3, "c")):
        table.publish(numbers(spark, n, p), partition_by=("p",), append=True, in_cells=True)
    table.publish(numbers(spark, 5, "b"), partition_by=("p",), in_cells=True, keep=lambda part: part.cell != "p=b")
    assert table.expire(keep=1) == 1  # the first load of b
    assert sorted(r["p"] for r in table.read().collect()) == ["a"] * 2 + ["b"] * 5 + ["c"] * 3


# Cells ------------------------------------------------------------------------------------------------
def test_cells_inside_cells():
    assert within("a=1/b=2", {"a=1"}) and within("a=1/b=2", {"a=1/b=2"})
    assert not within("a=11/b=2", {"a=1"}) and not within("a=1", {"a=1/b=2"})


def test_inventory_counts_rows_files_and_odd_names(spark, table, rows):
    odd = ["a b", "x/y=z%", "ü", None, "a:b"]
    df = spark.createDataFrame([(i, p) for i in range(4) for p in odd], "id bigint, p string")
    version = table.publish(df.repartition(2), partition_by=("p",), in_cells=True)
    assert [p.rows for p in version.parts] == [4] * 5 and all(p.files >= 1 and p.bytes > 0 for p in version.parts)
    assert rows(table.read(), "id", "p") == rows(df, "id", "p")
    for part in version.parts:
        only = table.read(only=lambda p, cell=part.cell: p.cell == cell)
        assert only.count() == 4 and only.select("p").distinct().count() == 1
    kept = table.publish(df.limit(0), partition_by=("p",), in_cells=True, keep=lambda p: "ü" in p.cell)
    assert kept.rows == 4 and rows(table.read().select("p").distinct()) == [("ü",)]


def test_a_version_of_no_cells_is_empty(spark, table):
    table.publish(numbers(spark, 0), partition_by=("p",), in_cells=True)
    assert table.read(row_id=True).collect() == [] and table.current().rows == 0
    table.publish(numbers(spark, 2), partition_by=("p",), in_cells=True, append=True)
    assert table.read().count() == 2


# Keyed loads ------------------------------------------------------------------------------------------
def test_one_changed_key_leaves_all_other_files(spark, tmp_path, rows):
    target = VersionedTable(spark, str(tmp_path / "served"), TICKETS.schema)
    first = [row(org=f"o{i}", count=i) for i in range(60)]
    merge_batch(target, TICKETS, tickets(spark, *first), buckets=16)
    before, version = files(target), target.current()
    assert version.note["bucket"] == 16 and len(version.parts) > 10
    merge_batch(target, TICKETS, tickets(spark, row(org="o7", count=700)))
    after = files(target)
    assert len(before - after) == 1  # the bucket of o7
    assert after - before and len(before & after) == len(before) - 1
    assert target.current().rows == 60
    expected = [(f"o{i}", 700 if i == 7 else i) for i in range(60)]
    assert rows(target.read(), "org_id", "ticket_count") == sorted(expected)


def test_a_replaced_partition_leaves_all_other_files(spark, tmp_path, rows):
    spec = SERVING["org_top_services_by_cost"]
    kind = "org_id string, period_end date, rank int, service string, period_start date, accumulated_cost_usd double"
    load = lambda orgs, n: spark.createDataFrame([(o, DAY, r, f"s{r}", DAY, 1.0) for o in orgs for r in range(1, n + 1)], kind)
    target = VersionedTable(spark, str(tmp_path / "served"), spec.schema)
    merge_batch(target, spec, load([f"o{i}" for i in range(40)], 5), buckets=16)
    before = files(target)
    merge_batch(target, spec, load(["o3"], 3))
    assert len(before - files(target)) == 1
    assert rows(target.read().where("org_id = 'o3'"), "rank") == [(1,), (2,), (3,)]
    assert target.read().count() == 39 * 5 + 3


def test_new_keys_and_null_keys_of_a_bucketed_table(spark, tmp_path, rows):
    target = VersionedTable(spark, str(tmp_path / "served"), TICKETS.schema)
    merge_batch(target, TICKETS, tickets(spark, row(org="o1"), row(org="o2")), buckets=4)
    merge_batch(target, TICKETS, tickets(spark, row(org="o9"), row(org=None)))
    assert rows(target.read(), "org_id") == [("o1",), ("o2",), ("o9",)]
    merge_batch(target, TICKETS, tickets(spark, row(org=None)))  # nothing but refused rows
    assert rows(target.read(), "org_id") == [("o1",), ("o2",), ("o9",)]


def test_a_grown_table_is_bucketed_anew(spark, tmp_path, rows, monkeypatch):
    from meterlake.streaming import publish

    target = VersionedTable(spark, str(tmp_path / "served"), TICKETS.schema)
    merge_batch(target, TICKETS, tickets(spark, row(org="o1")))
    assert target.current().note["bucket"] == 1
    monkeypatch.setattr(publish, "BUCKET_BYTES", 500)
    merge_batch(target, TICKETS, tickets(spark, *[row(org=f"o{i}") for i in range(40)]))
    assert target.current().note["bucket"] >= 4
    assert target.read().count() == 40


# Compaction -------------------------------------------------------------------------------------------
def bronze_rows(spark, day, n, service="compute"):
    values = {"event_ts": F.lit(f"{day} 10:00:00").cast("timestamp"), "service": F.lit(service), "event_id": F.col("id").cast("string")}
    picked = [values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENT_BRONZE]
    return spark.range(n).select(*picked)


def test_many_small_loads_leave_a_large_date_untouched(spark, tmp_path):
    """A large date and 25 small loads of another: only the small date's files merge."""
    target = VersionedTable(spark, str(tmp_path / "t"), EVENT_RELAID)
    lay = lambda df: target.publish(
        df.withColumn("usage_date", F.to_date("event_ts")), partition_by=layout.LAYOUT, append=True, in_cells=True
    )
    lay(bronze_rows(spark, "2025-08-01", 20_000))
    (large,) = files(target)
    small_bytes = os.path.getsize(large) // 2
    for _ in range(25):
        lay(bronze_rows(spark, "2025-08-02", 2))
        layout.merge_small_files(target, after=24, small_bytes=small_bytes)
    left = files(target)
    assert large in left and len(left) == 2
    assert target.current().rows == target.read().count() == 20_000 + 50
    assert layout.merge_small_files(target, after=24, small_bytes=small_bytes) == 0


def test_small_loads_of_a_large_date_merge_without_it(spark, tmp_path):
    target = VersionedTable(spark, str(tmp_path / "t"), EVENT_RELAID)
    lay = lambda df: target.publish(
        df.withColumn("usage_date", F.to_date("event_ts")), partition_by=layout.LAYOUT, append=True, in_cells=True
    )
    lay(bronze_rows(spark, "2025-08-01", 20_000))
    (large,) = files(target)
    for service in ("compute", "compute", "compute", "storage", None):
        lay(bronze_rows(spark, "2025-08-01", 3, service))
    assert layout.merge_small_files(target, after=3, small_bytes=os.path.getsize(large) // 2) == 1
    left = files(target)
    assert large in left and len(left) == 4  # large, merged compute, storage, no service
    assert target.read().count() == 20_000 + 15


def test_relayout_merges_by_itself(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(layout, "MERGE_AFTER", 3)
    monkeypatch.setattr(layout.merge_small_files, "__defaults__", (3, layout.SMALL_FILE_BYTES))
    bronze, checkpoint = str(tmp_path / "bronze"), str(tmp_path / "checkpoint")
    target = VersionedTable(spark, str(tmp_path / "t"), EVENT_RELAID)
    for i in range(5):
        bronze_rows(spark, "2025-08-02", 1).write.mode("append").partitionBy("ingest_date").parquet(bronze)
        assert layout.relayout(spark, bronze, target, checkpoint) == 1
    assert target.read().count() == 5 and len(files(target)) < 5


def test_scattered_parts_by_inventory():
    small = lambda d, i: Part(f"load={i}", f"usage_date={d}/service=s", 1, 1, 10)
    big = Part("load=b", "usage_date=1/service=s", 9, 1, 10**9)
    version = Version(1, "r", [*[small(1, i) for i in range(5)], *[small(2, i) for i in range(2)], big], None, "{}")
    found = layout.scattered_parts(version, after=3, small_bytes=100)
    assert found == [small(1, i) for i in range(5)]


