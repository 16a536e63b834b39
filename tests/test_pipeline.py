from datetime import date
from pathlib import Path

import pytest
from landing import FIRST, SECOND, add_events, event, write_landing
from pyspark.sql import functions as F

from meterlake import catalog
from meterlake.plans import checks
from meterlake.plans.layout import merge_small_files
from meterlake.plans.masters import bronze_master, with_lineage
from meterlake.plans.pipeline import Lake
from meterlake.session import work_folder


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    write_landing(root)
    lake = Lake(spark, str(root))
    lake.folder = root
    ingested = lake.run(as_of=F.lit("2025-08-12 00:00:00").cast("timestamp"))
    assert ingested.input_rows == len(FIRST)
    assert ingested.relaid
    return lake


def test_masters_are_split(lake, rows):
    assert rows(lake.silver("users"), "user_id") == [("u1",), ("u2",), ("u3",)]
    assert rows(lake.quarantine("users"), "user_id", "error_reason") == [
        ("u4", catalog.UNKNOWN_ORG),
        ("u5", catalog.UNKNOWN_ORG),
        (None, catalog.NULL_KEY),
    ]
    assert rows(lake.silver("nps_surveys"), "org_id", "survey_date") == [
        ("o1", date(2025, 8, 1)),
        ("o1", date(2025, 8, 2)),
        ("o2", date(2025, 8, 1)),
    ]


def test_masters_are_typed_and_conformed(lake, rows):
    assert rows(
        lake.silver("customers_orgs"), "org_id", "org_name", "hq_region", "is_enterprise", "signup_date", "nps_score"
    ) == [
        ("o1", "acme", "us-east", True, date(2024, 1, 5), 8.5),
        ("o2", "beta", "eu-west", True, None, None),
        ("o3", None, "eu-west", False, None, None),
    ]


def test_every_event_has_one_outcome(lake, rows):
    assert rows(lake.quarantine("usage_events"), "event_id", "error_reason") == sorted(
        [
            (None, catalog.NULL_EVENT_ID),
            (None, catalog.NULL_EVENT_ID),
            ("e5", catalog.VALUE_WITHOUT_UNIT),
            ("e6", catalog.COST_BELOW_MINIMUM),
            ("e7", catalog.BAD_EVENT_TS),
            ("e8", catalog.UNKNOWN_SERVICE),
            ("e9", catalog.UNKNOWN_REGION),
            ("e10", catalog.UNKNOWN_ORG),
            ("e11", catalog.UNKNOWN_RESOURCE),
            ("e12", catalog.IN_THE_FUTURE),
            ("e14", catalog.UNKNOWN_SERVICE),
            ("e16", catalog.VALUE_WITHOUT_UNIT),
        ],
        key=repr,
    )
    multi = lake.quarantine("usage_events").where("event_id = 'e16'").first()
    assert multi["error_reasons"] == [
        catalog.VALUE_WITHOUT_UNIT,
        catalog.COST_BELOW_MINIMUM,
        catalog.UNKNOWN_REGION,
    ]
    assert rows(lake.silver("usage_events"), "event_id") == sorted(
        [("e1",), ("e2",), ("e3",), ("e4",), ("e13",), ("e15",), ("e17",)]
    )


def test_enrichment(lake, rows):
    found = lake.silver("usage_events").where("event_id in ('e2', 'e3', 'e4')")
    assert rows(
        found, "event_id", "service", "cpu_hours", "genai_tokens", "carbon_kg", "org_user_count", "org_active_user_count"
    ) == [
        ("e2", "compute", 109.0, 0, 0.5, 2, 1),
        ("e3", "compute", 0.0, 0, 0.0, 2, 1),
        ("e4", "genai", 0.0, 7, 0.5, 1, 1),
    ]


def test_all_checks_pass(lake, rows):
    for suite in (lake.check_bronze(), lake.check_silver(), lake.check_gold(), lake.check_serving()):
        assert rows(checks.failed(suite)) == []


def test_revenue(lake, rows):
    found = rows(lake.mart("revenue_by_org_month"), "org_id", "billing_month", "revenue_usd", "invoice_count")
    assert [(o, m, round(r, 6), n) for o, m, r, n in found] == [
        ("o1", date(2025, 7, 1), 95.0 + 220.0, 3),
        ("o2", date(2025, 8, 1), 102.0, 1),
    ]


def test_lookups(lake, rows):
    p = lake.lookup_parameters("o1")
    assert p.ticket_period == (date(2025, 7, 12), date(2025, 8, 10))
    assert p.top_period == (date(2025, 7, 30), date(2025, 8, 12))
    found = lake.lookups(p)
    assert rows(found["critical_tickets_sla"]) == [(date(2025, 8, 10), 2, 1, 0.5, 4.0)]
    assert rows(found["top_services_by_cost"], "service", "rank") == [("compute", 1)]
    assert rows(found["daily_costs_and_requests"], "usage_date", "service") == [
        (date(2025, 8, 10), "compute"),
        (date(2025, 8, 12), "compute"),
    ]
    assert p.revenue_period == (date(2025, 7, 1), date(2025, 7, 1))
    assert rows(found["monthly_revenue"], "invoice_count") == [(3,)]
    nobody = lake.lookup_parameters("none")
    assert nobody.ticket_period == nobody.revenue_period == (None, None)
    assert all(rows(answer) == [] for answer in lake.lookups(nobody).values())


def test_counters(lake, rows):
    counted = {r["dataset"]: r["removed_duplicates"] for r in lake.master_counters().collect()}
    assert counted.pop("customers_orgs") == 1 and set(counted.values()) == {0}
    events = lake.event_counters().first()
    assert (events["raw_count"], events["valid_count"], events["quarantine_count"]) == (len(FIRST), 7, 12)
    assert sum(r["n"] for r in lake.reason_counts("usage_events").collect()) == 12
    assert lake.quarantine_sample(3).count() == 3


def test_masters_without_key_all_stay(spark, rows):
    users = catalog.MASTERS["users"]
    data = [(None, "o1", "x"), (None, "o1", "x"), (None, "o2", "y"), ("u1", "o1", "a"), ("u1", "o1", "b")]
    landed = spark.createDataFrame(data, "user_id string, org_id string, email string")
    stamped = with_lineage(landed, F.lit("f"), F.lit("2025-01-01").cast("timestamp"))
    assert rows(bronze_master(stamped, users), "user_id", "org_id", "email") == [
        ("u1", "o1", "b"),
        (None, "o1", "x"),
        (None, "o1", "x"),
        (None, "o2", "y"),
    ]


def test_rerun_changes_nothing_then_new_events_arrive(lake, rows):
    before = lake.snapshot()
    again = lake.run(as_of=F.lit("2025-08-12 00:00:00").cast("timestamp"))
    assert (again.input_rows, again.relaid) == (0, False)
    compared = checks.compare_snapshots(before, lake.snapshot())
    assert rows(compared.where("not ok")) == []

    add_events(lake.folder, "part-2", SECOND)
    more = lake.run(as_of=F.lit("2025-08-12 00:00:00").cast("timestamp"))
    assert (more.input_rows, more.relaid) == (len(SECOND), True)
    assert more.bronze_rows == len(FIRST) + len(SECOND) - 1
    assert rows(lake.mart("genai_tokens_by_org_date"), "org_id", "total_genai_tokens", "event_count") == [
        ("o1", 5, 2),
        ("o2", 7, 1),
    ]
    for suite in (lake.check_bronze(), lake.check_silver(), lake.check_gold()):
        assert rows(checks.failed(suite)) == []


def test_reset_replays_into_a_new_run(lake):
    replay = lake.ingest_events(reset=True)
    assert replay.input_rows == len(FIRST) + len(SECOND)
    assert replay.bronze_rows == len(FIRST) + len(SECOND) - 1


def files_of(table):
    found = table.read(row_id=False).select(F.input_file_name().alias("f")).distinct().collect()
    return {r["f"] for r in found}


def test_folders_merge_and_old_versions_go(lake, rows):
    table = lake.bronze_events_table()
    before = rows(table.read(), "event_id", "usage_date", "service", "value")
    add_events(lake.folder, "part-3", [event("e30"), event("e31", resource_id=None, service="ai")])
    assert lake.ingest_events().input_rows == 2
    assert len(table.current().folders) == 2
    files = {f for f in files_of(table)}
    crowded = {p.cell.split("/")[0] for p in table.current().parts if p.folder == table.current().parts[-1].folder}
    assert merge_small_files(table, after=1) >= 1
    assert merge_small_files(table, after=1) == 0
    assert len(table.current().folders) == 2
    kept = {f for f in files if f"/{next(iter(crowded))}/" not in f}
    assert kept and kept <= files_of(table)
    assert len(rows(table.read(), "event_id", "usage_date", "service", "value")) == len(before) + 2
    assert lake.expire(keep=1) > 0
    assert table.read().count() == len(before) + 2
    assert rows(checks.failed(lake.check_gold())) == []


def test_no_scratch_is_left(lake, spark):
    left = [p.name for p in Path(work_folder(spark)).iterdir() if p.name.startswith("serving-")]
    assert left == []


def test_missing_events_are_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="ingest"):
        Lake(spark, str(tmp_path)).bronze_events()
