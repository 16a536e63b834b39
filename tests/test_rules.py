from datetime import datetime

import pytest
from pyspark.sql import functions as F

from meterlake import catalog
from meterlake.catalog import EVENT_LANDING
from meterlake.operators.dedupe import SURPLUS
from meterlake.operators.rules import REASON, REASONS, Rule, apply_rules, quarantined_rows, valid_rows
from meterlake.plans import checks
from meterlake.plans.events import classify, to_bronze

AS_OF = datetime(2025, 1, 1, 12, 0, 0)
GOOD = {
    "event_id": "e",
    "value": 1.0,
    "unit": "count",
    "cost_usd_increment": 1.0,
    "event_ts": datetime(2025, 1, 1),
    "service": "compute",
    "region": "us-east",
    "org_name": "acme",
    "resource_id": "r",
    "resource_service": "compute",
    "event_latency_sec": 0,
    SURPLUS: False,
}
SCHEMA = (
    "event_id string, value double, unit string, cost_usd_increment double, event_ts timestamp, service string, "
    f"region string, org_name string, resource_id string, resource_service string, event_latency_sec bigint, {SURPLUS} boolean"
)


@pytest.mark.parametrize(
    ("change", "reason"),
    [
        ({}, None),
        ({"event_id": None}, catalog.NULL_EVENT_ID),
        ({SURPLUS: True}, catalog.DUPLICATE_EVENT_ID),
        ({"unit": None}, catalog.VALUE_WITHOUT_UNIT),
        ({"unit": None, "value": None}, None),
        ({"cost_usd_increment": -0.01}, None),
        ({"cost_usd_increment": -0.011}, catalog.COST_BELOW_MINIMUM),
        ({"cost_usd_increment": None}, None),
        ({"event_ts": None}, catalog.BAD_EVENT_TS),
        ({"service": "foo"}, catalog.UNKNOWN_SERVICE),
        ({"service": None}, None),
        ({"region": "moon"}, catalog.UNKNOWN_REGION),
        ({"region": None}, None),
        ({"org_name": None}, catalog.UNKNOWN_ORG),
        ({"resource_service": None}, catalog.UNKNOWN_RESOURCE),
        ({"resource_service": None, "resource_id": None}, None),
        ({"event_latency_sec": 1800}, None),
        ({"event_latency_sec": 1801}, catalog.TOO_LATE),
        ({"event_latency_sec": None}, None),
        ({"event_ts": datetime(2025, 1, 1, 12, 5, 0)}, None),
        ({"event_ts": datetime(2025, 1, 1, 12, 5, 1)}, catalog.IN_THE_FUTURE),
        ({"cost_usd_increment": -1.0, "region": "moon", "event_latency_sec": 9999}, catalog.COST_BELOW_MINIMUM),
        ({"org_name": None, "resource_service": None}, catalog.UNKNOWN_ORG),
    ],
)
def test_event_rules(spark, change, reason):
    row = {**GOOD, **change}
    df = spark.createDataFrame([tuple(row.values())], SCHEMA)
    found = classify(df, F.lit(AS_OF).cast("timestamp")).first()
    assert found[REASON] == reason
    assert (found[REASONS] == []) == (reason is None)


def test_first_broken_rule_is_the_reason_and_all_are_kept(spark, rows):
    df = spark.createDataFrame([(1,), (5,), (None,)], "n int")
    ruled = apply_rules(df, [Rule("big", F.col("n") > 3), Rule("odd", F.col("n") % 2 == 1)])
    assert rows(ruled.select("n", REASON, F.array_join(REASONS, "+"))) == [
        (1, "odd", "odd"),
        (5, "big", "big+odd"),
        (None, None, ""),
    ]
    assert valid_rows(ruled).count() + quarantined_rows(ruled).count() == 3
    assert valid_rows(ruled).columns == ["n"]


def test_quarantine_sample_and_counts(spark, rows):
    df = spark.createDataFrame([(str(i), "o", "m", 1.0, "u", i) for i in range(9)],
        "event_id string, org_id string, metric string, value double, unit string, n int")
    bad = quarantined_rows(apply_rules(df, [Rule("small", F.col("n") < 3), Rule("big", F.col("n") > 4)]))
    assert checks.quarantine_sample(bad).count() == 5
    assert rows(checks.reason_counts(bad)) == [("big", 4), ("small", 3)]


def test_lateness_tiers(spark, rows):
    delays = {"a": 600, "b": 601, "c": 1801, "d": None}
    data = [(e, "2025-01-01T00:00:00", d) for e, d in delays.items()] + [("x", "bad", 5)]
    df = spark.createDataFrame(data, "event_id string, timestamp string, delay int")
    for field in EVENT_LANDING:
        if field.name not in df.columns:
            df = df.withColumn(field.name, F.lit(None).cast(field.dataType))
    arrival = F.col("event_ts") + F.make_dt_interval(secs=F.col("delay"))
    assert rows(to_bronze(df, arrival), "event_id", "event_latency_sec", "is_late_arrival") == [
        ("a", 600, False),
        ("b", 601, True),
        ("c", 1801, True),
        ("d", None, None),
        ("x", None, None),
    ]
    replay = to_bronze(df).where("event_id = 'c'").first()
    assert (replay["event_latency_sec"], replay["is_late_arrival"]) == (0, False)
