from datetime import date, timedelta

import pytest

from meterlake import catalog
from meterlake.plans import checks, marts

DAY = date(2025, 8, 31)


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame([("o1", "acme", "pro"), ("o2", "beta", "free")], "org_id string, org_name string, plan_tier string")


def test_revenue_defaults(spark, customers, rows):
    billing = spark.createDataFrame(
        [
            ("o1", DAY, 100.0, 10.0, 5.0, None),
            ("o1", DAY, 100.0, None, None, 2.0),
            ("o1", DAY, None, 1.0, 1.0, 3.0),
            ("o9", DAY, None, 1.0, 1.0, 1.0),
        ],
        "org_id string, month date, subtotal double, credits double, taxes double, exchange_rate_to_usd double",
    )
    assert rows(
        marts.revenue(billing, customers),
        "org_id", "org_name", "org_plan_tier", "subtotal_usd", "credits_usd", "taxes_usd", "revenue_usd", "invoice_count",
    ) == [
        ("o1", "acme", "pro", 300.0, 13.0, 8.0, 295.0, 3),
        ("o9", None, None, None, 1.0, 1.0, None, 1),
    ]


def test_tickets(spark, customers, rows):
    tickets = spark.createDataFrame(
        [("o1", DAY, "high", 4.0, True), ("o1", DAY, "high", None, False), ("o1", DAY, "low", None, True)],
        "org_id string, created_at date, severity string, csat double, sla_breached boolean",
    )
    found = marts.tickets(tickets, customers)
    assert rows(found, "severity", "ticket_count", "sla_breach_count", "avg_csat", "sla_breach_rate") == [
        ("high", 2, 1, 4.0, 0.5),
        ("low", 1, 1, None, 1.0),
    ]


def test_genai_takes_the_service_or_the_tokens(spark, rows):
    valid = spark.createDataFrame(
        [
            ("o1", DAY, "genai", 0, 1.0, "acme"),
            ("o1", DAY, "storage", 5, 2.0, "acme"),
            ("o1", DAY, "storage", 0, 4.0, "acme"),
            ("o1", DAY, None, 7, 8.0, "acme"),
            ("o1", DAY, None, 0, 16.0, "acme"),
        ],
        "org_id string, usage_date date, service string, genai_tokens bigint, cost_usd_increment double, org_name string",
    )
    found = marts.genai_tokens(valid)
    assert rows(found, "total_genai_tokens", "estimated_cost_usd", "event_count") == [(12, 11.0, 3)]


def test_nps_counts_scored_surveys(spark, customers, rows):
    surveys = spark.createDataFrame(
        [("o1", DAY, 9.0), ("o1", DAY, None), ("o2", DAY, None)], "org_id string, survey_date date, nps_score double"
    )
    assert rows(marts.nps(surveys, customers), "org_id", "avg_nps_score", "survey_count", "scored_count") == [
        ("o1", 9.0, 2, 1),
        ("o2", None, 1, 0),
    ]


def test_marketing_rates(spark, customers, rows):
    touches = spark.sql(
        "SELECT 'o1' org_id, timestamp '2025-08-31 23:59:59' timestamp, 'ads' channel, c clicked, v converted "
        "FROM VALUES (true, false), (true, true), (false, false), (false, false) t(c, v)"
    )
    found = marts.marketing(touches, customers)
    assert rows(found, "touch_date", "touch_count", "click_rate", "conversion_rate") == [(DAY, 4, 0.5, 0.25)]


def usage(spark, data):
    return spark.createDataFrame(
        data, "org_id string, usage_date date, service string, total_daily_cost_usd double"
    )


def test_top_services_window_ties_and_limit(spark, rows):
    data = [("o1", DAY, s, c) for s, c in zip("abcdef", (1.0, 5.0, 5.0, 3.0, 2.0, 4.0))]
    data += [("o2", DAY - timedelta(days=13), "in", 1.0), ("o2", DAY - timedelta(days=14), "out", 9.0)]
    found = marts.top_services(usage(spark, data))
    assert rows(found.orderBy("org_id", "rank"), "org_id", "rank", "service") == [
        ("o1", 1, "b"),
        ("o1", 2, "c"),
        ("o1", 3, "f"),
        ("o1", 4, "d"),
        ("o1", 5, "e"),
        ("o2", 1, "in"),
    ]
    assert rows(found.select("period_start", "period_end").distinct()) == [(DAY - timedelta(days=13), DAY)]


def test_top_services_of_nothing(spark):
    assert marts.top_services(usage(spark, [])).isEmpty()


def test_top_services_plan(spark, tmp_path, plan):
    """The rank is limited before its shuffle, the last date is a subquery that prunes partitions, and
    there is no cross join."""
    path = str(tmp_path / "usage")
    usage(spark, [("o1", DAY, "a", 1.0)]).write.partitionBy("usage_date").parquet(path)
    text = plan(marts.top_services(spark.read.parquet(path)))
    assert "WindowGroupLimit" in text
    assert "PartitionFilters: [isnotnull(usage_date" in text and "Subquery" in text
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_cost_anomaly_score(spark, rows):
    flags = "is_cost_anomaly boolean, is_cost_anomaly_zscore boolean, is_cost_anomaly_mad boolean, is_cost_anomaly_percentile boolean"
    valid = spark.createDataFrame(
        [("o", DAY, "s", "n", 10.0, True, True, False, True), ("o", DAY, "s", "n", 2.0, False, False, False, False)],
        f"org_id string, usage_date date, service string, org_name string, cost_usd_increment double, {flags}",
    )
    found = marts.cost_anomalies(valid)
    assert rows(
        found, "event_count", "total_daily_cost_usd", "anomaly_cost_usd", "anomaly_score", "has_cost_anomaly",
        "zscore_anomaly_count", "mad_anomaly_count", "percentile_anomaly_count",
    ) == [(2, 12.0, 10.0, 0.5, True, 1, 0, 1)]


def test_marts_join_names_after_they_aggregate(spark, customers, plan):
    tickets = spark.createDataFrame(
        [("o1", DAY, "high", 4.0, True)],
        "org_id string, created_at date, severity string, csat double, sla_breached boolean",
    )
    text = plan(marts.tickets(tickets, customers), "extended").split("== Optimized")[1].split("== Physical")[0]
    assert text.index("Join") < text.index("Aggregate")


def test_checks_tell_good_from_bad(spark, rows):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", 3.0), (None, None)], "k string, v double")
    found = checks.suite(
        [
            checks.unique(df, "t", ["k"]),
            checks.unique(df, "t", ["k", "v"]),
            checks.has_columns(df, "t", ["k", "v"]),
            checks.has_columns(df, "t", ["k", "w"]),
            checks.balance(df, [df.where("k = 'a'"), df.where("k = 'b'")], "t"),
            checks.observed(spark, "t", "near", 6.0, 6.009, catalog.BALANCE_TOLERANCE),
            checks.observed(spark, "t", "far", 6.0, 6.011, catalog.BALANCE_TOLERANCE),
            checks.observed(spark, "t", "empty", None, 0.0, catalog.BALANCE_TOLERANCE),
        ]
    )
    assert [r["ok"] for r in found.collect()] == [False, True, True, False, False, True, False, True]
    assert rows(checks.failed(found), "check", "expected", "actual")[-1] == ("unique by k", 4.0, 3.0)
    assert checks.missing_columns(df, ["w", "k"]) == ["w"]


def test_snapshots(spark, rows):
    before = spark.createDataFrame([("a", 1), ("b", 2)], "metric string, n bigint")
    after = spark.createDataFrame([("a", 1), ("c", 2)], "metric string, n bigint")
    assert rows(checks.compare_snapshots(before, after), "metric", "ok") == [("a", True), ("b", False), ("c", False)]
