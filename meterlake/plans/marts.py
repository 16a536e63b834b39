"""Gold marts. Measures are aggregated first; org attributes join the few aggregated rows after."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import catalog as fixed
from ..functions.measures import carried, hits, rows, share, sum_where


def _named(mart: DataFrame, customers: DataFrame, **attributes: str) -> DataFrame:
    """Left join org attributes, given as mart column = customers column."""
    names = customers.select("org_id", *[F.col(c).alias(a) for a, c in attributes.items()])
    return mart.join(names, "org_id", "left")


def org_daily_usage(daily: DataFrame) -> DataFrame:
    renamed = ("requests", "cpu_hours", "storage_gb_hours", "genai_tokens", "carbon_kg", "daily_cost_usd")
    return daily.drop("silver_ts").withColumnsRenamed({c: f"total_{c}" for c in renamed})


def top_services(
    usage: DataFrame, days: int = fixed.TOP_SERVICES_DAYS, n: int = fixed.TOP_SERVICES
) -> DataFrame:
    """The n costliest services of each org over the days that end at the last usage date of all orgs.

    The last date is a scalar subquery of the same plan, so the date filter still prunes partitions.
    Equal costs rank by service name.
    """
    last = usage.agg(F.max("usage_date")).scalar()
    first = F.date_sub(last, days - 1)
    totals = (
        usage.where(F.col("usage_date") >= first)
        .groupBy("org_id", "service")
        .agg(F.sum("total_daily_cost_usd").alias("accumulated_cost_usd"))
    )
    order = Window.partitionBy("org_id").orderBy(
        F.col("accumulated_cost_usd").desc_nulls_last(), F.col("service").asc_nulls_first()
    )
    return (
        totals.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= n)
        .withColumns({"period_end": last, "period_start": first})
    )


def revenue(billing: DataFrame, customers: DataFrame) -> DataFrame:
    """Invoices in dollars per org and month. An unknown rate counts as one, unknown credits and taxes as
    zero; an unknown subtotal leaves the invoice's revenue unknown, which sums skip."""
    rate = F.coalesce("exchange_rate_to_usd", F.lit(1.0))
    parts = {
        "subtotal_usd": F.col("subtotal") * rate,
        "credits_usd": F.coalesce("credits", F.lit(0.0)) * rate,
        "taxes_usd": F.coalesce("taxes", F.lit(0.0)) * rate,
    }
    net = parts["subtotal_usd"] - parts["credits_usd"] + parts["taxes_usd"]
    mart = billing.groupBy("org_id", F.col("month").alias("billing_month")).agg(
        *[F.sum(amount).alias(name) for name, amount in {**parts, "revenue_usd": net}.items()],
        rows().alias("invoice_count"),
    )
    return _named(mart, customers, org_name="org_name", org_plan_tier="plan_tier")


def cost_anomalies(valid: DataFrame) -> DataFrame:
    cost, flag = F.col("cost_usd_increment"), F.col("is_cost_anomaly")
    per_test = {
        f"{test}_anomaly_count": hits(F.col(f"is_cost_anomaly_{test}"))
        for test in ("zscore", "mad", "percentile")
    }
    return (
        valid.groupBy("org_id", "usage_date", "service")
        .agg(
            carried("org_name").alias("org_name"),
            rows().alias("event_count"),
            F.sum(cost).alias("total_daily_cost_usd"),
            hits(flag).alias("anomaly_event_count"),
            sum_where(cost, flag).alias("anomaly_cost_usd"),
            *[count.alias(name) for name, count in per_test.items()],
        )
        .withColumns(
            {
                "anomaly_score": share(F.col("anomaly_event_count"), F.col("event_count")),
                "has_cost_anomaly": F.col("anomaly_event_count") > 0,
            }
        )
    )


def tickets(support: DataFrame, customers: DataFrame) -> DataFrame:
    mart = (
        support.groupBy("org_id", F.col("created_at").alias("ticket_date"), "severity")
        .agg(
            rows().alias("ticket_count"),
            hits(F.col("sla_breached")).alias("sla_breach_count"),
            F.avg("csat").alias("avg_csat"),
        )
        .withColumn("sla_breach_rate", share(F.col("sla_breach_count"), F.col("ticket_count")))
    )
    return _named(mart, customers, org_name="org_name")


def genai_use() -> Column:
    return (F.col("service") == "genai") | (F.col("genai_tokens") > 0)


def genai_tokens(valid: DataFrame) -> DataFrame:
    return (
        valid.where(genai_use())
        .groupBy("org_id", "usage_date")
        .agg(
            carried("org_name").alias("org_name"),
            F.sum("genai_tokens").alias("total_genai_tokens"),
            F.sum("cost_usd_increment").alias("estimated_cost_usd"),
            rows().alias("event_count"),
        )
    )


def nps(surveys: DataFrame, customers: DataFrame) -> DataFrame:
    mart = surveys.groupBy("org_id", "survey_date").agg(
        F.avg("nps_score").alias("avg_nps_score"),
        rows().alias("survey_count"),
        F.count("nps_score").alias("scored_count"),
    )
    return _named(mart, customers, org_name="org_name")


def marketing(touches: DataFrame, customers: DataFrame) -> DataFrame:
    mart = (
        touches.groupBy("org_id", F.to_date("timestamp").alias("touch_date"), "channel")
        .agg(
            rows().alias("touch_count"),
            hits(F.col("clicked")).alias("click_count"),
            hits(F.col("converted")).alias("conversion_count"),
        )
        .withColumns(
            {
                "click_rate": share(F.col("click_count"), F.col("touch_count")),
                "conversion_rate": share(F.col("conversion_count"), F.col("touch_count")),
            }
        )
    )
    return _named(mart, customers, org_name="org_name")


@dataclass(frozen=True)
class Mart:
    """A mart's builder, the tables it reads (by parameter), its grain, and how it reconciles: the sum of a
    measure over the rows of the first table must equal an aggregate over the mart."""

    name: str
    build: Callable[..., DataFrame]
    reads: tuple[str, ...]
    grain: tuple[str, ...]
    partition: str
    source_measure: Column | None = None
    mart_total: Column | None = None


def _marts() -> list[Mart]:
    by_service = ("org_id", "usage_date", "service")
    return [
        Mart(
            "org_daily_usage_by_service", org_daily_usage, ("org_service_daily",), by_service, "usage_date",
            F.col("daily_cost_usd"), F.sum("total_daily_cost_usd"),
        ),
        Mart(
            "org_top_services_by_cost", top_services, ("org_daily_usage_by_service",),
            ("org_id", "period_end", "rank", "service"), "period_end",
        ),
        Mart(
            "revenue_by_org_month", revenue, ("billing_monthly", "customers_orgs"),
            ("org_id", "billing_month"), "billing_month", F.lit(1), F.sum("invoice_count"),
        ),
        Mart(
            "cost_anomaly_mart", cost_anomalies, ("usage_events",), by_service, "usage_date",
            F.when(F.col("is_cost_anomaly"), 1), F.sum("anomaly_event_count"),
        ),
        Mart(
            "tickets_by_org_date", tickets, ("support_tickets", "customers_orgs"),
            ("org_id", "ticket_date", "severity"), "ticket_date", F.lit(1), F.sum("ticket_count"),
        ),
        Mart(
            "genai_tokens_by_org_date", genai_tokens, ("usage_events",), ("org_id", "usage_date"),
            "usage_date", F.when(genai_use(), F.col("genai_tokens")), F.sum("total_genai_tokens"),
        ),
        Mart(
            "nps_by_org_date", nps, ("nps_surveys", "customers_orgs"), ("org_id", "survey_date"),
            "survey_date", F.lit(1), F.sum("survey_count"),
        ),
        Mart(
            "marketing_touches_by_org_channel", marketing, ("marketing_touches", "customers_orgs"),
            ("org_id", "touch_date", "channel"), "touch_date", F.lit(1), F.sum("touch_count"),
        ),
    ]


# What is observed of a mart while it is written: its side of the reconciliation.
MART_TOTAL = "mart_total"


def source_metrics(table: str, counts: Column | None = None) -> dict[str, Column]:
    """What is observed of a table while it is written: for each mart that reconciles with it the sum of the
    mart's measure, over the rows where ``counts`` holds."""
    reading = [m for m in _marts() if m.source_measure is not None and m.reads[0] == table]
    measured = {m.name: m.source_measure for m in reading}
    return {n: F.sum(v if counts is None else F.when(counts, v)).cast("double") for n, v in measured.items()}


def mart_metrics(mart: Mart) -> dict[str, Column]:
    return {} if mart.mart_total is None else {MART_TOTAL: mart.mart_total.cast("double")}


def marts() -> dict[str, Mart]:
    """All eight marts in build order. A call, not a constant: Columns need an active session."""
    return {m.name: m for m in _marts()}
