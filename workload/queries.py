"""Registered queries: silver, gold and lookups. Each runs over its whole tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.catalog import BALANCE_TOLERANCE, MASTERS
from meterlake.functions.parse import typed
from meterlake.functions.text import conform
from meterlake.operators import anomaly, sketches
from meterlake.operators.dedupe import SURPLUS, drop_copies, keep_latest, mark_surplus
from meterlake.operators.lookup import without_match
from meterlake.operators.rules import REASON, REASONS, quarantined_rows, valid_rows
from meterlake.plans import checks, events, marts, serving
from meterlake.plans.masters import classify_master, with_lineage
from meterlake.session import fresh_path, settle, settle_observed
from meterlake.sources.tables import ROW_ID, read_parquet, with_row_id
from meterlake.sources.versioned import VersionedTable

from .proxies import AS_OF, billing, bronze, bronze_events, landed, silver, table
from .registry import query, rounded, rounded_sql

ORG = "org-3"


# Shared steps -----------------------------------------------------------------------------------------
def _event_inputs(spark: SparkSession, sf: str, customers: DataFrame | None = None) -> list[DataFrame]:
    """Bronze events, customers, resources and users. Customers, which several steps read, are stored first,
    as they are in the lake, unless they are given; each pass over events parses the columns it needs."""
    if customers is None:
        customers = settle(silver(spark, sf, "customers_orgs"), "customers")
    masters = [silver(spark, sf, name, customers) for name in ("resources", "users")]
    return [bronze_events(spark, sf), customers, *masters]


def enriched(spark: SparkSession, sf: str) -> DataFrame:
    bronze_rows, *masters = _event_inputs(spark, sf)
    return events.enrich(bronze_rows, events.dimensions(*masters))


def classified(spark: SparkSession, sf: str, customers: DataFrame | None = None) -> DataFrame:
    return events.silver_events(*_event_inputs(spark, sf, customers), as_of=F.lit(AS_OF).cast("timestamp"))


def valid(spark: SparkSession, sf: str, customers: DataFrame | None = None) -> DataFrame:
    return valid_rows(classified(spark, sf, customers))


def daily(spark: SparkSession, sf: str) -> DataFrame:
    return events.service_daily(valid(spark, sf))


def usage(spark: SparkSession, sf: str) -> DataFrame:
    return marts.org_daily_usage(daily(spark, sf))


def tickets_mart(spark: SparkSession, sf: str) -> DataFrame:
    return marts.tickets(silver(spark, sf, "support_tickets"), silver(spark, sf, "customers_orgs"))


def served(mart: DataFrame, name: str) -> DataFrame:
    """The mart as its serving table, stored in key order and read back. Rows that it refuses stay behind."""
    spec = serving.SERVING[name]
    if "gold_ts" in spec.schema.names:
        mart = mart.withColumn("gold_ts", F.lit(AS_OF).cast("timestamp"))
    return settle(serving.laid_out(serving.to_serving(mart, spec), spec), name)


# Parsing, text and lineage ----------------------------------------------------------------------------
@query(
    "typed_casts",
    f"""SELECT ticket_id, created_at, resolved_at, {rounded_sql("csat")}, sla_breached FROM tickets_typed""",
)
def typed_casts(spark, sf):
    tickets = typed(landed(spark, sf, "support_tickets"), MASTERS["support_tickets"].typed)
    return tickets.select("ticket_id", "created_at", "resolved_at", *rounded("csat"), "sla_breached")


@query("normalize_strings", "SELECT src, service, region, metric, unit FROM bronze")
def normalize_strings(spark, sf):
    raw = landed(spark, sf, "usage_events")
    return conform(raw, events.EVENT_TEXT).select("src", *events.EVENT_TEXT)


@query(
    "lineage_columns",
    f"""SELECT event_id AS src, 'landing/usage_events_stream/events.parquet' AS source_file,
               DATE '{AS_OF[:10]}' AS ingest_date FROM events""",
)
def lineage_columns(spark, sf):
    label = F.concat(F.lit("landing/usage_events_stream/"), F.col("_metadata.file_name"))
    stamped = with_lineage(table(spark, sf, "events"), label, F.lit(AS_OF).cast("timestamp"))
    return stamped.select(F.col("event_id").alias("src"), "source_file", "ingest_date")


@query(
    "schema_evolution_union",
    """SELECT src, schema_version, coalesce(genai_tokens, 0) AS genai_tokens, coalesce(carbon_kg, 0) AS carbon_kg
       FROM events_raw""",
)
def schema_evolution_union(spark, sf):
    """Files of two schema versions in one folder, read with the newer schema."""
    rows = landed(spark, sf, "usage_events").select(
        "src", "schema_version", "metric", F.lit(0.0).alias("value"), "genai_tokens", "carbon_kg"
    )
    path = fresh_path(spark, "two-schemas")
    older = F.col("schema_version") == 1
    rows.where(older).drop("genai_tokens", "carbon_kg").write.parquet(path)
    rows.where(~older).write.mode("append").parquet(path)
    both = events.metric_features(read_parquet(spark, path, rows.schema))
    return both.select("src", "schema_version", "genai_tokens", "carbon_kg")


# Dedupe and keys --------------------------------------------------------------------------------------
_LINE_ORDER = (
    "l_shipdate l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus"
).split()
_LINE_RANK = (
    "row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY "
    + ", ".join(f"{c} DESC NULLS LAST" for c in _LINE_ORDER)
    + ")"
)
_LINE_COLUMNS = ["l_orderkey", "l_linenumber", *[c for c in _LINE_ORDER if c != "l_shipdate"]]
_LINE_PICK = f"{', '.join(_LINE_COLUMNS)}, l_shipdate::DATE AS l_shipdate"


@query("dedupe_latest", f"SELECT {_LINE_PICK} FROM (SELECT *, {_LINE_RANK} AS nth FROM lineitem) WHERE nth = 1")
def dedupe_latest(spark, sf):
    kept = keep_latest(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], _LINE_ORDER)
    return kept.select(*_LINE_COLUMNS, F.to_date("l_shipdate").alias("l_shipdate"))


@query("duplicate_extract", f"SELECT {_LINE_PICK} FROM (SELECT *, {_LINE_RANK} AS nth FROM lineitem) WHERE nth > 1")
def duplicate_extract(spark, sf):
    lines = with_row_id(table(spark, sf, "lineitem"))
    surplus = mark_surplus(lines, ["l_orderkey", "l_linenumber"], _LINE_ORDER).where(SURPLUS)
    return surplus.select(*_LINE_COLUMNS, F.to_date("l_shipdate").alias("l_shipdate"))


@query("drop_copies", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def copies_dropped(spark, sf):
    """Of the columns named, those that the table has."""
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber")
    return drop_copies(lines, [*lines.columns, "l_not_there"])


@query(
    "union_missing_columns",
    """SELECT src, schema_version, metric, CASE WHEN schema_version = 2 THEN carbon_kg END AS carbon_kg,
              CASE WHEN schema_version = 2 THEN genai_tokens END AS genai_tokens
       FROM events_raw""",
)
def union_missing_columns(spark, sf):
    """Frames of two schema versions by name; what the older lacks is null."""
    rows = landed(spark, sf, "usage_events").select(
        "src", "schema_version", "metric", "carbon_kg", "genai_tokens"
    )
    older = rows.where("schema_version = 1").drop("carbon_kg", "genai_tokens")
    return older.unionByName(rows.where("schema_version = 2"), allowMissingColumns=True)


@query(
    "orphan_antijoin",
    """SELECT user_id, org_id FROM users_typed u
       WHERE NOT EXISTS (SELECT 1 FROM customers c WHERE c.org_id = u.org_id)""",
)
def orphan_antijoin(spark, sf):
    users, customers = bronze(spark, sf, "users"), silver(spark, sf, "customers_orgs")
    return without_match(users, customers, ["org_id"]).select("user_id", "org_id")


@query(
    "master_conform",
    """SELECT user_id, u.org_id, email, role, active, created_at, last_login,
              CASE WHEN user_id IS NULL THEN 'null primary key'
                   WHEN c.org_id IS NULL THEN 'org_id not found in customers_orgs' END AS error_reason
       FROM users_typed u LEFT JOIN customers c ON u.org_id = c.org_id""",
)
def master_conform(spark, sf):
    users, customers = bronze(spark, sf, "users"), silver(spark, sf, "customers_orgs")
    return classify_master(users, MASTERS["users"], customers).drop(REASONS)


@query(
    "customers_typed",
    f"""SELECT org_id, org_name, industry, hq_region, plan_tier, lifecycle_stage, is_enterprise, signup_date,
               {rounded_sql("nps_score")} FROM customers""",
)
def customers_typed(spark, sf):
    found = silver(spark, sf, "customers_orgs").drop("sales_rep", "marketing_source")
    return found.withColumn("nps_score", F.round("nps_score", 6))


@query(
    "billing_conform",
    f"""SELECT invoice_id, org_id, month, {rounded_sql("subtotal credits taxes exchange_rate_to_usd")}
        FROM billing""",
)
def billing_conform(spark, sf):
    """Invoices of silver: latest per id, of known orgs."""
    amounts = rounded("subtotal credits taxes exchange_rate_to_usd")
    return billing(spark, sf).select("invoice_id", "org_id", "month", *amounts)


# Enrichment -------------------------------------------------------------------------------------------
@query("org_user_stats", "SELECT * FROM user_stats")
def org_user_stats(spark, sf):
    return events.user_statistics(silver(spark, sf, "users"))


@query(
    "metric_features",
    f"SELECT src, {rounded_sql('requests cpu_hours storage_gb_hours carbon_kg')}, genai_tokens FROM enriched",
)
def metric_features(spark, sf):
    filled = events.metric_features(bronze_events(spark, sf))
    return filled.select("src", *rounded("requests cpu_hours storage_gb_hours carbon_kg"), "genai_tokens")


_ENRICHED = (
    "src, event_id, org_id, resource_id, service, region, metric, unit, value, cost_usd_increment, usage_date, "
    "org_name, org_industry, org_plan_tier, org_lifecycle_stage, org_hq_region, resource_service, resource_state, "
    "org_user_count, org_active_user_count, genai_tokens"
)


@query("enrich_events", f"SELECT {_ENRICHED} FROM enriched")
def enrich_events(spark, sf):
    return enriched(spark, sf).select(*_ENRICHED.split(", "))


# Anomalies --------------------------------------------------------------------------------------------
_STATS = "p01_cost median_cost p99_cost mean_cost std_cost"


@query("cost_percentiles", f"SELECT org_id, service, {rounded_sql(_STATS)} FROM cost_stats")
def cost_percentiles(spark, sf):
    return anomaly.cost_statistics(enriched(spark, sf)).select("org_id", "service", *rounded(_STATS))


@query("cost_mad", f"SELECT org_id, service, {rounded_sql('mad_cost')} FROM cost_mads")
def cost_mad(spark, sf):
    rows = settle(enriched(spark, sf).select("org_id", "service", anomaly.COST, *ROW_ID), "costs")
    stats = settle(anomaly.cost_statistics(rows), "cost-statistics")
    return anomaly.median_deviation(rows, stats).select("org_id", "service", *rounded("mad_cost"))


@query(
    "carried_statistics",
    f"""SELECT org_id, service, {rounded_sql(_STATS + " mad_cost")}
        FROM cost_stats JOIN cost_mads USING (org_id, service)""",
)
def carried_statistics(spark, sf):
    """Two days are missing, then come with events of theirs that were there already; the other days'
    summaries are kept, and the profile covers all days."""
    rows = settle(enriched(spark, sf).select("org_id", "service", sketches.DAY, anomaly.COST), "costs")
    late = [r[0] for r in rows.select(sketches.DAY).distinct().orderBy(F.desc(sketches.DAY)).limit(2).collect()]
    is_late = F.coalesce(F.col(sketches.DAY).isin(late), F.lit(False))
    table_ = VersionedTable(spark, fresh_path(spark, "cost-summaries"))
    sketches.carry_on(table_, rows.where(~is_late | (F.col(anomaly.COST) > 50)), ())
    sketches.carry_on(table_, rows.where(is_late), {sketches.day_cell(d) for d in late})
    found = sketches.merged_profile(table_.read())
    return found.select("org_id", "service", *rounded(_STATS + " mad_cost"))


_FLAGS = (
    "is_cost_anomaly_zscore, is_cost_anomaly_mad, is_cost_anomaly_percentile, is_cost_anomaly_p99_x, is_cost_anomaly"
)


@query("cost_anomaly_flags", f"SELECT src, org_id, service, {_FLAGS} FROM flagged")
def cost_anomaly_flags(spark, sf):
    rows = settle(enriched(spark, sf).select("src", "org_id", "service", anomaly.COST, *ROW_ID), "costs")
    return anomaly.flag_cost_anomalies(rows).select("src", "org_id", "service", *_FLAGS.split(", "))


# Lateness and quarantine ------------------------------------------------------------------------------
@query(
    "late_arrival_flags",
    """SELECT src, event_latency_sec, event_latency_sec > 600 AS is_late_arrival, ingest_ts::DATE AS ingest_date
       FROM bronze""",
)
def late_arrival_flags(spark, sf):
    return bronze_events(spark, sf).select("src", "event_latency_sec", "is_late_arrival", "ingest_date")


@query(
    "quarantine_split",
    """SELECT src, event_id, service, region, cost_usd_increment,
              CASE WHEN len(reasons) = 0 THEN 'valid' ELSE 'quarantined' END AS outcome,
              reasons[1] AS error_reason, all_reasons
       FROM classified""",
)
def quarantine_split(spark, sf):
    return classified(spark, sf).select(
        "src",
        "event_id",
        "service",
        "region",
        "cost_usd_increment",
        F.when(F.col(REASON).isNull(), "valid").otherwise("quarantined").alias("outcome"),
        REASON,
        F.array_join(REASONS, "; ").alias("all_reasons"),
    )


@query(
    "quarantine_reason_counts",
    """SELECT reasons[1] AS error_reason, count(*)::BIGINT AS n FROM classified
       WHERE len(reasons) > 0 GROUP BY reasons[1]""",
)
def quarantine_reason_counts(spark, sf):
    return checks.reason_counts(quarantined_rows(classified(spark, sf)))


@query(
    "quarantine_sample",
    """SELECT event_id, org_id, metric, value, unit, reasons[1] AS error_reason FROM classified
       WHERE len(reasons) > 0
       ORDER BY event_id NULLS FIRST, org_id NULLS FIRST, metric NULLS FIRST, value NULLS FIRST,
                unit NULLS FIRST, reasons[1] LIMIT 50""",
)
def quarantine_sample(spark, sf):
    return checks.quarantine_sample(quarantined_rows(classified(spark, sf)), 50)


# Features and marts -----------------------------------------------------------------------------------
_DAILY = "daily_cost_usd requests cpu_hours storage_gb_hours carbon_kg"


@query(
    "org_service_daily",
    f"""SELECT org_id, usage_date, service, org_name, org_industry, org_plan_tier, {rounded_sql(_DAILY, 4)},
               genai_tokens, event_count, anomaly_event_count, has_cost_anomaly FROM daily""",
)
def org_service_daily(spark, sf):
    found = daily(spark, sf)
    return found.withColumns(dict(zip(_DAILY.split(), rounded(_DAILY, 4))))


@query(
    "mart_org_daily_usage",
    """SELECT org_id, usage_date, service, org_name, org_industry, org_plan_tier, event_count,
              round(daily_cost_usd, 4) AS total_daily_cost_usd, round(requests, 4) AS total_requests,
              round(cpu_hours, 4) AS total_cpu_hours, round(storage_gb_hours, 4) AS total_storage_gb_hours,
              genai_tokens AS total_genai_tokens, round(carbon_kg, 4) AS total_carbon_kg, anomaly_event_count,
              has_cost_anomaly FROM daily""",
)
def mart_org_daily_usage(spark, sf):
    names = [f"total_{c}" for c in _DAILY.split()]
    return usage(spark, sf).withColumns(dict(zip(names, rounded(" ".join(names), 4))))


_TOPS = "org_id, service, rank, period_start, period_end"


@query("top_services", f"SELECT {_TOPS}, {rounded_sql('accumulated_cost_usd', 4)} FROM tops")
def top_services(spark, sf):
    found = marts.top_services(settle(usage(spark, sf), "usage"))
    return found.select(*_TOPS.split(", "), *rounded("accumulated_cost_usd", 4))


@query(
    "top_org",
    """SELECT org_id, round(sum(daily_cost_usd), 4) AS total_cost_usd FROM daily GROUP BY org_id
       ORDER BY sum(daily_cost_usd) DESC NULLS LAST, org_id LIMIT 1""",
)
def top_org(spark, sf):
    return serving.top_org(usage(spark, sf)).select("org_id", *rounded("total_cost_usd", 4))


_MONEY = "subtotal_usd credits_usd taxes_usd revenue_usd"


@query(
    "mart_revenue",
    f"""SELECT org_id, billing_month, org_name, org_plan_tier, {rounded_sql(_MONEY)}, invoice_count
        FROM revenue_mart""",
)
def mart_revenue(spark, sf):
    found = marts.revenue(billing(spark, sf), silver(spark, sf, "customers_orgs"))
    return found.withColumns(dict(zip(_MONEY.split(), rounded(_MONEY))))


_ANOMALY_MONEY = "total_daily_cost_usd anomaly_cost_usd"


@query(
    "mart_cost_anomaly",
    f"""SELECT org_id, usage_date, service, org_name, event_count, {rounded_sql(_ANOMALY_MONEY, 4)},
               anomaly_event_count, zscore_anomaly_count, mad_anomaly_count, percentile_anomaly_count,
               round(anomaly_event_count / event_count, 6) AS anomaly_score,
               anomaly_event_count > 0 AS has_cost_anomaly
        FROM anomaly_mart""",
)
def mart_cost_anomaly(spark, sf):
    found = marts.cost_anomalies(valid(spark, sf))
    names = f"{_ANOMALY_MONEY}".split()
    return found.withColumns(
        {**dict(zip(names, rounded(_ANOMALY_MONEY, 4))), "anomaly_score": rounded("anomaly_score")[0]}
    )


@query(
    "mart_tickets",
    f"""SELECT org_id, ticket_date, severity, org_name, ticket_count, sla_breach_count,
               {rounded_sql("avg_csat sla_breach_rate")} FROM tickets_mart""",
)
def mart_tickets(spark, sf):
    found = tickets_mart(spark, sf)
    return found.withColumns(
        dict(zip(("avg_csat", "sla_breach_rate"), rounded("avg_csat sla_breach_rate")))
    )


@query(
    "mart_genai_tokens",
    """SELECT org_id, usage_date, org_name, total_genai_tokens,
              round(estimated_cost_usd, 4) AS estimated_cost_usd, event_count FROM genai_mart""",
)
def mart_genai_tokens(spark, sf):
    found = marts.genai_tokens(valid(spark, sf))
    return found.withColumn("estimated_cost_usd", F.round("estimated_cost_usd", 4))


@query(
    "mart_nps",
    f"""SELECT org_id, survey_date, org_name, {rounded_sql("avg_nps_score")}, survey_count, scored_count
        FROM nps_mart""",
)
def mart_nps(spark, sf):
    found = marts.nps(silver(spark, sf, "nps_surveys"), silver(spark, sf, "customers_orgs"))
    return found.withColumn("avg_nps_score", F.round("avg_nps_score", 6))


@query(
    "mart_marketing",
    f"""SELECT org_id, touch_date, channel, org_name, touch_count, click_count, conversion_count,
               {rounded_sql("click_rate conversion_rate")} FROM marketing_mart""",
)
def mart_marketing(spark, sf):
    found = marts.marketing(silver(spark, sf, "marketing_touches"), silver(spark, sf, "customers_orgs"))
    return found.withColumns(
        dict(zip(("click_rate", "conversion_rate"), rounded("click_rate conversion_rate")))
    )


# Lookups ----------------------------------------------------------------------------------------------
@query(
    "serve_q1_daily_costs",
    f"""SELECT usage_date, service, round(daily_cost_usd, 4) AS total_daily_cost_usd,
               round(requests, 4) AS total_requests
        FROM daily WHERE org_id = '{ORG}' AND usage_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
          AND service IS NOT NULL""",
)
def serve_q1_daily_costs(spark, sf):
    stored = served(usage(spark, sf), "org_daily_usage_by_service")
    found = serving.daily_costs_and_requests(stored, ORG, "2024-01-05", "2024-01-20")
    return found.select("usage_date", "service", *rounded("total_daily_cost_usd total_requests", 4))


@query(
    "serve_q2_top_services",
    f"""SELECT service, {rounded_sql("accumulated_cost_usd", 4)}, period_start, period_end, rank
        FROM tops, period WHERE org_id = '{ORG}' AND period_end = last_day AND service IS NOT NULL
        ORDER BY rank LIMIT 4""",
)
def serve_q2_top_services(spark, sf):
    stored = served(marts.top_services(settle(usage(spark, sf), "usage")), "org_top_services_by_cost")
    last = stored.agg(F.max("period_end")).first()[0]
    found = serving.top_services_by_cost(stored, ORG, last, 4)
    return found.withColumn("accumulated_cost_usd", F.round("accumulated_cost_usd", 4))


@query(
    "serve_q3_tickets_sla",
    f"""SELECT ticket_date, ticket_count::INT AS ticket_count, sla_breach_count::INT AS sla_breach_count,
               {rounded_sql("sla_breach_rate avg_csat")}
        FROM tickets_mart WHERE org_id = '{ORG}' AND severity = 'high'
          AND ticket_date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'""",
)
def serve_q3_tickets_sla(spark, sf):
    stored = served(tickets_mart(spark, sf), "tickets_by_org_date")
    found = serving.critical_tickets_sla(stored, ORG, "high", "1996-01-01", "2000-12-31")
    return found.withColumns(
        dict(zip(("sla_breach_rate", "avg_csat"), rounded("sla_breach_rate avg_csat")))
    )


@query(
    "serve_q4_revenue",
    f"""SELECT billing_month, {rounded_sql(_MONEY)}, invoice_count::INT AS invoice_count FROM revenue_mart
        WHERE org_id = '{ORG}' AND billing_month BETWEEN DATE '1996-01-01' AND DATE '1999-12-01'
          AND subtotal_usd IS NOT NULL""",
)
def serve_q4_revenue(spark, sf):
    mart = marts.revenue(billing(spark, sf), silver(spark, sf, "customers_orgs"))
    stored = served(mart, "revenue_by_org_month")
    found = serving.monthly_revenue(stored, ORG, "1996-01-01", "1999-12-01")
    return found.withColumns(dict(zip(_MONEY.split(), rounded(_MONEY))))


@query(
    "serve_q5_genai",
    f"""SELECT usage_date, total_genai_tokens, round(estimated_cost_usd, 4) AS estimated_cost_usd
        FROM genai_mart WHERE org_id = '{ORG}' AND usage_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-28'""",
)
def serve_q5_genai(spark, sf):
    stored = served(marts.genai_tokens(valid(spark, sf)), "genai_tokens_by_org_date")
    found = serving.genai_tokens_daily(stored, ORG, "2024-01-03", "2024-01-28")
    return found.withColumn("estimated_cost_usd", F.round("estimated_cost_usd", 4))


@query("resolve_top_period", "SELECT first_day AS period_start, last_day AS period_end FROM period")
def resolve_top_period(spark, sf):
    stored = settle(usage(spark, sf), "usage")
    return serving.top_services_period(marts.top_services(stored), stored, ORG)


@query(
    "resolve_ticket_period",
    f"""SELECT (max(ticket_date) - 29)::DATE AS period_start, max(ticket_date) AS period_end
        FROM tickets_mart WHERE org_id = '{ORG}' AND severity = 'high'""",
)
def resolve_ticket_period(spark, sf):
    return serving.tickets_period(tickets_mart(spark, sf), ORG, "high")


@query(
    "lookup_parameters",
    """SELECT org_id, first_day AS top_start, last_day AS top_end,
              ((SELECT max(ticket_date) FROM tickets_mart t WHERE t.org_id = o.org_id AND severity = 'high')
                  - 29)::DATE AS ticket_start,
              (SELECT max(ticket_date) FROM tickets_mart t WHERE t.org_id = o.org_id AND severity = 'high')
                  AS ticket_end,
              (SELECT min(usage_date) FROM daily d WHERE d.org_id = o.org_id) AS daily_start,
              (SELECT max(usage_date) FROM daily d WHERE d.org_id = o.org_id) AS daily_end,
              (SELECT min(billing_month) FROM revenue_mart r WHERE r.org_id = o.org_id) AS revenue_start,
              (SELECT max(billing_month) FROM revenue_mart r WHERE r.org_id = o.org_id) AS revenue_end,
              (SELECT min(usage_date) FROM genai_mart g WHERE g.org_id = o.org_id) AS genai_start,
              (SELECT max(usage_date) FROM genai_mart g WHERE g.org_id = o.org_id) AS genai_end,
              'high' AS severity
       FROM (SELECT org_id FROM daily GROUP BY org_id
             ORDER BY sum(daily_cost_usd) DESC NULLS LAST, org_id LIMIT 1) o, period""",
)
def lookup_parameters(spark, sf):
    """The org of the highest cost and the periods that its lookups cover, from the marts."""
    rows = settle(valid(spark, sf), "usage-events")
    used = settle(marts.org_daily_usage(events.service_daily(rows)), "usage")
    revenue = marts.revenue(billing(spark, sf), silver(spark, sf, "customers_orgs"))
    p = serving.lookup_parameters(
        used, marts.top_services(used), tickets_mart(spark, sf), revenue, marts.genai_tokens(rows)
    )
    periods = {
        "top": p.top_period,
        "ticket": p.ticket_period,
        "daily": p.daily_costs_period,
        "revenue": p.revenue_period,
        "genai": p.genai_period,
    }
    days = {
        f"{name}_{end}": F.lit(day).cast("date")
        for name, period in periods.items()
        for end, day in zip(("start", "end"), period)
    }
    return spark.range(1).select(
        F.lit(p.org_id).alias("org_id"),
        *[day.alias(name) for name, day in days.items()],
        F.lit(p.severity).alias("severity"),
    )


@query(
    "serving_projection",
    """SELECT org_id, usage_date, service, org_name, org_industry, org_plan_tier, event_count::INT AS event_count,
              round(daily_cost_usd, 4) AS total_daily_cost_usd, round(requests, 4) AS total_requests,
              genai_tokens AS total_genai_tokens, round(carbon_kg, 4) AS total_carbon_kg,
              anomaly_event_count::INT AS anomaly_event_count, has_cost_anomaly = 1 AS has_cost_anomaly
       FROM daily WHERE service IS NOT NULL""",
)
def serving_projection(spark, sf):
    mart = usage(spark, sf).withColumn("gold_ts", F.lit(None))
    projected = serving.to_serving(mart, serving.SERVING["org_daily_usage_by_service"]).drop("gold_ts")
    names = ("total_daily_cost_usd", "total_requests", "total_carbon_kg")
    return projected.withColumns(dict(zip(names, rounded(" ".join(names), 4))))


@query(
    "serving_layout",
    f"""SELECT org_id, severity, ticket_date, org_name, ticket_count::INT AS ticket_count,
               sla_breach_count::INT AS sla_breach_count, {rounded_sql("sla_breach_rate avg_csat")}
        FROM tickets_mart WHERE severity IS NOT NULL AND ticket_date IS NOT NULL""",
)
def serving_layout(spark, sf):
    stored = served(tickets_mart(spark, sf), "tickets_by_org_date")
    return stored.withColumns(
        dict(zip(("sla_breach_rate", "avg_csat"), rounded("sla_breach_rate avg_csat")))
    )


# Checks -----------------------------------------------------------------------------------------------
@query(
    "uniqueness_check",
    """SELECT count(*)::BIGINT AS total_rows,
              (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))::BIGINT
                  AS distinct_keys,
              count(*) = (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
                  AS is_unique
       FROM lineitem""",
)
def uniqueness_check(spark, sf):
    return checks.key_report(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def _check_sql(table_name: str, check: str, expected: str, actual: str, source: str, tolerance: bool = False) -> str:
    same = f"abs(({expected}) - ({actual})) < 0.01" if tolerance else f"({expected}) = ({actual})"
    return (
        f"SELECT '{table_name}' AS \"table\", '{check}' AS \"check\", ({expected})::DOUBLE AS expected, "
        f"({actual})::DOUBLE AS actual, {same} AS ok FROM {source}"
    )


_REQUIRED = ("event_id", "ts", "user_id", "event_type", "value", "props", "source_file")


@query(
    "required_columns_check",
    _check_sql(
        "landing.events", "required columns", str(len(_REQUIRED)), "count(*)",
        "(DESCRIBE SELECT * FROM events) WHERE column_name IN ('" + "', '".join(_REQUIRED) + "')",
    ),
)
def required_columns_check(spark, sf):
    """Over the columns of the stored file. One (source_file) is not there, so the check must fail."""
    return checks.has_columns(table(spark, sf, "events"), "landing.events", _REQUIRED)


_SNAPSHOT = ("users", "support_tickets", "nps_surveys")
_SNAPSHOT_SQL = {"users": ("users_raw", "users"), "support_tickets": ("tickets_raw", "tickets"),
                 "nps_surveys": ("surveys_raw", "surveys")}


@query(
    "snapshot_compare",
    " UNION ALL ".join(
        f"SELECT '{name}' AS metric, (SELECT count(*) FROM {a})::BIGINT AS before, "
        f"(SELECT count(*) FROM {b})::BIGINT AS after, "
        f"(SELECT count(*) FROM {a}) = (SELECT count(*) FROM {b}) AS ok"
        for name, (a, b) in _SNAPSHOT_SQL.items()
    ),
)
def snapshot_compare(spark, sf):
    """Rows of three masters before and after the quarantine."""

    def counted(read) -> DataFrame:
        return checks.suite(
            read(name).agg(F.lit(name).alias("metric"), F.count(F.lit(1)).alias("n")) for name in _SNAPSHOT
        )

    customers = settle(silver(spark, sf, "customers_orgs"), "customers")
    before = counted(lambda name: landed(spark, sf, name))
    return checks.compare_snapshots(before, counted(lambda name: silver(spark, sf, name, customers)))


@query(
    "balance_check",
    _check_sql(
        "silver.usage_events", "row balance", "count(*)",
        "(SELECT count(*) FROM valid) + (SELECT count(*) FROM classified WHERE len(reasons) > 0)", "events_raw",
    ),
)
def balance_check(spark, sf):
    rows = settle(classified(spark, sf), "classified")
    whole = landed(spark, sf, "usage_events")
    return checks.balance(whole, [valid_rows(rows), quarantined_rows(rows)], "silver.usage_events")


@query(
    "grain_check",
    _check_sql(
        "gold.tickets_by_org_date", "unique by org_id, ticket_date, severity", "count(*)",
        "SELECT count(*) FROM (SELECT DISTINCT org_id, ticket_date, severity FROM tickets_mart)", "tickets_mart",
    ),
)
def grain_check(spark, sf):
    mart = marts.marts()["tickets_by_org_date"]
    return checks.unique(tickets_mart(spark, sf), "gold.tickets_by_org_date", mart.grain)


_RECONCILED = {
    "org_daily_usage_by_service": ("SELECT sum(daily_cost_usd) FROM daily",) * 2,
    "revenue_by_org_month": ("SELECT count(*) FROM billing", "SELECT sum(invoice_count) FROM revenue_mart"),
    "cost_anomaly_mart": (
        "SELECT count(*) FROM valid WHERE is_cost_anomaly",
        "SELECT sum(anomaly_event_count) FROM anomaly_mart",
    ),
    "tickets_by_org_date": ("SELECT count(*) FROM tickets", "SELECT sum(ticket_count) FROM tickets_mart"),
    "genai_tokens_by_org_date": (
        "SELECT sum(genai_tokens) FROM valid WHERE service = 'genai' OR genai_tokens > 0",
        "SELECT sum(total_genai_tokens) FROM genai_mart",
    ),
    "nps_by_org_date": ("SELECT count(*) FROM surveys", "SELECT sum(survey_count) FROM nps_mart"),
    "marketing_touches_by_org_channel": (
        "SELECT count(*) FROM touches",
        "SELECT sum(touch_count) FROM marketing_mart",
    ),
}
_RECONCILE_SQL = " UNION ALL ".join(
    f"SELECT 'gold.{name}' AS \"table\", 'total' AS \"check\", round((({a}))::DOUBLE, 2) AS expected, "
    f"round((({b}))::DOUBLE, 2) AS actual, abs(({a}) - ({b})) < 0.01 AS ok"
    for name, (a, b) in _RECONCILED.items()
)
_GRAIN_SQL = " UNION ALL ".join(
    f"SELECT 'gold.{name}' AS \"table\", 'unique by {', '.join(grain)}' AS \"check\", "
    f"(SELECT count(*) FROM {cte})::DOUBLE AS expected, "
    f"(SELECT count(*) FROM (SELECT DISTINCT {', '.join(grain)} FROM {cte}))::DOUBLE AS actual, true AS ok"
    for name, cte, grain in (
        ("org_daily_usage_by_service", "daily", ("org_id", "usage_date", "service")),
        ("org_top_services_by_cost", "tops", ("org_id", "period_end", "rank", "service")),
        ("revenue_by_org_month", "revenue_mart", ("org_id", "billing_month")),
        ("cost_anomaly_mart", "anomaly_mart", ("org_id", "usage_date", "service")),
        ("tickets_by_org_date", "tickets_mart", ("org_id", "ticket_date", "severity")),
        ("genai_tokens_by_org_date", "genai_mart", ("org_id", "usage_date")),
        ("nps_by_org_date", "nps_mart", ("org_id", "survey_date")),
        ("marketing_touches_by_org_channel", "marketing_mart", ("org_id", "touch_date", "channel")),
    )
)


class _Written(NamedTuple):
    """Tables and what was observed while each was written."""

    tables: dict[str, DataFrame]
    seen: dict[str, dict]

    def add(self, name: str, df: DataFrame, metrics: dict) -> None:
        if metrics:
            self.tables[name], self.seen[name] = settle_observed(df, name, metrics)
        else:
            self.tables[name] = settle(df, name)


def _sources(spark: SparkSession, sf: str) -> _Written:
    """All inputs of the marts, each stored once."""
    out = _Written({}, {})
    out.add("customers_orgs", silver(spark, sf, "customers_orgs"), {})
    customers = out.tables["customers_orgs"]
    for name in ("support_tickets", "marketing_touches", "nps_surveys"):
        out.add(name, silver(spark, sf, name, customers), marts.source_metrics(name))
    out.add("billing_monthly", billing(spark, sf, customers), marts.source_metrics("billing_monthly"))
    out.add("usage_events", valid(spark, sf, customers), marts.source_metrics("usage_events"))
    daily_ = events.service_daily(out.tables["usage_events"])
    out.add("org_service_daily", daily_, marts.source_metrics("org_service_daily"))
    return out


def _built(written: _Written) -> None:
    for name, mart in marts.marts().items():
        inputs = [written.tables[t] for t in mart.reads]
        written.add(name, mart.build(*inputs), {**marts.source_metrics(name), **marts.mart_metrics(mart)})


def _reconciled(spark: SparkSession, written: _Written) -> list[DataFrame]:
    """Sums over sources against sums over marts, both taken while the tables were written."""
    return [
        checks.observed(
            spark,
            f"gold.{name}",
            "total",
            written.seen[mart.reads[0]][name],
            written.seen[name][marts.MART_TOTAL],
            BALANCE_TOLERANCE,
        ).withColumns({"expected": F.round("expected", 2), "actual": F.round("actual", 2)})
        for name, mart in marts.marts().items()
        if mart.source_measure is not None
    ]


@query("reconcile_measures", _RECONCILE_SQL)
def reconcile_measures(spark, sf):
    written = _sources(spark, sf)
    _built(written)
    return checks.suite(_reconciled(spark, written))


@query("validation_suite", f"{_RECONCILE_SQL} UNION ALL {_GRAIN_SQL}")
def validation_suite(spark, sf):
    """Every gold check over all eight marts: totals as observed, keys counted."""
    written = _sources(spark, sf)
    _built(written)
    grains = [checks.unique(written.tables[n], f"gold.{n}", m.grain) for n, m in marts.marts().items()]
    return checks.suite([*_reconciled(spark, written), *grains])


@query(
    "dq_counters",
    """SELECT count(*)::BIGINT AS raw_count,
              (count(*) FILTER (WHERE len(reasons) = 0))::BIGINT AS valid_count,
              (count(*) FILTER (WHERE len(reasons) > 0))::BIGINT AS quarantine_count,
              (count(*) FILTER (WHERE len(reasons) = 0 AND is_cost_anomaly))::BIGINT AS cost_anomalies_flagged,
              (count(*) FILTER (WHERE len(reasons) = 0 AND is_cost_anomaly_zscore))::BIGINT AS cost_anomalies_zscore,
              (count(*) FILTER (WHERE len(reasons) = 0 AND is_cost_anomaly_mad))::BIGINT AS cost_anomalies_mad,
              (count(*) FILTER (WHERE len(reasons) = 0 AND is_cost_anomaly_percentile))::BIGINT
                  AS cost_anomalies_percentile,
              (count(*) FILTER (WHERE len(reasons) = 0 AND is_cost_anomaly_p99_x))::BIGINT AS cost_anomalies_p99_x,
              (count(*) FILTER (WHERE len(reasons) = 0 AND is_late_arrival))::BIGINT AS late_arrivals_flagged,
              (count(*) FILTER (WHERE reasons[1] = 'cost_usd_increment below -0.01'))::BIGINT
                  AS negative_cost_quarantined,
              (count(*) FILTER (WHERE reasons[1] = 'service not in allowed cloud catalog'))::BIGINT
                  AS invalid_service_quarantined,
              (count(*) FILTER (WHERE reasons[1] = 'region not in allowed cloud catalog'))::BIGINT
                  AS invalid_region_quarantined,
              (count(*) FILTER (WHERE reasons[1] = 'event latency exceeds catch-up window'))::BIGINT
                  AS late_arrivals_quarantined,
              (count(*) FILTER (WHERE reasons[1] = 'event_ts beyond allowed future tolerance'))::BIGINT
                  AS future_event_ts_quarantined
       FROM classified""",
)
def dq_counters(spark, sf):
    return checks.event_counters(classified(spark, sf))
