"""The same results in DuckDB SQL, written from the rules of the domain as common table expressions."""

from __future__ import annotations

import re

from .proxies import AS_OF, BILLING, LANDED, select_sql

# Spelled out here again, so that the SQL does not follow a wrong constant in the library.
_SERVICES = "('analytics', 'compute', 'database', 'genai', 'networking', 'storage')"
_REGIONS = "('ap-northeast', 'ap-south', 'eu-central', 'eu-west', 'sa-east', 'us-east', 'us-west')"


def text(c: str) -> str:
    return f"nullif(lower(trim({c})), '')"


def region(c: str) -> str:
    return f"replace({text(c)}, '_', '-')"


def service(c: str) -> str:
    return (
        f"CASE {text(c)} WHEN 'ai' THEN 'genai' WHEN 'computing' THEN 'compute' "
        f"WHEN 'databases' THEN 'database' WHEN 'network' THEN 'networking' "
        f"WHEN 'object-storage' THEN 'storage' ELSE {text(c)} END"
    )


def number(c: str) -> str:
    return f"try_cast(nullif(trim({c}), '') AS DOUBLE)"


def day(c: str) -> str:
    return f"try_cast(nullif(trim({c}), '') AS DATE)"


def flag(c: str) -> str:
    return f"coalesce(lower(trim({c})) = 'true', false)"


def _owned(table: str, columns: str) -> str:
    return f"SELECT {columns} FROM {table} t WHERE t.org_id IN (SELECT org_id FROM customers)"


REASONS_SQL = f"""
  CASE WHEN event_id IS NULL THEN 'null event_id' END,
  CASE WHEN surplus THEN 'duplicate event_id' END,
  CASE WHEN value IS NOT NULL AND unit IS NULL THEN 'null unit with non-null value' END,
  CASE WHEN cost_usd_increment < -0.01::DOUBLE THEN 'cost_usd_increment below -0.01' END,
  CASE WHEN event_ts IS NULL THEN 'event_ts missing or unparseable' END,
  CASE WHEN service NOT IN {_SERVICES} THEN 'service not in allowed cloud catalog' END,
  CASE WHEN region NOT IN {_REGIONS} THEN 'region not in allowed cloud catalog' END,
  CASE WHEN org_name IS NULL THEN 'org_id not found in customers_orgs' END,
  CASE WHEN resource_id IS NOT NULL AND resource_service IS NULL
       THEN 'resource_id not found in resources' END,
  CASE WHEN event_latency_sec > 1800 THEN 'event latency exceeds catch-up window' END,
  CASE WHEN event_ts > TIMESTAMP '{AS_OF}' + INTERVAL 300 SECOND
       THEN 'event_ts beyond allowed future tolerance' END
"""

CTES: dict[str, str] = {
    "customers_raw": select_sql(LANDED["customers_orgs"]),
    "users_raw": select_sql(LANDED["users"]),
    "resources_raw": select_sql(LANDED["resources"]),
    "tickets_raw": select_sql(LANDED["support_tickets"]),
    "touches_raw": select_sql(LANDED["marketing_touches"]),
    "surveys_raw": select_sql(LANDED["nps_surveys"]),
    "events_raw": select_sql(LANDED["usage_events"]),
    "billing_raw": select_sql(BILLING),
    "billing_latest": """
        SELECT *, row_number() OVER (
                   PARTITION BY invoice_id
                   ORDER BY org_id DESC NULLS LAST, month DESC NULLS LAST, subtotal DESC NULLS LAST,
                            credits DESC NULLS LAST, taxes DESC NULLS LAST, currency DESC NULLS LAST,
                            exchange_rate_to_usd DESC NULLS LAST) AS nth
        FROM billing_raw""",
    "customers": f"""
        SELECT org_id, {text("org_name")} AS org_name, {text("industry")} AS industry,
               {region("hq_region")} AS hq_region, {text("plan_tier")} AS plan_tier,
               {text("lifecycle_stage")} AS lifecycle_stage, {flag("is_enterprise")} AS is_enterprise,
               {day("signup_date")} AS signup_date, {number("nps_score")} AS nps_score
        FROM customers_raw WHERE org_id IS NOT NULL""",
    "billing": _owned("billing_latest", "*") + " AND nth = 1",
    "users_typed": f"""
        SELECT user_id, org_id, {text("email")} AS email, {text("role")} AS role,
               {flag("active")} AS active, {day("created_at")} AS created_at,
               {day("last_login")} AS last_login
        FROM users_raw""",
    "users": _owned("users_typed", "*") + " AND user_id IS NOT NULL",
    "resources": _owned(
        "resources_raw",
        f"resource_id, org_id, {service('service')} AS service, {region('region')} AS region, "
        f"{text('state')} AS state, {text('tags_json')} AS tags_json, {day('created_at')} AS created_at",
    )
    + " AND resource_id IS NOT NULL",
    "tickets_typed": f"""
        SELECT ticket_id, org_id, {text("category")} AS category, {text("severity")} AS severity,
               {day("created_at")} AS created_at, {day("resolved_at")} AS resolved_at,
               {number("csat")} AS csat, {flag("sla_breached")} AS sla_breached
        FROM tickets_raw""",
    "tickets": _owned("tickets_typed", "*") + " AND ticket_id IS NOT NULL",
    "touches": _owned(
        "touches_raw",
        f"touch_id, org_id, {text('channel')} AS channel, try_cast(\"timestamp\" AS TIMESTAMP) AS touched_at, "
        f"{flag('clicked')} AS clicked, {flag('converted')} AS converted",
    ),
    "surveys": _owned(
        "surveys_raw",
        f"org_id, {day('survey_date')} AS survey_date, {number('nps_score')} AS nps_score",
    )
    + f" AND {day('survey_date')} IS NOT NULL",
    "bronze": f"""
        SELECT src, event_id, org_id, resource_id, {service("service")} AS service,
               {region("region")} AS region, {text("metric")} AS metric, {number("value")} AS value,
               {text("unit")} AS unit, cost_usd_increment, schema_version, carbon_kg, genai_tokens,
               try_cast("timestamp" AS TIMESTAMP) AS event_ts,
               try_cast("timestamp" AS TIMESTAMP) + to_seconds(delay_sec) AS ingest_ts,
               CASE WHEN try_cast("timestamp" AS TIMESTAMP) IS NOT NULL
                    THEN delay_sec::BIGINT END AS event_latency_sec
        FROM events_raw""",
    "user_stats": """
        SELECT org_id, count(*)::BIGINT AS org_user_count,
               (count(*) FILTER (WHERE active))::BIGINT AS org_active_user_count
        FROM users GROUP BY org_id""",
    "enriched": f"""
        SELECT b.src, b.event_id, b.org_id, b.resource_id, b.unit, b.value, b.metric, b.event_ts, b.ingest_ts,
               b.event_latency_sec, b.event_latency_sec > 600 AS is_late_arrival, b.cost_usd_increment,
               b.event_ts::DATE AS usage_date,
               coalesce(r.service, b.service) AS service, coalesce(r.region, b.region) AS region,
               r.service AS resource_service, r.state AS resource_state,
               c.org_name, c.industry AS org_industry, c.plan_tier AS org_plan_tier,
               c.lifecycle_stage AS org_lifecycle_stage, c.hq_region AS org_hq_region,
               coalesce(s.org_user_count, 0) AS org_user_count,
               coalesce(s.org_active_user_count, 0) AS org_active_user_count,
               CASE WHEN b.metric = 'requests' THEN coalesce(b.value, 0) ELSE 0 END AS requests,
               CASE WHEN b.metric = 'cpu_hours' THEN coalesce(b.value, 0) ELSE 0 END AS cpu_hours,
               CASE WHEN b.metric = 'storage_gb_hours' THEN coalesce(b.value, 0) ELSE 0 END AS storage_gb_hours,
               coalesce(b.genai_tokens, 0) AS genai_tokens, coalesce(b.carbon_kg, 0) AS carbon_kg
        FROM bronze b
        LEFT JOIN customers c ON b.org_id = c.org_id
        LEFT JOIN resources r ON b.resource_id = r.resource_id
        LEFT JOIN user_stats s ON b.org_id = s.org_id""",
    "cost_stats": """
        SELECT org_id, service, avg(cost_usd_increment) AS mean_cost,
               stddev_pop(cost_usd_increment) AS std_cost,
               quantile_disc(cost_usd_increment, 0.01) AS p01_cost,
               quantile_disc(cost_usd_increment, 0.5) AS median_cost,
               quantile_disc(cost_usd_increment, 0.99) AS p99_cost
        FROM enriched WHERE org_id IS NOT NULL AND service IS NOT NULL GROUP BY org_id, service""",
    "cost_mads": """
        SELECT e.org_id, e.service, quantile_disc(abs(cost_usd_increment - median_cost), 0.5) AS mad_cost
        FROM enriched e JOIN cost_stats s ON e.org_id = s.org_id AND e.service = s.service
        GROUP BY e.org_id, e.service""",
    "scored": """
        SELECT e.*, p01_cost, p99_cost, mad_cost,
               CASE WHEN std_cost IS NULL OR std_cost = 0 THEN 0
                    ELSE (cost_usd_increment - mean_cost) / std_cost END AS z,
               CASE WHEN mad_cost IS NULL OR mad_cost = 0 THEN 0
                    ELSE 0.6745::DOUBLE * (cost_usd_increment - median_cost) / mad_cost END AS mz
        FROM enriched e
        LEFT JOIN cost_stats s ON e.org_id = s.org_id AND e.service = s.service
        LEFT JOIN cost_mads m ON e.org_id = m.org_id AND e.service = m.service""",
    "flags": """
        SELECT *, coalesce(abs(z) > 3, false) AS is_cost_anomaly_zscore,
               coalesce(mad_cost >= 0.01::DOUBLE AND abs(mz) > 3.5, false) AS is_cost_anomaly_mad,
               coalesce(cost_usd_increment < p01_cost OR cost_usd_increment > p99_cost, false)
                   AS is_cost_anomaly_percentile,
               coalesce(cost_usd_increment > p99_cost * 2, false) AS is_cost_anomaly_p99_x
        FROM scored""",
    "flagged": """
        SELECT *, is_cost_anomaly_zscore OR is_cost_anomaly_mad OR is_cost_anomaly_percentile
                  OR is_cost_anomaly_p99_x AS is_cost_anomaly
        FROM flags""",
    "ranked": """
        SELECT *, event_id IS NOT NULL AND row_number() OVER (
                   PARTITION BY event_id
                   ORDER BY event_ts DESC NULLS LAST, ingest_ts DESC NULLS LAST,
                            cost_usd_increment DESC NULLS LAST, org_id DESC NULLS LAST,
                            resource_id DESC NULLS LAST, service DESC NULLS LAST, region DESC NULLS LAST,
                            metric DESC NULLS LAST, value DESC NULLS LAST, unit DESC NULLS LAST) > 1 AS surplus
        FROM flagged""",
    "judged": f"SELECT *, concat_ws('; ', {REASONS_SQL}) AS all_reasons FROM ranked",
    "classified": """
        SELECT *, CASE WHEN all_reasons = '' THEN [] ELSE string_split(all_reasons, '; ') END AS reasons
        FROM judged""",
    "valid": "SELECT * FROM classified WHERE len(reasons) = 0",
    "daily": """
        SELECT org_id, usage_date, service, max(org_name) AS org_name, max(org_industry) AS org_industry,
               max(org_plan_tier) AS org_plan_tier, sum(cost_usd_increment) AS daily_cost_usd,
               sum(requests) AS requests, sum(cpu_hours) AS cpu_hours,
               sum(storage_gb_hours) AS storage_gb_hours, sum(genai_tokens)::BIGINT AS genai_tokens,
               sum(carbon_kg) AS carbon_kg, count(*)::BIGINT AS event_count,
               (count(*) FILTER (WHERE is_cost_anomaly))::BIGINT AS anomaly_event_count,
               max(is_cost_anomaly::INT) AS has_cost_anomaly
        FROM valid GROUP BY org_id, usage_date, service""",
    "period": "SELECT max(usage_date) AS last_day, (max(usage_date) - 13)::DATE AS first_day FROM daily",
    "service_totals": """
        SELECT org_id, service, sum(daily_cost_usd) AS cost FROM daily, period
        WHERE usage_date BETWEEN first_day AND last_day GROUP BY org_id, service""",
    "tops": """
        SELECT org_id, service, cost AS accumulated_cost_usd, rank, last_day AS period_end,
               first_day AS period_start
        FROM (SELECT *, row_number() OVER (PARTITION BY org_id
                        ORDER BY cost DESC NULLS LAST, service NULLS FIRST)::INT AS rank
              FROM service_totals), period
        WHERE rank <= 5""",
    "revenue_mart": """
        SELECT b.org_id, b.month AS billing_month, max(c.org_name) AS org_name,
               max(c.plan_tier) AS org_plan_tier,
               sum(subtotal * coalesce(exchange_rate_to_usd, 1)) AS subtotal_usd,
               sum(coalesce(credits, 0) * coalesce(exchange_rate_to_usd, 1)) AS credits_usd,
               sum(coalesce(taxes, 0) * coalesce(exchange_rate_to_usd, 1)) AS taxes_usd,
               sum(subtotal * coalesce(exchange_rate_to_usd, 1)
                   - coalesce(credits, 0) * coalesce(exchange_rate_to_usd, 1)
                   + coalesce(taxes, 0) * coalesce(exchange_rate_to_usd, 1)) AS revenue_usd,
               count(*)::BIGINT AS invoice_count
        FROM billing b LEFT JOIN customers c ON b.org_id = c.org_id GROUP BY b.org_id, b.month""",
    "anomaly_mart": """
        SELECT org_id, usage_date, service, max(org_name) AS org_name, count(*)::BIGINT AS event_count,
               sum(cost_usd_increment) AS total_daily_cost_usd,
               (count(*) FILTER (WHERE is_cost_anomaly))::BIGINT AS anomaly_event_count,
               sum(CASE WHEN is_cost_anomaly THEN cost_usd_increment ELSE 0 END) AS anomaly_cost_usd,
               (count(*) FILTER (WHERE is_cost_anomaly_zscore))::BIGINT AS zscore_anomaly_count,
               (count(*) FILTER (WHERE is_cost_anomaly_mad))::BIGINT AS mad_anomaly_count,
               (count(*) FILTER (WHERE is_cost_anomaly_percentile))::BIGINT AS percentile_anomaly_count
        FROM valid GROUP BY org_id, usage_date, service""",
    "tickets_mart": """
        SELECT t.org_id, t.created_at AS ticket_date, severity, max(c.org_name) AS org_name,
               count(*)::BIGINT AS ticket_count,
               (count(*) FILTER (WHERE sla_breached))::BIGINT AS sla_breach_count, avg(csat) AS avg_csat,
               (count(*) FILTER (WHERE sla_breached)) / count(*) AS sla_breach_rate
        FROM tickets t LEFT JOIN customers c ON t.org_id = c.org_id
        GROUP BY t.org_id, t.created_at, severity""",
    "genai_mart": """
        SELECT org_id, usage_date, max(org_name) AS org_name, sum(genai_tokens)::BIGINT AS total_genai_tokens,
               sum(cost_usd_increment) AS estimated_cost_usd, count(*)::BIGINT AS event_count
        FROM valid WHERE service = 'genai' OR genai_tokens > 0 GROUP BY org_id, usage_date""",
    "nps_mart": """
        SELECT s.org_id, survey_date, max(c.org_name) AS org_name, avg(s.nps_score) AS avg_nps_score,
               count(*)::BIGINT AS survey_count, count(s.nps_score)::BIGINT AS scored_count
        FROM surveys s LEFT JOIN customers c ON s.org_id = c.org_id GROUP BY s.org_id, survey_date""",
    "marketing_mart": """
        SELECT t.org_id, t.touched_at::DATE AS touch_date, channel, max(c.org_name) AS org_name,
               count(*)::BIGINT AS touch_count, (count(*) FILTER (WHERE clicked))::BIGINT AS click_count,
               (count(*) FILTER (WHERE converted))::BIGINT AS conversion_count,
               (count(*) FILTER (WHERE clicked)) / count(*) AS click_rate,
               (count(*) FILTER (WHERE converted)) / count(*) AS conversion_rate
        FROM touches t LEFT JOIN customers c ON t.org_id = c.org_id
        GROUP BY t.org_id, t.touched_at::DATE, channel""",
}


def with_ctes(query: str) -> str:
    """The query behind the expressions it needs, found by name, in order of definition."""

    def mentioned(sql: str) -> set[str]:
        return set(re.findall(r"[a-z_]+", sql)) & CTES.keys()

    needed: set[str] = set()
    todo = mentioned(query)
    while todo:
        name = todo.pop()
        needed.add(name)
        todo |= mentioned(CTES[name]) - needed
    listed = ",\n".join(f"{name} AS ({sql})" for name, sql in CTES.items() if name in needed)
    return f"WITH {listed}\n{query}" if listed else query
