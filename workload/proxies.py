"""Landing tables of the domain, derived row by row from the driver's tables.

Each is a list of SQL expressions that Spark and DuckDB read alike, so both sides start from the same
rows. The remainders of the row number put dirt of every kind among them: null and repeated ids, bad
timestamps and numbers, unknown services, regions, orgs and resources, negative costs, late arrivals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.catalog import MASTERS
from meterlake.functions.measures import rows
from meterlake.functions.parse import typed
from meterlake.operators.rules import valid_rows
from meterlake.plans.events import to_bronze
from meterlake.plans.masters import bronze_master, classify_master, with_lineage
from meterlake.sources.tables import ROW_ID, with_row_id

AS_OF = "2024-01-30 00:00:00"

_K = "regexp_extract(props, '([0-9]+)', 1)"
_OWNER = (
    "CASE WHEN o_orderkey % 13 = 0 THEN 'org-ghost' WHEN o_orderkey % 37 = 0 THEN NULL "
    "ELSE 'org-' || CAST(o_custkey AS STRING) END"
)
_ORDER_DAY = "CAST(CAST(o_orderdate AS DATE) AS STRING)"

EVENTS = {
    "src": "event_id",
    "event_id": "CASE WHEN event_id % 101 = 0 THEN NULL "
    "WHEN event_id % 73 = 0 THEN 'evt-' || CAST(event_id - 1 AS STRING) "
    "ELSE 'evt-' || CAST(event_id AS STRING) END",
    "timestamp": "CASE WHEN event_id % 107 = 0 THEN 'not a time' "
    "ELSE CAST(date_trunc('second', ts) AS STRING) END",
    "org_id": "CASE WHEN event_id % 61 = 0 THEN 'org-ghost' ELSE 'org-' || CAST(user_id % 5 AS STRING) END",
    "resource_id": "CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 67 = 0 THEN 'res-ghost' "
    "ELSE 'res-' || CAST(CAST((event_id - event_id % 5) / 5 AS BIGINT) AS STRING) END",
    "service": "CASE WHEN event_id % 83 = 0 THEN 'quantum' WHEN event_id % 109 = 0 THEN NULL "
    "WHEN event_type = 'view' THEN ' Storage' WHEN event_type = 'click' THEN 'Computing' "
    "WHEN event_type = 'purchase' THEN 'AI' WHEN event_type = 'signup' THEN 'DATABASE ' "
    "ELSE 'Object-Storage' END",
    "region": "CASE WHEN event_id % 103 = 0 THEN 'moon' WHEN event_id % 11 = 0 THEN NULL "
    "WHEN event_id % 4 = 0 THEN 'US_East' WHEN event_id % 4 = 1 THEN 'eu_west ' "
    "WHEN event_id % 4 = 2 THEN 'sa-east' ELSE 'AP-South' END",
    "metric": "CASE WHEN event_id % 5 = 0 THEN 'requests' WHEN event_id % 5 = 1 THEN ' CPU_Hours' "
    "WHEN event_id % 5 = 2 THEN 'storage_gb_hours' WHEN event_id % 5 = 3 THEN 'egress_gb' END",
    "value": f"CASE WHEN event_id % 113 = 0 THEN 'n/a' WHEN event_id % 13 = 0 THEN NULL "
    f"WHEN event_id % 2 = 0 THEN {_K} || '.0' ELSE ' ' || {_K} END",
    "unit": "CASE WHEN event_id % 97 = 0 OR event_id % 26 = 0 THEN NULL ELSE ' Count' END",
    "cost_usd_increment": "CASE WHEN event_id % 89 = 0 THEN -value "
    "WHEN event_id % 127 = 0 THEN CAST(-0.01 AS DOUBLE) WHEN event_id % 131 = 0 THEN NULL "
    "WHEN event_id % 211 = 0 THEN value * 10 ELSE value END",
    "schema_version": "CAST(CASE WHEN event_id % 4 = 0 THEN 1 ELSE 2 END AS INT)",
    "carbon_kg": f"CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST({_K} AS DOUBLE) / 100 END",
    "genai_tokens": f"CASE WHEN event_id % 4 = 0 THEN NULL "
    f"WHEN event_type = 'purchase' OR event_id % 6 = 1 THEN CAST({_K} AS BIGINT) * 10 "
    f"ELSE CAST(0 AS BIGINT) END",
    "delay_sec": "CAST(CASE WHEN event_id % 79 = 0 THEN 2400 WHEN event_id % 59 = 0 THEN 900 "
    "WHEN event_id % 137 = 0 THEN NULL ELSE 5 END AS INT)",
}

# Per table: columns, and the FROM clause.
LANDED: dict[str, tuple[dict[str, str], str]] = {
    "usage_events": (EVENTS, "events"),
    "customers_orgs": (
        {
            "org_id": "'org-' || CAST(c_custkey AS STRING)",
            "org_name": "' ' || c_name",
            "industry": "c_mktsegment",
            "hq_region": "replace(r_name, ' ', '_')",
            "plan_tier": "CASE WHEN c_nationkey % 3 = 0 THEN 'Free' WHEN c_nationkey % 3 = 1 THEN ' Pro' "
            "ELSE 'ENTERPRISE' END",
            "is_enterprise": "CASE WHEN c_nationkey % 3 = 2 THEN 'True' ELSE 'no' END",
            "signup_date": "CASE WHEN c_custkey % 17 = 0 THEN '2024-02-30' "
            "ELSE '2024-0' || CAST(c_nationkey % 9 + 1 AS STRING) || '-15' END",
            "sales_rep": "n_name",
            "lifecycle_stage": "CASE WHEN c_custkey % 4 = 0 THEN '  ' ELSE 'Active' END",
            "marketing_source": "'Web'",
            "nps_score": "CASE WHEN c_custkey % 5 = 0 THEN 'none' ELSE CAST(c_custkey % 11 AS STRING) END",
        },
        "customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
    ),
    "users": (
        {
            "user_id": "CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE 'usr-' || CAST(o_orderkey AS STRING) END",
            "org_id": _OWNER,
            "email": "' User' || CAST(o_orderkey AS STRING) || '@Example.com'",
            "role": "o_orderpriority",
            "active": "CASE WHEN o_orderstatus = 'O' THEN ' True' WHEN o_orderstatus = 'F' THEN 'false' END",
            "created_at": _ORDER_DAY,
            "last_login": f"CASE WHEN o_orderkey % 5 = 0 THEN 'never' ELSE {_ORDER_DAY} END",
        },
        "orders",
    ),
    "resources": (
        {
            "resource_id": "'res-' || CAST(p_partkey AS STRING)",
            "org_id": "'org-' || CAST(p_partkey % 5 AS STRING)",
            "service": "CASE WHEN p_partkey % 97 = 0 THEN 'mainframe' WHEN p_size % 6 = 0 THEN 'Network' "
            "WHEN p_size % 6 = 1 THEN 'compute ' WHEN p_size % 6 = 2 THEN 'Databases' "
            "WHEN p_size % 6 = 3 THEN 'GenAI' WHEN p_size % 6 = 4 THEN 'analytics' ELSE 'storage' END",
            "region": "CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_size % 2 = 0 THEN 'EU_Central' "
            "ELSE 'us_west' END",
            "created_at": "'2023-05-0' || CAST(p_partkey % 9 + 1 AS STRING)",
            "state": "p_type",
            "tags_json": "'{\"Brand\": \"' || p_brand || '\"}'",
        },
        "part",
    ),
    "support_tickets": (
        {
            "ticket_id": "'tkt-' || CAST(o_orderkey AS STRING)",
            "org_id": _OWNER,
            "category": "o_orderpriority",
            "severity": "CASE WHEN o_orderpriority = '1-URGENT' THEN ' High' "
            "WHEN o_orderpriority = '2-HIGH' THEN 'HIGH' WHEN o_orderpriority = '3-MEDIUM' THEN 'Medium' "
            "ELSE 'low' END",
            "created_at": _ORDER_DAY,
            "resolved_at": f"CASE WHEN o_orderstatus = 'F' THEN {_ORDER_DAY} ELSE '' END",
            "csat": "CASE WHEN o_orderkey % 3 = 0 THEN ' ' WHEN o_orderkey % 29 = 0 THEN 'good' "
            "ELSE CAST(o_orderkey % 5 + 1 AS STRING) || '.5' END",
            "sla_breached": "CASE WHEN o_orderstatus = 'F' THEN 'TRUE' WHEN o_orderstatus = 'O' THEN 'False' "
            "ELSE '1' END",
        },
        "orders",
    ),
    "marketing_touches": (
        {
            "touch_id": "'tch-' || CAST(event_id AS STRING)",
            "org_id": "'org-' || CAST(user_id AS STRING)",
            "campaign": "'Winter'",
            "channel": "CASE WHEN event_id % 4 = 0 THEN ' Email' WHEN event_id % 4 = 1 THEN 'ADS' "
            "WHEN event_id % 4 = 2 THEN 'web' ELSE NULL END",
            "timestamp": "CASE WHEN event_id % 107 = 0 THEN 'soon' "
            "ELSE CAST(date_trunc('second', ts) AS STRING) END",
            "clicked": "CASE WHEN event_type = 'click' OR event_type = 'purchase' THEN 'True' ELSE 'False' END",
            "converted": "CASE WHEN event_type = 'purchase' THEN 'true' END",
        },
        "events",
    ),
    "nps_surveys": (
        {
            "org_id": _OWNER,
            "survey_date": _ORDER_DAY,
            "nps_score": "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey % 11 AS STRING) END",
            "comment": "o_orderpriority",
        },
        "orders",
    ),
}

# Already typed: its prices are numbers, and printing them would only test number formatting.
BILLING = (
    {
        "invoice_id": "'inv-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)",
        "org_id": _OWNER,
        "month": "CAST(date_trunc('month', o_orderdate) AS DATE)",
        "subtotal": "CASE WHEN l_partkey % 41 = 0 THEN NULL ELSE l_extendedprice END",
        "credits": "CASE WHEN l_linenumber = 3 THEN NULL ELSE l_extendedprice * l_discount END",
        "taxes": "CASE WHEN l_linenumber = 5 THEN NULL ELSE l_extendedprice * l_tax END",
        "currency": "'EUR'",
        "exchange_rate_to_usd": "CASE WHEN l_partkey % 3 = 0 THEN NULL "
        "WHEN l_partkey % 3 = 1 THEN CAST(1.1 AS DOUBLE) ELSE CAST(0.9 AS DOUBLE) END",
    },
    "lineitem JOIN orders ON l_orderkey = o_orderkey",
)


def select_sql(proxy: tuple[dict[str, str], str]) -> str:
    """The proxy as a DuckDB query."""
    columns, source = proxy
    picked = ", ".join(f'{expression} AS "{name}"' for name, expression in columns.items())
    return f"SELECT {picked} FROM {source}"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _columns(df: DataFrame, proxy: tuple[dict[str, str], str], *also: str) -> DataFrame:
    return df.selectExpr(*[f"{expression} AS `{name}`" for name, expression in proxy[0].items()], *also)


def landed(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A landing proxy; usage events carry their row identity."""
    proxy = LANDED[name]
    if name == "customers_orgs":
        base = (
            table(spark, sf, "customer")
            .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        )
        return _columns(base, proxy)
    if name == "usage_events":
        return _columns(with_row_id(table(spark, sf, "events")), proxy, *ROW_ID)
    return _columns(table(spark, sf, proxy[1]), proxy)


def billing(spark: SparkSession, sf: str, customers: DataFrame | None = None) -> DataFrame:
    """Invoices of silver: one per id, of known orgs."""
    if customers is None:
        customers = silver(spark, sf, "customers_orgs")
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    raw = _columns(lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")), BILLING)
    invoices = MASTERS["billing_monthly"]
    stamped = with_lineage(raw, F.lit("landing/billing_monthly"), F.lit(AS_OF).cast("timestamp"))
    bronze_rows = bronze_master(stamped, invoices)
    return valid_rows(classify_master(bronze_rows, invoices, customers))


def bronze(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return typed(landed(spark, sf, name), MASTERS[name].typed)


def silver(spark: SparkSession, sf: str, name: str, customers: DataFrame | None = None) -> DataFrame:
    """Valid rows of a master."""
    if MASTERS[name].owned_by_org and customers is None:
        customers = silver(spark, sf, "customers_orgs")
    return valid_rows(classify_master(bronze(spark, sf, name), MASTERS[name], customers))


def bronze_events(spark: SparkSession, sf: str) -> DataFrame:
    delay = F.make_dt_interval(secs=F.col("delay_sec"))
    arrival = F.col("event_ts") + delay
    # Rows that are counted are handed on one by one. Derived, parsed, looked up and flagged in one generated
    # method, as Spark would, they are interpreted: HotSpot compiles no method of over 8,000 bytes.
    counted = landed(spark, sf, "usage_events").observe("landed_events", rows().alias("n"))
    return to_bronze(counted, arrival)
