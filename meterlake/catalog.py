"""Fixed values of the domain and the contract of every table.

A table contract is its typed DDL. The landing form of a table is the same columns as strings; the
casts follow from the types, so a new table needs one entry here and no code.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from .schemas import columns

# Thresholds ---------------------------------------------------------------------------
LATE_AFTER_SECONDS = 600
QUARANTINE_AFTER_SECONDS = 1800
FUTURE_TOLERANCE_SECONDS = 300
MINIMUM_COST = -0.01
ZSCORE_LIMIT = 3.0
MODIFIED_Z_FACTOR = 0.6745
MODIFIED_Z_LIMIT = 3.5
MAD_FLOOR = 0.01
LOW_PERCENTILE = 0.01
HIGH_PERCENTILE = 0.99
HIGH_PERCENTILE_MULTIPLE = 2.0
TOP_SERVICES = 5
TOP_SERVICES_DAYS = 14
TICKET_WINDOW_DAYS = 30
BALANCE_TOLERANCE = 0.01
PRODUCTION_WATERMARK = "10 minutes"
REPLAY_WATERMARK = "60 days"
FILES_PER_TRIGGER = 20

# Service and region catalogues --------------------------------------------------------
SERVICES = ("analytics", "compute", "database", "genai", "networking", "storage")
REGIONS = ("ap-northeast", "ap-south", "eu-central", "eu-west", "sa-east", "us-east", "us-west")
SERVICE_ALIASES = {
    "ai": "genai",
    "computing": "compute",
    "databases": "database",
    "network": "networking",
    "object-storage": "storage",
}
METRIC_FEATURES = ("requests", "cpu_hours", "storage_gb_hours")

# Quarantine reasons -------------------------------------------------------------------
UNREADABLE_LINE = "unreadable landing line"
NULL_EVENT_ID = "null event_id"
DUPLICATE_EVENT_ID = "duplicate event_id"
VALUE_WITHOUT_UNIT = "null unit with non-null value"
COST_BELOW_MINIMUM = "cost_usd_increment below -0.01"
UNKNOWN_SERVICE = "service not in allowed cloud catalog"
UNKNOWN_REGION = "region not in allowed cloud catalog"
BAD_EVENT_TS = "event_ts missing or unparseable"
UNKNOWN_ORG = "org_id not found in customers_orgs"
UNKNOWN_RESOURCE = "resource_id not found in resources"
NULL_KEY = "null primary key"
TOO_LATE = "event latency exceeds catch-up window"
IN_THE_FUTURE = "event_ts beyond allowed future tolerance"


@dataclass(frozen=True)
class MasterTable:
    """Contract of a master table: typed columns, key, conformed columns, and the org check.

    ``conform`` maps a column to the name of a text rule in ``functions.text.RULES``; leaving a column
    out keeps its text as it arrived.
    """

    name: str
    ddl: str
    keys: tuple[str, ...]
    conform: dict[str, str] = field(default_factory=dict)
    owned_by_org: bool = True

    @property
    def typed(self) -> T.StructType:
        return columns(self.ddl)

    @property
    def landing(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, T.StringType()) for f in self.typed])

    @property
    def bronze(self) -> T.StructType:
        return T.StructType(self.typed.fields + LINEAGE.fields)

    @property
    def silver(self) -> T.StructType:
        return T.StructType(self.bronze.fields + columns("silver_ts timestamp").fields)


# The text of a landed line of which nothing but its key could be read; null for all other rows.
UNREADABLE = "unreadable"
LINEAGE = columns(f"source_file string, ingest_ts timestamp, ingest_date date, {UNREADABLE} string")

MASTERS: dict[str, MasterTable] = {
    t.name: t
    for t in (
        MasterTable(
            "customers_orgs",
            "org_id string, org_name string, industry string, hq_region string, plan_tier string, "
            "is_enterprise boolean, signup_date date, sales_rep string, lifecycle_stage string, "
            "marketing_source string, nps_score double",
            keys=("org_id",),
            conform={
                "org_name": "text",
                "industry": "text",
                "hq_region": "region",
                "plan_tier": "text",
                "lifecycle_stage": "text",
                "marketing_source": "text",
                "sales_rep": "text",
            },
            owned_by_org=False,
        ),
        MasterTable(
            "users",
            "user_id string, org_id string, email string, role string, active boolean, "
            "created_at date, last_login date",
            keys=("user_id",),
            conform={"email": "text", "role": "text"},
        ),
        MasterTable(
            "billing_monthly",
            "invoice_id string, org_id string, month date, subtotal double, credits double, taxes double, "
            "currency string, exchange_rate_to_usd double",
            keys=("invoice_id",),
            conform={"currency": "text"},
        ),
        MasterTable(
            "resources",
            "resource_id string, org_id string, service string, region string, created_at date, "
            "state string, tags_json string",
            keys=("resource_id",),
            conform={"service": "service", "region": "region", "state": "text", "tags_json": "text"},
        ),
        MasterTable(
            "support_tickets",
            "ticket_id string, org_id string, category string, severity string, created_at date, "
            "resolved_at date, csat double, sla_breached boolean",
            keys=("ticket_id",),
            conform={"category": "text", "severity": "text"},
        ),
        MasterTable(
            "marketing_touches",
            "touch_id string, org_id string, campaign string, channel string, timestamp timestamp, "
            "clicked boolean, converted boolean",
            keys=("touch_id",),
            conform={"campaign": "text", "channel": "text"},
        ),
        MasterTable(
            "nps_surveys",
            "org_id string, survey_date date, nps_score double, comment string",
            keys=("org_id", "survey_date"),
            conform={"comment": "text"},
        ),
    )
}

# Usage events: as landed (JSON lines; schema version 1 lacks the last two columns) and as bronze.
EVENT_LANDING = columns(
    "event_id string, timestamp string, org_id string, resource_id string, service string, region string, "
    "metric string, value string, unit string, cost_usd_increment double, schema_version int, "
    "carbon_kg double, genai_tokens bigint"
)
EVENT_BRONZE = columns(
    "event_id string, timestamp string, org_id string, resource_id string, service string, region string, "
    "metric string, value double, unit string, cost_usd_increment double, schema_version int, "
    "carbon_kg double, genai_tokens bigint, event_ts timestamp, source_file string, ingest_ts timestamp, "
    f"event_latency_sec bigint, is_late_arrival boolean, ingest_date date, {UNREADABLE} string"
)
EVENT_RELAID = T.StructType(EVENT_BRONZE.fields + columns("usage_date date").fields)

ANOMALY_FLAGS = (
    "is_cost_anomaly_zscore",
    "is_cost_anomaly_mad",
    "is_cost_anomaly_percentile",
    "is_cost_anomaly_p99_x",
    "is_cost_anomaly",
)
ORG_ATTRIBUTES = {
    "org_name": "org_name",
    "industry": "org_industry",
    "plan_tier": "org_plan_tier",
    "lifecycle_stage": "org_lifecycle_stage",
    "hq_region": "org_hq_region",
}
RESOURCE_ATTRIBUTES = {
    "service": "resource_service",
    "region": "resource_region",
    "state": "resource_state",
}
EVENT_SILVER = T.StructType(
    EVENT_RELAID.fields
    + columns(
        ", ".join(f"{c} string" for c in (*ORG_ATTRIBUTES.values(), *RESOURCE_ATTRIBUTES.values()))
        + ", org_user_count bigint, org_active_user_count bigint, "
        + ", ".join(f"{c} double" for c in METRIC_FEATURES)
        + ", "
        + ", ".join(f"{c} boolean" for c in ANOMALY_FLAGS)
        + ", silver_ts timestamp"
    ).fields
)
SERVICE_DAILY = columns(
    "org_id string, usage_date date, service string, org_name string, org_industry string, "
    "org_plan_tier string, daily_cost_usd double, requests double, cpu_hours double, "
    "storage_gb_hours double, genai_tokens bigint, carbon_kg double, event_count bigint, "
    "anomaly_event_count bigint, has_cost_anomaly int, silver_ts timestamp"
)
