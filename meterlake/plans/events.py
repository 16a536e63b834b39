"""Usage events: landing -> bronze -> enriched, flagged and classified -> daily features."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import catalog as fixed
from ..functions.measures import carried, hits, metric_value, rows
from ..functions.parse import to_instant, to_number
from ..functions.text import RULES, clean_region, clean_service, clean_text, unknown_region, unknown_service
from ..operators.anomaly import COST, GROUP, cost_profile, with_flags
from ..operators.dedupe import SURPLUS, kept_copies, with_surplus
from ..operators.lookup import BROADCAST_LIMIT_BYTES, lookup_join
from ..operators.rules import Rule, apply_rules, unreadable_rule
from ..session import Measured, settle, settle_measured
from ..sources.tables import ROW_ID

EVENT_TEXT = {"service": "service", "region": "region", "metric": "text", "unit": "text"}


def to_bronze(landed: DataFrame, ingest_ts: Column | None = None) -> DataFrame:
    """Parsed and conformed events with arrival lateness. Serves the stream and a batch alike.

    ``ingest_ts`` is the arrival clock: leave it out for a replay (arrival = event time), or give
    ``current_timestamp()`` or a column.
    """
    parsed = landed.withColumns(
        {
            "event_ts": to_instant(F.col("timestamp")),
            "value": to_number(F.col("value")),
            **{c: RULES[rule](F.col(c)) for c, rule in EVENT_TEXT.items()},
        }
    )
    if fixed.UNREADABLE not in landed.columns:
        parsed = parsed.withColumn(fixed.UNREADABLE, F.lit(None).cast("string"))
    clocked = parsed.withColumn("ingest_ts", F.col("event_ts") if ingest_ts is None else ingest_ts)
    latency = F.unix_timestamp("ingest_ts") - F.unix_timestamp("event_ts")
    return clocked.withColumns(
        {
            "event_latency_sec": latency,
            "is_late_arrival": latency > fixed.LATE_AFTER_SECONDS,
            "ingest_date": F.to_date("ingest_ts"),
        }
    )


def user_statistics(users: DataFrame) -> DataFrame:
    """Users and active users per org."""
    return users.groupBy("org_id").agg(
        rows().alias("org_user_count"), hits(F.col("active")).alias("org_active_user_count")
    )


def metric_features(events: DataFrame) -> DataFrame:
    """One column per known metric, and zero for what older event schemas lack."""
    filled = {
        "genai_tokens": F.coalesce("genai_tokens", F.lit(0).cast("bigint")),
        "carbon_kg": F.coalesce("carbon_kg", F.lit(0.0)),
    }
    return events.withColumns({**{m: metric_value(m) for m in fixed.METRIC_FEATURES}, **filled})


class Dimensions(NamedTuple):
    """What events are enriched with, one stored and measured table per key."""

    by_org: Measured
    by_resource: Measured

    @property
    def broadcast(self) -> bool:
        return max(self.by_org.bytes, self.by_resource.bytes) <= BROADCAST_LIMIT_BYTES


def dimensions(customers: DataFrame, resources: DataFrame, users: DataFrame) -> Dimensions:
    """Org attributes with user counts, and resource attributes. Orgs without users, and users of orgs
    unknown to customers, both count, as they do when each is looked up by itself."""
    orgs = customers.select(
        "org_id", *[F.col(c).alias(a) for c, a in fixed.ORG_ATTRIBUTES.items()]
    ).withColumn("org_hq_region", clean_region(F.col("org_hq_region")))
    stock = resources.select(
        "resource_id", *[F.col(c).alias(a) for c, a in fixed.RESOURCE_ATTRIBUTES.items()]
    ).withColumns(
        {
            "resource_service": clean_service(F.col("resource_service")),
            "resource_region": clean_region(F.col("resource_region")),
        }
    )
    return Dimensions(
        settle_measured(orgs.join(user_statistics(users), "org_id", "full"), "orgs"),
        settle_measured(stock, "resources"),
    )


def with_resource(events: DataFrame, known: Dimensions, spread_by: Sequence[str] = ROW_ID) -> DataFrame:
    """Resource attributes on every event, whose service and region win, and the metric features."""
    joined = lookup_join(events, known.by_resource, ["resource_id"], spread_by=spread_by)
    conformed = joined.withColumns(
        {
            "service": F.coalesce("resource_service", clean_service(F.col("service"))),
            "region": F.coalesce("resource_region", clean_region(F.col("region"))),
            "metric": clean_text(F.col("metric")),
            "unit": clean_text(F.col("unit")),
            "usage_date": F.to_date("event_ts"),
        }
    )
    return metric_features(conformed)


def with_org(
    events: DataFrame,
    known: Dimensions,
    spread_by: Sequence[str] = ROW_ID,
    count_in: DataFrame | None = None,
) -> DataFrame:
    """Org attributes and user counts on every event."""
    joined = lookup_join(events, known.by_org, ["org_id"], spread_by=spread_by, count_in=count_in)
    counts = ("org_user_count", "org_active_user_count")
    return joined.withColumns({c: F.coalesce(c, F.lit(0).cast("bigint")) for c in counts})


def enrich(events: DataFrame, known: Dimensions, spread_by: Sequence[str] = ROW_ID) -> DataFrame:
    """Org, resource and user attributes on every event; the resource's service and region win."""
    return with_org(with_resource(events, known, spread_by), known, spread_by, count_in=events)


def event_rules(as_of: Column | None = None) -> list[Rule]:
    """The eleven quarantine rules in order of priority. ``as_of`` is the clock of the future rule."""
    now = F.current_timestamp() if as_of is None else as_of
    col = F.col
    return [
        Rule(fixed.NULL_EVENT_ID, col("event_id").isNull()),
        Rule(fixed.DUPLICATE_EVENT_ID, col(SURPLUS)),
        Rule(fixed.VALUE_WITHOUT_UNIT, col("value").isNotNull() & col("unit").isNull()),
        Rule(fixed.COST_BELOW_MINIMUM, col("cost_usd_increment") < fixed.MINIMUM_COST),
        Rule(fixed.BAD_EVENT_TS, col("event_ts").isNull()),
        Rule(fixed.UNKNOWN_SERVICE, unknown_service(col("service"))),
        Rule(fixed.UNKNOWN_REGION, unknown_region(col("region"))),
        Rule(fixed.UNKNOWN_ORG, col("org_name").isNull()),
        Rule(fixed.UNKNOWN_RESOURCE, col("resource_id").isNotNull() & col("resource_service").isNull()),
        Rule(fixed.TOO_LATE, col("event_latency_sec") > fixed.QUARANTINE_AFTER_SECONDS),
        Rule(
            fixed.IN_THE_FUTURE,
            col("event_ts") > now + F.make_dt_interval(secs=F.lit(fixed.FUTURE_TOLERANCE_SECONDS)),
        ),
    ]


# Which copy of a repeated event stays: the latest by event time, then by these columns.
COPY_ORDER = (
    "event_ts",
    "ingest_ts",
    "cost_usd_increment",
    "org_id",
    "resource_id",
    "service",
    "region",
    "metric",
    "value",
    "unit",
)


def classify(marked: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Every event (with its SURPLUS mark) once, with the reasons it breaks: valid + quarantined = all, by
    construction."""
    return apply_rules(marked, [*unreadable_rule(marked), *event_rules(as_of)]).drop(SURPLUS)


# What silver needs of every event before it can judge one.
NARROW = tuple(dict.fromkeys(["event_id", *COPY_ORDER, *GROUP, COST]))


def silver_events(
    events: DataFrame,
    customers: DataFrame,
    resources: DataFrame,
    users: DataFrame,
    as_of: Column | None = None,
    row_id: Sequence[str] = ROW_ID,
    profile: Measured | None = None,
) -> DataFrame:
    """Bronze events to classified events. The anomaly statistics count every row, the bad ones too; a
    ``profile`` of them that was made before takes their place.

    Events are parsed twice. The first pass stores the columns that repeated ids and statistics need, which
    are read from there, each by itself; the last reads the full rows and looks up orgs and findings. If the
    dimensions are too large to broadcast, the rows are stored with their resources instead of being shuffled
    twice.
    """
    known = dimensions(customers, resources, users)
    stocked = with_resource(events, known, row_id)
    if known.broadcast:
        narrow = settle(stocked.select(*NARROW, *row_id), "narrow-events")
    else:
        stocked = settle(stocked, "events-with-resources")
        narrow = stocked.select(*NARROW, *row_id)
    kept = kept_copies(narrow, ["event_id"], COPY_ORDER, row_id=row_id)
    found = cost_profile(narrow, spread_by=row_id) if profile is None else profile
    marked = with_surplus(stocked, kept, ["event_id"], row_id=row_id)
    flagged = with_flags(marked, found, spread_by=row_id, count_in=narrow)
    return classify(with_org(flagged, known, row_id, count_in=narrow), as_of)


def service_daily(valid: DataFrame) -> DataFrame:
    """Daily features per org and service."""
    flag = F.col("is_cost_anomaly")
    totals = ("requests", "cpu_hours", "storage_gb_hours", "genai_tokens", "carbon_kg")
    return valid.groupBy("org_id", "usage_date", "service").agg(
        *[carried(c).alias(c) for c in ("org_name", "org_industry", "org_plan_tier")],
        F.sum("cost_usd_increment").alias("daily_cost_usd"),
        *[F.sum(c).alias(c) for c in totals],
        rows().alias("event_count"),
        hits(flag).alias("anomaly_event_count"),
        F.max(flag.cast("int")).alias("has_cost_anomaly"),
    )
