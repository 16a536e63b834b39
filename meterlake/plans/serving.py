"""Serving tables: contracts, projections, and the parameterised lookups they answer."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import catalog as fixed
from ..operators.keyed import arrange_by_key
from ..schemas import columns


@dataclass(frozen=True)
class ServingTable:
    """Key layout and columns. A row with a null in a ``not null`` column is refused: loads keep it apart,
    with the names of those columns, and serve the others."""

    name: str
    partition_key: tuple[str, ...]
    clustering: tuple[tuple[str, str], ...]
    ddl: str
    replaces_partitions: bool = False

    @property
    def schema(self) -> T.StructType:
        return columns(self.ddl)

    @property
    def keys(self) -> tuple[str, ...]:
        return self.partition_key + tuple(c for c, _ in self.clustering)


SERVING: dict[str, ServingTable] = {
    t.name: t
    for t in (
        ServingTable(
            "org_daily_usage_by_service",
            ("org_id",),
            (("usage_date", "desc"), ("service", "asc")),
            "org_id string not null, usage_date date not null, service string not null, org_name string, "
            "org_industry string, org_plan_tier string, event_count int not null, "
            "total_daily_cost_usd double not null, total_requests double not null, "
            "total_genai_tokens bigint not null, total_carbon_kg double not null, "
            "anomaly_event_count int not null, has_cost_anomaly boolean not null, gold_ts timestamp",
        ),
        ServingTable(
            "org_top_services_by_cost",
            ("org_id", "period_end"),
            (("rank", "asc"), ("service", "asc")),
            "org_id string not null, period_end date not null, rank int not null, service string not null, "
            "period_start date not null, accumulated_cost_usd double not null",
            replaces_partitions=True,
        ),
        ServingTable(
            "tickets_by_org_date",
            ("org_id", "severity"),
            (("ticket_date", "desc"),),
            "org_id string not null, severity string not null, ticket_date date not null, org_name string, "
            "ticket_count int not null, sla_breach_count int not null, sla_breach_rate double not null, "
            "avg_csat double",
        ),
        ServingTable(
            "revenue_by_org_month",
            ("org_id",),
            (("billing_month", "desc"),),
            "org_id string not null, billing_month date not null, org_name string, "
            "subtotal_usd double not null, credits_usd double not null, taxes_usd double not null, "
            "revenue_usd double not null, invoice_count int not null",
        ),
        ServingTable(
            "genai_tokens_by_org_date",
            ("org_id",),
            (("usage_date", "desc"),),
            "org_id string not null, usage_date date not null, org_name string, "
            "total_genai_tokens bigint not null, estimated_cost_usd double not null, event_count int not null",
        ),
    )
}


REFUSED = "_refused"


def refused_schema(table: ServingTable) -> T.StructType:
    """Of refused rows: the table's columns and the names of those that are null and must not be."""
    names = T.StructField(REFUSED, T.ArrayType(T.StringType()))
    return T.StructType([*[T.StructField(f.name, f.dataType) for f in table.schema], names])


def judged(mart: DataFrame, table: ServingTable, *also: Column) -> DataFrame:
    """All rows of the mart in the table's columns and types, with REFUSED; ``also`` are further columns."""
    values = {f.name: F.col(f.name).cast(f.dataType) for f in table.schema}
    required = [f.name for f in table.schema if not f.nullable]
    missing = F.filter(
        F.array(*[F.when(values[c].isNull(), F.lit(c)) for c in required]), lambda name: name.isNotNull()
    )
    return mart.select(*[v.alias(c) for c, v in values.items()], missing.alias(REFUSED), *also)


def to_serving(mart: DataFrame, table: ServingTable) -> DataFrame:
    """The mart's rows that the table takes, in its columns and types."""
    return judged(mart, table).where(F.size(REFUSED) == 0).drop(REFUSED)


def laid_out(df: DataFrame, table: ServingTable, first: Sequence[str] = ()) -> DataFrame:
    return arrange_by_key(df, table.partition_key, table.clustering, first)


@dataclass(frozen=True)
class Lookup:
    """A point lookup: equality on some key columns, an optional inclusive range, the columns it returns."""

    table: str
    equals: tuple[str, ...]
    returns: tuple[str, ...]
    between: str | None = None
    order: tuple[str, ...] = ()


LOOKUPS = {
    "daily_costs_and_requests": Lookup(
        "org_daily_usage_by_service", ("org_id",),
        ("usage_date", "service", "total_daily_cost_usd", "total_requests"), "usage_date",
    ),
    "top_services_by_cost": Lookup(
        "org_top_services_by_cost", ("org_id", "period_end"),
        ("service", "accumulated_cost_usd", "period_start", "period_end", "rank"), order=("rank",),
    ),
    "critical_tickets_sla": Lookup(
        "tickets_by_org_date", ("org_id", "severity"),
        ("ticket_date", "ticket_count", "sla_breach_count", "sla_breach_rate", "avg_csat"), "ticket_date",
    ),
    "monthly_revenue": Lookup(
        "revenue_by_org_month", ("org_id",),
        ("billing_month", "subtotal_usd", "credits_usd", "taxes_usd", "revenue_usd", "invoice_count"),
        "billing_month",
    ),
    "genai_tokens_daily": Lookup(
        "genai_tokens_by_org_date", ("org_id",),
        ("usage_date", "total_genai_tokens", "estimated_cost_usd"), "usage_date",
    ),
}


def _day(value: str | date | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def look_up(
    df: DataFrame,
    lookup: Lookup,
    keys: dict[str, object],
    start: str | date | Column | None = None,
    end: str | date | Column | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Answer a lookup from a serving table. All conditions are on stored columns, so they reach the scan.
    Rows come in the order of the lookup, else of the table's clustering."""
    table = SERVING[lookup.table]
    types = {f.name: f.dataType for f in table.schema}
    for name in lookup.equals:
        df = df.where(F.col(name) == F.lit(keys[name]).cast(types[name]))
    if lookup.between is not None:
        df = df.where(F.col(lookup.between).between(_day(start), _day(end)))
    by = dict(table.clustering)
    order = [
        F.col(c).desc() if by.get(c) == "desc" else F.col(c).asc() for c in (lookup.order or tuple(by))
    ]
    found = df.select(*lookup.returns).orderBy(*order)
    return found if limit is None else found.limit(limit)


def daily_costs_and_requests(df: DataFrame, org_id: str, start_date, end_date) -> DataFrame:
    return look_up(df, LOOKUPS["daily_costs_and_requests"], {"org_id": org_id}, start_date, end_date)


def top_services_by_cost(df: DataFrame, org_id: str, period_end, top_n: int = fixed.TOP_SERVICES) -> DataFrame:
    keys = {"org_id": org_id, "period_end": period_end}
    return look_up(df, LOOKUPS["top_services_by_cost"], keys, limit=top_n)


def critical_tickets_sla(df: DataFrame, org_id: str, severity: str, start_date, end_date) -> DataFrame:
    keys = {"org_id": org_id, "severity": severity}
    return look_up(df, LOOKUPS["critical_tickets_sla"], keys, start_date, end_date)


def monthly_revenue(df: DataFrame, org_id: str, start_month, end_month) -> DataFrame:
    return look_up(df, LOOKUPS["monthly_revenue"], {"org_id": org_id}, start_month, end_month)


def genai_tokens_daily(df: DataFrame, org_id: str, start_date, end_date) -> DataFrame:
    return look_up(df, LOOKUPS["genai_tokens_daily"], {"org_id": org_id}, start_date, end_date)


# Parameters of the lookups, found in the marts -------------------------------------------------------
Period = tuple[date | None, date | None]


def top_org(usage: DataFrame) -> DataFrame:
    """The org with the highest total cost; the lowest id among equals."""
    return (
        usage.groupBy("org_id")
        .agg(F.sum("total_daily_cost_usd").alias("total_cost_usd"))
        .orderBy(F.col("total_cost_usd").desc_nulls_last(), F.col("org_id"))
        .limit(1)
    )


def top_services_period(tops: DataFrame, usage: DataFrame, org_id: str) -> DataFrame:
    """One row: the org's window in the top-services mart, else the window at the last usage date."""
    last = usage.agg(F.max("usage_date")).scalar()
    return (
        tops.where(F.col("org_id") == org_id)
        .agg(F.max("period_start").alias("start"), F.max("period_end").alias("end"))
        .select(
            F.when(F.col("end").isNotNull(), F.col("start"))
            .otherwise(F.date_sub(last, fixed.TOP_SERVICES_DAYS - 1))
            .alias("period_start"),
            F.coalesce("end", last).alias("period_end"),
        )
    )


def tickets_period(tickets: DataFrame, org_id: str, severity: str = "high") -> DataFrame:
    """One row: the days that end at the last ticket of that org and severity; nulls if it has none."""
    return (
        tickets.where((F.col("org_id") == org_id) & (F.col("severity") == severity))
        .agg(F.max("ticket_date").alias("last"))
        .select(
            F.date_sub("last", fixed.TICKET_WINDOW_DAYS - 1).alias("period_start"),
            F.col("last").alias("period_end"),
        )
    )


def whole_period(mart: DataFrame, day: str, org_id: str) -> DataFrame:
    """One row: the first and last day that the mart has for the org; nulls if it has none."""
    return mart.where(F.col("org_id") == org_id).agg(
        F.min(day).alias("period_start"), F.max(day).alias("period_end")
    )


@dataclass(frozen=True)
class LookupParameters:
    """A period without days answers with no rows."""

    org_id: str
    top_period: Period
    ticket_period: Period
    daily_costs_period: Period
    revenue_period: Period
    genai_period: Period
    severity: str = "high"
    top_n: int = fixed.TOP_SERVICES


def lookup_parameters(
    usage: DataFrame,
    tops: DataFrame,
    tickets: DataFrame,
    revenue: DataFrame,
    genai: DataFrame,
    org_id: str | None = None,
) -> LookupParameters:
    """Resolve one org, the one of the highest cost unless given, and its periods, all from the marts: a few
    one-row answers."""
    if org_id is None:
        first = top_org(usage).first()
        if first is None:
            raise LookupError("the usage mart is empty: name an org")
        org_id = first["org_id"]
    periods = (
        top_services_period(tops, usage, org_id),
        tickets_period(tickets, org_id),
        whole_period(usage, "usage_date", org_id),
        whole_period(revenue, "billing_month", org_id),
        whole_period(genai, "usage_date", org_id),
    )
    return LookupParameters(org_id, *[tuple(period.first()) for period in periods])


def run_lookups(tables: dict[str, DataFrame], p: LookupParameters) -> dict[str, DataFrame]:
    """All five lookups, each from its serving table."""
    return {
        "daily_costs_and_requests": daily_costs_and_requests(
            tables["org_daily_usage_by_service"], p.org_id, *p.daily_costs_period
        ),
        "top_services_by_cost": top_services_by_cost(
            tables["org_top_services_by_cost"], p.org_id, p.top_period[1], p.top_n
        ),
        "critical_tickets_sla": critical_tickets_sla(
            tables["tickets_by_org_date"], p.org_id, p.severity, *p.ticket_period
        ),
        "monthly_revenue": monthly_revenue(tables["revenue_by_org_month"], p.org_id, *p.revenue_period),
        "genai_tokens_daily": genai_tokens_daily(tables["genai_tokens_by_org_date"], p.org_id, *p.genai_period),
    }
