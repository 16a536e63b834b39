"""Registered queries that write and read back: sources, sinks, layouts, streams and serving loads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.catalog import EVENT_BRONZE, EVENT_LANDING, EVENT_RELAID, MASTERS, NULL_EVENT_ID, UNREADABLE
from meterlake.operators.rules import REASON, Rule, apply_rules, unreadable_rule
from meterlake.plans import checks, marts, serving
from meterlake.plans.layout import relayout
from meterlake.plans.masters import bronze_master, classify_master, landed_master
from meterlake.session import fresh_path, settle
from meterlake.sinks.parquet import save_to, write_partitioned
from meterlake.sources.tables import read_parquet
from meterlake.sources.versioned import VersionedTable
from meterlake.plans.events import to_bronze
from meterlake.plans.pipeline import Lake
from meterlake.streaming.counters import BATCHES, counted, finish, listen
from meterlake.streaming.ingest import NAMED, UNNAMED, event_stream, start_ingest
from meterlake.streaming.publish import load_frame, load_stream, merge_batch, refused_table

from .proxies import AS_OF, bronze_events, landed, silver, table
from .queries import _LINE_ORDER, tickets_mart, usage
from .registry import query, rounded, rounded_sql


@query(
    "csv_typed_ingest",
    """SELECT user_id, org_id, email, role, active, created_at, last_login, 'landing/users.csv' AS source_file
       FROM (SELECT user_id, org_id, trim(email) AS email, role, lower(trim(active)) IS NOT DISTINCT FROM 'true'
                        AS active,
                    try_cast(created_at AS DATE) AS created_at, try_cast(last_login AS DATE) AS last_login,
                    row_number() OVER (PARTITION BY user_id ORDER BY org_id DESC NULLS LAST,
                                       trim(email) DESC NULLS LAST) AS nth
             FROM users_raw)
       WHERE nth = 1 OR user_id IS NULL""",
)
def csv_typed_ingest(spark, sf):
    """The users as CSV, then typed, stamped and deduplicated as bronze does it."""
    path = f"{fresh_path(spark, 'landing')}/users.csv"
    landed(spark, sf, "users").write.option("header", True).csv(path)
    users = MASTERS["users"]
    found = bronze_master(landed_master(spark, users, path), users)
    return found.drop("ingest_ts", "ingest_date", UNREADABLE)


@query(
    "unreadable_lines",
    """SELECT 'users' AS source, coalesce(reason, 'valid') AS reason, count(*)::BIGINT AS n FROM (
           SELECT CASE WHEN user_id IS NULL THEN 'null primary key'
                       WHEN NOT EXISTS (SELECT 1 FROM customers c WHERE c.org_id = u.org_id)
                       THEN 'org_id not found in customers_orgs' END AS reason FROM users_typed u
           UNION ALL SELECT 'unreadable landing line' FROM nation) GROUP BY ALL
       UNION ALL
       SELECT 'events', reason, count(*)::BIGINT FROM (
           SELECT CASE WHEN event_id IS NULL THEN 'null event_id' ELSE 'valid' END AS reason FROM events_raw
           UNION ALL SELECT 'unreadable landing line' FROM nation) GROUP BY ALL""",
)
def unreadable_lines(spark, sf):
    """CSV and JSON files with a broken line for each nation among them: each line is a row that some rule
    judges, and none is lost. An event id that comes twice is one here, so each gets its own."""
    broken = table(spark, sf, "nation").select(F.concat(F.lit("#"), F.col("n_nationkey").cast("string")).alias("key"))
    csv, json_lines = fresh_path(spark, "landing"), fresh_path(spark, "landing-events")
    users = MASTERS["users"]
    landed(spark, sf, "users").write.option("header", True).csv(f"{csv}/users.csv")
    # One file with one header, as a CSV file has.
    lines = F.concat_ws("\n", F.lit(",".join(users.landing.names)), F.array_sort(F.collect_list("key")))
    broken.agg(lines).write.mode("append").text(f"{csv}/users.csv")
    found = bronze_master(landed_master(spark, users, f"{csv}/users.csv"), users)
    judged = classify_master(found, users, silver(spark, sf, "customers_orgs"))
    counted = judged.groupBy(F.lit("users").alias("source"), F.coalesce(REASON, F.lit("valid")).alias("reason"))

    _landing_rows(spark, sf).write.json(json_lines)
    broken.select(F.concat(F.lit('{"event_id": "'), "key", F.lit('", "timesta'))).write.mode("append").text(json_lines)
    streamed = _ingested(spark, json_lines, fresh_path(spark, "stream"))[1]
    rules = [*unreadable_rule(streamed), Rule(NULL_EVENT_ID, F.col("event_id").isNull())]
    events = apply_rules(streamed, rules)
    by_event = events.groupBy(F.lit("events").alias("source"), F.coalesce(REASON, F.lit("valid")).alias("reason"))
    return counted.agg(F.count("*").alias("n")).unionAll(by_event.agg(F.count("*").alias("n")))


@query(
    "ingest_counters",
    """SELECT 'lineitem' AS dataset, count(*)::BIGINT AS raw_count,
              count(DISTINCT (l_orderkey, l_linenumber))::BIGINT AS deduped_count,
              (count(*) - count(DISTINCT (l_orderkey, l_linenumber)))::BIGINT AS removed_duplicates
       FROM lineitem""",
)
def ingest_counters(spark, sf):
    from meterlake.operators.dedupe import keep_latest

    lines = table(spark, sf, "lineitem")
    kept = keep_latest(lines, ["l_orderkey", "l_linenumber"], _LINE_ORDER)
    return checks.ingest_counters(lines, kept, "lineitem")


@query(
    "partitioned_write_roundtrip",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders""",
)
def partitioned_write_roundtrip(spark, sf):
    """Hive-partitioned Parquet, read with its schema, then through the generic sink and back."""
    orders = table(spark, sf, "orders").drop("o_orderdate")
    first, second = fresh_path(spark, "by-status"), fresh_path(spark, "generic")
    write_partitioned(orders, first, ["o_orderstatus"])
    save_to(read_parquet(spark, first, orders.schema), "orc", {"path": second})
    return spark.read.schema(orders.schema).orc(second)


_BRONZE_PICK = "event_id, org_id, resource_id, service, region, metric, unit, value, cost_usd_increment, schema_version"


def _bronze_layout(df: DataFrame) -> DataFrame:
    return df.withColumn("source_file", F.lit("events")).select(*[f.name for f in EVENT_BRONZE])


@query("relayout", f"SELECT {_BRONZE_PICK}, event_ts::DATE AS usage_date FROM bronze")
def relayout_events(spark, sf):
    stream_folder = fresh_path(spark, "bronze-events")
    write_partitioned(_bronze_layout(bronze_events(spark, sf)), stream_folder, ["ingest_date"])
    target = VersionedTable(spark, fresh_path(spark, "bronze-by-date"), EVENT_RELAID)
    relayout(spark, stream_folder, target, fresh_path(spark, "relayout-checkpoint"))
    return target.read().select(*_BRONZE_PICK.split(", "), "usage_date")


# Streams ----------------------------------------------------------------------------------------------
def _landing_rows(spark, sf) -> DataFrame:
    """Usage events as they land, each under an id of its own; some without."""
    own = F.when(F.col("event_id").isNotNull(), F.concat(F.lit("evt-"), "src"))
    rows = landed(spark, sf, "usage_events").withColumn("event_id", own)
    return rows.select(*[f.name for f in EVENT_LANDING])


def _ingested(spark, landing: str, folder: str, **options) -> tuple[int, DataFrame]:
    query_ = start_ingest(spark, landing, f"{folder}/events", f"{folder}/checkpoint", **options)
    seen = finish(spark, query_)
    return seen[NAMED] + seen[UNNAMED], read_parquet(spark, f"{folder}/events", EVENT_BRONZE)


_STREAMED = "event_id, org_id, service, region, metric, unit, value, cost_usd_increment, genai_tokens"
_STREAMED_SQL = f"""
    SELECT CASE WHEN event_id IS NOT NULL THEN 'evt-' || src END AS event_id,
           {_STREAMED.partition(', ')[2]}, event_ts::DATE AS ingest_date,
           CASE WHEN event_ts IS NOT NULL THEN 0::BIGINT END AS event_latency_sec,
           CASE WHEN event_ts IS NOT NULL THEN false END AS is_late_arrival
    FROM bronze"""


def _streamed(df: DataFrame) -> DataFrame:
    return df.select(*_STREAMED.split(", "), "ingest_date", "event_latency_sec", "is_late_arrival")


@query("stream_ingest", _STREAMED_SQL)
def stream_ingest(spark, sf):
    """JSON lines through the stream into bronze, on the replay clock."""
    landing = fresh_path(spark, "landing-events")
    _landing_rows(spark, sf).write.json(landing)
    return _streamed(_ingested(spark, landing, fresh_path(spark, "stream"))[1])


@query(
    "stream_dedupe",
    f"SELECT * FROM ({_STREAMED_SQL}) UNION ALL SELECT * FROM ({_STREAMED_SQL}) WHERE event_id IS NULL",
)
def stream_dedupe(spark, sf):
    """Every event lands twice; those with an id come out once."""
    rows = _landing_rows(spark, sf)
    landing = fresh_path(spark, "landing-events")
    rows.unionAll(rows).write.json(landing)
    return _streamed(_ingested(spark, landing, fresh_path(spark, "stream"), dedupe="bounded")[1])


@query(
    "stream_global",
    f"SELECT * FROM ({_STREAMED_SQL}) UNION ALL SELECT * FROM ({_STREAMED_SQL}) WHERE event_id IS NULL",
)
def stream_global(spark, sf):
    """As ``stream_dedupe``, with ids that are never forgotten; the second copies come in a second run."""
    rows = _landing_rows(spark, sf)
    landing, folder = fresh_path(spark, "landing-events"), fresh_path(spark, "stream")
    rows.write.json(landing)
    _ingested(spark, landing, folder, dedupe="global")
    rows.write.mode("append").json(landing)
    return _streamed(_ingested(spark, landing, folder, dedupe="global")[1])


@query(
    "load_counters",
    """SELECT * FROM (VALUES
           ('read', (SELECT count(*) FROM events_raw)),
           ('without_id', (SELECT count(*) FROM events_raw WHERE event_id IS NULL)),
           ('without_time', (SELECT count(*) FROM bronze WHERE event_ts IS NULL)),
           ('batches', 120)) t(counter, n)""",
)
def load_counters(spark, sf):
    """Rows counted in 120 batches of one file each, more than a query's own progress remembers."""
    landing = fresh_path(spark, "landing-events")
    _landing_rows(spark, sf).repartition(120).write.json(landing)
    events = counted(to_bronze(event_stream(spark, landing, files_per_trigger=1)), "read")
    no_id = counted(events.where(F.col("event_id").isNull()), "without_id")
    no_time = counted(events.where(F.col("event_ts").isNull()), "without_time")
    listen(spark)
    query_ = (
        no_id.select("event_ts").unionAll(no_time.select("event_ts"))
        .writeStream.format("noop")
        .option("checkpointLocation", fresh_path(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    seen = finish(spark, query_)
    found = {name: seen[name] for name in ("read", "without_id", "without_time")}
    counts = checks.counted_snapshot(spark, {**found, "batches": seen[BATCHES]})
    return counts.withColumnRenamed("metric", "counter")


@query(
    "rerun_compare",
    """SELECT * FROM (VALUES ('bronze_customers_orgs', (SELECT count(*) FROM customer), true),
           ('bronze_users', (SELECT count(*) FROM users_typed), true),
           ('bronze_events', (SELECT count(*) FROM events_raw), true),
           ('silver_customers_orgs', (SELECT count(*) FROM customer), true),
           ('silver_users', (SELECT count(*) FROM users_typed), true)) t(metric, n, ok)""",
)
def rerun_compare(spark, sf):
    """Two masters and the events of a lake, from landing to silver, twice: the second run changes nothing."""
    lake = Lake(spark, fresh_path(spark, "lake"))
    names = ("customers_orgs", "users")
    for name in names:
        rows = landed(spark, sf, name)
        rows.write.option("header", True).csv(f"{lake.root}/landing/{name}.csv")
    _landing_rows(spark, sf).coalesce(2).write.json(f"{lake.root}/landing/usage_events_stream/all.jsonl")

    def run() -> DataFrame:
        for name in names:
            lake.ingest_master(name)
            lake.build_silver_master(name)
        lake.ingest_events()
        counts = {
            **{f"bronze_{n}": lake.bronze_table(n).current().rows for n in names},
            "bronze_events": lake.bronze_events_table().current().rows,
            **{f"silver_{n}": lake.silver_table(n).current().rows for n in names},
        }
        return checks.counted_snapshot(spark, counts)

    compared = checks.compare_snapshots(run(), run())
    return compared.select("metric", F.col("after").alias("n"), "ok")


@query(
    "stream_resume",
    """SELECT schema_version,
              (count(*) + count(*) FILTER (WHERE event_id IS NULL AND schema_version = 1))::BIGINT AS n,
              count(event_id)::BIGINT AS named,
              (SELECT count(*) FROM events_raw WHERE schema_version = 1)::BIGINT AS first_run,
              (SELECT count(*) FROM events_raw)::BIGINT AS second_run,
              0::BIGINT AS third_run
       FROM events_raw GROUP BY schema_version""",
)
def stream_resume(spark, sf):
    """Files land in two lots with a run after each, and a third run finds nothing new. The second lot brings
    the first once more: ids that an earlier run let through are not let through again."""
    rows = _landing_rows(spark, sf)
    landing, folder = fresh_path(spark, "landing-events"), fresh_path(spark, "stream")
    rows.where("schema_version = 1").write.json(landing)
    first, _ = _ingested(spark, landing, folder)
    rows.write.mode("append").json(landing)
    second, _ = _ingested(spark, landing, folder)
    third, bronze = _ingested(spark, landing, folder)
    counted = bronze.groupBy("schema_version").agg(
        F.count(F.lit(1)).alias("n"), F.count("event_id").alias("named")
    )
    runs = {"first_run": first, "second_run": second, "third_run": third}
    return counted.withColumns({name: F.lit(n).cast("bigint") for name, n in runs.items()})


_FUTURE = "schema_version = 1 AND src % 40 = 0"


@query(
    "stream_future_clock",
    f"""SELECT CASE WHEN event_id IS NOT NULL THEN 'evt-' || src END AS event_id, org_id, schema_version,
               CASE WHEN {_FUTURE} THEN DATE '2099-01-01' ELSE event_ts::DATE END AS ingest_date
        FROM bronze""",
)
def stream_future_clock(spark, sf):
    """Events of a clock far ahead come with the first lot; the second lot loses nothing by it."""
    rows = landed(spark, sf, "usage_events").withColumns(
        {
            "event_id": F.when(F.col("event_id").isNotNull(), F.concat(F.lit("evt-"), "src")),
            "timestamp": F.when(F.expr(_FUTURE), "2099-01-01 00:00:00").otherwise(F.col("timestamp")),
        }
    )
    lots = rows.select(*[f.name for f in EVENT_LANDING])
    landing, folder = fresh_path(spark, "landing-events"), fresh_path(spark, "stream")
    lots.where("schema_version = 1").write.json(landing)
    _ingested(spark, landing, folder, watermark="1 hour")
    lots.where("schema_version = 2").write.mode("append").json(landing)
    found = _ingested(spark, landing, folder, watermark="1 hour")[1]
    return found.select("event_id", "org_id", "schema_version", "ingest_date")


# Serving loads ----------------------------------------------------------------------------------------
@query(
    "serving_upsert",
    f"""SELECT org_id, severity, ticket_date, org_name, ticket_count::INT AS ticket_count,
               sla_breach_count::INT AS sla_breach_count, {rounded_sql("sla_breach_rate avg_csat")}
        FROM tickets_mart WHERE severity IS NOT NULL AND ticket_date IS NOT NULL""",
)
def serving_upsert(spark, sf):
    """A first load with wrong counts, then the right rows as new files: the same keys, the last wins."""
    spec = serving.SERVING["tickets_by_org_date"]
    mart = settle(tickets_mart(spark, sf), "tickets")
    source, checkpoint = fresh_path(spark, "mart-files"), fresh_path(spark, "load-checkpoint")
    target = VersionedTable(spark, fresh_path(spark, "serving"), spec.schema)
    mart.withColumn("ticket_count", F.col("ticket_count") + 1000).write.parquet(source)
    load_stream(spark, source, target, spec, checkpoint)
    mart.write.mode("append").parquet(source)
    load_stream(spark, source, target, spec, checkpoint)
    return target.read().withColumns(
        dict(zip(("sla_breach_rate", "avg_csat"), rounded("sla_breach_rate avg_csat")))
    )


@query(
    "serving_last_wins",
    f"""SELECT org_id, severity, ticket_date, ticket_count::INT AS ticket_count,
               sla_breach_count::INT AS sla_breach_count, {rounded_sql("sla_breach_rate avg_csat")}
        FROM tickets_mart WHERE severity IS NOT NULL AND ticket_date IS NOT NULL""",
)
def serving_last_wins(spark, sf):
    """Two loads wait for one run. The first has the greater counts, the second the right ones."""
    spec = serving.SERVING["tickets_by_org_date"]
    mart = settle(tickets_mart(spark, sf), "tickets")
    source = fresh_path(spark, "mart-files")
    target = VersionedTable(spark, fresh_path(spark, "serving"), spec.schema)
    mart.withColumn("ticket_count", F.col("ticket_count") + 1000).write.parquet(source)
    mart.write.mode("append").parquet(source)
    load_stream(spark, source, target, spec, fresh_path(spark, "load-checkpoint"))
    rates = rounded("sla_breach_rate avg_csat")
    return target.read().select(
        "org_id", "severity", "ticket_date", "ticket_count", "sla_breach_count", *rates
    )


@query(
    "serving_last_partition",
    """SELECT org_id, period_end, rank, service, round(accumulated_cost_usd, 4) AS accumulated_cost_usd
       FROM tops WHERE rank <= 3 AND service IS NOT NULL""",
)
def serving_last_partition(spark, sf):
    """Five ranks and then three wait for one run: ranks four and five of the older load do not stay."""
    spec = serving.SERVING["org_top_services_by_cost"]
    daily = settle(usage(spark, sf), "usage")
    source = fresh_path(spark, "mart-files")
    target = VersionedTable(spark, fresh_path(spark, "serving"), spec.schema)
    for hour, n in enumerate((5, 3)):
        built = F.lit(AS_OF).cast("timestamp") + F.make_dt_interval(hours=F.lit(hour))
        top = marts.top_services(daily, n=n).withColumn("gold_ts", built)
        top.write.mode("append").parquet(source)
    load_stream(spark, source, target, spec, fresh_path(spark, "load-checkpoint"))
    cost = rounded("accumulated_cost_usd", 4)
    return target.read().select("org_id", "period_end", "rank", "service", *cost)


@query(
    "serving_refused",
    """SELECT org_id, usage_date, service, event_count::INT AS event_count, 'service' AS missing FROM daily
       WHERE service IS NULL""",
)
def serving_refused(spark, sf):
    """Daily usage without a service is refused by the table that it keys, and kept with the reason."""
    spec = serving.SERVING["org_daily_usage_by_service"]
    mart = usage(spark, sf).withColumn("gold_ts", F.lit(AS_OF).cast("timestamp"))
    target = VersionedTable(spark, fresh_path(spark, "serving"), spec.schema)
    merge_batch(target, spec, mart, whole=True)
    missing = F.array_join(serving.REFUSED, ",").alias("missing")
    refused = refused_table(target, spec).read_or_empty()
    return refused.select("org_id", "usage_date", "service", "event_count", missing)


@query(
    "replace_partitions",
    """SELECT org_id, period_end, rank, service, period_start,
              round(accumulated_cost_usd, 4) AS accumulated_cost_usd
       FROM tops WHERE rank <= 3 AND service IS NOT NULL
       UNION ALL
       SELECT org_id, (period_end - 30)::DATE, rank, service, period_start, round(accumulated_cost_usd, 4)
       FROM tops WHERE service IS NOT NULL""",
)
def replace_partitions(spark, sf):
    """Five ranks of two periods are loaded, then three ranks of the last: ranks four and five of that
    period go, the other period stays."""
    spec = serving.SERVING["org_top_services_by_cost"]
    daily = settle(usage(spark, sf), "usage")
    five = settle(marts.top_services(daily), "five")
    three = marts.top_services(daily, n=3)
    earlier = five.withColumn("period_end", F.date_sub("period_end", 30))
    target = VersionedTable(spark, fresh_path(spark, "serving"), spec.schema)
    staging, checkpoint = fresh_path(spark, "staging"), fresh_path(spark, "load-checkpoint")
    load_frame(five.unionByName(earlier), staging, target, spec, checkpoint)
    load_frame(three, staging, target, spec, checkpoint)
    return target.read().withColumn("accumulated_cost_usd", F.round("accumulated_cost_usd", 4))
