"""The lake from landing to serving, over one root folder."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import catalog as fixed
from ..operators.rules import REASON, REASONS
from ..operators.sketches import carried_profile, carry_on
from ..schemas import columns
from ..files import exists, listed, make_folder, remove
from ..session import scratch
from ..sources.versioned import ORPHAN_AFTER_HOURS, VersionedTable
from ..streaming.counters import finish, totals
from ..streaming.ingest import NAMED, PASSED, UNNAMED, start_ingest
from ..streaming.publish import LoadResult, load_result, load_stream, merge_batch, refused_table
from . import checks
from .events import dimensions, service_daily, silver_events, with_resource
from .layout import LAID, RUN, relayout, start_relayout
from .marts import MART_TOTAL, mart_metrics, marts, source_metrics
from .masters import bronze_master, classify_master, landed_master
from .serving import SERVING, LookupParameters, lookup_parameters, run_lookups, to_serving

# Silver rows are written once, split by outcome: reading one outcome prunes the other's files.
OUTCOME, VALID, QUARANTINED = "outcome", "valid", "quarantined"
_VERDICT = columns(f"{REASONS} strings, {REASON} string, silver_ts timestamp, {OUTCOME} string")
_RUN = columns("started timestamp, folder string")


@dataclass(frozen=True)
class EventIngest:
    """Rows read, let through and dropped as copies of an id, rows without an id, whether any were re-laid,
    and the rows of bronze after it."""

    input_rows: int
    relaid: bool
    bronze_rows: int
    dropped_rows: int = 0
    unnamed_rows: int = 0


@dataclass(frozen=True)
class EventStreams:
    """Two queries that run on: events into bronze, and bronze into the layout that silver reads."""

    spark: SparkSession
    ingest: StreamingQuery
    relayout: StreamingQuery

    def catch_up(self) -> None:
        """Wait until all that has landed is re-laid."""
        self.ingest.processAllAvailable()
        self.relayout.processAllAvailable()

    def counted(self) -> dict[str, int]:
        """Rows so far: read, dropped as copies, re-laid."""
        seen = totals(self.spark, self.ingest)
        read = seen[NAMED] + seen[UNNAMED]
        return {"read": read, "dropped": read - seen[PASSED], "laid": totals(self.spark, self.relayout)[LAID]}

    def stop(self) -> None:
        self.ingest.stop()
        self.relayout.stop()


# What is observed of silver while it is written: rows by outcome, and the cost of valid events.
COST = "cost"


def _outcomes(name: str) -> dict[str, Column]:
    """Rows by outcome, and the valid rows' side of what gold reconciles with this table."""
    is_valid = F.col(OUTCOME) == VALID
    counts = {VALID: F.count_if(is_valid), QUARANTINED: F.count_if(~is_valid)}
    return {**counts, **source_metrics(name, is_valid)}


def _judged(schema: T.StructType) -> T.StructType:
    return T.StructType([f for f in schema if f.name != "silver_ts"] + _VERDICT.fields)


def _with_outcome(classified: DataFrame) -> DataFrame:
    verdict = F.when(F.col(REASON).isNull(), VALID).otherwise(QUARANTINED)
    return classified.withColumns({"silver_ts": F.current_timestamp(), OUTCOME: verdict})


class Lake:
    """Zones under ``root``: landing (given), bronze, silver, gold, serving. Steps may run again at any
    time: each publishes new versions, and none overwrites a folder it or another job reads."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # Tables -------------------------------------------------------------------------------------------
    def _versioned(self, zone: str, name: str, schema: T.StructType | None) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/{zone}/{name}", schema)

    def bronze_table(self, master: str) -> VersionedTable:
        return self._versioned("bronze", master, fixed.MASTERS[master].bronze)

    def bronze_events_table(self) -> VersionedTable:
        return self._versioned("bronze", "usage_events_by_date", fixed.EVENT_RELAID)

    def silver_table(self, name: str) -> VersionedTable:
        schema = fixed.EVENT_SILVER if name == "usage_events" else fixed.MASTERS[name].bronze
        return self._versioned("silver", name, _judged(schema))

    def daily_table(self) -> VersionedTable:
        return self._versioned("silver", "org_service_daily", fixed.SERVICE_DAILY)

    def mart_table(self, name: str) -> VersionedTable:
        return self._versioned("gold", name, None)

    def serving_table(self, name: str) -> VersionedTable:
        return self._versioned("serving", name, SERVING[name].schema)

    def silver(self, name: str) -> DataFrame:
        judged = self.silver_table(name).read().where(F.col(OUTCOME) == VALID)
        return judged.drop(REASON, REASONS, OUTCOME, fixed.UNREADABLE)

    def quarantine(self, name: str) -> DataFrame:
        rows = self.silver_table(name).read().where(F.col(OUTCOME) == QUARANTINED)
        return rows.drop(OUTCOME).withColumnRenamed("silver_ts", "quarantine_ts")

    def mart(self, name: str) -> DataFrame:
        return self.mart_table(name).read()

    # Bronze -------------------------------------------------------------------------------------------
    def ingest_master(self, name: str) -> None:
        table = fixed.MASTERS[name]
        landed = landed_master(self.spark, table, f"{self.root}/landing/{name}.csv")
        self.bronze_table(name).publish(bronze_master(landed, table), partition_by=("ingest_date",))

    def ingest_masters(self) -> None:
        for name in fixed.MASTERS:
            self.ingest_master(name)

    def _stream_run(self, reset: bool) -> str:
        """Folder of the current stream run: its output and its checkpoint, which only make sense
        together. A reset starts another run and leaves the old one as it is."""
        log = f"{self.root}/bronze/usage_events_runs"
        if not reset and exists(self.spark, log):
            return self.spark.read.schema(_RUN).json(log).agg(F.max_by("folder", "started")).first()[0]
        folder = f"{self.root}/bronze/usage_events/{uuid.uuid4().hex}"
        line = self.spark.range(1).select(F.current_timestamp().alias("started"), F.lit(folder).alias("folder"))
        line.write.mode("append").json(log)
        return folder

    def ingest_events(
        self,
        *,
        reset: bool = False,
        ingest_ts: Column | None = None,
        watermark: str = fixed.REPLAY_WATERMARK,
        dedupe: str = "bounded",
        spread_copies: int = 1,
        files_per_trigger: int = fixed.FILES_PER_TRIGGER,
    ) -> EventIngest:
        """Stream what has landed since the last call into bronze, and re-lay what is not re-laid yet, which
        may be more if an earlier call was stopped in between."""
        run = self._stream_run(reset)
        query = self._start_ingest(
            run,
            ingest_ts=ingest_ts,
            watermark=watermark,
            dedupe=dedupe,
            spread_copies=spread_copies,
            files_per_trigger=files_per_trigger,
        )
        seen = finish(self.spark, query)
        read = seen[NAMED] + seen[UNNAMED]
        target = self.bronze_events_table()
        laid = relayout(self.spark, f"{run}/events", target, f"{run}/relayout-checkpoint")
        version = target.current()
        return EventIngest(read, laid > 0, version.rows if version else 0, read - seen[PASSED], seen[UNNAMED])

    def start_events(self, every: str, *, reset: bool = False, **options) -> EventStreams:
        """Stream into bronze, and from there into the layout that silver reads, each with a trigger every
        ``every`` interval until they are stopped. Small files of the layout merge as it goes. The options are
        those of ``ingest_events``, which goes on where this stopped."""
        run = self._stream_run(reset)
        make_folder(self.spark, f"{run}/events")
        ingest = self._start_ingest(run, every=every, **options)
        try:
            laid = start_relayout(
                self.spark,
                f"{run}/events",
                self.bronze_events_table(),
                f"{run}/relayout-checkpoint",
                every=every,
            )
        except Exception:
            ingest.stop()
            raise
        return EventStreams(self.spark, ingest, laid)

    def _start_ingest(self, run: str, **options) -> StreamingQuery:
        landing = f"{self.root}/landing/usage_events_stream/*.jsonl"
        return start_ingest(self.spark, landing, f"{run}/events", f"{run}/checkpoint", **options)

    def bronze_events(self) -> DataFrame:
        """Relaid events with their row identity, or an error that says what to run first."""
        table = self.bronze_events_table()
        if table.current() is None:
            raise FileNotFoundError(f"no usage events under {self.root}; run ingest_events first")
        return table.read(row_id=True)

    # Silver -------------------------------------------------------------------------------------------
    def build_silver_master(self, name: str) -> None:
        table = fixed.MASTERS[name]
        customers = self.silver("customers_orgs") if table.owned_by_org else None
        with scratch(self.spark):
            classified = classify_master(self.bronze_table(name).read(), table, customers)
            self.silver_table(name).publish(
                _with_outcome(classified), partition_by=(OUTCOME, "ingest_date"), metrics=_outcomes(name)
            )

    def summaries_table(self) -> VersionedTable:
        """Daily summaries of event costs, one row per org, service and day."""
        return self._versioned("silver", "cost_summaries", None)

    def refresh_summaries(self) -> list[str]:
        """Summarise the costs of days whose events have changed since the last call, all days if the stream
        was reset or resources have changed; give the cells of those days. Events are only ever added to
        bronze, so a day that has as many as before has not changed."""
        bronze, summaries = self.bronze_events_table(), self.summaries_table()
        laid, last = bronze.current(), summaries.current()
        days: Counter[str] = Counter()
        for part in laid.parts:
            days[part.cell.split("/")[0]] += part.rows
        resources = self.silver("resources")
        content = resources.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64(*[c for c in resources.columns if not c.endswith("_ts")]))
        ).first()
        basis = [laid.note.get(RUN), *content]
        known = last.note["days"] if last and last.note["basis"] == basis else {}
        stale = [cell for cell in {*days, *known} if days.get(cell) != known.get(cell)]
        if stale or last is None:
            gone = set(stale) if known else {*days, *[part.cell for part in (last.parts if last else [])]}
            with scratch(self.spark):
                dims = dimensions(self.silver("customers_orgs"), resources, self.silver("users"))
                events = bronze.read(row_id=True, only=lambda part: part.cell.split("/")[0] in gone)
                carry_on(summaries, with_resource(events, dims), gone, {"days": dict(days), "basis": basis})
        return sorted(stale)

    def build_silver_events(self, as_of: Column | None = None, *, statistics: str = "recomputed") -> None:
        """Classify all events. Their cost statistics are ``recomputed`` from all of them, or ``carried`` on
        by days: only new or changed days are read for them, and quantiles of large groups come from sketches
        (``operators.sketches``)."""
        if statistics not in ("recomputed", "carried"):
            raise ValueError(f"statistics are recomputed or carried, not {statistics}")
        table = self.silver_table("usage_events")
        if statistics == "carried":
            self.refresh_summaries()
        with scratch(self.spark):
            carried = carried_profile(self.summaries_table()) if statistics == "carried" else None
            classified = silver_events(
                self.bronze_events(),
                self.silver("customers_orgs"),
                self.silver("resources"),
                self.silver("users"),
                as_of,
                profile=carried,
            )
            judged = _with_outcome(classified).select(*table.schema.names)
            cost = {COST: F.sum(F.when(F.col(OUTCOME) == VALID, F.col("cost_usd_increment")))}
            table.publish(
                judged, partition_by=(OUTCOME, "usage_date"), metrics={**_outcomes("usage_events"), **cost}
            )
        daily = service_daily(self.silver("usage_events"))
        stamped = daily.withColumn("silver_ts", F.current_timestamp())
        metrics = {**source_metrics("org_service_daily"), COST: F.sum("daily_cost_usd")}
        self.daily_table().publish(stamped, partition_by=("usage_date",), metrics=metrics)

    def build_silver(self, as_of: Column | None = None, *, statistics: str = "recomputed") -> None:
        """Masters, customers first since the others are checked against them; then events."""
        for name in fixed.MASTERS:
            self.build_silver_master(name)
        self.build_silver_events(as_of, statistics=statistics)

    # Gold ---------------------------------------------------------------------------------------------
    def _input(self, name: str) -> DataFrame:
        if name == "org_service_daily":
            return self.daily_table().read()
        return self.mart(name) if name in marts() else self.silver(name)

    def build_mart(self, name: str) -> None:
        mart = marts()[name]
        built = mart.build(*[self._input(t) for t in mart.reads])
        stamped = built.withColumn("gold_ts", F.current_timestamp())
        metrics = {**source_metrics(name), **mart_metrics(mart)}
        self.mart_table(name).publish(stamped, partition_by=(mart.partition,), metrics=metrics)

    def build_gold(self) -> None:
        for name in marts():
            self.build_mart(name)

    # Serving ------------------------------------------------------------------------------------------
    def load_serving(
        self, name: str, *, transform: Callable[[DataFrame], DataFrame] | None = None
    ) -> LoadResult:
        """Serve the current version of a mart. Marts are rebuilt in full, so what it lacks goes."""
        version, target = self.mart_table(name).current(), self.serving_table(name)
        checkpoint = f"{self.root}/serving/{name}/checkpoint"
        if not version.rows:  # no files, so the stream would see nothing
            token = f"{checkpoint}#{version.folders[-1]}"
            merge_batch(target, SERVING[name], self.mart(name), token=token, whole=True)
            return load_result(target, SERVING[name], 0)
        return load_stream(
            self.spark,
            version.folders[-1],
            target,
            SERVING[name],
            checkpoint,
            transform=transform,
            schema=version.struct,
            whole=True,
        )

    def refused(self, name: str) -> DataFrame:
        """Rows of a mart that its serving table refuses, with the columns that are null in them."""
        return refused_table(self.serving_table(name), SERVING[name]).read_or_empty()

    def load_all_serving(self) -> list[LoadResult]:
        return [self.load_serving(name) for name in SERVING]

    def lookup_parameters(self, org_id: str | None = None) -> LookupParameters:
        return lookup_parameters(
            self.mart("org_daily_usage_by_service"),
            self.mart("org_top_services_by_cost"),
            self.mart("tickets_by_org_date"),
            self.mart("revenue_by_org_month"),
            self.mart("genai_tokens_by_org_date"),
            org_id,
        )

    def lookups(self, parameters: LookupParameters) -> dict[str, DataFrame]:
        return run_lookups({name: self.serving_table(name).read() for name in SERVING}, parameters)

    def run(self, *, reset: bool = False, as_of: Column | None = None) -> EventIngest:
        """Everything once, in order."""
        self.ingest_masters()
        ingested = self.ingest_events(reset=reset)
        self.build_silver(as_of)
        self.build_gold()
        self.load_all_serving()
        return ingested

    def expire(self, keep: int = 2, orphans_after_hours: float = ORPHAN_AFTER_HOURS) -> int:
        """Delete versions of all tables before the last ``keep``, what broken loads have left, and the output
        of stream runs before the last; give the number of folders. The rows of an older run are in its
        versions of the layout, as long as those are kept."""
        tables = [
            *[self.bronze_table(n) for n in fixed.MASTERS],
            self.bronze_events_table(),
            *[self.silver_table(n) for n in (*fixed.MASTERS, "usage_events")],
            self.daily_table(),
            self.summaries_table(),
            *[self.mart_table(n) for n in marts()],
            *[self.serving_table(n) for n in SERVING],
            *[refused_table(self.serving_table(n), SERVING[n]) for n in SERVING],
        ]
        return sum(table.expire(keep, orphans_after_hours) for table in tables) + self._expire_runs()

    def _expire_runs(self) -> int:
        """Delete all stream runs but the last, which a reset has left behind."""
        folder = f"{self.root}/bronze/usage_events"
        if not exists(self.spark, f"{self.root}/bronze/usage_events_runs"):
            return 0
        last = self._stream_run(reset=False)
        old = [f"{folder}/{f.name}" for f in listed(self.spark, folder) if f"{folder}/{f.name}" != last]
        for run in old:
            remove(self.spark, run)
        return len(old)

    # Counters -----------------------------------------------------------------------------------------
    def master_counters(self) -> DataFrame:
        """(dataset, raw_count, deduped_count, removed_duplicates) of each master."""
        return checks.suite(
            checks.ingest_counters(
                landed_master(self.spark, table, f"{self.root}/landing/{name}.csv"),
                self.bronze_table(name).read(),
                name,
            )
            for name, table in fixed.MASTERS.items()
        )

    def event_counters(self) -> DataFrame:
        """One row: events in, valid, quarantined, flagged, and by rule."""
        return checks.event_counters(self.silver_table("usage_events").read())

    def reason_counts(self, name: str) -> DataFrame:
        return checks.reason_counts(self.quarantine(name))

    def quarantine_sample(self, n: int = 5) -> DataFrame:
        return checks.quarantine_sample(self.quarantine("usage_events"), n)

    # Checks -------------------------------------------------------------------------------------------
    def check_bronze(self) -> DataFrame:
        masters = [
            checks.unique(self.bronze_table(n).read(), f"bronze.{n}", t.keys)
            for n, t in fixed.MASTERS.items()
        ]
        events = self.bronze_events_table().read()
        required = checks.has_columns(events, "bronze.usage_events", checks.REQUIRED_BRONZE_EVENTS)
        named = events.where(F.col("event_id").isNotNull())
        return checks.suite([*masters, checks.unique(named, "bronze.usage_events", ("event_id",)), required])

    def _balance(self, name: str, bronze: VersionedTable) -> DataFrame:
        """Rows of bronze against those of both outcomes, as counted while they were written."""
        seen = self.silver_table(name).current().metrics
        return checks.observed(
            self.spark, f"silver.{name}", "row balance", bronze.current().rows, seen[VALID] + seen[QUARANTINED]
        )

    def check_silver(self) -> DataFrame:
        """Rows and costs balance by what was observed while the tables were written; keys are counted."""
        balances = [self._balance(n, self.bronze_table(n)) for n in fixed.MASTERS]
        valid, daily = self.silver("usage_events"), self.daily_table().read()
        grain = ("org_id", "usage_date", "service")
        return checks.suite(
            [
                *balances,
                self._balance("usage_events", self.bronze_events_table()),
                checks.unique(valid, "silver.usage_events", ("event_id",)),
                checks.has_columns(valid, "silver.usage_events", checks.REQUIRED_SILVER_EVENTS),
                checks.unique(daily, "silver.org_service_daily", grain),
                checks.has_columns(daily, "silver.org_service_daily", checks.REQUIRED_SERVICE_DAILY),
                checks.observed(
                    self.spark,
                    "silver.org_service_daily",
                    "total cost",
                    self.silver_table("usage_events").current().metrics[COST],
                    self.daily_table().current().metrics[COST],
                    fixed.BALANCE_TOLERANCE,
                ),
            ]
        )

    def _input_table(self, name: str) -> VersionedTable:
        if name == "org_service_daily":
            return self.daily_table()
        return self.mart_table(name) if name in marts() else self.silver_table(name)

    def check_gold(self) -> DataFrame:
        """Totals reconcile by what was observed while the tables were written; keys are counted."""
        found = []
        for name, mart in marts().items():
            built = self.mart(name)
            found.append(checks.unique(built, f"gold.{name}", mart.grain))
            if mart.source_measure is not None:
                source = self._input_table(mart.reads[0]).current().metrics[name]
                total = self.mart_table(name).current().metrics[MART_TOTAL]
                found.append(
                    checks.observed(
                        self.spark, f"gold.{name}", "total", source, total, fixed.BALANCE_TOLERANCE
                    )
                )
        usage = self.mart("org_daily_usage_by_service")
        found.append(checks.has_columns(usage, "gold.org_daily_usage_by_service", checks.REQUIRED_ORG_DAILY))
        return checks.suite(found)

    def check_serving(self) -> DataFrame:
        """Each mart is served row by row, nothing else is, and what is missing was refused."""
        found = []
        for name, table in SERVING.items():
            mart, served = self.mart(name), self.serving_table(name).read()
            found.append(checks.identical(to_serving(mart, table), served, f"serving.{name}"))
            found.append(checks.balance(mart, [served, self.refused(name)], f"serving.{name}"))
        return checks.suite(found)

    def snapshot(self) -> DataFrame:
        """(metric, n): row counts of the layers, to compare before and after a rerun."""
        counted = {
            **{f"bronze_{n}": self.bronze_table(n).read() for n in fixed.MASTERS},
            "bronze_events": self.bronze_events_table().read(),
            "bronze_events_distinct": self.bronze_events_table().read().select("event_id").distinct(),
            "silver_valid": self.silver("usage_events"),
            "silver_quarantine": self.quarantine("usage_events"),
            **{f"gold_{n}": self.mart(n) for n in marts()},
        }
        return checks.suite(
            df.agg(F.lit(metric).alias("metric"), F.count(F.lit(1)).alias("n"))
            for metric, df in counted.items()
        )
