import json
import time

import pytest
from landing import event

from meterlake.catalog import EVENT_BRONZE, EVENT_LANDING
from meterlake.plans import pipeline
from meterlake.plans.events import to_bronze
from meterlake.streaming.counters import counted, finish, listen
from meterlake.streaming.ingest import NAMED, UNNAMED, dedupe_stream, event_stream, start_ingest


@pytest.fixture()
def ingest(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()

    def land(name, *events):
        (landing / f"{name}.jsonl").write_text("".join(json.dumps(e) + "\n" for e in events))

    def run(**options):
        query = start_ingest(
            spark,
            f"{landing}/*.jsonl",
            str(tmp_path / "bronze"),
            str(tmp_path / "checkpoint"),
            files_per_trigger=1,
            **options,
        )
        seen = finish(spark, query)
        return seen[NAMED] + seen[UNNAMED], query

    def stored():
        return spark.read.schema(EVENT_BRONZE).parquet(str(tmp_path / "bronze"))

    return land, run, stored


def test_values_of_mixed_json_types(ingest, rows):
    land, run, stored = ingest
    land("a", event("e1", value=124.0), event("e2", value="109.0"), event("e3", value=None), event("e4", value="x"))
    run()
    assert rows(stored(), "event_id", "value") == [("e1", 124.0), ("e2", 109.0), ("e3", None), ("e4", None)]
    assert stored().first()["source_file"] == "landing/usage_events_stream/a.jsonl"


def test_resume_reads_only_new_files(ingest, rows):
    land, run, stored = ingest
    land("a", event("e1"), event("e2"))
    assert run()[0] == 2
    assert run()[0] == 0
    land("b", event("e2"), event("e3"), event(None), event(None))
    assert run()[0] == 4
    assert rows(stored(), "event_id") == [("e1",), ("e2",), ("e3",), (None,), (None,)]


@pytest.mark.parametrize("mode", ["global", "bounded"])
def test_an_event_from_the_future_drops_nothing(ingest, rows, mode):
    land, run, stored = ingest
    land("a", event("e1", "2025-08-10T10:00:00"), event("future", "2099-01-01T00:00:00"))
    run(dedupe=mode)
    land("b", *[event(f"n{i}", "2025-08-10T10:00:00") for i in range(50)], event("e1", "2025-08-10T10:00:00"))
    _, query = run(dedupe=mode)
    dropped = sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])
    assert dropped == 0
    assert stored().count() == 52


@pytest.mark.parametrize(("mode", "times"), [("global", 1), ("bounded", 2)])
def test_bounded_dedupe_forgets_what_has_not_come_in_for_long(ingest, mode, times):
    land, run, stored = ingest
    for name in ("e1", "e2", "e3", "e1"):
        land(f"{name}-{time.monotonic_ns()}", event(name))
        run(watermark="1 second", dedupe=mode)
        time.sleep(2.5)
    assert stored().where("event_id = 'e1'").count() == times


def test_rows_streamed_before_a_stop_are_laid_out_by_the_next_call(spark, tmp_path, monkeypatch):
    lake = pipeline.Lake(spark, str(tmp_path))
    landing = tmp_path / "landing" / "usage_events_stream"
    landing.mkdir(parents=True)
    (landing / "a.jsonl").write_text("".join(json.dumps(event(f"e{i}")) + "\n" for i in range(2)))

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(pipeline, "relayout", stop)
        with pytest.raises(RuntimeError):
            lake.ingest_events()
    again = lake.ingest_events()
    assert (again.input_rows, again.relaid) == (0, True)
    assert lake.bronze_events().count() == 2


@pytest.mark.parametrize("mode", ["global", "bounded"])
def test_rows_without_id_or_time_pass_in_every_batch(ingest, rows, mode):
    land, run, stored = ingest
    for name in ("a", "b", "c"):
        land(name, event(None), event(None), event(f"e-{name}"), event(f"bad-{name}", "no time"))
        run(dedupe=mode)
    land("d", event(None), event("e-a"))
    land("e", event(None), event("bad-e", "no time"))
    run(dedupe=mode)
    found = rows(stored(), "event_id")
    assert found.count((None,)) == 8
    assert len(found) == 8 + 3 + 4


@pytest.mark.parametrize("mode", ["global", "bounded"])
def test_spread_copies_still_come_out_once(ingest, rows, mode):
    land, run, stored = ingest
    land("a", *[event("hot")] * 200, event("e1"), event(None), event(None))
    land("b", *[event("hot")] * 200, event("e2"))
    run(dedupe=mode, spread_copies=8)
    land("c", *[event("hot")] * 50, event("e1"))
    run(dedupe=mode, spread_copies=8)
    assert rows(stored(), "event_id") == [("e1",), ("e2",), ("hot",), (None,), (None,)]


def test_runs_on_an_interval(spark, ingest, tmp_path):
    land, _, stored = ingest
    land("a", event("e1"))
    query = start_ingest(
        spark, f"{tmp_path}/landing/*.jsonl", f"{tmp_path}/bronze", f"{tmp_path}/checkpoint", every="1 second"
    )
    query.processAllAvailable()
    assert query.isActive
    query.stop()
    assert stored().count() == 1


def test_batch_and_stream_agree(spark, ingest, rows, tmp_path):
    land, run, stored = ingest
    land("a", event("e1", value="3"), event("e2", region="EU_West", service="AI"), event("e3", "no time"))
    run()
    batch = to_bronze(spark.read.schema(EVENT_LANDING).json(f"{tmp_path}/landing/*.jsonl"))
    picked = [c for c in EVENT_BRONZE.names if c != "source_file"]
    assert rows(batch, *picked) == rows(stored(), *picked)


def test_unknown_mode(spark, tmp_path):
    with pytest.raises(ValueError, match="global or bounded"):
        dedupe_stream(event_stream(spark, str(tmp_path)), watermark="1 day", mode="all")


@pytest.fixture()
def landed_lake(spark, tmp_path):
    landing = tmp_path / "landing" / "usage_events_stream"
    landing.mkdir(parents=True)

    def land(name, *events):
        (landing / f"{name}.jsonl").write_text("".join(json.dumps(e) + "\n" for e in events))

    return pipeline.Lake(spark, str(tmp_path)), land


def test_continuous_events_reach_the_layout_without_another_call(landed_lake, rows):
    lake, land = landed_lake
    land("a", event("e1"), event(None))
    streams = lake.start_events("1 second")
    try:
        streams.catch_up()
        assert rows(lake.bronze_events(), "event_id") == [("e1",), (None,)]
        land("b", event("e1"), event("e2"), event(None))
        streams.catch_up()
        assert rows(lake.bronze_events(), "event_id") == [("e1",), ("e2",), (None,), (None,)]
        assert streams.ingest.isActive and streams.relayout.isActive
    finally:
        streams.stop()


def test_the_lake_goes_on_after_an_interval_run(landed_lake):
    lake, land = landed_lake
    land("a", event("e1"))
    streams = lake.start_events("1 second")
    streams.catch_up()
    streams.stop()
    land("b", event("e1"), event("e2"), event(None))
    done = lake.ingest_events()
    assert (done.input_rows, done.dropped_rows, done.unnamed_rows, done.bronze_rows) == (3, 1, 1, 3)


def test_counts_are_exact_over_more_batches_than_spark_keeps(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    for i in range(130):
        (landing / f"{i:03}.csv").write_text("1\n" * (i % 5))
    listen(spark)
    stream = spark.readStream.schema("n int").option("maxFilesPerTrigger", 1).csv(str(landing))
    query = (
        counted(counted(stream, "read").where("n = 1"), "kept")
        .writeStream.format("noop")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    seen = finish(spark, query)
    assert seen["read"] == seen["kept"] == sum(i % 5 for i in range(130))
    assert len(query.recentProgress) <= 100


@pytest.mark.parametrize("mode", ["global", "bounded"])
def test_rows_without_an_id_leave_nothing_in_the_state(ingest, mode):
    land, run, _ = ingest
    land("a", *[event(None)] * 50, event("e1"), event("e2"), event("e1"))
    _, query = run(dedupe=mode)
    (state,) = query.lastProgress["stateOperators"]
    assert state["numRowsTotal"] == 2
