import glob
import itertools
import json
import os
from datetime import datetime

import pytest
from conftest import values
from pyspark.sql import functions as F

from fleetgauge.plans import driver_state as ds
from fleetgauge.plans import telemetry as tm
from fleetgauge.plans.stores import DriverStateStore
from fleetgauge.settings import StreamSettings
from fleetgauge.sources.streams import json_lines_source, kafka_source
from fleetgauge.streaming import queries as sq
from fleetgauge.streaming import timers
from fleetgauge.streaming.supervision import await_outcomes, supervised
from samples import queries as samples
from samples.tables import TABLES, FleetSample

DIMENSION = "vin STRING, driver_id STRING, daily_rate DOUBLE, region STRING"
T0 = 1704067200
NOW = datetime(2024, 2, 1)
ONCE = {"availableNow": True}


def message(vin, offset, speed=120, lat=12.6, lon=77.3):
    return {"vin": vin, "speed": speed, "rpm": 2000, "lat": lat, "lon": lon, "event_timestamp": T0 + offset}


class Telemetry:
    """A folder of message files; each file is one micro-batch."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.count = spark, f"{folder}/in", 0
        self.sent = []
        os.makedirs(self.folder)

    def send(self, *messages):
        path = f"{self.folder}/{self.count:04d}.json"
        with open(path, "w") as out:
            out.writelines((m if isinstance(m, str) else json.dumps(m)) + "\n" for m in messages)
        os.utime(path, (1_700_000_000 + self.count, 1_700_000_000 + self.count))
        self.count += 1
        self.sent += [m for m in messages if not isinstance(m, str)]

    def stream(self):
        return json_lines_source(self.spark, self.folder, max_files_per_trigger=1)

    def batch(self):
        rows = [(m["vin"], m["speed"], m["rpm"], m["lat"], m["lon"], m["event_timestamp"]) for m in self.sent]
        return tm.clean_telemetry(self.spark.createDataFrame(rows, tm.TELEMETRY))


@pytest.fixture
def source(spark, folder):
    return Telemetry(spark, folder)


@pytest.fixture
def dimension(frame):
    return frame(DIMENSION, [("V1", "D1", 100.0, "N"), ("V2", "D1", 50.0, "S"), ("V3", "D2", 10.0, "N")])


def run(query):
    query.awaitTermination(120)
    assert query.exception() is None
    return query


def fill(source):
    source.send(message("V1", 0), message("V1", 0), message("V2", 60), "not json")
    source.send(message("V1", 0), message("V3", 300, speed=90), message("V9", 400), message("V1", 310))
    source.send(message("V1", 1900), message("V2", 1950, lat=1.0))
    source.send(message("V1", 9000))


def test_event_table_equals_batch(spark, source, dimension, folder):
    fill(source)
    run(sq.start_driver_safety(source.stream(), dimension, f"{folder}/out", f"{folder}/cp", trigger=ONCE))
    assert os.path.isdir(f"{folder}/out/date=2024-01-01/hour=2")
    columns = [c for c in tm.SAFETY_COLUMNS if c != "processing_ts"]
    expected = tm.driver_safety_status(source.batch(), dimension)
    assert values(spark.read.parquet(f"{folder}/out"), *columns) == values(expected, *columns)
    # a restart goes on where it stopped
    source.send(message("V1", 0), message("V1", 9001))
    run(sq.start_driver_safety(source.stream(), dimension, f"{folder}/out", f"{folder}/cp", trigger=ONCE))
    assert spark.read.parquet(f"{folder}/out").count() == expected.count() + 1


def test_current_assignments_are_read_in_every_batch(spark, source, frame, folder):
    drivers = (f"D{n}" for n in itertools.count(1))
    source.send(message("V1", 0))
    source.send(message("V1", 10))
    run(sq.start_driver_safety_current(
        source.stream(), lambda: frame(DIMENSION, [("V1", next(drivers), 1.0, "N")]),
        f"{folder}/out", f"{folder}/cp", trigger=ONCE))
    assert values(spark.read.parquet(f"{folder}/out"), "event_timestamp", "driver_id", "batch_id") == [
        (T0, "D1", 0), (T0 + 10, "D2", 1)]


def test_repeated_batches_keep_their_assignments(spark, source, frame, folder):
    """Vehicles are reassigned between the runs; events and state of a batch stay what they were."""
    source.send(message("V1", 0), message("V2", 1))
    source.send(message("V1", 10))
    store = DriverStateStore(spark, f"{folder}/state")
    seen = []
    for checkpoint, driver in (("cp1", "D1"), ("cp2", "D2")):
        vehicles = lambda driver=driver: frame(DIMENSION, [
            ("V1", driver, 1.0, "N"), ("V2", "D3", 1.0, "S"), ("V8", "D8", 1.0, "S")])
        run(sq.start_events_and_state(source.stream(), vehicles, f"{folder}/out", store,
                                      f"{folder}/{checkpoint}", trigger=ONCE, clock=lambda: NOW,
                                      stream_id="fleet"))
        events = spark.read.parquet(f"{folder}/out").drop("processing_ts")
        seen.append((values(events, "vin", "event_timestamp", "driver_id", "batch_id"),
                     values(store.read_state()), values(store.read_audit())))
    assert seen[0] == seen[1]
    assert {row[2] for row in seen[0][0]} == {"D1", "D3"}
    # the vehicles of the batch alone are kept, and readers of the events do not see them
    assert spark.read.parquet(f"{folder}/out/_assignments/of-fleet/1").count() == 1
    source.send(message("V1", 20))  # a batch of its own has the assignments of its time
    run(sq.start_events_and_state(source.stream(), vehicles, f"{folder}/out", store, f"{folder}/cp2",
                                  trigger=ONCE, clock=lambda: NOW, stream_id="fleet"))
    late = spark.read.parquet(f"{folder}/out").filter(f"event_timestamp = {T0 + 20}")
    assert values(late, "driver_id") == [("D2",)]


def test_closed_windows_equal_batch(spark, source, dimension, folder):
    fill(source)
    run(sq.start_driver_risk_aggregates(source.stream(), dimension, f"{folder}/out", f"{folder}/cp",
                                        trigger=ONCE))
    expected = tm.driver_risk_aggregates(tm.score_events(tm.enrich(source.batch(), dimension)))
    closed = tm.flatten_window(expected).filter("window_end <= TIMESTAMP '2024-01-01 02:20:00'")
    got = tm.flatten_window(spark.read.parquet(f"{folder}/out"))
    assert values(got) == values(closed)
    assert got.filter("driver_id IS NULL").count() == 1


def test_late_events_are_dropped_and_counted(source, dimension, folder):
    source.send(message("V1", 0))
    source.send(message("V1", 90000))
    source.send(message("V1", 90001))
    source.send(message("V2", 5))
    query = run(sq.start_driver_safety(source.stream(), dimension, f"{folder}/out", f"{folder}/cp",
                                       trigger=ONCE))
    assert sq.late_events_dropped(query) == 1


def test_state_over_batches_equals_one_batch(spark, source, dimension, folder, frame):
    fill(source)
    store = DriverStateStore(spark, f"{folder}/state")
    run(sq.start_driver_state(source.stream(), lambda: dimension, store, f"{folder}/cp", trigger=ONCE,
                              clock=lambda: NOW))
    windows = tm.flatten_window(
        tm.driver_risk_aggregates(tm.score_events(tm.enrich(source.batch(), dimension))))
    expected = ds.merge_state(frame(store.read_state().schema, []), ds.evaluate_windows(windows), NOW)
    assert values(store.read_state()) == values(expected)
    # the first window of D1 got events in two batches and was rated in both
    assert store.read_audit().count() == 5


def test_events_and_state_from_one_query(spark, source, dimension, folder, frame):
    fill(source)
    store = DriverStateStore(spark, f"{folder}/state")
    for checkpoint in ("cp1", "cp2"):  # the second run repeats every batch
        run(sq.start_events_and_state(source.stream(), lambda: dimension, f"{folder}/out", store,
                                      f"{folder}/{checkpoint}", trigger=ONCE, clock=lambda: NOW,
                                      stream_id="fleet"))
        events = tm.driver_safety_status(source.batch(), dimension)
        assert values(spark.read.parquet(f"{folder}/out"), "vin", "event_timestamp", "driver_id",
                      "strike_score") == values(events, "vin", "event_timestamp", "driver_id", "strike_score")
        windows = tm.flatten_window(tm.driver_risk_aggregates(events))
        expected = ds.merge_state(frame(store.read_state().schema, []), ds.evaluate_windows(windows), NOW)
        assert values(store.read_state()) == values(expected)


def test_state_in_rocksdb(spark, source, dimension, folder):
    fill(source)
    sq.use_rocksdb_state(spark)
    try:
        run(sq.start_driver_safety(source.stream(), dimension, f"{folder}/out", f"{folder}/cp", trigger=ONCE))
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    expected = tm.driver_safety_status(source.batch(), dimension)
    assert spark.read.parquet(f"{folder}/out").count() == expected.count()


def test_replay_of_a_stream_changes_nothing(spark, source, dimension, folder):
    fill(source)
    store = DriverStateStore(spark, f"{folder}/state")
    states = []
    for attempt in ("cp1", "cp2"):
        run(sq.start_driver_state(source.stream(), lambda: dimension, store, f"{folder}/{attempt}",
                                  trigger=ONCE, clock=lambda: NOW, stream_id="fleet"))
        states.append(values(store.read_state()))
    assert states[0] == states[1]


def test_new_checkpoint_with_new_events_adds_them(spark, frame, folder):
    vehicles = frame(DIMENSION,
                     [("V1", "D1", 1.0, "N"), ("V2", "D2", 1.0, "S")])
    store = DriverStateStore(spark, f"{folder}/state")
    for vin in ("V1", "V2"):  # two streams on one store, both at batch 0
        own = Telemetry(spark, f"{folder}/{vin}")
        own.send(*[message(vin, i) for i in range(3)])
        run(sq.start_events_and_state(own.stream(), lambda: vehicles, f"{folder}/out", store,
                                      f"{folder}/cp-{vin}", trigger=ONCE, clock=lambda: NOW))
    events = spark.read.parquet(f"{folder}/out")
    assert values(events.select("vin").distinct()) == [("V1",), ("V2",)]
    assert values(store.read_state(), "driver_id") == [("D1",), ("D2",)]
    assert values(store.read_state(), "total_strike_score") == [(9,), (9,)]


def test_as_emitted_counts_growing_windows_again(spark, source, dimension, folder):
    for second in range(3):
        source.send(*[message("V1", 10 * second + i) for i in range(3)])
    store = DriverStateStore(spark, f"{folder}/state")
    run(sq.start_driver_state_as_emitted(source.stream(), dimension, store, f"{folder}/cp", trigger=ONCE,
                                         clock=lambda: NOW))
    # totals 9, 18 and 27 of one window
    assert values(store.read_state(), "total_strike_score") == [(54,)]


def test_large_dimension_is_joined_by_salted_keys(spark, source, dimension, folder):
    """The same rows as with a broadcast, from streams that may not broadcast anything."""
    fill(source)
    none = StreamSettings(broadcast_rows=0, join_salts=5)
    run(sq.start_driver_safety(source.stream(), dimension, f"{folder}/out", f"{folder}/cp1", stream=none,
                               trigger=ONCE))
    run(sq.start_driver_risk_aggregates(source.stream(), dimension, f"{folder}/windows", f"{folder}/cp2",
                                        stream=none, trigger=ONCE))
    columns = [c for c in tm.SAFETY_COLUMNS if c != "processing_ts"]
    events = tm.driver_safety_status(source.batch(), dimension)
    assert values(spark.read.parquet(f"{folder}/out"), *columns) == values(events, *columns)
    closed = tm.flatten_window(tm.driver_risk_aggregates(events)).filter(
        "window_end <= TIMESTAMP '2024-01-01 02:20:00'")
    assert values(tm.flatten_window(spark.read.parquet(f"{folder}/windows"))) == values(closed)


def test_hot_vehicle_is_spread_over_the_tasks(spark):
    """One vehicle has half of all events; no task of the join has twice the median."""
    events = spark.range(40_000).selectExpr(
        "IF(id % 2 = 0, 'HOT', concat('V', id)) AS vin", "timestamp_seconds(1704067200 + id) AS event_time")
    vehicles = events.select("vin").distinct().selectExpr("vin", "concat('D', vin) AS driver_id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows_by_task = lambda df: sorted(r[0] for r in df.filter("driver_id LIKE 'D%'").groupBy(
            F.spark_partition_id()).count().select("count").collect())
        joined = tm.enrich(events, vehicles.hint("merge"), 64)
        sizes, alone = rows_by_task(joined), rows_by_task(tm.enrich(events, vehicles.hint("merge")))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert joined.filter("driver_id = concat('D', vin)").count() == sum(sizes) == 40_000
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2] and alone[-1] > 2 * alone[len(alone) // 2]


def test_large_dimension_is_not_broadcast(spark, frame):
    from fleetgauge.operators.joins import sized_join_side
    small, large = sized_join_side(spark.range(3), 3), sized_join_side(spark.range(4), 3)
    plan = lambda d: spark.range(9).join(d, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan(small) and "strategy=merge" in plan(large)


def test_wide_dimension_is_not_broadcast(spark):
    from fleetgauge.operators.joins import fits_broadcast
    wide = spark.range(10).selectExpr("id", "repeat('x', 1000) AS note")
    assert fits_broadcast(wide, 10, 20_000) and not fits_broadcast(wide, 10, 10_000)
    assert fits_broadcast(wide.filter("id < 0"), 0, 0)


@pytest.mark.parametrize("stop_others", [False, True])
def test_outcomes_of_a_failed_and_a_finished_query(spark, folder, stop_others):
    telemetry = Telemetry(spark, folder)
    telemetry.send(message("V1", 0), message("V2", 10))
    telemetry.send(message("V1", 7200))
    telemetry.send(message("V1", 7300))
    telemetry.send(message("V2", 60), message("V1", 7400))

    def fail(batch, batch_id):
        raise ValueError("no such table")

    def start(name, sink, **trigger):
        return (sq.clean_stream(telemetry.stream(), StreamSettings()).writeStream.foreachBatch(sink)
                .option("checkpointLocation", f"{folder}/{name}").queryName(name).trigger(**trigger).start())

    with supervised(spark) as supervisor:
        if stop_others:
            start("endless", lambda batch, batch_id: batch.count(), processingTime="1 second")
        else:
            start("good", lambda batch, batch_id: batch.count(), **ONCE)
        start("bad", fail, **ONCE)
        got = {r["query"]: r for r in await_outcomes(spark, supervisor, stop_others).collect()}
    assert got["bad"].ended and "no such table" in got["bad"].error
    if stop_others:
        endless = got["endless"]
        assert (endless.ended, endless.stopped, endless.error) == (True, True, None)
    else:
        good = got["good"]
        assert (good.rows, good.dropped, good.ended, good.stopped, good.error) == (6, 1, True, False, None)
        assert good.batches >= 4
    assert not spark.streams.active


def test_kafka_options():
    class Reader:
        def __init__(self):
            self.said = {}

        def format(self, name):
            self.said["format"] = name
            return self

        def option(self, key, value):
            self.said[key] = value
            return self

        def load(self):
            return self.said

    session = lambda: type("Session", (), {"readStream": Reader()})()
    wanted = {"format": "kafka", "kafka.bootstrap.servers": "host:1", "subscribe": "events",
              "startingOffsets": "latest", "failOnDataLoss": "false"}
    assert kafka_source(session(), "host:1", "events") == wanted
    limited = StreamSettings(max_offsets_per_trigger=500)
    assert kafka_source(session(), "host:1", "events", limited, "earliest") == wanted | {
        "startingOffsets": "earliest", "maxOffsetsPerTrigger": 500}


def test_a_batch_over_many_hours_writes_a_file_an_hour(spark, source, dimension, folder):
    source.send(*[message(f"V{n % 3 + 1}", n * 977 % 86400) for n in range(300)])
    run(sq.start_driver_safety_current(source.stream(), lambda: dimension, f"{folder}/out",
                                       f"{folder}/cp", trigger=ONCE, stream_id="fleet"))
    files = glob.glob(f"{folder}/out/stream_id=fleet/batch_id=0/date=2024-01-01/hour=*/*.parquet")
    assert len(files) == 24  # before, each of the four tasks had a file in every hour
    columns = [c for c in tm.SAFETY_COLUMNS if c != "processing_ts"]
    events = spark.read.parquet(f"{folder}/out")
    assert values(events, *columns) == values(tm.driver_safety_status(source.batch(), dimension), *columns)


def test_a_batch_within_an_hour_is_split(spark, source, dimension, folder):
    source.send(*[message(f"V{n % 3 + 1}", n) for n in range(300)])
    run(sq.start_driver_safety_current(source.stream(), lambda: dimension, f"{folder}/out",
                                       f"{folder}/cp", trigger=ONCE, stream_id="fleet"))
    files = glob.glob(f"{folder}/out/**/hour=0/*.parquet", recursive=True)
    assert 1 < len(files) <= 4
    assert spark.read.parquet(f"{folder}/out").count() == 300


def test_changes_by_timers_leave_texts_and_times_to_the_jvm(spark, source, dimension, folder):
    """Nine overspeeds in the zone suspend D1; its cooldown of 40 minutes ends between two windows."""
    source.send(*[message("V1", n) for n in range(9)], message("V3", 5, speed=90, lat=1.0))
    source.send(message("V1", 7300, speed=90, lat=1.0))
    source.send(message("V3", 20000))
    with sq.rocksdb_state(spark):
        windows = timers.closed_windows(source.stream(), dimension)
        plan = timers.driver_changes(windows)._jdf.queryExecution().analyzed().toString()
        run(timers.start_driver_changes(source.stream(), dimension, f"{folder}/out", f"{folder}/cp",
                                        cooldown_seconds=2400, trigger=ONCE))
    (step,) = [line for line in plan.splitlines() if "TransformWithState" in line]
    assert "risk_category" not in step and "cooldown_until" not in step
    got = spark.read.schema(timers.CHANGES).parquet(f"{folder}/out")
    assert got.schema.names == timers.CHANGES.names
    assert values(got.filter("driver_id = 'D1'"), "step", "event_type", "previous_status", "suspension_status",
                  "suspension_reason", "total_strike_score", "strike_score", "strike_decay_score",
                  "reinstatement_eligible", "changed_ts", "cooldown_until") == [
        (1, "RISK_EVALUATION", "ACTIVE", "SUSPENDED_7D", "Critical repeat offender", 27, 27, 25, 0,
         datetime(2024, 1, 1, 0, 30), datetime(2024, 1, 1, 1, 10)),
        (2, "AUTO_REINSTATEMENT", "SUSPENDED_7D", "ACTIVE", None, 27, 27, 25, 1,
         datetime(2024, 1, 1, 1, 10), datetime(2024, 1, 1, 1, 10)),
        (3, "RISK_EVALUATION", "ACTIVE", "ACTIVE", None, 27, 0, 0, 1,
         datetime(2024, 1, 1, 2, 30), datetime(2024, 1, 1, 3, 10))]
    assert values(got.filter("driver_id = 'D2'"), "step", "suspension_status") == [(1, "ACTIVE")]


def test_stored_assignments_are_made_once_for_all_batches(spark, frame, folder, monkeypatch):
    day = datetime(2024, 1, 1)
    rows = {"events": [(n, n % 3) for n in range(600)],
            "orders": [(n, n % 3, "O", day, "1-URGENT") for n in range(6)],
            "customer": [(n, 0, 1.0, "A") for n in range(3)], "nation": [(0, 0)], "region": [(0, "N")]}
    for name, schema in TABLES.items():
        frame(schema, rows[name]).write.parquet(f"{folder}/{name}.parquet")
    made, dimension = [], FleetSample.dimension
    monkeypatch.setattr(FleetSample, "dimension", lambda self: made.append(1) or dimension(self))
    events = samples.stream_late_events(spark, folder)
    assert events.filter("driver_id IS NULL").count() == 0
    assert events.select("batch_id").distinct().count() == 6
    assert len(made) == 1  # once a batch before
