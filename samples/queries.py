"""Every operator as a query over the test tables: ``name -> f(spark, folder)``.

Averages are rounded to six places, and ``processing_ts`` is left out, so that
results compare by value.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import AbstractContextManager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetgauge.operators.geo import flag_zones, match_zones
from fleetgauge.operators.quality import quality_profile
from fleetgauge.operators.sequence import with_previous
from fleetgauge.plans import assets, fuel, reports, silver, telemetry
from fleetgauge.plans import driver_state as ds
from fleetgauge.plans.publish import ParquetReports, publish_reports
from fleetgauge.plans.stores import DriverStateStore
from fleetgauge.schemas import ASSET_HISTORY, DRIVER_RISK_STATE, RAW_COLUMNS, empty_table
from fleetgauge.sources.catalog import register_table
from fleetgauge.sources.files import overwrite, overwrite_partitions, read_raw
from fleetgauge.sources.scratch import new_scratch_path, staged
from fleetgauge.sources.streams import json_lines_source
from fleetgauge.streaming import queries as streams
from fleetgauge.streaming import timers
from fleetgauge.streaming.supervision import await_outcomes, supervised
from samples import oracle
from samples.tables import FIRST_SNAPSHOT_END, FleetSample

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ALL_NOW = {"availableNow": True}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns if c in df.columns})


# --- typed tables


@query
def silver_vehicle_registry(spark: SparkSession, folder: str) -> DataFrame:
    return silver.vehicle_registry(FleetSample(spark, folder).raw_registry())


@query
def silver_vehicle_assignment(spark: SparkSession, folder: str) -> DataFrame:
    return silver.vehicle_assignment(FleetSample(spark, folder).raw_assignment())


@query
def silver_fuel_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return silver.fuel_transactions(FleetSample(spark, folder).raw_fuel())


@query
def silver_maintenance(spark: SparkSession, folder: str) -> DataFrame:
    return silver.maintenance_logs(FleetSample(spark, folder).raw_maintenance())


@query
def silver_from_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Fuel transactions by way of CSV files with their columns in another order."""
    raw = FleetSample(spark, folder).raw_fuel()
    path = new_scratch_path(spark, "fuel-csv")
    raw.select(*reversed(raw.columns)).write.option("header", True).csv(path)
    return silver.fuel_transactions(read_raw(spark, path, RAW_COLUMNS["fuel_transactions"]))


def _fuel_by_month(spark: SparkSession, folder: str) -> DataFrame:
    return silver_fuel_transactions(spark, folder).select(
        "vin", "transaction_id", F.month("event_time").alias("month"))


@query
def overwrite_months(spark: SparkSession, folder: str) -> DataFrame:
    """Refuels stored by month; then the odd months are replaced by two thirds of their rows."""
    path, rows = new_scratch_path(spark, "fuel-months"), _fuel_by_month(spark, folder)
    overwrite(rows, path, ["month"])
    overwrite_partitions(
        rows.filter("month % 2 = 1 AND CAST(transaction_id AS BIGINT) % 3 <> 0"), path, ["month"])
    return spark.read.parquet(path)


@query
def registered_months(spark: SparkSession, folder: str) -> DataFrame:
    """Refuels by name: months that come after the registration, and a column that comes with them."""
    path, rows = new_scratch_path(spark, "fuel-registered"), _fuel_by_month(spark, folder)
    name = "fuel_" + path.rsplit("/", 1)[-1].replace("-", "_").replace(".", "_")
    overwrite(rows.filter("month <= 6"), path, ["month"])
    register_table(spark, name, path)
    later = rows.filter("month > 5").withColumn("digits", F.length("transaction_id"))
    overwrite_partitions(later, path, ["month"])
    return register_table(spark, name, path)


# --- fuel audit and assets


@query
def gold_fuel_efficiency(spark: SparkSession, folder: str) -> DataFrame:
    audit = fuel.fuel_efficiency(
        silver_fuel_transactions(spark, folder), silver_vehicle_registry(spark, folder),
        silver_maintenance(spark, folder))
    return rounded(audit, "baseline_kmpl")


@query
def previous_reading_hot_vin(spark: SparkSession, folder: str) -> DataFrame:
    """The reading before each refuel, with one vin in two thirds of all rows."""
    hot = F.col("transaction_id").cast("bigint") % 3 != 0
    fuel_rows = silver_fuel_transactions(spark, folder).withColumn(
        "vin", F.when(hot, "VIN0").otherwise(F.col("vin")))
    stepped = with_previous(fuel_rows, "vin", "event_time", "odometer_reading",
                            ["transaction_id"], "previous_reading")
    return stepped.select("vin", "transaction_id", "previous_reading")


@query
def previous_reading_one_hour(spark: SparkSession, folder: str) -> DataFrame:
    """The same with all refuels of that vin within one hour, cut into seconds."""
    hot = F.col("transaction_id").cast("bigint") % 3 != 0
    second = F.col("transaction_id").cast("bigint") % 3600
    fuel_rows = silver_fuel_transactions(spark, folder).withColumns({
        "vin": F.when(hot, "VIN0").otherwise(F.col("vin")),
        "event_time": F.when(hot, F.timestamp_seconds(F.lit(1704067200) + second)).otherwise(
            F.col("event_time"))})
    stepped = with_previous(fuel_rows, "vin", "event_time", "odometer_reading",
                            ["transaction_id"], "previous_reading", most=10)
    return stepped.select("vin", "transaction_id", "previous_reading")


@query
def gold_asset_history_scd2(spark: SparkSession, folder: str) -> DataFrame:
    """Two merges: the assignments up to a day, then all of them."""
    sample = FleetSample(spark, folder)
    empty = empty_table(spark, ASSET_HISTORY)
    once = assets.merge_asset_history(empty, sample.assignment_snapshot(FIRST_SNAPSHOT_END),
                                      oracle.FIRST_MERGE, drop_copies=False)
    return assets.merge_asset_history(once, sample.assignment_snapshot(), oracle.SECOND_MERGE)


@query
def gold_active_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return assets.active_fleet_snapshot(gold_asset_history_scd2(spark, folder))


# --- telemetry


@query
def telemetry_clean(spark: SparkSession, folder: str) -> DataFrame:
    events = telemetry.parse_telemetry(FleetSample(spark, folder).messages())
    return telemetry.clean_telemetry(events).drop("kafka_ingestion_ts")


def _clean(sample: FleetSample) -> DataFrame:
    return telemetry.clean_telemetry(sample.events())


@query
def driver_safety_status(spark: SparkSession, folder: str) -> DataFrame:
    sample = FleetSample(spark, folder)
    return telemetry.driver_safety_status(_clean(sample), sample.dimension()).drop("processing_ts")


def _aggregates(spark: SparkSession, folder: str) -> DataFrame:
    return telemetry.flatten_window(
        telemetry.driver_risk_aggregates(driver_safety_status(spark, folder)))


@query
def driver_risk_aggregates(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_aggregates(spark, folder), "avg_speed")


@query
def zone_range_join(spark: SparkSession, folder: str) -> DataFrame:
    sample = FleetSample(spark, folder)
    return match_zones(_clean(sample), sample.zones())


@query
def zone_flag(spark: SparkSession, folder: str) -> DataFrame:
    sample = FleetSample(spark, folder)
    return flag_zones(_clean(sample), sample.zones())


@query
def zone_flag_by_merge(spark: SparkSession, folder: str) -> DataFrame:
    """The same, with boxes that count as too many to be broadcast."""
    sample = FleetSample(spark, folder)
    return flag_zones(_clean(sample), sample.zones(), broadcast_cells=0)


# --- driver state


@query
def driver_risk_state(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches: the windows before a time, then the others."""
    evaluations = ds.evaluate_windows(_aggregates(spark, folder))
    early = F.col("window_start") < F.lit(oracle.BATCH_SPLIT).cast("timestamp")
    empty = empty_table(spark, DRIVER_RISK_STATE)
    once = ds.merge_state(empty, evaluations.filter(early), oracle.FIRST_BATCH)
    return ds.merge_state(once, evaluations.filter(~early), oracle.SECOND_BATCH)


@query
def risk_evaluation_audit(spark: SparkSession, folder: str) -> DataFrame:
    return ds.evaluation_audit(ds.evaluate_windows(_aggregates(spark, folder)))


@query
def strike_decay(spark: SparkSession, folder: str) -> DataFrame:
    return ds.decay_strikes(driver_risk_state(spark, folder), oracle.UPKEEP)


@query
def strike_decay_audit(spark: SparkSession, folder: str) -> DataFrame:
    return ds.decay_audit(strike_decay(spark, folder))


def _waiting(spark: SparkSession, folder: str) -> DataFrame:
    """The state with the cooldown over for drivers with an even score."""
    days = F.when(F.col("total_strike_score") % 2 == 0, -1).otherwise(1)
    return driver_risk_state(spark, folder).withColumn(
        "cooldown_until", F.lit(oracle.UPKEEP).cast("timestamp") + F.make_interval(days=days))


@query
def reinstatement(spark: SparkSession, folder: str) -> DataFrame:
    return ds.reinstate(_waiting(spark, folder), oracle.UPKEEP)


@query
def reinstatement_audit(spark: SparkSession, folder: str) -> DataFrame:
    return ds.reinstatement_audit(reinstatement(spark, folder))


# --- streams, each run until all of its source is read


def _stored_dimension(sample: FleetSample) -> AbstractContextManager[DataFrame]:
    """The current assignments as the stored table that a stream reads in every batch."""
    return staged(sample.dimension(), "dimension")


@query
def stream_driver_safety_status(spark: SparkSession, folder: str) -> DataFrame:
    """The event table as the stream writes it."""
    sample, path = FleetSample(spark, folder), new_scratch_path(spark, "stream-events")
    with _stored_dimension(sample) as dimension:
        streams.start_driver_safety_current(
            sample.messages(stream=True), lambda: dimension, path,
            new_scratch_path(spark, "stream-checkpoint"), trigger=ALL_NOW).awaitTermination()
    return spark.read.parquet(path).drop("processing_ts", "stream_id", "batch_id")


@query
def stream_risk_aggregates(spark: SparkSession, folder: str) -> DataFrame:
    """The windows that the watermark has closed."""
    sample, path = FleetSample(spark, folder), new_scratch_path(spark, "stream-windows")
    with _stored_dimension(sample) as dimension:
        streams.start_driver_risk_aggregates(
            sample.messages(stream=True), dimension, path,
            new_scratch_path(spark, "stream-checkpoint"), trigger=ALL_NOW).awaitTermination()
    return rounded(telemetry.flatten_window(spark.read.parquet(path)), "avg_speed")


@query
def stream_driver_state(spark: SparkSession, folder: str) -> DataFrame:
    """The stored driver state after the stream has applied its batches."""
    sample = FleetSample(spark, folder)
    store = DriverStateStore(spark, new_scratch_path(spark, "stream-state"))
    with _stored_dimension(sample) as dimension:
        streams.start_driver_state(
            sample.messages(stream=True), lambda: dimension, store,
            new_scratch_path(spark, "stream-checkpoint"), trigger=ALL_NOW,
            clock=lambda: oracle.FIRST_BATCH).awaitTermination()
    return store.read_state()


# --- streams of several micro-batches, with late and repeated events


def _arrivals(sample: FleetSample) -> DataFrame:
    """A file a batch, in the order of arrival."""
    path = sample.write_arrivals(new_scratch_path(sample.spark, "arrivals"))
    return json_lines_source(sample.spark, path, max_files_per_trigger=1)


def _late_stream(spark: SparkSession, folder: str) -> tuple[StreamingQuery, str]:
    sample, path = FleetSample(spark, folder), new_scratch_path(spark, "late-events")
    with _stored_dimension(sample) as dimension:
        query = streams.start_driver_safety_current(
            _arrivals(sample), lambda: dimension, path, new_scratch_path(spark, "stream-checkpoint"),
            trigger=ALL_NOW)
        query.awaitTermination()
    return query, path


@query
def stream_late_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events that come before the watermark has passed them, each once, with their batch."""
    _, path = _late_stream(spark, folder)
    return spark.read.parquet(path).select("driver_id", "vin", "event_timestamp", "strike_score",
                                           F.col("batch_id").cast("bigint").alias("batch_id"))


@query
def stream_late_dropped(spark: SparkSession, folder: str) -> DataFrame:
    """How many events of each batch came too late."""
    late, _ = _late_stream(spark, folder)
    return streams.late_events_by_batch(spark, late).filter("dropped > 0")


@query
def stream_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """What the supervisor reports of that stream."""
    with supervised(spark) as supervisor:
        _late_stream(spark, folder)
        outcomes = await_outcomes(spark, supervisor)
    return outcomes.select("query", "dropped", "ended", F.col("error").isNotNull().alias("failed"))


@query
def stream_state_of_batches(spark: SparkSession, folder: str) -> DataFrame:
    """The stored state when windows fill over several batches."""
    sample = FleetSample(spark, folder)
    store = DriverStateStore(spark, new_scratch_path(spark, "stream-state"))
    with _stored_dimension(sample) as dimension:
        streams.start_driver_state(
            _arrivals(sample), lambda: dimension, store, new_scratch_path(spark, "stream-checkpoint"),
            trigger=ALL_NOW, clock=lambda: oracle.FIRST_BATCH).awaitTermination()
    return store.read_state()


@query
def stream_audit_of_batches(spark: SparkSession, folder: str) -> DataFrame:
    """What each batch found: a row per window it touched, rated by its total so far."""
    sample = FleetSample(spark, folder)
    store = DriverStateStore(spark, new_scratch_path(spark, "stream-state"))
    with _stored_dimension(sample) as dimension:
        streams.start_driver_state(
            _arrivals(sample), lambda: dimension, store, new_scratch_path(spark, "stream-checkpoint"),
            trigger=ALL_NOW, clock=lambda: oracle.FIRST_BATCH).awaitTermination()
    return store.read_audit()


@query
def stream_state_as_emitted(spark: SparkSession, folder: str) -> DataFrame:
    """The same in update mode: a window counts as a whole each time it grows."""
    sample = FleetSample(spark, folder)
    store = DriverStateStore(spark, new_scratch_path(spark, "stream-state"))
    with _stored_dimension(sample) as dimension:
        streams.start_driver_state_as_emitted(
            _arrivals(sample), dimension, store, new_scratch_path(spark, "stream-checkpoint"),
            trigger=ALL_NOW, clock=lambda: oracle.FIRST_BATCH).awaitTermination()
    return store.read_state()


def _changes(spark: SparkSession, folder: str) -> DataFrame:
    """Changes of all drivers, with cooldowns of an hour and a half."""
    sample, path = FleetSample(spark, folder), new_scratch_path(spark, "driver-changes")
    with streams.rocksdb_state(spark), _stored_dimension(sample) as dimension:
        timers.start_driver_changes(
            _arrivals(sample), dimension, path, new_scratch_path(spark, "stream-checkpoint"),
            cooldown_seconds=oracle.COOLDOWN_SECONDS, trigger=ALL_NOW).awaitTermination()
    return spark.read.schema(timers.CHANGES).parquet(path)


@query
def stream_state_by_timers(spark: SparkSession, folder: str) -> DataFrame:
    """The state of each driver, with cooldowns that ended by the time of the events."""
    return timers.state_of(_changes(spark, folder))


@query
def stream_audit_by_timers(spark: SparkSession, folder: str) -> DataFrame:
    """Evaluations and reinstatements in one log."""
    return timers.audit_of(_changes(spark, folder))


# --- quality and reports


@query
def quality_profile_of_raw(spark: SparkSession, folder: str) -> DataFrame:
    sample = FleetSample(spark, folder)
    raw = {"vehicle_registry": sample.raw_registry(), "vehicle_assignment": sample.raw_assignment(),
           "fuel_transactions": sample.raw_fuel(), "maintenance_logs": sample.raw_maintenance()}
    profiles = [quality_profile(df).select(F.lit(name).alias("table_name"), "*")
                for name, df in raw.items()]
    return reduce(DataFrame.unionByName, profiles)


QUERIES["quality_profile"] = QUERIES.pop("quality_profile_of_raw")


def _report(target: str) -> Query:
    report = next(r for r in reports.REPORTS if r.target == target)

    def run(spark: SparkSession, folder: str) -> DataFrame:
        if target in oracle.SAFETY_REPORTS:
            events = driver_safety_status(spark, folder)
            tables = reports.FleetTables(events, reports.event_facts(events), None, None)
        else:
            history = gold_asset_history_scd2(spark, folder)
            tables = reports.FleetTables(None, None, history, assets.active_fleet_snapshot(history))
        return rounded(report.build(tables), "avg_speed")

    return run


for _target, _key in oracle.REPORT_KEYS.items():
    QUERIES[_key] = _report(_target)


def publish(spark: SparkSession, folder: str) -> DataFrame:
    """Publish all reports from stored gold tables; the run log without its times."""
    with (staged(gold_asset_history_scd2(spark, folder), "history") as history,
          staged(driver_safety_status(spark, folder), "events") as events,
          staged(reports.rolled_up(reports.event_facts(events)), "facts") as facts):
        reports.create_views(
            reports.FleetTables(events, facts, history, assets.active_fleet_snapshot(history)))
        log = publish_reports(spark, ParquetReports(spark, new_scratch_path(spark, "reports")))
    return log.select("target", "status", "rows_fetched", "duplicate_rows", "null_cells",
                      "rows_removed", "final_rows")


QUERIES["publish_reports"] = publish
