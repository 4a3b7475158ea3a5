"""The streaming queries.

Each takes ``messages`` (see ``sources.streams``), an output path and a
checkpoint path, and returns the started query. ``trigger`` is the keyword of
``DataStreamWriter.trigger``; the default is the processing time in the settings.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetgauge.operators.joins import sized_join_side, stream_join_side
from fleetgauge.plans.stores import DriverStateStore
from fleetgauge.plans.telemetry import (
    clean_telemetry,
    driver_risk_aggregates,
    driver_safety_status,
    enrich,
    flatten_window,
    parse_telemetry,
    score_events,
)
from fleetgauge.settings import RiskSettings, StreamSettings
from fleetgauge.sources.files import overwrite_partitions
from fleetgauge.sources.folders import found
from fleetgauge.sources.scratch import delete, staged

Dimension = Callable[[], DataFrame]
Clock = Callable[[], datetime]
BatchFunction = Callable[[DataFrame, int], None]


STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB; for state beyond executor memory, and for timers."""
    spark.conf.set(
        STATE_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """The same for the queries that are started within."""
    before = spark.conf.get(STATE_PROVIDER, None)
    use_rocksdb_state(spark)
    try:
        yield
    finally:
        spark.conf.set(STATE_PROVIDER, before) if before else spark.conf.unset(STATE_PROVIDER)


def clean_stream(messages: DataFrame, stream: StreamSettings = StreamSettings()) -> DataFrame:
    return clean_telemetry(parse_telemetry(messages), stream)


def start_driver_safety(messages: DataFrame, assignments: DataFrame, path: str, checkpoint: str,
                        settings: RiskSettings = RiskSettings(),
                        stream: StreamSettings = StreamSettings(),
                        trigger: dict | None = None) -> StreamingQuery:
    """Scored events to Parquet by date and hour, exactly once.

    The assignments are those of the start; restart the query to renew them, or
    use :func:`start_driver_safety_current`.
    """
    dimension, salts = stream_join_side(assignments, stream.broadcast_rows, stream.join_salts)
    events = driver_safety_status(clean_stream(messages, stream), dimension, settings, salts=salts)
    return (
        events.writeStream.format("parquet").outputMode("append").partitionBy("date", "hour")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": stream.event_trigger}))
        .queryName("scored_events").start()
    )


def start_driver_safety_current(messages: DataFrame, assignments: Dimension, path: str,
                                checkpoint: str, settings: RiskSettings = RiskSettings(),
                                stream: StreamSettings = StreamSettings(),
                                trigger: dict | None = None,
                                stream_id: str | None = None) -> StreamingQuery:
    """Like :func:`start_driver_safety`, with the assignments read anew in every batch.

    Rows are partitioned by stream_id and batch_id before date and hour, and a repeated batch
    replaces its own partitions, by the assignments it had the first time. A table that has
    date and hour first, of an earlier version, is not to be gone on with: start another.
    ``stream_id`` is that of the checkpoint if not given.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        name = _identity(batch, stream_id)
        with staged(batch, "batch") as rows:
            held = pinned(rows, batch_id, assignments, path, name, stream)
            _write_events(rows, batch_id, held, path, settings, name)

    return (
        clean_stream(messages, stream).writeStream.foreachBatch(write).outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": stream.event_trigger}))
        .queryName("scored_events_current").start()
    )


def _identity(batch: DataFrame, given: str | None) -> str:
    """What tells the batches of this stream from those of others: the query's id.

    It is kept in the checkpoint, so a restart has the same and a new checkpoint a new one.
    """
    return given or batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def pinned(batch: DataFrame, batch_id: int, assignments: Dimension, folder: str,
           stream_id: str, stream: StreamSettings = StreamSettings(), keep: int = 1000) -> DataFrame:
    """The assignments of the vehicles of a batch, as they were when it was first run, measured.

    They are written before anything else of the batch, in a folder that readers of the
    tables around it pass over, so a batch that is repeated gives the same rows whatever has
    been reassigned. Those of the last ``keep`` batches of a stream stay.
    """
    spark = batch.sparkSession
    root = f"{folder}/_assignments/of-{quote(stream_id, safe='')}"
    place = f"{root}/{batch_id}"
    if not found(spark, f"{place}/_SUCCESS"):
        vehicles = batch.select("vin").distinct()
        assignments().join(vehicles, "vin", "left_semi").write.mode("overwrite").parquet(place)
        marks = sorted(int(p.rsplit("/", 2)[1]) for p, _ in found(spark, f"{root}/*/_SUCCESS"))
        for old in marks[:-keep]:
            delete(spark, f"{root}/{old}")
    return sized_join_side(spark.read.parquet(place), stream.broadcast_rows)


def _write_events(batch: DataFrame, batch_id: int, held: DataFrame, path: str,
                  settings: RiskSettings, stream_id: str) -> None:
    events = driver_safety_status(batch, held, settings)
    named = events.withColumns({"stream_id": F.lit(stream_id),
                                "batch_id": F.lit(batch_id).cast("bigint")})
    # the batch comes first: its hours share these folders, which else are made anew in each
    overwrite_partitions(named, path, ["stream_id", "batch_id", "date", "hour"],
                         ["vin", "event_time"])


def _once(store: DriverStateStore, apply: BatchFunction, stream_id: str | None) -> BatchFunction:
    """``apply`` for batches the store does not have yet.

    A batch that it has is still computed, because the de-duplication state of
    the stream must go forward with it.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        if store.has_applied(batch_id, _identity(batch, stream_id)):
            batch.write.format("noop").mode("overwrite").save()
        else:
            apply(batch, batch_id)

    return run


def _windowed(messages: DataFrame, assignments: DataFrame, settings: RiskSettings,
              stream: StreamSettings) -> DataFrame:
    dimension, salts = stream_join_side(assignments, stream.broadcast_rows, stream.join_salts)
    scored = score_events(enrich(clean_stream(messages, stream), dimension, salts), settings)
    return driver_risk_aggregates(scored, stream)


def start_driver_risk_aggregates(messages: DataFrame, assignments: DataFrame, path: str,
                                 checkpoint: str, settings: RiskSettings = RiskSettings(),
                                 stream: StreamSettings = StreamSettings(),
                                 trigger: dict | None = None) -> StreamingQuery:
    """Each window once, when the watermark has passed its end."""
    return (
        _windowed(messages, assignments, settings, stream)
        .writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": stream.aggregate_trigger}))
        .queryName("risk_windows").start()
    )


def start_driver_state(messages: DataFrame, assignments: Dimension, store: DriverStateStore,
                       checkpoint: str, trigger: dict | None = None,
                       clock: Clock | None = None, stream_id: str | None = None,
                       **options) -> StreamingQuery:
    """Keep the driver state up to date, event by event.

    The only streaming state is the de-duplication; window totals live in the
    ledger of the store. Assignments are read anew in every batch. ``options``
    are ``cooldown_by_tier`` and ``true_previous``. ``stream_id`` is that of the
    checkpoint if not given: a new checkpoint is a new stream, whose events all count.
    To read old events again without counting them twice, give the id of before.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        name = _identity(batch, stream_id)
        with staged(batch, "batch") as rows:
            held = pinned(rows, batch_id, assignments, store.path, name, store.stream)
            _credit(rows, batch_id, held, store, clock, name, options)

    return (
        clean_stream(messages, store.stream).writeStream.foreachBatch(_once(store, apply, stream_id))
        .outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": store.stream.aggregate_trigger}))
        .queryName("driver_state_stream").start()
    )


def _credit(batch: DataFrame, batch_id: int, held: DataFrame, store: DriverStateStore,
            clock: Clock | None, stream_id: str, options: dict) -> None:
    scored = score_events(enrich(batch, held), store.settings)
    store.apply_events(scored, batch_id, clock() if clock else None, stream_id, **options)


def start_events_and_state(messages: DataFrame, assignments: Dimension, path: str,
                           store: DriverStateStore, checkpoint: str, trigger: dict | None = None,
                           clock: Clock | None = None, stream_id: str | None = None,
                           **options) -> StreamingQuery:
    """Event table and driver state from one query.

    The source is read and de-duplicated once for both, where two queries would
    each do it with a state of their own. A batch is staged in the shared folder, and
    both use the assignments it was first run with.
    """

    def both(batch: DataFrame, batch_id: int) -> None:
        name = _identity(batch, stream_id)
        with staged(batch, "batch") as rows:
            held = pinned(rows, batch_id, assignments, path, name, store.stream)
            _write_events(rows, batch_id, held, path, store.settings, name)
            _credit(rows, batch_id, held, store, clock, name, options)

    return (
        clean_stream(messages, store.stream).writeStream.foreachBatch(both).outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": store.stream.event_trigger}))
        .queryName("events_and_state_stream").start()
    )


def start_driver_state_as_emitted(messages: DataFrame, assignments: DataFrame,
                                  store: DriverStateStore, checkpoint: str,
                                  trigger: dict | None = None, clock: Clock | None = None,
                                  stream_id: str | None = None, **options) -> StreamingQuery:
    """Keep the driver state by adding every total that an updated window emits.

    A window that fills over several batches counts several times. It is here for
    those who depend on such scores; :func:`start_driver_state` counts once.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        store.apply_window_totals(flatten_window(batch), batch_id, clock() if clock else None,
                                  _identity(batch, stream_id), **options)

    return (
        _windowed(messages, assignments, store.settings, store.stream)
        .writeStream.foreachBatch(_once(store, add, stream_id)).outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": store.stream.aggregate_trigger}))
        .queryName("driver_state_as_emitted_stream").start()
    )


def late_events_dropped(query: StreamingQuery) -> int:
    """Events below the watermark that the recent batches of ``query`` dropped."""
    return sum(operator["numRowsDroppedByWatermark"]
               for progress in query.recentProgress for operator in progress["stateOperators"])


def late_events_by_batch(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """``batch_id, dropped`` of the recent batches of ``query``."""
    rows = [(p["batchId"], sum(o["numRowsDroppedByWatermark"] for o in p["stateOperators"]))
            for p in query.recentProgress]
    return spark.createDataFrame(rows, "batch_id BIGINT, dropped BIGINT")


def await_any(spark: SparkSession) -> None:
    """Block until one of the queries ends."""
    spark.streams.awaitAnyTermination()
