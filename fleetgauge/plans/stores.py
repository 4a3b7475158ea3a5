"""Stored asset history and driver risk state, as plain partitioned Parquet."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.functions import rules
from fleetgauge.functions.conversion import moment
from fleetgauge.plans import assets
from fleetgauge.plans import driver_state as ds
from fleetgauge.plans.telemetry import driver_risk_aggregates, flatten_window
from fleetgauge.schemas import (
    ASSET_HISTORY,
    BIGINT,
    DOUBLE,
    DRIVER_RISK_STATE,
    STORED_STATE,
    STRING,
    SUSPENSION_EVENT_HISTORY,
    empty_table,
    table,
)
from fleetgauge.settings import RiskSettings, StreamSettings
from fleetgauge.sources.files import overwrite_partitions
from fleetgauge.sources.folders import RunFolders, found, turn
from fleetgauge.sources.scratch import delete, staged

Moment = datetime | str | Column | None
RUN = table(run=BIGINT, newest=DOUBLE)


class AssetHistoryStore:
    """Current rows are rewritten by each merge; archived rows are only appended.

    The cost of a merge grows with the fleet, not with its history. A merge is one folder with
    the current rows and those it archived; the history are the current rows of the last
    finished merge and the archived ones of all.
    """

    def __init__(self, spark: SparkSession, path: str, keep_versions: int = 48,
                 keep_seconds: float = 3600.0):
        self.spark, self.merges = spark, RunFolders(spark, path)
        self.keep_versions, self.keep_seconds = keep_versions, keep_seconds

    def read_current(self) -> DataFrame:
        return self._current(self.merges.latest())

    def read(self) -> DataFrame:
        """The whole history."""
        finished = self.merges.finished()
        folders = {f"run={run}" for run in finished}
        archived = [path for path, _ in found(self.spark, f"{self.merges.path}/run=*/is_current=0")
                    if path.rsplit("/", 2)[1] in folders]
        return self._current(max(finished, default=None)).unionByName(self._rows(archived, 0))

    def _current(self, run: int | None) -> DataFrame:
        paths = [] if run is None else found(self.spark, f"{self.merges.at(run)}/is_current=1")
        return self._rows([path for path, _ in paths], 1)

    def _rows(self, paths: list[str], is_current: int) -> DataFrame:
        # is_current is the folder, not a column of its files
        if not paths:
            return empty_table(self.spark, ASSET_HISTORY)
        rows = self.spark.read.schema(ASSET_HISTORY).parquet(*paths)
        return rows.withColumn("is_current", F.lit(is_current)).select(ASSET_HISTORY.names)

    def merge(self, assignments: DataFrame, as_of: Moment = None,
              one_current_per_vin: bool = True, null_safe: bool = False) -> int:
        """Compare a snapshot with the current rows and write the outcome; the merge's number."""
        with turn(self.merges.path):
            current = self._current(self.merges.latest())
            snapshot = assets.assignment_snapshot(assignments, one_current_per_vin)
            rolled = assets.roll_forward(current, snapshot, as_of, null_safe)
            run = self.merges.write(rolled, "is_current")
            self.merges.keep(self.keep_versions, self.keep_seconds, "is_current=1")
            return run


class DriverStateStore:
    """Driver risk state with its open windows, and the audit log.

        state/of=<buckets>/bucket=<b>/version=<v>   a row per driver
        audit/source=<stream or job>/run=<batch>    what a run found
        runs/<stream>/<batch>                       the newest event of a batch

    Drivers are hashed into a fixed number of buckets. A batch reads and writes the buckets of
    its drivers alone, as a new version of each; the rows of the version before are not touched,
    so a crash loses nothing. Every row says which run of each source it holds: a batch that is
    repeated after a crash is added to the rows that lack it, and to no other. One application
    writes at a time; its threads take turns.
    """

    def __init__(self, spark: SparkSession, path: str, settings: RiskSettings = RiskSettings(),
                 stream: StreamSettings = StreamSettings()):
        self.spark, self.path = spark, path.rstrip("/")
        self.settings, self.stream = settings, stream

    def read_state(self) -> DataFrame:
        return self.read_stored().select(DRIVER_RISK_STATE.names)

    def read_ledger(self) -> DataFrame:
        """Open windows of all drivers."""
        return self.read_stored().select("driver_id", F.inline("windows"))

    def read_stored(self, buckets: list[int] | None = None) -> DataFrame:
        """Whole rows, of all or of some buckets: of each the files of its last version."""
        latest = self._latest()
        paths = [path for b, (_, path) in latest.items() if buckets is None or b in buckets]
        if not paths:
            return empty_table(self.spark, STORED_STATE)
        return self.spark.read.schema(STORED_STATE).parquet(*paths)

    def read_audit(self) -> DataFrame:
        columns = SUSPENSION_EVENT_HISTORY.names
        if not found(self.spark, f"{self.path}/audit"):
            return empty_table(self.spark, SUSPENSION_EVENT_HISTORY)
        schema = table(**{f.name: f.dataType for f in SUSPENSION_EVENT_HISTORY}, source=STRING,
                       run=BIGINT)
        return self.spark.read.schema(schema).parquet(f"{self.path}/audit").select(columns)

    def apply_events(self, scored: DataFrame, batch_id: int, as_of: Moment = None,
                     stream_id: str = "", **options) -> None:
        """Credit a micro-batch of new, scored events.

        A driver's row holds the totals of its open windows, so a window counts once however
        many batches it takes to fill, and is rated by its total so far. A batch of the same
        stream that was applied before changes nothing; batches of other streams, such as one
        with a new checkpoint, count on their own.
        """
        fresh = flatten_window(driver_risk_aggregates(scored, self.stream))
        self._credit(fresh, batch_id, as_of, stream_id, **options)

    def apply_window_totals(self, windows: DataFrame, batch_id: int, as_of: Moment = None,
                            stream_id: str = "", **options) -> None:
        """Add window totals as they come.

        A window that is emitted again with a larger total is added again as a
        whole. Use :meth:`apply_events` unless that is wanted.
        """
        self._credit(windows, batch_id, as_of, stream_id, by_window=False, **options)

    def has_applied(self, batch_id: int, stream_id: str = "") -> bool:
        """Whether a batch, or a later one of its stream, was applied to its end."""
        return batch_id <= max(self._runs(stream_id), default=-1)

    def decay(self, as_of: Moment = None, run: int | None = None) -> None:
        """Lower the scores of all drivers. A run that is given a number and repeated with it
        lowers each driver once."""
        status, score = F.col("suspension_status"), F.col("total_strike_score")
        finding = ds.finding("STRIKE_DECAY", status, status, rules.lowered(score, self.settings.decay_step),
                             F.lit("Automated strike decay applied"))
        self._upkeep("decay", F.lit(True), finding,
                     lambda rows: ds.decay_strikes(rows, as_of, self.settings), as_of, run)

    def reinstate(self, as_of: Moment = None, only_changed: bool = False,
                  run: int | None = None) -> None:
        """Make drivers active whose cooldown is over; only their buckets are written.

        The audit names all eligible drivers, or, with ``only_changed``, those made active now.
        """
        # one clock reading for the state and the audit
        now = as_of if as_of is not None else datetime.now().astimezone()
        over = F.coalesce(ds.cooldown_over(now), F.lit(False))
        finding = ds.finding("AUTO_REINSTATEMENT", F.col("suspension_status"), F.lit(ds.ACTIVE),
                             F.col("total_strike_score"), F.lit("Cooldown expired"))
        everyone = None if only_changed else lambda: ds.reinstatement_audit(self.read_state())
        self._upkeep("reinstatement", over, finding, lambda rows: ds.reinstate(rows, now), now, run,
                     everyone)

    # --- steps

    def _credit(self, fresh: DataFrame, batch_id: int, as_of: Moment, stream_id: str,
                **options) -> None:
        if self.has_applied(batch_id, stream_id):
            return
        known = fresh.filter(F.col("driver_id").isNotNull()).withColumn("bucket", self._bucket())
        timed = F.max("last_event_time") if "last_event_time" in fresh.columns else F.lit(None)
        with turn(self.path), staged(known, "window-totals") as mine:  # a stream runs once
            before = self._newest(stream_id)
            # as many numbers as there are buckets
            seen = mine.agg(F.collect_set("bucket").alias("buckets"),
                            timed.cast("timestamp").cast("double").alias("newest")).first()
            if seen.buckets:
                after = ds.credit(self.read_stored(seen.buckets), mine, stream_id, batch_id, as_of,
                                  closed=self._closed_before(before, batch_id), settings=self.settings,
                                  kept_sources=self.stream.retained_sources, **options)
                self._write(after)
                self._write_audit(ds.findings_of(self.read_stored(seen.buckets), stream_id, batch_id),
                                  stream_id, batch_id)
            times = [t for t in (seen.newest, *before.values()) if t is not None]
            self._finish(stream_id, batch_id, max(times, default=None))

    def _upkeep(self, source: str, affected: Column, finding: Column,
                change: Callable[[DataFrame], DataFrame], as_of: Moment, run: int | None,
                everyone: Callable[[], DataFrame] | None = None) -> None:
        """Write the buckets of affected drivers with their changed rows, then the audit."""
        run = run if run is not None else time.time_ns()
        due = affected & ~F.coalesce(F.col("applied")[source]["run"] >= run, F.lit(False))
        with turn(self.path):
            buckets = [r.bucket for r in self.read_stored().filter(due).select(
                self._bucket().alias("bucket")).distinct().collect()]
            if buckets:
                held = self.read_stored(buckets)
                applied = ds.mark(source, run, moment(as_of), self.stream.retained_sources)
                noted = held.filter(due).withColumns({"applied": applied, "findings": F.array(finding)})
                self._write(change(noted).unionByName(held.filter(~due)))
            rows = everyone() if everyone else ds.findings_of(self.read_stored(), source, run)
            self._write_audit(rows, source, run)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("driver_id"), F.lit(self._buckets())).cast("int")

    def _buckets(self) -> int:
        """The number of buckets that the state was first written with."""
        made = found(self.spark, f"{self.path}/state/of=*")
        return int(made[0][0].rsplit("of=", 1)[1]) if made else self.stream.state_buckets

    def _versions(self) -> dict[int, list[tuple[int, str, float]]]:
        """Versions of each bucket with their folders and times, in order."""
        out: dict[int, list[tuple[int, str, float]]] = {}
        for path, when in found(self.spark, f"{self.path}/state/of=*/bucket=*/version=*"):
            bucket, version = (int(p.split("=")[1]) for p in path.rsplit("/", 2)[1:])
            out.setdefault(bucket, []).append((version, path, when))
        return {bucket: sorted(versions) for bucket, versions in out.items()}

    def _latest(self) -> dict[int, tuple[int, str]]:
        return {bucket: versions[-1][:2] for bucket, versions in self._versions().items()}

    def _write(self, rows: DataFrame) -> None:
        """``rows``, whole buckets, as their next version."""
        of, version = self._buckets(), max((v for v, _ in self._latest().values()), default=0) + 1
        keyed = rows.select(*STORED_STATE.names, self._bucket().alias("bucket"),
                            F.lit(version).cast("bigint").alias("version"))
        overwrite_partitions(keyed, f"{self.path}/state/of={of}", ["bucket", "version"])
        limit = time.time() - self.stream.retained_seconds
        for versions in self._versions().values():
            keep = self.stream.retained_versions
            for (_, path, _), (_, _, replaced) in zip(versions[:-keep], versions[1:], strict=False):
                if replaced <= limit:
                    delete(self.spark, path)

    def _write_audit(self, rows: DataFrame, source: str, run: int) -> None:
        keyed = rows.withColumns({"source": F.lit(source), "run": F.lit(run).cast("bigint")})
        overwrite_partitions(keyed, f"{self.path}/audit", ["source", "run"], ["driver_id"])

    # --- runs of a stream

    def _run_folder(self, stream_id: str) -> str:
        return f"{self.path}/runs/of-{quote(stream_id, safe='')}"

    def _runs(self, stream_id: str) -> list[int]:
        marks = found(self.spark, f"{self._run_folder(stream_id)}/*/_SUCCESS")
        return sorted(int(path.rsplit("/", 2)[1]) for path, _ in marks)

    def _newest(self, stream_id: str) -> dict[int, float]:
        """Time of the newest event up to each of the last batches."""
        paths = [f"{self._run_folder(stream_id)}/{run}" for run in self._runs(stream_id)]
        if not paths:
            return {}
        rows = self.spark.read.schema(RUN).parquet(*paths).filter("newest IS NOT NULL").collect()
        return {row.run: row.newest for row in rows}

    def _finish(self, stream_id: str, batch_id: int, newest: float | None) -> None:
        """The last step of a batch; the last few batches of each stream are remembered."""
        folder = self._run_folder(stream_id)
        row = self.spark.range(1).select(F.lit(batch_id).cast("bigint").alias("run"),
                                         F.lit(newest).cast("double").alias("newest"))
        row.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{batch_id}")
        for run in self._runs(stream_id)[:-4]:
            delete(self.spark, f"{folder}/{run}")

    def _closed_before(self, newest: dict[int, float], batch_id: int) -> Column | None:
        """End of the windows that no event can reach any more.

        The stream drops events by the watermark of the batch before, so the
        newest event of the batches before that is what counts.
        """
        known = [when for run, when in newest.items() if run <= batch_id - 2]
        if not known:
            return None
        return F.timestamp_seconds(F.lit(max(known))) - F.expr(f"INTERVAL {self.stream.watermark_delay}")
