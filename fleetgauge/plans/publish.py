"""Publishing of report views to serving tables, with a run log."""

from __future__ import annotations

import time
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass
from datetime import datetime, timezone
from typing import Protocol

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession

from fleetgauge.operators.quality import COPIES, count_copies, profile_columns
from fleetgauge.plans.reports import REPORTS, Report
from fleetgauge.schemas import BIGINT, DOUBLE, INT, STRING, TIMESTAMP, table
from fleetgauge.settings import PublishSettings
from fleetgauge.sources.catalog import read_view, write_jdbc
from fleetgauge.sources.folders import RunFolders, turn
from fleetgauge.sources.scratch import staged

RUN_LOG = table(
    view=STRING, target=STRING, status=STRING, attempts=INT, rows_fetched=BIGINT,
    duplicate_rows=BIGINT, null_cells=BIGINT, rows_removed=BIGINT, final_rows=BIGINT,
    error=STRING, started_at=TIMESTAMP, seconds=DOUBLE,
)


@dataclass
class Outcome:
    view: str
    target: str
    status: str = "failed"
    attempts: int = 0
    rows_fetched: int | None = None
    duplicate_rows: int | None = None
    null_cells: int | None = None
    rows_removed: int | None = None
    final_rows: int | None = None
    error: str | None = None
    started_at: datetime | None = None
    seconds: float | None = None


class ReportSink(Protocol):
    def refresh(self, target: str, rows: DataFrame, profile: Observation) -> bool:
        """Replace the target by ``rows``; False, with the target as it was, if there are none."""


class ParquetReports:
    """Targets are folders of one folder, with a numbered folder for each refresh."""

    def __init__(self, spark: SparkSession, path: str, keep_versions: int = 3,
                 settings: PublishSettings = PublishSettings()):
        self.spark, self.path, self.keep_versions = spark, path.rstrip("/"), keep_versions
        self.settings = settings

    def runs(self, target: str) -> RunFolders:
        return RunFolders(self.spark, f"{self.path}/{target}")

    def refresh(self, target: str, rows: DataFrame, profile: Observation) -> bool:
        runs = self.runs(target)
        with turn(runs.path):
            # whether there are rows is known when they are written
            run = runs.write(rows, accept=lambda: profile.get["final_rows"] > 0)
            runs.keep(self.keep_versions, self.settings.retained_seconds)
        return run is not None

    def read(self, target: str) -> DataFrame:
        """The target as last refreshed."""
        run = self.runs(target).latest()
        if run is None:
            raise LookupError(f"{target} was never published")
        return self.spark.read.parquet(self.runs(target).at(run))


class JdbcReports:
    """Targets are tables of one database, loaded from a staged copy."""

    def __init__(self, url: str, properties: dict[str, str],
                 settings: PublishSettings = PublishSettings()):
        self.url, self.properties, self.settings = url, properties, settings

    def refresh(self, target: str, rows: DataFrame, profile: Observation) -> bool:
        with staged(rows, target) as copy:
            if profile.get["final_rows"] == 0:
                return False
            write_jdbc(copy, self.url, target, self.properties, self.settings.insert_chunk,
                       self.settings.connections)
            return True


def publish_report(spark: SparkSession, report: Report, sink: ReportSink,
                   settings: PublishSettings = PublishSettings()) -> Outcome:
    """Read the view, drop equal rows, refresh the target; several attempts.

    The profile is observed by the job that writes, so the view runs once. An
    empty view is not an error: its target stays, and there is no other attempt.
    """
    outcome = Outcome(report.view, report.target, started_at=datetime.now(timezone.utc))
    clock = time.monotonic()
    for attempt in range(1, settings.attempts + 1):
        outcome.attempts = attempt
        try:
            view = read_view(spark, report.view)
            profile = Observation()
            rows = count_copies(view).observe(profile, *profile_columns(view.columns)).drop(COPIES)
            written = sink.refresh(report.target, rows, profile)
            for name, value in profile.get.items():
                setattr(outcome, name, value)
            outcome.status = "published" if written else "skipped_empty"
            outcome.error = None
            break
        except Exception as error:  # one report must not stop the others
            outcome.error = str(error)
            if attempt < settings.attempts:
                time.sleep(settings.pause_seconds)
    outcome.seconds = time.monotonic() - clock
    return outcome


def publish_reports(spark: SparkSession, sink: ReportSink, reports: Iterable[Report] = REPORTS,
                    settings: PublishSettings = PublishSettings()) -> DataFrame:
    """Publish every report and return the run log, one row per report.

    Reports are independent jobs; a few are submitted at a time so that small
    ones fill the gaps of large ones.
    """
    publish = inheritable_thread_target(spark)(publish_report)
    with ThreadPoolExecutor(settings.concurrent_reports) as pool:
        outcomes = list(pool.map(lambda report: publish(spark, report, sink, settings), reports))
    return spark.createDataFrame([tuple(asdict(o).values()) for o in outcomes], RUN_LOG)
