"""Plain Parquet in numbered folders: a job writes the next one, readers take the last finished one.

A folder is written aside and renamed, and holds Spark's success mark, so a job that dies leaves
the one before as it is. One application writes a table at a time; threads of it take turns
(``turn``).
"""

from __future__ import annotations

import time
import uuid
from collections import defaultdict
from collections.abc import Callable
from threading import RLock

from pyspark.sql import DataFrame, SparkSession

from fleetgauge.sources.files import gathered
from fleetgauge.sources.scratch import delete

_TURNS: dict[str, RLock] = defaultdict(RLock)


def turn(path: str) -> RLock:
    """The lock of the writers of a table within this application."""
    return _TURNS[path.rstrip("/")]


def found(spark: SparkSession, pattern: str) -> list[tuple[str, float]]:
    """Paths that fit a pattern, with the time of their last change, in order."""
    place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    listed = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return sorted((str(f.getPath().toString()), f.getModificationTime() / 1000) for f in listed or ())


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder to a place that must not exist."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(path(target)) or not fs.rename(path(source), path(target)):
        raise OSError(f"cannot move {source} to {target}")


class RunFolders:
    """``path/run=<n>``, each a whole Parquet table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def at(self, run: int) -> str:
        return f"{self.path}/run={run}"

    def finished(self) -> dict[int, float]:
        """Finished runs in order, with the time they were finished."""
        marks = found(self.spark, f"{self.path}/run=*/_SUCCESS")
        runs = {int(path.rsplit("/", 2)[1].removeprefix("run=")): when for path, when in marks}
        return dict(sorted(runs.items()))

    def latest(self) -> int | None:
        return max(self.finished(), default=None)

    def write(self, df: DataFrame, partition_by: str | None = None,
              accept: Callable[[], bool] = lambda: True) -> int | None:
        """The next run, written aside and renamed. ``df`` may read the runs before.

        None, and no run, if ``accept`` says so when the rows are written.
        """
        aside = f"{self.path}/_aside-{uuid.uuid4().hex}"
        try:
            rows = gathered(df, [partition_by]) if partition_by else df
            (rows.write.partitionBy(partition_by) if partition_by else rows.write).parquet(aside)
            if not accept():
                return None
            run = (self.latest() or 0) + 1
            rename(self.spark, aside, self.at(run))
            return run
        finally:
            delete(self.spark, aside)

    def keep(self, runs: int, seconds: float = 0.0, part: str = "") -> None:
        """Delete runs (or a ``part`` of them) but the last ones and those replaced just now."""
        finished = list(self.finished().items())
        for (run, _), (_, replaced) in zip(finished[:-runs], finished[1:], strict=False):
            if replaced <= time.time() - seconds:
                delete(self.spark, self.at(run) + (f"/{part}" if part else ""))
