import os

import pytest
from conftest import values

from fleetgauge.plans.publish import ParquetReports, publish_reports
from fleetgauge.plans.reports import Report
from fleetgauge.operators.quality import quality_profile
from fleetgauge.settings import PublishSettings
from fleetgauge.sources.catalog import register_table
from fleetgauge.sources.files import overwrite, overwrite_partitions
from fleetgauge.sources.folders import RunFolders
from fleetgauge.sources.scratch import scratch_folder, staged

QUICK = PublishSettings(pause_seconds=0.0)


def test_run_may_be_built_from_the_one_it_replaces(spark, folder):
    runs = RunFolders(spark, folder)
    assert runs.latest() is None
    old = spark.read.parquet(runs.at(runs.write(spark.range(3))))
    new = runs.write(old.selectExpr("id + 10 AS id"))
    assert values(spark.read.parquet(runs.at(new))) == [(10,), (11,), (12,)]
    assert (new, values(old)) == (2, [(0,), (1,), (2,)])


def test_failed_or_refused_write_leaves_no_run(spark, folder):
    runs = RunFolders(spark, folder)
    runs.write(spark.range(3))
    with pytest.raises(Exception):
        runs.write(spark.range(3).selectExpr("raise_error('no') AS id"))
    assert runs.write(spark.range(3), accept=lambda: False) is None
    assert [n for n in os.listdir(folder) if not n.startswith(".")] == ["run=1"]


def test_unfinished_run_is_not_read(spark, folder):
    runs = RunFolders(spark, folder)
    runs.write(spark.range(3))
    os.makedirs(f"{folder}/run=2")
    assert runs.latest() == 1


def test_runs_stay_as_long_as_readers_may_need_them(spark, folder):
    runs = RunFolders(spark, folder)
    for n in range(5):
        runs.write(spark.range(n))
    runs.keep(1, seconds=3600)
    assert list(runs.finished()) == [1, 2, 3, 4, 5]
    for run in (2, 3):  # replaced two hours ago
        mark = f"{runs.at(run)}/_SUCCESS"
        os.utime(mark, (os.stat(mark).st_mtime - 7200,) * 2)
    runs.keep(1, seconds=3600)
    assert list(runs.finished()) == [3, 4, 5]
    runs.keep(2)
    assert list(runs.finished()) == [4, 5]


def test_partition_overwrite_can_be_repeated(spark, folder):
    rows = spark.range(4).selectExpr("id", "id % 2 AS p")
    overwrite_partitions(rows, folder, ["p"])
    overwrite_partitions(rows.filter("p = 1").selectExpr("id + 10 AS id", "p"), folder, ["p"])
    assert values(spark.read.parquet(folder), "id") == [(0,), (11,), (13,), (2,)]


def test_register_table_finds_partitions(spark, folder):
    overwrite(spark.range(4).selectExpr("id", "'2024-01-01' AS date", "id % 2 AS hour"), folder, ["date", "hour"])
    table = register_table(spark, "registered_events", folder)
    assert table.filter("hour = 1").count() == 2
    overwrite(spark.range(6).selectExpr("id", "'2024-01-02' AS date", "id % 3 AS hour"), folder, ["date", "hour"])
    assert register_table(spark, "registered_events", folder).count() == 6


def test_register_table_keeps_the_table_and_follows_the_folder(spark, folder, monkeypatch):
    overwrite(spark.range(4).selectExpr("id", "id % 2 AS part"), folder, ["part"])
    register_table(spark, "followed", folder)
    said, ask = [], spark.sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: (said.append(text), ask(text))[1])
    overwrite(spark.range(6).selectExpr("id", "id * 2 AS twice", "id % 3 + 1 AS part"), folder, ["part"])
    table = register_table(spark, "followed", folder)
    # part 0 is gone, part 3 and a column are new, and there was no moment without the table
    assert values(table.select("id", "twice", "part")) == [(i, 2 * i, i % 3 + 1) for i in range(6)]
    assert not any(text.startswith(("DROP", "CREATE")) for text in said)
    overwrite(spark.range(2).selectExpr("CAST(id AS STRING) AS id"), folder)
    assert values(register_table(spark, "followed", folder)) == [("0",), ("1",)]
    assert any(text.startswith("DROP") for text in said)
    other = folder + "/it's elsewhere"
    overwrite(spark.range(3).selectExpr("CAST(id + 7 AS STRING) AS id"), other)
    assert values(register_table(spark, "followed", other)) == [("7",), ("8",), ("9",)]


def test_staging_uses_the_shared_folder_and_cleans_up(spark):
    assert scratch_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    with staged(spark.range(3)) as copy:
        place = copy.inputFiles()[0].removeprefix("file:").replace("//", "")
        assert place.startswith(scratch_folder(spark)) and os.path.exists(place)
        assert values(copy) == [(0,), (1,), (2,)]
    assert not os.path.exists(os.path.dirname(place))


def test_partitioned_write_gathers_rows(spark, folder):
    overwrite(spark.range(0, 400, 1, 8).selectExpr("id", "id % 3 AS p"), folder, ["p"])
    files = [f for _, _, names in os.walk(folder) for f in names if f.endswith(".parquet")]
    assert len(files) == 3


def test_profile(frame):
    df = frame("a INT, b STRING", [(1, "x"), (1, "x"), (1, "x"), (None, "x"), (None, None), (None, None)])
    assert values(quality_profile(df)) == [(6, 3, 5, 3, 3)]
    assert values(quality_profile(df.filter("false"))) == [(0, 0, 0, 0, 0)]


def test_publish(spark, folder, frame):
    frame("a INT, b STRING", [(1, "x"), (1, "x"), (2, None)]).createOrReplaceTempView("view_rows")
    frame("a INT", []).createOrReplaceTempView("view_empty")
    reports = [Report("view_rows", "t_rows", None), Report("view_none", "t_none", None),
               Report("view_empty", "t_empty", None)]
    sink = ParquetReports(spark, folder)
    columns = ("target", "status", "attempts", "rows_fetched", "duplicate_rows", "null_cells",
               "rows_removed", "final_rows")
    assert values(publish_reports(spark, sink, reports, QUICK), *columns) == [
        ("t_empty", "skipped_empty", 1, 0, 0, 0, 0, 0),
        ("t_none", "failed", 3, None, None, None, None, None),
        ("t_rows", "published", 1, 3, 1, 1, 1, 2)]
    assert values(sink.read("t_rows")) == [(1, "x"), (2, None)]
    # an empty view keeps the old target
    frame("a INT, b STRING", []).createOrReplaceTempView("view_rows")
    publish_reports(spark, sink, reports[:1], QUICK)
    assert sink.read("t_rows").count() == 2


def test_publish_tries_again(spark, folder, frame):
    frame("a INT", [(1,)]).createOrReplaceTempView("view_rows")

    class Flaky(ParquetReports):
        calls = 0

        def refresh(self, *arguments):
            Flaky.calls += 1
            if Flaky.calls < 3:
                raise OSError("not now")
            return super().refresh(*arguments)

    log = publish_reports(spark, Flaky(spark, folder), [Report("view_rows", "t", None)], QUICK)
    assert values(log, "status", "attempts", "error") == [("published", 3, None)]
