"""What several operators share: staging, size checks, row keys and global ranks."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetgauge.sources.scratch import new_scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\f\r"

#: Bytes of Parquet up to which a staged table may be broadcast (a few times that in memory).
BROADCAST_BYTES = 16 << 20


def ascii_lower(text: Column) -> Column:
    """Only A-Z are lower-cased."""
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """The words of a text; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+"))


def n_words_of(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def text_key(text: Column) -> list[Column]:
    """128 bits that stand for a text (null counts as its own text), as two columns.

    Results that depend on the text alone are joined by it instead of by ``doc_id``,
    which may be null or repeated.
    """
    return [F.xxhash64(text).alias("_key"), F.xxhash64(F.lit(7), text, F.lit(11)).alias("_key2")]


KEYS = ["_key", "_key2"]


def stage(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends here.

    Survives lost executors, and gives Spark the true size of the table, by which it
    chooses joins. The files stay until ``clear_staged`` or the end of the folder, since
    the frames built on them are lazy.
    """
    spark = df.sparkSession
    path = new_scratch_path(spark, f"llm/{spark.sparkContext.applicationId}/{name}")
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within, Spark deletes the shuffle files of a query when it ends, not when the driver
    happens to collect its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before) if before else spark.conf.unset(SHUFFLE_CLEANUP)


def clear_staged(spark: SparkSession) -> None:
    """Deletes what this application staged. Call it when all results are written."""
    from fleetgauge.sources.scratch import delete, scratch_folder

    delete(spark, f"{scratch_folder(spark)}/llm/{spark.sparkContext.applicationId}")


def staged_bytes(df: DataFrame) -> int:
    """Bytes of the files that a staged frame reads."""
    spark = df.sparkSession
    total = 0
    for path in df.inputFiles():
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        total += place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).getLen()
    return total


def broadcast_if_small(staged: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A broadcast hint, if the files of a staged frame are within ``limit`` bytes; else Spark
    joins by shuffle and splits skewed keys."""
    return F.broadcast(staged) if staged_bytes(staged) <= limit else staged


def ranked(df: DataFrame, order: list[Column], rank: str) -> DataFrame:
    """``df`` with its 0-based position in a total order, without one task for all rows.

    Rows are range-partitioned and numbered within each part; parts are offset by the
    counts of those before, of which there are as many as shuffle partitions.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = stage(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()),
                 "ranked")
    before, offsets = 0, []
    for row in sorted(rows.groupBy("_part").count().collect()):
        offsets += [F.lit(row["_part"]), F.lit(before)]
        before += row["count"]
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    if not offsets:
        return rows.withColumn(rank, F.lit(0).cast("long")).drop("_part")
    return rows.withColumn(rank, (F.create_map(*offsets)[F.col("_part")] + place - 1).cast("long")
                           ).drop("_part")


def ship_package(spark: SparkSession) -> None:
    """Makes this library importable in Python workers, once per application.

    Spark serves the archive from the driver; workers need no folder shared with it. Batches
    of texts that go to them are kept small, since texts can be long.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    context = spark.sparkContext
    if getattr(context, "_fleetgauge_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="fleetgauge-")) / "fleetgauge-package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._fleetgauge_shipped = True
