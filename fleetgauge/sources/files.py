"""CSV and Parquet tables."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetgauge.schemas import empty_table, require_columns


def read_raw(spark: SparkSession, path: str, required: Iterable[str] = ()) -> DataFrame:
    """A CSV directory with header; every column is text and bound by name."""
    return require_columns(spark.read.option("header", True).csv(path), required)


def read_table(spark: SparkSession, path: str, required: Iterable[str] = ()) -> DataFrame:
    return require_columns(spark.read.parquet(path), required)


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The Parquet table at ``path``, or an empty one if the path does not exist.

    Any other failure is raised, so that a permission error cannot restart a
    history from nothing.
    """
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_table(spark, schema)


def gathered(df: DataFrame, keys: list[str], spread_by: Iterable[str] = ()) -> DataFrame:
    """Rows of one output folder in few tasks, so that it gets few files.

    Adaptive execution splits a large folder over several tasks again. Spark runs the batches
    of a stateful stream without it and drops the hint there: every task would write a file to
    every folder. These rows are dealt by the keys and, given ``spread_by``, a folder with more
    than a task's share of the rows is split by a hash of these columns. That counts the rows.
    """
    conf, spread = df.sparkSession.conf, list(spread_by)
    if conf.get("spark.sql.adaptive.enabled", "true").lower() == "true":
        return df.hint("rebalance", *[F.col(k) for k in keys])
    if not spread:
        return df.repartition(*keys)
    share = max(df.count() / int(conf.get("spark.sql.shuffle.partitions")), 1.0)
    sizes = df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        F.ceil(F.count(F.lit(1)) / share).alias("_parts"))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    part = F.pmod(F.xxhash64(*spread), F.col("_parts"))
    return df.join(F.broadcast(sizes), same).withColumn("_part", part).repartition(
        *keys, "_part").select(df.columns)


def overwrite(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> None:
    """Replace the Parquet table at ``path``, which ``df`` must not read from."""
    keys = list(partition_by)
    rows = gathered(df, keys) if keys else df
    writer = rows.write.mode("overwrite").option("compression", "snappy")
    (writer.partitionBy(*keys) if keys else writer).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Iterable[str],
                         spread_by: Iterable[str] = ()) -> None:
    """Replace only the partitions that ``df`` has rows for. Safe to repeat."""
    keys = list(partition_by)
    (gathered(df, keys, spread_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*keys).parquet(path))
