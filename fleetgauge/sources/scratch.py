"""The folder for staged tables, and lineage cuts that survive lost executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder(spark.sparkContext.applicationId)


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"fleetgauge-{application}-")


def new_scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def staged(df: DataFrame, name: str = "stage") -> Iterator[DataFrame]:
    """``df`` written once to the scratch folder, for the length of a ``with`` block.

    For a frame used several times: cheaper than evaluating it again and, unlike
    a cache, still there when an executor is lost.
    """
    spark = df.sparkSession
    path = new_scratch_path(spark, name)
    try:
        df.write.parquet(path)
        yield spark.read.parquet(path)
    finally:
        delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
