"""Stream sources: frames with ``value`` (JSON) and ``timestamp``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.settings import StreamSettings


def kafka_source(spark: SparkSession, servers: str, topic: str,
                 settings: StreamSettings = StreamSettings(),
                 starting_offsets: str = "latest") -> DataFrame:
    """A Kafka topic. Needs the Spark Kafka package on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", "false")
    )
    if settings.max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", settings.max_offsets_per_trigger)
    return reader.load()


def json_lines_source(spark: SparkSession, path: str,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Files with one JSON document per line, in the shape of the Kafka source."""
    reader = spark.readStream.format("text").schema("value STRING")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select(
        F.col("value").cast("binary").alias("value"), F.current_timestamp().alias("timestamp")
    )
