"""Stream sources. All give the same envelope: binary ``key`` and ``value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from arbolytics.functions.scalars import message_key


def kafka_source(spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Readings from a Kafka topic; needs the Kafka connector on the class path."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load()


def file_source(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, archive: str | None = None,
                options: dict[str, str] | None = None) -> DataFrame:
    """Files as a stream; every file is taken once per checkpoint.

    With ``archive`` consumed files are moved there by Spark.
    """
    reader = spark.readStream.format(fmt).schema(schema).options(**(options or {}))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(path)


def envelope(readings: DataFrame, device: str = "device_id", time: str = "timestamp") -> DataFrame:
    """Readings as messages: key ``device_time``, value the row as JSON."""
    return readings.select(
        message_key(F.col(device), F.col(time)).cast("binary").alias("key"),
        F.to_json(F.struct(*readings.columns)).cast("binary").alias("value"))
