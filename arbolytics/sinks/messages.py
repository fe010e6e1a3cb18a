"""Message and document sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from arbolytics.sources.streams import envelope


def write_kafka(readings: DataFrame, servers: str, topic: str) -> None:
    """Publish readings; needs the Kafka connector on the class path."""
    (envelope(readings).write.format("kafka").option("kafka.bootstrap.servers", servers)
     .option("topic", topic).save())


def documents(df: DataFrame) -> DataFrame:
    """Each row as one JSON document."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("document"))


def document_writer(folder: str) -> Callable[[DataFrame, int], None]:
    """Per-batch writer of JSON lines, run by the executors.

    A batch that is replayed overwrites its own folder, so nothing is doubled.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        (documents(batch).write.mode("overwrite").text(f"{folder}/batch_id={batch_id}"))

    return write


def table_writer(folder: str) -> Callable[[DataFrame, int], None]:
    """Per-batch Parquet writer with the same overwrite rule."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")

    return write


def console(stream: DataFrame, mode: str = "update") -> DataStreamWriter:
    return stream.writeStream.outputMode(mode).format("console")
