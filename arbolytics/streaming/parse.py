"""Messages to readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from arbolytics.functions.scalars import parse_reading_time
from arbolytics.operators.quality import parse_with_rejects
from arbolytics.sources.schemas import READING


def parse_readings(messages: DataFrame, schema: T.StructType = READING) -> DataFrame:
    """Binary JSON to columns plus ``event_time``; what does not fit is null."""
    return (messages.select(F.from_json(F.col("value").cast("string"), schema).alias("value"))
            .select("value.*")
            .withColumn("event_time", parse_reading_time(F.col("timestamp"))))


def parse_checked(messages: DataFrame, schema: T.StructType = READING) -> DataFrame:
    """As above, and marks rows with bad JSON or without a readable time (``is_bad``)."""
    no_time = parse_reading_time(F.col("timestamp")).isNull()
    return parse_with_rejects(messages, schema, reject_when=no_time).withColumn(
        "event_time", parse_reading_time(F.col("timestamp")))
