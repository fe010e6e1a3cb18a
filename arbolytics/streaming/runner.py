"""Starting stream queries and reading what they wrote."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from arbolytics.operators.quality import split_rejects
from arbolytics.sinks.messages import document_writer, table_writer
from arbolytics.streaming.aggregates import garden_counts, species_averages, window_averages, with_lateness


def start(stream: DataFrame, name: str, checkpoint: str, writer: Callable[[DataFrame, int], None],
          mode: str = "update", available_now: bool = False, every: str | None = None) -> StreamingQuery:
    """A named query with its own checkpoint, so that it resumes after a restart."""
    query = (stream.writeStream.queryName(name).outputMode(mode)
             .option("checkpointLocation", f"{checkpoint}/{name}").foreachBatch(writer))
    if available_now:
        query = query.trigger(availableNow=True)
    elif every:
        query = query.trigger(processingTime=every)
    return query.start()


def start_append(stream: DataFrame, name: str, checkpoint: str, folder: str,
                 available_now: bool = False) -> StreamingQuery:
    """Closed windows only, written once to a Parquet table."""
    query = (stream.writeStream.queryName(name).outputMode("append").format("parquet")
             .option("checkpointLocation", f"{checkpoint}/{name}").option("path", folder))
    if available_now:
        query = query.trigger(availableNow=True)
    return query.start()


def run_to_end(query: StreamingQuery) -> None:
    query.awaitTermination()


def start_analytics(readings: DataFrame, folder: str, checkpoint: str,
                    available_now: bool = False) -> list[StreamingQuery]:
    """The live dashboard feeds: both average queries and the garden counts.

    The queries start independently; none waits for another to end. If the readings come from
    ``parse_checked``, messages without a readable body or time make a fourth feed, ``rejects``.
    """
    rejected = None
    if "is_bad" in readings.columns:
        readings, rejected = split_rejects(readings)
    late = with_lateness(readings)
    plans = {"window_averages": window_averages(late), "species_averages": species_averages(late),
             "garden_counts": garden_counts(late)}
    if rejected is not None:
        plans["rejects"] = rejected
    return [start(plan, name, checkpoint, document_writer(f"{folder}/{name}"),
                  available_now=available_now) for name, plan in plans.items()]


def latest_updates(spark: SparkSession, folder: str, schema: T.StructType,
                   keys: Sequence[str]) -> DataFrame:
    """The newest row per key of an update-mode table."""
    full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    rows = spark.read.schema(full).parquet(folder)
    values = [c for c in schema.fieldNames() if c not in keys]
    return (rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("v"))
            .select(*keys, *[F.col(f"v.`{c}`").alias(c) for c in values]))


def run_update(stream: DataFrame, name: str, folder: str, checkpoint: str,
               keys: Sequence[str]) -> DataFrame:
    """Run an update-mode query over what is available and read its result."""
    run_to_end(start(stream, name, checkpoint, table_writer(folder), available_now=True))
    return latest_updates(stream.sparkSession, folder, stream.schema, keys)


def run_append(stream: DataFrame, name: str, folder: str, checkpoint: str) -> DataFrame:
    """Run an append-mode query over what is available and read its result."""
    run_to_end(start_append(stream, name, checkpoint, folder, available_now=True))
    return stream.sparkSession.read.schema(stream.schema).parquet(folder)
