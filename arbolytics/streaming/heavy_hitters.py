"""Most active gardens of a stream: exact totals, bounded summaries, sketches, and the top k of each batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from arbolytics.operators import sketches
from arbolytics.operators.ranking import count_per, top_k
from arbolytics.operators.sketches import DEPTH, TOP_K, WIDTH, bucket
from arbolytics.operators.space_saving import CAPACITY, merged, summary_of
from arbolytics.session import remove_folder
from arbolytics.sinks.messages import documents


def running_totals(readings: DataFrame, key: str = "garden_id") -> DataFrame:
    """Readings per garden since the start. One state row per garden."""
    return readings.groupBy(key).agg(F.count(F.lit(1)).alias("count"))


def running_sketch(readings: DataFrame, key: str = "garden_id", width: int = WIDTH,
                   depth: int = DEPTH) -> DataFrame:
    """The count-min sketch as streaming state: at most ``width * depth`` rows for any number of keys."""
    rows = F.explode(F.sequence(F.lit(0), F.lit(depth - 1))).alias("row")
    return (readings.select(key, rows).withColumn("bucket", bucket(F.col("row"), F.col(key), width))
            .groupBy("row", "bucket").agg(F.count(F.lit(1)).alias("cell")))


def top_k_writer(folder: str, k: int = TOP_K, key: str = "garden_id") -> Callable[[DataFrame, int], None]:
    """Per-batch writer of the k most frequent gardens as documents ``{garden_id, count}``.

    For a query in complete mode, whose batches hold all totals. A replayed
    batch overwrites its own folder.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        best = top_k(batch, "count", k, key).select(key, "count")
        documents(best).write.mode("overwrite").text(f"{folder}/batch_id={batch_id}")

    return write


def batch_folders(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the batches that have a finished table below a folder, in order."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/batch_id=*/_SUCCESS")) or []
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)


def state_writer(folder: str, step: Callable[[DataFrame, DataFrame | None], DataFrame],
                 after: Callable[[DataFrame, int], None] | None = None) -> Callable[[DataFrame, int], None]:
    """Per-batch writer that keeps a small table as state: ``step`` makes it of a batch and the state before it.

    The state of a batch has a folder of its own, and the one before it stays, so a replayed batch starts from what it started
    from the first time. Older ones are removed; what is kept does not grow with the stream.
    ``after`` gets the written state.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = [n for n in batch_folders(spark, folder) if n < batch_id]
        before = spark.read.parquet(f"{folder}/batch_id={earlier[-1]}") if earlier else None
        path = f"{folder}/batch_id={batch_id}"
        step(batch, before).write.mode("overwrite").parquet(path)
        if after:
            after(spark.read.parquet(path), batch_id)
        for n in earlier[:-1]:
            remove_folder(spark, f"{folder}/batch_id={n}")

    return write


def newest_state(spark: SparkSession, folder: str) -> DataFrame:
    """The state after the last finished batch."""
    return spark.read.parquet(f"{folder}/batch_id={batch_folders(spark, folder)[-1]}")


def bounded_hitters_writer(state: str, folder: str, k: int = TOP_K, key: str = "garden_id",
                           capacity: int = CAPACITY) -> Callable[[DataFrame, int], None]:
    """The most frequent gardens since the start from at most ``capacity`` counters, for a stream of readings in append mode.

    Each batch is summed up by itself and merged with the summary before it; the least counters are evicted. Documents
    ``{garden_id, count, error}`` of the k greatest go to a folder per batch.
    """
    def step(batch: DataFrame, before: DataFrame | None) -> DataFrame:
        now = summary_of(batch, key, capacity)
        if before is None:
            return now
        return merged(now.withColumn("part", F.lit(1)).union(before.select(key, "count", "error", "floor", F.lit(0))), key, "part", capacity)

    def publish(summary: DataFrame, batch_id: int) -> None:
        best = top_k(summary, "count", k, key).select(key, "count", "error")
        documents(best).write.mode("overwrite").text(f"{folder}/batch_id={batch_id}")

    return state_writer(state, step, publish)


def sketch_writer(state: str, key: str = "garden_id", width: int = WIDTH, depth: int = DEPTH) -> Callable[[DataFrame, int], None]:
    """The binary sketch of all readings since the start, merged batch by batch; one row of a fixed size."""
    def step(batch: DataFrame, before: DataFrame | None) -> DataFrame:
        now = sketches.binary_sketch(count_per(batch, key), key, width=width, depth=depth)
        return now if before is None else sketches.merged_sketch(now.union(before), width, depth)

    return state_writer(state, step)
