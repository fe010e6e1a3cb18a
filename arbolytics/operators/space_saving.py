"""Heavy hitters in bounded memory: summaries of a fixed number of counters that can be merged.

A summary tracks at most ``capacity`` keys. For a tracked key ``count - error <= true count <= count``; a key that is not
tracked has at most ``floor`` rows, which is the same on all rows of the summary. With N rows counted
``floor <= N / (capacity + 1)``, so every key with more rows than that is tracked. This holds for merged summaries
as well, however the rows were dealt: whenever the least counters are evicted, all that were kept are above the floor
by what the evicted ones can make up for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

#: Keys that a summary tracks.
CAPACITY = 1000


def _kept(rows: DataFrame, key: str, capacity: int, floor: Column) -> DataFrame:
    """The ``capacity`` greatest counters; the greatest evicted one is the new floor."""
    best = rows.orderBy(F.col("count").desc(), F.col(key).asc_nulls_last()).limit(capacity + 1)
    # No more than capacity + 1 rows are left for these windows.
    ranked = best.withColumn("_rank", F.row_number().over(Window.orderBy(F.col("count").desc(), F.col(key).asc_nulls_last())))
    evicted = F.max(F.when(F.col("_rank") > capacity, F.col("count"))).over(Window.partitionBy())
    return (ranked.withColumn("floor", F.coalesce(evicted, floor).cast("long")).filter(F.col("_rank") <= capacity)
            .select(key, "count", "error", "floor"))


def summary_of(df: DataFrame, key: str, capacity: int = CAPACITY) -> DataFrame:
    """key, count, error and floor of the most frequent keys of a table. Null is a key; no rows give an empty summary."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("count")).withColumn("error", F.lit(0).cast("long"))
    return _kept(counts, key, capacity, F.lit(0))


def merged(rows: DataFrame, key: str, part: str, capacity: int = CAPACITY) -> DataFrame:
    """The summary of all rows that the summaries in ``rows`` (told apart by ``part``) stand for.

    A key that a summary does not track counts there with its floor, as count and as error.
    """
    floors = rows.groupBy(part).agg(F.max("floor").alias("floor")).agg(F.coalesce(F.sum("floor"), F.lit(0))).scalar()
    missing = floors - F.sum("floor")
    both = rows.groupBy(key).agg((F.sum("count") + missing).alias("count"), (F.sum("error") + missing).alias("error"))
    return _kept(both, key, capacity, floors)


def bounds(keys: DataFrame, summary: DataFrame, key: str) -> DataFrame:
    """key, tracked, and the least and the greatest true count that the summary allows for each of the keys."""
    floor = F.coalesce(summary.agg(F.max("floor")).scalar(), F.lit(0))
    # The summary has a bounded number of rows.
    side = F.broadcast(summary.select(F.col(key).alias("_key"), "count", "error"))
    found = keys.join(side, F.col(key).eqNullSafe(F.col("_key")), "left")
    tracked = F.col("count").isNotNull()
    return found.select(key, tracked.alias("tracked"), F.when(tracked, F.col("count") - F.col("error")).otherwise(0).alias("at_least"),
                        F.when(tracked, F.col("count")).otherwise(floor).alias("at_most"))
