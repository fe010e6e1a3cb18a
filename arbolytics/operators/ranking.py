"""Top-k, random picks and row numbers without a single-task sort."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from arbolytics.session import stage


def count_per(df: DataFrame, *keys: str, name: str = "number") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def top_k(df: DataFrame, by: str, k: int, *ties: str) -> DataFrame:
    """The k greatest rows; ``ties`` make the choice unique."""
    return df.orderBy(F.col(by).desc(), *[F.col(t).asc() for t in ties]).limit(k)


def bottom_k(df: DataFrame, by: str, k: int, *ties: str) -> DataFrame:
    return df.orderBy(F.col(by).asc(), *[F.col(t).asc() for t in ties]).limit(k)


def shuffle_key(key: str, seed: int) -> Column:
    """A repeatable pseudo-random sort key."""
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))


def random_k(df: DataFrame, key: str, k: int, seed: int) -> DataFrame:
    """k rows picked by a hash of their key: random, yet the same on a retry."""
    return df.orderBy(shuffle_key(key, seed), F.col(key)).limit(k)


def number_rows(df: DataFrame, order: Sequence[Column], name: str = "row_index") -> DataFrame:
    """0-based position in the given order, computed in parallel.

    A range shuffle sorts the rows, the staged copy fixes their place, and the
    counts of the sorted pieces (one row per piece) give each its offset.
    """
    pieces = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = stage(pieces, "numbered").withColumn("_piece", F.shiftright("_at", 33))
    # monotonically_increasing_id holds the piece number above bit 33.
    in_piece = F.col("_at") - F.shiftleft(F.col("_piece"), 33)
    before = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_piece").agg(F.count(F.lit(1)).alias("_n")).select(
        "_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    # One row per sorted piece, so the broadcast is bounded by the shuffle partitions.
    return (placed.join(F.broadcast(offsets), "_piece")
            .withColumn(name, F.col("_offset") + in_piece)
            .drop("_piece", "_at", "_offset"))


def number_weighted(df: DataFrame, order: Mapping[str, Column], group: Sequence[str], weight: str, name: str) -> DataFrame:
    """Rows that take ``weight`` numbers each: the first of them in the given order, and ``several``, whether the row shares its group.

    ``group`` names the leading parts of the order. Equal groups stay in one piece, so their rows are neighbours in it.
    """
    made = {n: c for n, c in order.items() if n not in df.columns}
    pieces = df.repartitionByRange(*[order[g] for g in group]).withColumns(made).sortWithinPartitions(*order).drop(*made)
    placed = stage(pieces.withColumn("_at", F.monotonically_increasing_id()), "numbered").withColumn("_piece", F.shiftright("_at", 33))
    in_piece = Window.partitionBy("_piece").orderBy("_at")
    numbers, same = F.struct(*[order[g] for g in group]), F.lit(False)
    for neighbour in (F.lag(numbers), F.lead(numbers)):
        same = same | F.coalesce(neighbour.over(in_piece).eqNullSafe(numbers), F.lit(False))
    so_far = F.coalesce(F.sum(weight).over(in_piece.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_piece").agg(F.sum(weight).alias("_n")).select(
        "_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    # One row per sorted piece, as in number_rows.
    return (placed.select("*", so_far.alias("_before"), same.alias("several")).join(F.broadcast(offsets), "_piece")
            .withColumn(name, F.col("_offset") + F.col("_before")).drop("_piece", "_at", "_offset", "_before"))
