"""Nearest vectors by inner product, with collision counting over single projections.

Each projection puts all vectors of a block on a line, in a sorted array. A query opens a window around its own
place on every line; vectors in the window collide with it. Windows are widened step by
step (virtual rehashing: a wider bucket is a wider window of the same array), and vectors that
collide on enough lines are verified with their exact inner product, until enough are verified.

Inner products become distances by one more coordinate (vectors are lifted to the same length).
Vectors and queries are dealt to blocks; every query meets every block, in blocks, and the best
of each block are merged per query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from arbolytics.llm.common import bare, hash_group
from arbolytics.session import stage

#: Rows in a block of vectors and in a block of queries: both sides of a cell stay small at any size.
BLOCK_ROWS, QUERY_ROWS = 16_384, 2_048  # at most 65,535 rows and 255 lines
#: Blocks of any table, so that small ones are spread over tasks as well.
LEAST_BLOCKS = 16
PROJECTIONS, THRESHOLD = 96, 0.6
CELLS = 1024
#: Share of a block that a query verifies at least, besides k.
VERIFIED = 0.08
#: Window half widths, as shares of the spread of the projections.
WIDTHS = 0.25 * 1.25 ** np.arange(12)


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and vector (doubles) of rows with an id whose vector is neither null, empty nor zero, and has finite parts only."""
    rows = bare(df, vec_id=id_col, vector=vector_col).select(F.col("vec_id").cast("long"), F.col("vector").cast("array<double>"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).filter(finite & F.exists("vector", lambda x: x != 0))


class Lines:
    """The sorted projections of one block."""

    def __init__(self, vectors: np.ndarray, longest: float, seed: int = 7):
        self.vectors = vectors
        rest = np.sqrt(np.maximum(longest ** 2 - (vectors ** 2).sum(1), 0))
        lifted = np.column_stack([vectors, rest])
        self.axes = np.random.default_rng(seed).standard_normal((lifted.shape[1], PROJECTIONS))
        places = np.ascontiguousarray((lifted @ self.axes).T)
        order = np.argsort(places, axis=1)
        sorted_places = np.take_along_axis(places, order, 1)
        # A vector's place on each line: it is in a window when its place is between the window's ends.
        self.ranks = np.empty(order.shape, np.uint16)
        np.put_along_axis(self.ranks, order, np.arange(order.shape[1], dtype=np.uint16)[None], 1)
        # Ends of windows are found by cells of equal width: how many entries stand before each cell.
        self.start = places.min() - 1e-9
        self.scale = CELLS / (places.max() - self.start + 1e-9)
        edges = self.start + np.arange(CELLS + 1) / self.scale
        self.upto = np.stack([np.searchsorted(line, edges) for line in sorted_places])
        self.upto[:, -1] = order.shape[1]
        self.rows = np.arange(PROJECTIONS) * (CELLS + 1)
        self.longest, self.last = longest, len(WIDTHS) // 2

    def places(self, queries: np.ndarray) -> np.ndarray:
        """Places of the queries on all lines, in cells.

        A query is made as long as the longest vector, so distances and inner products have one order.
        """
        lifted = queries * (self.longest / np.linalg.norm(queries, axis=1))[:, None]
        return (lifted @ self.axes[:-1] - self.start) * self.scale

    def colliding(self, place: np.ndarray, width: int) -> np.ndarray:
        """Vectors that are in the query's window on enough lines."""
        half = WIDTHS[width] * self.longest * self.scale
        start = self.upto.take(self.rows + np.clip(place - half, 0, CELLS).astype(np.int64))
        end = self.upto.take(self.rows + np.clip(place + half, 0, CELLS).astype(np.int64))
        inside = (self.ranks - start.astype(np.uint16)[:, None]) < (end - start).astype(np.uint16)[:, None]
        return np.flatnonzero(inside.view(np.uint8).sum(0, dtype=np.uint8) >= THRESHOLD * PROJECTIONS)

    def candidates(self, place: np.ndarray, enough: int) -> np.ndarray:
        """Vectors that collide on enough lines, from the narrowest windows that give ``enough`` of them.

        The search over widths begins where it ended for the query before, which saves steps only.
        """
        at, found = self.last, self.colliding(place, self.last)
        if len(found) >= enough:
            while at and len(narrower := self.colliding(place, at - 1)) >= enough:
                at, found = at - 1, narrower
        else:
            while len(found) < enough and at + 1 < len(WIDTHS):
                at, found = at + 1, self.colliding(place, at + 1)
        self.last = at
        return found if len(found) >= enough else np.arange(self.ranks.shape[1])


def search(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int,
           longest: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the queries, vector ids and scores of the best k of a block for each query; rows with the query's own id are left out."""
    lines = Lines(vectors, longest)
    enough = k + 1 + int(VERIFIED * len(ids))
    places = lines.places(queries)
    out = []
    for i, (q, query) in enumerate(zip(query_ids, queries, strict=True)):
        found = lines.candidates(places[i], enough) if len(ids) > enough else np.arange(len(ids))
        found = found[ids[found] != q]
        scores = vectors[found] @ query
        if len(found) > 4 * k:  # ties with the k-th stay in
            best = scores >= np.partition(scores, -k)[-k]
            found, scores = found[best], scores[best]
        best = np.lexsort((ids[found], -scores))[:k]
        out.append((np.full(len(best), i), ids[found[best]], scores[best]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the ``k`` nearest found for each query, by inner product.

    Rows without an id, and null, empty or zero vectors or such with null or non-finite parts take no part.
    A query is not its own neighbour: rows with its id are left out. Rows of different dimension do not
    meet. Ties go to the smaller id; rows that repeat an id stay rows of their own. With fewer candidates
    than ``k`` all are returned. Each query row has its own result, also if it repeats an id. Extra columns are left out; an empty table gives no rows.
    """
    rows = usable(vectors, id_col, vector_col)
    asked = stage(usable(queries, id_col, vector_col).withColumn("query_row", F.monotonically_increasing_id()), "neighbour-queries")
    width = F.size("vector").alias("dim")
    n = rows.count()
    blocks, chunks = max(LEAST_BLOCKS, -(-n // BLOCK_ROWS)), max(1, -(-asked.count() // QUERY_ROWS))
    longest = rows.agg(F.max(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))).first()[0]
    longest = float(np.sqrt(longest)) if longest else 1.0
    cell = [F.col("dim"), F.col("block"), F.col("chunk")]
    left = rows.select("vec_id", "vector", width, hash_group(F.xxhash64("vec_id", "vector"), blocks).alias("block"),
                       F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
    right = asked.select("vec_id", "query_row", "vector", width, hash_group(F.xxhash64("vec_id", "vector"), chunks).alias("chunk"),
                         F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    schema = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(found: pa.Table, asking: pa.Table) -> pa.Table:
        if not found.num_rows or not asking.num_rows:
            return schema.empty_table()
        asked_ids, asked_rows = (asking.column(c).to_numpy() for c in ("vec_id", "query_row"))
        at, *hits = search(_matrix(found.column("vector")), found.column("vec_id").to_numpy(), _matrix(asking.column("vector")),
                           asked_ids, k, longest)
        return pa.table([asked_rows[at], asked_ids[at], *hits], schema=schema)

    found = stage(left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(
        run, "query_row long, query_id long, vec_id long, score double"), "neighbours")
    # At most k rows per query and block.
    place = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
