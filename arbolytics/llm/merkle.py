"""Merkle manifest of a table: a hash tree over its rows, proofs, and versions by path copying.

Each row is a leaf. The leaves of one partition value (say a language) form a tree in the order of their ids: nodes are
hashed in consecutive runs of two, level by level, the last run alone if need be. The roots of these trees form one more
tree, whose root stands for the whole table.

Trees are cut into aligned blocks of ``2 ** BLOCK_LEVELS`` nodes. A round hashes every block by itself, so that a level of
block roots is left, and goes on with these: as many rounds as the logarithm of the greatest tree to the
base of a block. Blocks are dealt to tasks many at a time, whatever tree they are of, so neither one
great tree nor very many small ones meet in a task.

The tree is persistent. A changed leaf makes a version that shares every untouched node of the base and copies the leaf's
ancestors only: those within its block where the block is, and those above along the siblings that the rounds
above hand down to the block. Versions stay spread over the tasks of their leaves up to the root.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from arbolytics.session import stage

BLOCK_LEVELS = 10
#: Nodes in a group of blocks, on average.
GROUP_NODES = 1 << 16
NODES = "tree string, pos long, n long, digest string"
TOPS = "tree string, pos long, path array<string>, subroot string"


def digest(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(*values: Column) -> Column:
    """sha256 of the values in order: ``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    def written(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(written, values)), 256)


def tree_name(value: Column) -> Column:
    """A name for any partition value that is never null and sorts null first, then by bytes."""
    return F.coalesce(F.concat(F.lit("1"), value.cast("string")), F.lit("0"))


def placed_leaves(leaves: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Staged leaves (``tree``, ``digest`` and others) with ``pos`` in their tree and the tree's size ``n``.

    A range shuffle sorts the leaves; the counts of a tree in each sorted piece give the offsets. Rows of equal
    order and digest are interchangeable and may be dealt to several pieces.
    """
    keys = [F.col("tree"), *order, F.col("digest"), F.col("_salt")]
    pieces = (leaves.withColumn("_salt", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
              .drop("_salt").withColumn("_at", F.monotonically_increasing_id()))
    sorted_leaves = stage(pieces, "merkle-sorted").withColumn("_piece", F.shiftright("_at", 33))
    before = Window.partitionBy("tree").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    runs = stage(sorted_leaves.groupBy("tree", "_piece").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
                 .select("tree", "_piece", (F.col("_first") - F.coalesce(F.sum("_n").over(before), F.lit(0))).alias("_zero"),
                         F.sum("_n").over(Window.partitionBy("tree")).alias("n")), "merkle-runs")
    placed = sorted_leaves.join(runs, ["tree", "_piece"]).withColumn("pos", F.col("_at") - F.col("_zero"))
    return stage(placed.drop("_piece", "_at", "_zero"), "merkle-leaves")


def tree_levels(n: int) -> int:
    """Levels above the nodes of a tree of n."""
    return max(n - 1, 0).bit_length()


def block_nodes(leaves: list[str], levels: int) -> list[list[str]]:
    """The levels of a block, its own nodes first."""
    out = [leaves]
    for _ in range(levels):
        below = out[-1]
        out.append([digest(below[i:i + 2]) for i in range(0, len(below), 2)])
    return out


def siblings(levels: list[list[str]], at: int) -> list[str]:
    """For each level of a block the sibling of node ``at``'s ancestor, with its side (L or R); empty if it has none."""
    out = []
    for nodes in levels[:-1]:
        other = at ^ 1
        out.append(("R" if other > at else "L") + nodes[other] if other < len(nodes) else "")
        at >>= 1
    return out


def copied_path(leaf: str, path: list[str]) -> list[str]:
    """The digests of a leaf's ancestors, from the lowest to the root."""
    out = []
    for other in path:
        leaf = digest((other[1:], leaf) if other[:1] == "L" else (leaf, other[1:]))
        out.append(leaf)
    return out


def _blocks(table: pa.Table) -> Iterator[tuple[str, int, int, list[dict]]]:
    """tree, block, levels within the block, and the block's rows in order."""
    rows = sorted(table.to_pylist(), key=lambda r: (r["tree"], r["pos"]))
    for (tree, block), members in groupby(rows, key=lambda r: (r["tree"], r["pos"] >> BLOCK_LEVELS)):
        found = list(members)
        yield tree, block, min(BLOCK_LEVELS, tree_levels(found[0]["n"])), found


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_NODES = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("digest", pa.string())])
_TOPS = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("path", pa.list_(pa.string())), ("subroot", pa.string())])


def _roots(table: pa.Table) -> pa.Table:
    return _table([(tree, block, -(-rows[0]["n"] >> BLOCK_LEVELS) if rows[0]["n"] > 1 << BLOCK_LEVELS else 1,
                    block_nodes([r["digest"] for r in rows], levels)[-1][0]) for tree, block, levels, rows in _blocks(table)], _NODES)


def _paths(nodes: pa.Table, tops: pa.Table) -> pa.Table:
    above = {(t["tree"], t["pos"]): t for t in tops.to_pylist()}
    out = []
    for tree, block, levels, rows in _blocks(nodes):
        hashed, top = block_nodes([r["digest"] for r in rows], levels), above[tree, block]
        out += [(tree, r["pos"], siblings(hashed, i) + top["path"], top["subroot"]) for i, r in enumerate(rows)]
    return _table(out, _TOPS)


def in_groups(nodes: DataFrame, groups: int, shift: int = BLOCK_LEVELS) -> DataFrame:
    """With ``grp``: the group of a node's block, or of a block itself (``shift`` 0)."""
    return nodes.withColumn("grp", F.pmod(F.xxhash64("tree", F.shiftright("pos", shift)), F.lit(groups)))


def _groups(rows: int) -> int:
    return max(1, math.ceil(rows / GROUP_NODES))


def climb(nodes: DataFrame) -> list[tuple[DataFrame, int]]:
    """The staged levels of block roots, from the nodes to one root for each tree, with their numbers of rows."""
    out = []
    while True:
        rows, largest = nodes.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0))).first()
        out.append((nodes, rows))
        if largest <= 1:
            return out
        roots = in_groups(nodes.select("tree", "pos", "n", "digest"), _groups(rows)).groupBy("grp").applyInArrow(_roots, NODES)
        nodes = stage(roots, "merkle-roots")


def descend(levels: list[tuple[DataFrame, int]], tops: DataFrame) -> DataFrame:
    """For each block of the lowest of ``levels``: the siblings above it, given those above the tree roots."""
    for nodes, rows in levels[:0:-1]:
        groups = _groups(rows)
        tops = stage(in_groups(nodes.select("tree", "pos", "n", "digest"), groups).groupBy("grp").cogroup(
            in_groups(tops, groups, 0).groupBy("grp")).applyInArrow(_paths, TOPS), "merkle-paths")
    return tops


@dataclass
class Manifest:
    """A hash tree over a table: its staged leaves, the levels of block roots, and what stands above each block.

    ``leaves`` has ``key`` (a struct), ``tree``, ``pos``, ``n``, ``digest`` and ``changed``. ``root`` is None without rows.
    """

    leaves: DataFrame
    levels: list[tuple[DataFrame, int]]
    upper: list[tuple[DataFrame, int]]
    tops: DataFrame
    root: str | None


def build_manifest(df: DataFrame, columns: Sequence[str], tree_col: str = "lang", id_col: str = "doc_id",
                   changed: dict[str, Column] | None = None, when: Column | None = None) -> Manifest:
    """The manifest of a table. Leaves are digests of ``columns``, trees are the values of ``tree_col`` (null is one),
    their leaves ascend by ``id_col`` (null first, equal ids by digest; equal rows are leaves of their own).

    ``changed`` replaces columns where ``when`` holds: such rows carry the digest of their changed leaf as well,
    from which ``versions`` makes a version each. Other columns play no part and cannot clash; an empty table has no root.
    """
    col = lambda c: F.col(f"`{c}`")
    other = leaf_digest(*[(changed or {}).get(c, col(c)) for c in columns])
    leaves = df.select(F.struct(col(id_col).cast("long").alias("id")).alias("key"), tree_name(col(tree_col)).alias("tree"),
                       leaf_digest(*map(col, columns)).alias("digest"),
                       (F.when(when, other) if when is not None else F.lit(None).cast("string")).alias("changed"))
    placed = placed_leaves(leaves, [F.col("key.id").asc_nulls_first()])
    levels = climb(placed)
    names = levels[-1][0].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    subroots = placed_leaves(names, [F.col("name")])
    upper = climb(subroots)
    roots = upper[-1][0]
    above = descend(upper, roots.select("tree", "pos", F.array().cast("array<string>").alias("path"), F.col("digest").alias("subroot")))
    groups = _groups(upper[0][1])
    above = stage(in_groups(subroots, groups).groupBy("grp").cogroup(in_groups(above, groups, 0).groupBy("grp")).applyInArrow(_paths, TOPS),
                  "merkle-subroots") if len(upper) > 1 else above
    tops = (subroots.join(above.drop("tree", "subroot"), "pos")
            .select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("pos"), "path", F.col("digest").alias("subroot")))
    root = roots.first()  # one row
    return Manifest(placed, levels, upper, descend(levels, stage(tops, "merkle-tops")), root.digest if root else None)


VERSIONS = "key struct<id:long>, leaf string, subroot string, proof_sha256 string, folded_root string"
_VERSIONS = pa.schema([("key", pa.struct([("id", pa.int64())])), ("leaf", pa.string()), ("subroot", pa.string()),
                       ("proof_sha256", pa.string()), ("folded_root", pa.string())])


def versions(manifest: Manifest, with_copies: bool = False) -> DataFrame:
    """key, leaf, subroot, proof_sha256, folded_root and root of every leaf; with ``with_copies`` also tree, pos and ``copies``.

    The version of a leaf starts from its changed digest, or from its own if it has none. ``copies`` are the digests of the
    copied ancestors, the lowest first, the root last (null if the leaf is unchanged: nothing is copied); all other nodes of
    the version are those of the base. folded_root is the version's root. proof_sha256 is over the siblings on
    the way to the root, in that order.
    """
    schema = _VERSIONS
    if with_copies:
        for field in (pa.field("tree", pa.string()), pa.field("pos", pa.int64()), pa.field("copies", pa.list_(pa.string()))):
            schema = schema.append(field)

    def run(leaves: pa.Table, tops: pa.Table) -> pa.Table:
        above = {(t["tree"], t["pos"]): t for t in tops.to_pylist()}
        out = []
        for tree, block, levels, rows in _blocks(leaves):
            hashed, top = block_nodes([r["digest"] for r in rows], levels), above[tree, block]
            for i, r in enumerate(rows):
                path = siblings(hashed, i) + top["path"]
                start = r["digest"] if r["changed"] is None else r["changed"]
                copies = copied_path(start, path)
                row = (r["key"], r["digest"], top["subroot"], digest([x[1:] for x in path]), copies[-1] if copies else start)
                out.append(row + (tree, r["pos"], None if r["changed"] is None else copies) if with_copies else row)
        return _table(out, schema)

    groups = _groups(manifest.levels[0][1])
    found = in_groups(manifest.leaves, groups).groupBy("grp").cogroup(in_groups(manifest.tops, groups, 0).groupBy("grp")).applyInArrow(
        run, VERSIONS + (", tree string, pos long, copies array<string>" if with_copies else ""))
    return found.withColumn("root", F.lit(manifest.root).cast("string"))


def tree_nodes(manifest: Manifest) -> DataFrame:
    """tree, level (0: leaves), pos and digest of every node of the base, below and at the tree roots."""
    schema = pa.schema([("tree", pa.string()), ("level", pa.int32()), ("pos", pa.int64()), ("digest", pa.string())])

    def above(base: int):
        def run(table: pa.Table) -> pa.Table:
            return _table([(tree, base + h, (block << BLOCK_LEVELS >> h) + i, x) for tree, block, levels, found in _blocks(table)
                           for h, level in enumerate(block_nodes([r["digest"] for r in found], levels)) if h
                           for i, x in enumerate(level)], schema)

        return run

    out = manifest.leaves.select("tree", F.lit(0).alias("level"), "pos", "digest")
    for k, (nodes, rows) in enumerate(manifest.levels[:-1]):
        groups = in_groups(nodes.select("tree", "pos", "n", "digest"), _groups(rows)).groupBy("grp")
        out = out.union(groups.applyInArrow(above(k * BLOCK_LEVELS), "tree string, level int, pos long, digest string"))
    return out
