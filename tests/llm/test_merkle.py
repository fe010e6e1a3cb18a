"""The manifest against trees built row by row."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from arbolytics.llm import merkle as K

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def way(levels, at):
    out = []
    for nodes in levels[:-1]:
        run = [i for i in (at - at % 2, at - at % 2 + 1) if i < len(nodes)]
        out.append((at % 2, [nodes[i] for i in run if i != at]))
        at //= 2
    return out


def fold(x, path):
    for side, others in path:
        x = sha("".join(others + [x] if side else [x] + others))
    return x


def tampered(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0


def brute(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append(row)
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    made = {}
    for x in langs:
        trees[x].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        made[x] = levels_of([leaf(r) for r in trees[x]])
    top = levels_of([made[x][-1][0] for x in langs])
    root, out = top[-1][0], []
    for k, x in enumerate(langs):
        for i, row in enumerate(trees[x]):
            path = way(made[x], i) + way(top, k)
            changed = tampered(row[0]) and row[3] is not None
            start = leaf((*row[:3], row[3] + 1, row[4])) if changed else leaf(row)
            folded = fold(start, path)
            out.append((row[0], leaf(row), made[x][-1][0], root, sha("".join(s for _, o in path for s in o)), folded, folded == root))
    return sorted(out, key=repr)


def query(df):
    from arbolytics.llm.queries import manifest_rows

    return manifest_rows(df)


def result(df):
    return sorted(map(tuple, query(df).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=repr)


@pytest.mark.parametrize("block,group", [(1, 4), (2, 1000), (10, 50)])
def test_manifest(spark, monkeypatch, block, group):
    monkeypatch.setattr(K, "BLOCK_LEVELS", block)
    monkeypatch.setattr(K, "GROUP_NODES", group)
    pick = random.Random(block)
    rows = [(d, pick.choice(["s", None]), pick.choice(["en", "en", "en", "de", None, "é", "Z", "", "x"]), pick.choice([None, d, 10 ** d % 999]),
             pick.choice([None, "", "text é " * d])) for d in range(60)]
    rows += [(None, "s", "en", 1, "x"), (7, "s", "en", 1, "x"), (7, "s", "en", 1, "x"), (7, "s", "en", 1, "y"), (99, None, "lone", None, None)]
    assert result(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 9])
def test_one_tree(spark, monkeypatch, n):
    monkeypatch.setattr(K, "BLOCK_LEVELS", 1)
    rows = [(d, "s", "en", 2 ** 62, str(d)) for d in range(n)]
    assert result(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_many_trees(spark, monkeypatch):
    monkeypatch.setattr(K, "BLOCK_LEVELS", 2)
    rows = [(d, "s", f"lang{d}", 1, "t") for d in range(40)]
    assert result(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_none_and_other_columns(spark):
    assert result(spark.createDataFrame([], SCHEMA)) == []
    rows = [(d, "s", "en", d, "t") for d in range(5)]
    df = spark.createDataFrame([(*r, 1, 2, "k", "g") for r in rows], SCHEMA + ", pos int, n int, key string, tree string")
    assert result(df) == brute(rows)


def test_versions_share_untouched_nodes(spark, monkeypatch):
    """A version is the base with the copied ancestors in place; each copy is the hash of its children in the version."""
    monkeypatch.setattr(K, "BLOCK_LEVELS", 2)
    rows = [(d, "s", "en" if d % 3 else "de", d, "t") for d in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    manifest = K.build_manifest(df, COLUMNS, changed={"n_chars": F.col("n_chars") + 1}, when=F.col("doc_id") % 4 == 0)
    base = {(r.tree, r.level, r.pos): r.digest for r in K.tree_nodes(manifest).collect()}
    found = K.versions(manifest, with_copies=True).collect()
    assert sum(1 for r in found if r.copies is None) == sum(1 for d in range(30) if d % 4)
    for r in found:
        height = max(h for t, h, _ in base if t == r.tree)
        assert base[r.tree, height, 0] == r.subroot
        if r.copies is None:
            assert r.folded_root == r.root
            continue
        version = dict(base)
        version[r.tree, 0, r.pos] = leaf((r.key.id, "s", r.tree[1:], r.key.id + 1, "t"))
        for h in range(height):
            at = r.pos >> h + 1
            children = [version[r.tree, h, i] for i in (2 * at, 2 * at + 1) if (r.tree, h, i) in version]
            version[r.tree, h + 1, at] = r.copies[h]
            assert sha("".join(children)) == r.copies[h] != base[r.tree, h + 1, at]
        assert len(r.copies) == height + 1 and r.copies[-1] == r.folded_root != r.root
