"""Fingerprints and their classes against brute force."""

import itertools
import random

import pytest
import xxhash

from arbolytics.llm import simhash as H

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fingerprint(text, length):
    ws = (text or "").translate(LOW).encode().split()
    runs = [b" ".join(ws[i:i + length]) for i in range(max(1, len(ws) - length + 1))] if ws else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(fps, distance):
    seen = list(range(len(fps)))

    def root(i):
        while seen[i] != i:
            i = seen[i]
        return i

    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= distance:
            seen[root(i)] = root(j)
    return [root(i) for i in range(len(fps))]


def brute_rows(rows, distance, length):
    fps = [brute_fingerprint(t, length) for _, t in rows]
    roots = brute_classes(fps, distance)
    out = []
    for (d, _), fp, r in zip(rows, fps, roots, strict=True):
        ids = [rows[j][0] for j, x in enumerate(roots) if x == r and rows[j][0] is not None]
        out.append((d, f"{fp:016x}", min(ids, default=None)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("length,distance", [(3, 2), (5, 3), (1, 0), (2, 1)])
def test_documents(docs, words, length, distance):
    pick, rows = random.Random(length), []
    for family in range(5):
        base = words(pick.randrange(3, 120), family)
        for _ in range(10):
            text = list(base)
            for _ in range(pick.randrange(3)):
                text[pick.randrange(len(text))] = f"New{pick.randrange(10)}"
            rows.append((pick.randrange(70), " ".join(text)))
    rows += [(100, None), (101, ""), (102, " \n\t"), (103, "One"), (None, "one"), (104, "É x é"), (3, rows[3][1]), (None, "alone here is one text")]
    got = H.near_duplicates(docs(rows), distance, length).collect()
    assert sorted(map(tuple, got), key=repr) == brute_rows(rows, distance, length)


def test_long_texts_are_hashed_in_slices(monkeypatch, words):
    text = "  ".join(words(500, 1)) + "\n"
    whole = H.fingerprint(text, 3)
    monkeypatch.setattr(H, "SLICE_BYTES", 50)
    assert H.fingerprint(text, 3) == whole
    assert whole & ((1 << 64) - 1) == brute_fingerprint(text, 3)
    assert H.fingerprint("x" * 300, 3) & ((1 << 64) - 1) == brute_fingerprint("x" * 300, 3)


@pytest.mark.parametrize("distance,segments,long_list", [(2, 2, 1000), (2, 2, 1), (2, 3, 4), (3, 2, 3), (1, 2, 2), (0, 2, 1), (4, 2, 1000)])
def test_links_of_fingerprints(spark, monkeypatch, distance, segments, long_list):
    """Both the tables and the half-way points find exactly the classes of all pairs."""
    monkeypatch.setattr(H, "LONG_LIST", long_list)
    pick, fps = random.Random(distance), set()
    for _ in range(6):
        base = pick.getrandbits(64)
        for _ in range(12):
            x = base
            for _ in range(pick.randrange(5)):
                x ^= 1 << pick.randrange(64)
            fps.add(x)
        fps |= {base ^ pick.getrandbits(32), base ^ pick.getrandbits(32) << 32}
    fps = sorted(fps | {0, (1 << 64) - 1, 1 << 63})
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    links = H.near_fingerprints(spark.createDataFrame([(x,) for x in signed], "fp long"), distance, segments).collect()
    at = {x: i for i, x in enumerate(signed)}
    for u, v in links:
        assert u != v and (fps[at[u]] ^ fps[at[v]]).bit_count() <= distance
    seen = list(range(len(fps)))

    def root(i):
        while seen[i] != i:
            i = seen[i]
        return i

    for u, v in links:
        seen[root(at[u])] = root(at[v])
    wanted, found = brute_classes(fps, distance), [root(i) for i in range(len(fps))]
    for i, j in itertools.combinations(range(len(fps)), 2):
        assert (wanted[i] == wanted[j]) == (found[i] == found[j])


def test_one_crowded_value(spark):
    """Thousands of fingerprints in one list give rows in proportion, not pairs."""
    fps = sorted({7 ^ (1 << a) ^ (1 << b) ^ (1 << c) for a in range(32) for b in range(32) for c in range(32)})
    links = H.near_fingerprints(spark.createDataFrame([(x,) for x in fps], "fp long"), 2, 2)
    assert links.count() < 80 * len(fps)


def test_none_and_clashing_columns(spark, docs):
    assert H.near_duplicates(docs([])).count() == 0
    df = spark.createDataFrame([(1, "a b c d", 5, 6, 7), (2, "a  b c D", 5, 6, 7)], "doc_id long, text string, fp int, key int, component_id int")
    got = H.near_duplicates(df, 2, 3)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(r.component_id for r in got.collect()) == [1, 1]
