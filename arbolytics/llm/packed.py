"""Sorted hashes as compressed blobs: what a group of documents sends to a bucket of hashes.

A group (some megabytes of documents) sends each of its distinct hashes once, to the bucket
that the hash's leading bits name. A hash that a third of all documents share so reaches its bucket
once from each group, not once from each document, and the blobs are several times smaller than rows.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard

BLOBS = "bucket int, grp int, blob binary"
SCHEMA = pa.schema([("bucket", pa.int32()), ("grp", pa.int32()), ("blob", pa.binary())])


def pack(keys: np.ndarray, *columns: np.ndarray) -> bytes:
    """Ascending unsigned keys and columns beside them. Bytes of equal weight stand together."""
    steps = np.diff(keys, prepend=np.zeros(1, keys.dtype)).astype("<u8")
    out = [struct.pack("<QB", len(keys), len(columns))]
    for x in (steps, *columns):
        kind = x.dtype.newbyteorder("<").str.encode()
        planes = np.ascontiguousarray(x.astype(x.dtype.newbyteorder("<")).view(np.uint8).reshape(len(x), -1).T).tobytes()
        packed = zstandard.compress(planes, 1)
        out.append(struct.pack("<BQ", len(kind), len(packed)) + kind + packed)
    return b"".join(out)


def unpack(blob: bytes) -> list[np.ndarray]:
    """The keys (64 bit) and the columns."""
    n, columns = struct.unpack_from("<QB", blob)
    at, out = 9, []
    for _ in range(columns + 1):
        kind_len, size = struct.unpack_from("<BQ", blob, at)
        at += 9
        kind = np.dtype(blob[at:at + kind_len].decode())
        at += kind_len
        planes = np.frombuffer(zstandard.decompress(blob[at:at + size]) if n else b"", np.uint8).reshape(kind.itemsize, n)
        at += size
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
    out[0] = np.cumsum(out[0], dtype=np.uint64)
    return out


def send(group: int, buckets: int, keys: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """Rows (bucket, group, blob) of ascending 64-bit keys; empty buckets get none."""
    bounds = np.array([-(-(b << 64) // buckets) for b in range(1, buckets)], np.uint64)
    cuts = [0, *np.searchsorted(keys, bounds).tolist(), len(keys)]
    for b in range(buckets):
        if cuts[b] < cuts[b + 1]:
            part = slice(cuts[b], cuts[b + 1])
            yield b, group, pack(keys[part], *(c[part] for c in columns))


def to_table(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    buckets, groups, blobs = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.table({"bucket": pa.array(buckets, pa.int32()), "grp": pa.array(groups, pa.int32()), "blob": pa.array(blobs, pa.binary())},
                    schema=SCHEMA)


def gather(groups: list[int], blobs: list[bytes]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """All entries of a bucket in key order: keys, columns, and the group of each entry."""
    found = [unpack(b) for b in blobs]
    if not found:
        return np.empty(0, np.uint64), [], np.empty(0, np.int32)
    owner = np.repeat(np.array(groups, np.int32), [len(x[0]) for x in found])
    keys, *columns = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(keys, kind="stable")
    return keys[order], [c[order] for c in columns], owner[order]


def answer(owner: np.ndarray, wanted: np.ndarray, keys: np.ndarray, *columns: np.ndarray) -> list[tuple[int, int, bytes]]:
    """Rows (-1, group, blob) that send the wanted entries back to their groups; keys stay ascending."""
    at = np.flatnonzero(wanted)
    if not len(at):
        return []
    at = at[np.argsort(owner[at], kind="stable")]
    groups, firsts = np.unique(owner[at], return_index=True)
    return [(-1, int(g), pack(keys[part], *(c[part] for c in columns)))
            for g, part in zip(groups, np.split(at, firsts[1:]), strict=True)]


def merge(blobs: list[bytes]) -> list[np.ndarray]:
    """Entries that all buckets sent back to a group, in key order."""
    found = [unpack(b) for b in blobs]
    if not found:
        return [np.empty(0, np.uint64)]
    out = [np.concatenate(x) for x in zip(*found, strict=True)]
    order = np.argsort(out[0], kind="stable")
    return [x[order] for x in out]


def positions(wanted: np.ndarray, known: np.ndarray) -> np.ndarray:
    """For each wanted key its place in the ascending known keys, or -1."""
    if not len(known):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return np.where(known[at] == wanted, at, -1)
