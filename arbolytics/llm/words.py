"""Words of texts as 64-bit hashes, and hashes of runs of words, all vectorised.

Hashes are polynomials over a ring of 2^64 with random byte values, mixed at the end. Two
independent hashes of a run make collisions of different runs as good as impossible (96
bits or more); where one hash is used, its user says what a collision would do.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from arbolytics.llm.common import WORD_SPACES

CHUNK_BYTES = 1 << 20
BYTE_BASE, RUN_BASE, RUN_BASE_2 = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F
_SPACE = np.zeros(256, bool)
_SPACE[list(WORD_SPACES)] = True
_VALUES = np.random.default_rng(20_240_101).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _VALUES.copy()
_FOLDED[65:91] = _VALUES[97:123]  # A-Z as a-z


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over all bits (a bijection)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Powers:
    """Powers of an odd base and of its inverse, grown as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(0, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            self.up, self.down = self._powers(self.base, size), self._powers(self.inverse, size)
        return self.up[:n], self.down[:n]

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)


_BYTES, _RUNS, _RUNS_2 = Powers(BYTE_BASE), Powers(RUN_BASE), Powers(RUN_BASE_2)


@dataclass
class Words:
    """Word hashes of consecutive documents: those of document d are hashes[cuts[d]:cuts[d + 1]]."""

    hashes: np.ndarray
    cuts: np.ndarray

    def room(self) -> np.ndarray:
        """For each word, the words from it to its document's end."""
        return np.repeat(self.cuts[1:], np.diff(self.cuts)) - np.arange(len(self.hashes))

    def runs(self, length: int, second: bool = False) -> np.ndarray:
        """Hash of the run of ``length`` words at each position; of use only where ``room`` is enough."""
        n = len(self.hashes)
        if n < length:
            return np.zeros(n, np.uint64)
        up, down = (_RUNS_2 if second else _RUNS)(n)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.hashes * up, dtype=np.uint64)])
        out = np.zeros(n, np.uint64)
        out[:n - length + 1] = mix((total[length:] - total[:n - length + 1]) * down[:n - length + 1] + np.uint64(length))
        return out


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text array without nulls, and the offsets of its texts."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    cuts = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    raw = np.frombuffer(data, np.uint8)[cuts[0]:cuts[-1]] if data is not None and len(texts) else np.empty(0, np.uint8)
    return raw, cuts - cuts[0]


def word_hashes(texts: pa.Array | pa.ChunkedArray, fold: bool = False) -> Words:
    """The words (runs of bytes other than ASCII white space) of each text; null has none.

    With ``fold`` A-Z count as a-z. Works on about a megabyte at a time, so the wide
    temporary arrays stay small however large the batch is; a longer text is one piece.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
    raw, cuts = _bytes_of(texts.fill_null(""))
    found, counts, at = [], [], 0
    while at < len(cuts) - 1:
        end = max(at + 1, int(np.searchsorted(cuts, cuts[at] + CHUNK_BYTES, "right")) - 1)
        part = raw[cuts[at]:cuts[end]]
        hashes, words = _hash_piece(part, cuts[at:end + 1] - cuts[at], _FOLDED if fold else _VALUES)
        found.append(hashes)
        counts.append(words)
        at = end
    counted = np.concatenate([[0], *counts]).astype(np.int64)
    return Words(np.concatenate(found) if found else np.empty(0, np.uint64), np.cumsum(counted))


def _hash_piece(part: np.ndarray, cuts: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(part)
    if not n:
        return np.empty(0, np.uint64), np.zeros(len(cuts) - 1, np.int64)
    solid = ~_SPACE[part]
    edge = np.zeros(n + 1, bool)
    edge[cuts] = True
    before = np.concatenate([[False], solid[:-1]])
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.concatenate([solid[1:], [False]])
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    up, down = _BYTES(n)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values[part] * up, dtype=np.uint64)])
    hashes = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.diff(np.searchsorted(starts, cuts))


def document_slices(words: Words, most_words: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Document ranges of about ``most_words`` words (one document at least)."""
    at, last = 0, len(words.cuts) - 1
    while at < last:
        end = max(at + 1, int(np.searchsorted(words.cuts, words.cuts[at] + most_words, "right")) - 1)
        yield at, min(end, last)
        at = min(end, last)
