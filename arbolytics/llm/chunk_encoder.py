"""Encodes texts chunk by chunk, each distinct chunk once.

Tokenizers never join what white space parts, so a text's ids are those of its chunks in
order. Words repeat, so few chunks are new in a batch: Arrow numbers the chunks of a batch,
the library encodes those not seen before, and numpy lays the ids out. The store of known
chunks is a cache of bounded size; it is emptied when full and changes no result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from arbolytics.llm.common import slices

Encode = Callable[[list[str]], list[list[int]]]
#: Chunks that the library gets as one text, as a call for each costs more than its work.
JOINED = 2_000
MOST_KNOWN = 200_000
SLICE_CHARS = 1_000_000
# Blanks before more white space or at the end: there a blank is no chunk's start.
# Unicode white space and the four separators that some libraries count as such.
WIDE_BLANK = r" ([\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|$)"


class ChunkEncoder:
    """``encode`` gives the ids of each of a list of texts.

    With ``leading_blank`` a chunk is a word with the blank before it (byte-level
    vocabularies); texts in which a blank may belong to a longer run of white space are then
    encoded whole. Without it, a chunk is what stands between ASCII white space (vocabularies
    that drop white space). ``widths`` has the number of bytes that each id stands for,
    ``written`` gives what a tokenizer makes of a chunk before it cuts it.
    """

    def __init__(self, encode: Encode, leading_blank: bool, widths: np.ndarray, written: Callable[[str], str] = str,
                 most_known: int = MOST_KNOWN, slice_chars: int = SLICE_CHARS):
        self.encode, self.leading_blank, self.widths, self.written = encode, leading_blank, widths, written
        self.most_known, self.slice_chars = most_known, slice_chars
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {"": 0}
        self.ids = np.zeros(1 << 16, np.int32)
        self.ends = [0, 0]  # chunk 0 is the empty one

    def _numbers(self, chunks: list[str]) -> np.ndarray:
        new = [c for c in dict.fromkeys(chunks) if c not in self.known]
        found = [ids for a in range(0, len(new), JOINED) for ids in self._joined(new[a:a + JOINED])]
        total = self.ends[-1] + sum(map(len, found))
        if total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(total, len(self.ids)), np.int32)])
        for chunk, ids in zip(new, found, strict=True):
            at = self.ends[-1]
            self.ids[at:at + len(ids)] = ids
            self.known[chunk] = len(self.ends) - 1
            self.ends.append(at + len(ids))
        return np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks))

    def _joined(self, chunks: list[str]) -> list[list[int]]:
        """The ids of chunks encoded as one text and cut by the bytes that the ids stand for.

        If a cut falls inside an id, the text was not written byte by byte, and each chunk is
        encoded by itself.
        """
        ids = self.encode([("" if self.leading_blank else " ").join(chunks)])[0]
        reached = np.cumsum(self.widths[ids])
        ends = np.cumsum([len(self.written(c).encode("utf-8", "surrogatepass")) for c in chunks])
        at = np.searchsorted(reached, ends)
        if not ids or reached[-1] != ends[-1] or (reached[at] != ends).any():
            return self.encode(chunks)
        return [ids[a:b] for a, b in zip([0, *(at[:-1] + 1).tolist()], (at + 1).tolist(), strict=True)]

    def __call__(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text, in order."""
        for a, b in slices(texts, self.slice_chars):
            yield from self._slice(texts[a:b])

    def _slice(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.known) > self.most_known:
            self._clear()
        column = pa.array(texts, pa.string())
        whole = {}
        if self.leading_blank:
            odd = [i for i, x in enumerate(pc.match_substring_regex(column, WIDE_BLANK).to_pylist()) if x]
            whole = dict(zip(odd, self.encode([texts[i] for i in odd]), strict=True)) if odd else {}
            words = pc.split_pattern(column, " ")
        else:
            words = pc.ascii_split_whitespace(column)
        offsets = words.offsets.to_numpy()
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        codes = coded.indices.to_numpy()
        if not self.leading_blank:
            numbers = self._numbers(distinct)[codes] if len(codes) else np.empty(0, np.int64)
        else:
            numbers = self._numbers([" " + w for w in distinct])[codes] if len(codes) else np.empty(0, np.int64)
            first = offsets[:-1][np.diff(offsets) > 0]
            numbers[first] = self._numbers([distinct[c] for c in codes[first]])
        ends = np.array(self.ends)
        starts, lengths = ends[:-1][numbers], np.diff(ends)[numbers]
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        flat = self.ids[np.repeat(starts - bounds[:-1], lengths) + np.arange(bounds[-1])] if bounds[-1] else np.empty(0, np.int32)
        cuts = bounds[offsets]
        return [np.array(whole[i], np.int32) if i in whole else flat[cuts[i]:cuts[i + 1]] for i in range(len(texts))]
