"""Passages that stand in an earlier document, by fixed-block anchors.

1. Anchors. Each document is cut into blocks of half a window; the blocks are the index.
   Every rolling run of that length, in every document, probes it. A window of two block
   lengths holds a whole block of its document, so a repeated window holds a hit.
2. Extension. Around the hits, runs of a whole window are compared; windows side by side
   make the maximal exact repeat. For each such window the smallest document is kept.
3. Removal. A word goes if a window over it starts in a document with a smaller id.

Documents are dealt to groups by a hash of their id. Groups send distinct hashes to buckets
(see ``packed``), so a passage in a third of all documents costs no more than any other, and pairs
of documents are never formed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from arbolytics.llm import packed
from arbolytics.llm.common import WORD_SPACES, bare, hash_group, pieces, text_bytes
from arbolytics.llm.words import Words, word_hashes

GROUP_BYTES = 8 << 20
#: Anchors are compared by their leading bits only. More equal anchors mean more windows to compare, not more removals.
ANCHOR_BITS = 48
_DROP = np.uint64(64 - ANCHOR_BITS)
NONE = np.iinfo(np.int64).max


def _docs(table: pa.Table) -> tuple[Words, np.ndarray]:
    """Words and ids; a null id is larger than any other."""
    return word_hashes(table.column("text")), table.column("doc_id").fill_null(NONE).to_numpy()


def _anchor_runs(words: Words, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading bits of the run at each word, and whether the document has room for it."""
    return (words.runs(block) >> _DROP) << _DROP, words.room() >= block


def _first_of(keys: np.ndarray) -> np.ndarray:
    """Where a new key begins in ascending keys."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)


def _anchors(block: int, buckets: int):
    """Each group's distinct runs: bit 0 says that one is a block, bit 1 that two documents have it."""
    def run(table: pa.Table) -> pa.Table:
        words, _ = _docs(table)
        runs, fits = _anchor_runs(words, block)
        at = np.flatnonzero(fits)
        doc = np.repeat(np.arange(len(words.cuts) - 1), np.diff(words.cuts))
        is_block = (np.arange(len(runs)) - words.cuts[doc]) % block == 0
        at = at[np.argsort(runs[at], kind="stable")]
        keys, docs = runs[at], doc[at]
        first = _first_of(keys)
        if not len(first):
            return packed.to_table([])
        flags = np.maximum.reduceat(is_block[at].astype(np.uint8), first)
        flags |= (np.minimum.reduceat(docs, first) != np.maximum.reduceat(docs, first)).astype(np.uint8) << 1
        return packed.to_table(list(packed.send(table.column("grp")[0].as_py(), buckets, keys[first], flags)))

    return run


def _hits(table: pa.Table) -> pa.Table:
    """The runs that are a block somewhere and stand in two documents, sent back to their groups."""
    keys, columns, owner = packed.gather(table.column("grp").to_pylist(), table.column("blob").to_pylist())
    if not len(keys):
        return packed.to_table([])
    first = _first_of(keys)
    n = np.diff(np.append(first, len(keys)))
    flags = np.bitwise_or.reduceat(columns[0], first)
    good = (flags & 1 > 0) & ((n > 1) | (flags & 2 > 0))
    return packed.to_table(packed.answer(owner, np.repeat(good, n), keys))


def _windows(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    return words.runs(window), words.runs(window, second=True).astype(np.uint32)


def _candidates(window: int, block: int, buckets: int):
    """Each group's windows that hold a hit, with their smallest document and whether two have them."""
    def run(docs: pa.Table, hits: pa.Table) -> pa.Table:
        if not docs.num_rows or not hits.num_rows:
            return packed.to_table([])
        words, ids = _docs(docs)
        runs, fits = _anchor_runs(words, block)
        hit = fits & (packed.positions(runs, packed.merge(hits.column("blob").to_pylist())[0]) >= 0)
        upto = np.concatenate([[0], np.cumsum(hit)])
        start = np.arange(len(runs))
        last = np.minimum(start + window - block + 1, len(runs))
        at = start[(words.room() >= window) & (upto[last] > upto[start])]
        key, check = _windows(words, window)
        doc = np.repeat(ids, np.diff(words.cuts))[at]
        order = np.lexsort((doc, check[at], key[at]))
        at, doc = at[order], doc[order]
        key, check = key[at], check[at]
        if not len(at):
            return packed.to_table([])
        first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (check[1:] != check[:-1])]))
        least, most = doc[first], np.maximum.reduceat(doc, first)
        return packed.to_table(list(packed.send(docs.column("grp")[0].as_py(), buckets, key[first], check[first], least,
                                                (least != most).astype(np.uint8))))

    return run


def _owners(table: pa.Table) -> pa.Table:
    """The windows that two documents have, with the smallest of all their documents, sent back."""
    keys, columns, owner = packed.gather(table.column("grp").to_pylist(), table.column("blob").to_pylist())
    if not len(keys):
        return packed.to_table([])
    check, doc, more = columns
    order = np.lexsort((check, keys))
    keys, check, doc, more, owner = keys[order], check[order], doc[order], more[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (check[1:] != check[:-1])]))
    n = np.diff(np.append(first, len(keys)))
    least = np.repeat(np.minimum.reduceat(doc, first), n)
    return packed.to_table(packed.answer(owner, (more > 0) | (least < doc), keys, check, least))


RESULT = "doc_id long, n_words long, n_removed long, kept_text string, removed array<struct<start:long,end:long>>"
RESULT_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string()),
                           ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def _removals(window: int):
    def run(docs: pa.Table, owners: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return RESULT_SCHEMA.empty_table()
        words, ids = _docs(docs)
        n = len(words.hashes)
        gone = np.zeros(n, bool)
        if owners.num_rows and n:
            keys, checks, least = packed.merge(owners.column("blob").to_pylist())
            key, check = _windows(words, window)
            doc = np.repeat(ids, np.diff(words.cuts))
            covered = np.zeros(n, bool)
            at = packed.positions(key, keys)
            fits = np.flatnonzero((at >= 0) & (words.room() >= window))
            # Equal first hashes with different second ones stand side by side.
            place = at[fits]
            while len(fits):
                same = checks[place] == check[fits]
                covered[fits[same & (least[place] < doc[fits])]] = True
                place, fits = place[~same] + 1, fits[~same]
                more = place < len(keys)
                more[more] = keys[place[more]] == key[fits[more]]
                place, fits = place[more], fits[more]
            edges = np.zeros(n + window + 1, np.int32)
            starts = np.flatnonzero(covered)
            np.add.at(edges, starts, 1)
            np.add.at(edges, starts + window, -1)
            gone = np.cumsum(edges)[:n] > 0
        counts = np.diff(words.cuts)
        removed = np.add.reduceat(np.append(gone, False).astype(np.int64), words.cuts[:-1]) * (counts > 0) if len(counts) else counts
        texts, spans = [], []
        for d, text in enumerate(docs.column("text").to_pylist()):
            parts = (text or "").encode().split()  # the same six characters of white space
            mine = gone[words.cuts[d]:words.cuts[d + 1]]
            if removed[d]:
                turns = np.flatnonzero(np.diff(np.concatenate([[False], mine, [False]]).astype(np.int8)))
                spans.append([{"start": int(a), "end": int(b)} for a, b in zip(turns[::2], turns[1::2], strict=True)])
                parts = [p for p, g in zip(parts, mine.tolist(), strict=True) if not g]
            else:
                spans.append([])
            texts.append(b" ".join(parts).decode())
        return pa.table({"doc_id": docs.column("doc_id"), "n_words": counts, "n_removed": removed, "kept_text": texts, "removed": spans},
                        schema=RESULT_SCHEMA)

    return run


def substring_dedup(df: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_text and removed (word spans) of every row.

    A word goes if a window of ``window`` words over it also starts in a row with a smaller
    id. Words are runs of characters other than ASCII white space, kept as they are; kept
    words are joined by one blank. Null or empty text has no words. Rows that repeat an id do not
    remove each other's words; a null id counts as larger than all others. Windows
    are judged on the input. An empty table gives no rows, extra columns are left out.
    """
    if window < 2:
        raise ValueError("a window has two words at least")
    assert set(WORD_SPACES) == set(b" \t\n\x0b\x0c\r")  # what bytes.split() takes as white space
    block = window // 2
    rows = bare(df, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    n = pieces(text_bytes(rows), GROUP_BYTES)
    docs = rows.withColumn("grp", hash_group("doc_id", n))
    hits = docs.groupBy("grp").applyInArrow(_anchors(block, n), packed.BLOBS).groupBy("bucket").applyInArrow(_hits, packed.BLOBS)
    owners = (docs.groupBy("grp").cogroup(hits.groupBy("grp")).applyInArrow(_candidates(window, block, n), packed.BLOBS)
              .groupBy("bucket").applyInArrow(_owners, packed.BLOBS))
    return docs.groupBy("grp").cogroup(owners.groupBy("grp")).applyInArrow(_removals(window), RESULT)
