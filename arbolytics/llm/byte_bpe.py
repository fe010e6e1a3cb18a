"""Byte-level BPE with the tokenizers library from a rank file, and its inverse.

A rank file lists byte strings with ranks. The library works on characters, so each byte
is written as one printable character (the public byte-to-character table), texts are cut by the
pattern, and merges come from the ranks: every way to cut a token in two known tokens is a
merge of the token's rank. Decoding looks each id's bytes up and joins them; a character
split over several ids comes back whole, as bytes are joined before they are decoded.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from arbolytics.llm.chunk_encoder import ChunkEncoder
from arbolytics.llm.common import bare, batch_slices, slices, texts_of


def byte_characters() -> list[str]:
    """The character of each byte: printable Latin-1 as it is, the others from U+0100 on in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    moved = [b for b in range(256) if b not in set(plain)]
    return [chr(b) if b in set(plain) else chr(256 + moved.index(b)) for b in range(256)]


def read_ranks(rank_file: str) -> dict[bytes, int]:
    """The ranks of a file with a base64 token and its rank on each line."""
    with open(rank_file, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


@lru_cache(maxsize=2)
def library_tokenizer(rank_file: str, pattern: str):
    """A tokenizer of the library that gives the ids of the rank file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
    from tokenizers import Regex, Tokenizer, pre_tokenizers

    ranks, char = read_ranks(rank_file), byte_characters()
    written = {token: "".join(char[b] for b in token) for token in ranks}
    merges = []
    for token in sorted((t for t in ranks if len(t) > 1), key=ranks.__getitem__):
        # Shorter left parts first: of two equal merges the one further left wins, as in rank order.
        merges += [[written[token[:i]], written[token[i:]]] for i in range(1, len(token))
                   if token[:i] in ranks and token[i:] in ranks]
    model = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None,
             "fuse_unk": False, "byte_fallback": False, "ignore_merges": True,
             "vocab": {written[t]: r for t, r in ranks.items()}, "merges": merges}
    out = Tokenizer.from_str(json.dumps({"version": "1.0", "truncation": None, "padding": None, "added_tokens": [],
                                         "normalizer": None, "pre_tokenizer": None, "post_processor": None,
                                         "decoder": None, "model": model}))
    out.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return out


def token_bytes(rank_file: str) -> dict[int, bytes]:
    """The inverse table: bytes of each id."""
    return {rank: token for token, rank in read_ranks(rank_file).items()}


def decode_bytes(ids: list[int], table: dict[int, bytes]) -> bytes:
    """Bytes of a list of ids; characters split over ids are whole again."""
    return b"".join(map(table.__getitem__, ids))


@lru_cache(maxsize=2)
def chunk_encoder(rank_file: str, pattern: str) -> ChunkEncoder:
    tokenizer = library_tokenizer(rank_file, pattern)
    return ChunkEncoder(lambda texts: [x.ids for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)],
                        leading_blank=True, widths=np.array([len(t) for _, t in sorted(token_bytes(rank_file).items())]))


def encode_column(df: DataFrame, rank_file: str, pattern: str, text_col: str = "text",
                  id_col: str = "doc_id", offsets: bool = False) -> DataFrame:
    """doc_id, ids and, on request, the character offsets [start, end) of each id.

    Null counts as empty; an empty text has no ids. Texts are encoded whole. Repeated rows
    give repeated results, extra columns are left out, an empty table gives none. Several
    ids of one split character share its offsets.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = chunk_encoder(rank_file, pattern)
        tokenizer = library_tokenizer(rank_file, pattern)
        for batch in batches:
            texts = texts_of(batch.column("text"))
            for a, b in slices(texts, 200_000 if offsets else 4_000_000):
                out = {"doc_id": batch.column("doc_id").slice(a, b - a)}
                if offsets:
                    found = tokenizer.encode_batch(texts[a:b], add_special_tokens=False)
                    out["ids"] = pa.array([x.ids for x in found], pa.list_(pa.int32()))
                    out["starts"] = pa.array([[s for s, _ in x.offsets] for x in found], pa.list_(pa.int32()))
                    out["ends"] = pa.array([[e for _, e in x.offsets] for x in found], pa.list_(pa.int32()))
                else:
                    out["ids"] = pa.array(list(encode(texts[a:b])), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(out)

    rows = bare(df, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>" + (", starts array<int>, ends array<int>" if offsets else ""))


def decode_column(df: DataFrame, rank_file: str, ids_col: str = "ids", id_col: str = "doc_id") -> DataFrame:
    """doc_id and the decoded bytes. Null ids give empty bytes; an unknown id raises."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(rank_file)
        for batch in batches:
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "decoded": pa.array([decode_bytes(x or [], table) for x in batch.column("ids").to_pylist()], pa.binary())})

    return bare(df, doc_id=id_col, ids=ids_col).mapInArrow(run, "doc_id long, decoded binary")


def round_trip(df: DataFrame, rank_file: str, pattern: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256, encoded and decoded in one pass over the texts.

    ids_sha256 is over the decimal ids joined by commas, decoded_sha256 over the decoded
    bytes. Cases as in ``encode_column``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, table = chunk_encoder(rank_file, pattern), token_bytes(rank_file)
        written = {i: str(i) for i in table}
        for batch in (part for whole in batches for part in batch_slices(whole)):
            texts, counts, ids_sha, decoded_sha = texts_of(batch.column("text")), [], [], []
            for ids in map(np.ndarray.tolist, encode(texts)):
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(",".join(map(written.__getitem__, ids)).encode()).hexdigest())
                decoded_sha.append(hashlib.sha256(decode_bytes(ids, table)).hexdigest())
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_tokens": pa.array(counts, pa.int64()),
                                              "ids_sha256": pa.array(ids_sha, pa.string()),
                                              "decoded_sha256": pa.array(decoded_sha, pa.string())})

    rows = bare(df, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
