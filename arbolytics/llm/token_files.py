"""Token-id files: independent zstandard frames, a document index and a trailing seek table.

Layout of one file (integers are little-endian):

* zstandard frames. Each holds the ids (unsigned 32 bit) of whole documents.
* one skippable frame with the document index: magic 0x184D2A5D, length, then a
  zstandard frame with the number of documents (8 bytes), the frame number of each
  document (4 bytes each), and the number of ids of each document (8 bytes each).
* one skippable frame with the seek table of the public zstd seekable format: magic
  0x184D2A5E, length, per frame compressed size, decompressed size and checksum (low 32
  bits of XXH64 of the decompressed bytes), then number of frames, descriptor byte and
  magic 0x8F92EAB1. The index frame counts as a frame of decompressed size 0.

A reader seeks to the last 9 bytes, reads the table and the index, and decompresses only
the frames of the documents asked for. A plain zstandard reader can read the whole file.

Files are written by tasks under a name of their own; the staged manifest names the files
that count, so a repeated or lost task leaves at most an unused file.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from arbolytics.llm.chunk_encoder import ChunkEncoder
from arbolytics.llm.common import bare, pieces, text_bytes, texts_of
from arbolytics.session import fresh_path, stage

# Fixed values of the public zstd seekable format, and the skippable magic of the index.
SEEK_MAGIC, TABLE_MAGIC, INDEX_MAGIC = 0x8F92EAB1, 0x184D2A5E, 0x184D2A5D
CHECKSUMS = 0x80
FRAME_BYTES = 1 << 20
FILE_TEXT_BYTES = 16 << 20


class FileWriter:
    """Writes documents of ids to one stream; a document never crosses a frame."""

    def __init__(self, sink, frame_bytes: int = FRAME_BYTES, level: int = 3):
        self.sink, self.frame_bytes = sink, frame_bytes
        self.packer = zstandard.ZstdCompressor(level=level)
        self.open: list[bytes] = []
        self.open_bytes = 0
        self.table: list[tuple[int, int, int]] = []
        self.frames: list[int] = []
        self.counts: list[int] = []

    def add(self, ids: np.ndarray) -> None:
        raw = ids.astype("<u4").tobytes()
        if self.open and self.open_bytes + len(raw) > self.frame_bytes:
            self._frame()
        self.open.append(raw)
        self.open_bytes += len(raw)
        self.frames.append(len(self.table))
        self.counts.append(len(ids))

    def _frame(self) -> None:
        raw = b"".join(self.open)
        packed = self.packer.compress(raw)
        self.sink.write(packed)
        self.table.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.open, self.open_bytes = [], 0

    def close(self) -> None:
        if self.open:
            self._frame()
        index = self.packer.compress(struct.pack("<Q", len(self.counts)) + np.array(self.frames, "<u4").tobytes()
                                     + np.array(self.counts, "<u8").tobytes())
        self.sink.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        self.table.append((len(index) + 8, 0, 0))
        rows = b"".join(struct.pack("<III", *row) for row in self.table)
        tail = rows + struct.pack("<IBI", len(self.table), CHECKSUMS, SEEK_MAGIC)
        self.sink.write(struct.pack("<II", TABLE_MAGIC, len(tail)) + tail)


class FileReader:
    """Random access to the documents of one file."""

    def __init__(self, source):
        self.source = source
        self.unpacker = zstandard.ZstdDecompressor()
        size = source.size()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_MAGIC or not flags & CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        self.table = np.frombuffer(self._at(size - 9 - 12 * n, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.table[:, 0])])
        index = self.unpacker.decompress(self._at(int(self.starts[n - 1]) + 8, int(self.table[n - 1, 0]) - 8))
        docs = struct.unpack_from("<Q", index)[0]
        self.frames = np.frombuffer(index, "<u4", docs, 8)
        self.counts = np.frombuffer(index, "<u8", docs, 8 + 4 * docs).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(self.counts)])

    def _at(self, offset: int, length: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(length)

    def frame(self, k: int) -> np.ndarray:
        raw = self.unpacker.decompress(self._at(int(self.starts[k]), int(self.table[k, 0])),
                                       max_output_size=int(self.table[k, 1]))
        if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.table[k, 2]:
            raise ValueError(f"checksum of frame {k} does not match")
        return np.frombuffer(raw, "<u4")

    def documents(self, wanted: Iterable[int]) -> Iterator[tuple[int, np.ndarray]]:
        """The ids of the wanted documents; each frame is read once for documents in order."""
        held, ids = -1, np.empty(0, "<u4")
        for d in wanted:
            k = int(self.frames[d])
            if k != held:
                held, ids = k, self.frame(k)
                first = int(np.searchsorted(self.frames, k))
            at = int(self.before[d] - self.before[first])
            yield d, ids[at:at + int(self.counts[d])]


@lru_cache(maxsize=2)
def encoder(tokenizer_file: str) -> ChunkEncoder:
    """Encodes texts without special tokens, for a tokenizer that drops white space."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file)
    tokenizer.encode_special_tokens = True
    widths = np.zeros(tokenizer.get_vocab_size(), np.int64)
    for token, k in tokenizer.get_vocab().items():
        widths[k] = len(token.removesuffix("</w>"))  # one character for each byte
    return ChunkEncoder(lambda texts: [x.ids for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)],
                        leading_blank=False, widths=widths, written=str.lower, most_known=1_000_000, slice_chars=4_000_000)


MANIFEST = "part int, file string, n_docs long, n_ids long, least_id long, greatest_id long, doc_ids binary"


def write_token_files(df: DataFrame, folder: str, tokenizer_file: str, end_id: int,
                      id_col: str = "doc_id", text_col: str = "text",
                      frame_bytes: int = FRAME_BYTES, file_text_bytes: int = FILE_TEXT_BYTES) -> DataFrame:
    """Writes the documents' ids in ascending id order below ``folder``; returns the manifest.

    Every text is encoded whole and gets ``end_id`` at its end; null counts as empty, so
    its document holds the end id alone. Rows that repeat an id are all written, ordered by
    text; a null id sorts first. Extra columns are left out. An empty table writes nothing.

    The manifest has a row per file in id order: part, file, number of documents and ids, least and greatest
    document id (null if all are), and the document ids (packed, with a leading null mask).
    """
    spark = df.sparkSession
    rows = bare(df, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    n = pieces(text_bytes(rows), file_text_bytes)
    spread = F.xxhash64("text")
    ordered = (rows.withColumn("_h", spread).repartitionByRange(n, "doc_id", "_h")
               .sortWithinPartitions("doc_id", "_h", "text").drop("_h"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, fs, out, writer, ids = None, None, None, None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                encode = encoder(tokenizer_file)
                fs, root = pafs.FileSystem.from_uri(folder)
                fs.create_dir(root, recursive=True)
                name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.ids"
                out = fs.open_output_stream(f"{root}/{name}", compression=None)
                writer = FileWriter(out, frame_bytes)
            texts = texts_of(batch.column("text"))
            ids.extend(batch.column("doc_id").to_pylist())
            for found in encode(texts):
                writer.add(np.append(found, end_id))
        if writer is not None:
            writer.close()
            out.close()
            nulls = np.array([x is None for x in ids], np.uint8).tobytes()
            known = [x for x in ids if x is not None]
            packed = zstandard.compress(nulls + np.array([x or 0 for x in ids], "<i8").tobytes())
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([TaskContext.get().partitionId()], pa.int32()), "file": [f"{folder}/{name}"],
                "n_docs": [len(ids)], "n_ids": [sum(writer.counts)],
                "least_id": pa.array([min(known, default=None)], pa.int64()), "greatest_id": pa.array([max(known, default=None)], pa.int64()),
                "doc_ids": pa.array([packed], pa.binary())})

    return stage(ordered.mapInArrow(write, MANIFEST), "token-manifest")


READ = "doc_id long, start long, n_tokens long, ids array<long>"


def read_token_files(manifest: DataFrame, with_ids: bool = True) -> DataFrame:
    """Reads every document back: id, ids before it (over all files), its number of ids, its ids.

    With ``with_ids`` false the ids are replaced by their checksum: ``ids_crc32``.
    """
    # One row per file: the window holds file sizes, not documents.
    sizes = manifest.select("part", "n_ids").withColumn(
        "base", F.coalesce(F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    files = manifest.join(sizes.select("part", "base"), "part")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = pafs.FileSystem.from_uri(row["file"])
                raw = zstandard.decompress(row["doc_ids"])
                nulls, ids = np.frombuffer(raw, np.uint8, row["n_docs"]), np.frombuffer(raw, "<i8", row["n_docs"], row["n_docs"])
                with fs.open_input_file(path) as source:
                    reader = FileReader(source)
                    step = 2_000
                    for a in range(0, len(ids), step):
                        b = min(a + step, len(ids))
                        got = [x for _, x in reader.documents(range(a, b))]
                        out = {"doc_id": pa.array(ids[a:b], mask=nulls[a:b].astype(bool)),
                               "start": pa.array(reader.before[a:b] + row["base"]),
                               "n_tokens": pa.array([len(x) for x in got], pa.int64())}
                        if with_ids:
                            out["ids"] = pa.array([x.astype(np.int64) for x in got], pa.list_(pa.int64()))
                        else:
                            out["ids_crc32"] = pa.array([zlib.crc32(x.tobytes()) for x in got], pa.int64())
                        yield pa.RecordBatch.from_pydict(out)

    schema = READ if with_ids else READ.replace("ids array<long>", "ids_crc32 long")
    # A task per file: a number that is given is not merged.
    return files.repartitionByRange(max(manifest.count(), 1), "part").mapInArrow(read, schema)


def read_documents(spark: SparkSession, manifest: DataFrame, doc_ids: list[int]) -> dict[int, list[int]]:
    """The ids of a few documents; only the files that may hold one are opened, in tasks, and only their frames are read.

    The result is as large as the caller's list asks for. Of rows that repeat an id the last counts; unknown ids are left out.
    """
    wanted = sorted(set(doc_ids))
    if not wanted:
        return {}
    may_hold = F.exists(F.array(*[F.lit(x).cast("long") for x in wanted]), lambda x: x.between(F.col("least_id"), F.col("greatest_id")))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                raw = zstandard.decompress(row["doc_ids"])
                nulls, ids = np.frombuffer(raw, np.uint8, row["n_docs"]), np.frombuffer(raw, "<i8", row["n_docs"], row["n_docs"])
                at = np.flatnonzero(np.isin(ids, wanted) & (nulls == 0)).tolist()
                if at:
                    fs, path = pafs.FileSystem.from_uri(row["file"])
                    with fs.open_input_file(path) as source:
                        found = [(int(ids[i]), row["part"], i, x.tolist()) for i, x in FileReader(source).documents(at)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), (
                        pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64())), strict=True)], ["doc_id", "part", "place", "ids"])

    files = manifest.filter(may_hold)
    rows = files.repartitionByRange(max(min(files.count(), len(wanted)), 1), "part").mapInArrow(
        read, "doc_id long, part int, place long, ids array<long>").collect()
    return {r.doc_id: r.ids for r in sorted(rows, key=lambda r: (r.part, r.place))}


def token_folder(spark: SparkSession) -> str:
    return fresh_path(spark, "token-files")
