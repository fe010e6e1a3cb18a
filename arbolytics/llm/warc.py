"""WARC archives with an index: records are written with their place, then read by byte ranges.

Writing: one gzip member for each record; the index has file, offset, length, URL and digest.
Reading: the index rows wanted are sorted by file and offset, near ranges are read in one
request, and each record is cut out of it. The index is staged, so lost tasks leave at most
unused files that no index row names.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from arbolytics.llm.common import bare, pieces
from arbolytics.session import stage

# Fixed value: the profile of revisit records in the public WARC standard.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILE_BYTES = 16 << 20
GAP_BYTES, READ_BYTES = 64 << 10, 8 << 20


def classify(pages: DataFrame, least_bytes: int = 1000, id_col: str = "page_id", url_col: str = "url",
             html_col: str = "html") -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type and refers_to of each row.

    Null html counts as empty. Of equal payloads of ``least_bytes`` or more the row with the
    largest id is the response; rows with smaller (or null) ids revisit it. Rows that repeat
    the response's id are responses as well; without any id all rows are responses.
    """
    rows = bare(pages, page_id=id_col, url=url_col, html=html_col).select(
        F.col("page_id").cast("long"), "url", F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = (rows.withColumn("payload_bytes", F.octet_length("payload").cast("long"))
            .withColumn("payload_digest", F.sha1("payload")))
    # Ids per digest are reduced before they are shuffled, and only payloads that repeat are joined.
    keepers = stage(rows.filter(F.col("payload_bytes") >= least_bytes)
                    .groupBy(F.col("payload_digest").alias("d"), F.col("payload_bytes").alias("b"))
                    .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
                    .filter("n > 1").select("d", "b", "keeper"), "warc-keepers")
    joined = rows.join(keepers, (F.col("payload_digest") == F.col("d")) & (F.col("payload_bytes") == F.col("b")), "left")
    revisits = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return joined.select("page_id", "url", "payload", "payload_bytes", "payload_digest",
                         F.when(revisits, "revisit").otherwise("response").alias("record_type"),
                         F.when(revisits, F.col("keeper")).alias("refers_to"))


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def record_bytes(row: dict, date: str) -> bytes:
    """One WARC record. A revisit has the HTTP head of its payload, but not the payload."""
    revisit = row["record_type"] == "revisit"
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    block = head if revisit else head + row["payload"]
    fields = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {record_id(row['page_id'])}", f"WARC-Date: {date}"]
    if row["url"] is not None:
        fields.append("WARC-Target-URI: " + re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", row["url"]))
    fields.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(row["payload_digest"])).decode())
    if revisit:
        fields += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(row['refers_to'])}"]
    fields += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


INDEX = "file string, offset long, length long, page_id long, url string, payload_digest string"


def write_archives(records: DataFrame, folder: str, date: str = "2000-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the rows of ``classify`` below ``folder``; returns the staged index, a row per record."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        out, at, name = None, 0, ""
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if out is None:
                    fs.create_dir(root, recursive=True)
                    name = f"pages-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                    out, at = fs.open_output_stream(f"{root}/{name}", compression=None), 0
                packed = gzip.compress(record_bytes(row, date), 4, mtime=0)
                out.write(packed)
                rows.append((f"{folder}/{name}", at, len(packed), row["page_id"], row["url"], row["payload_digest"]))
                at += len(packed)
                if at >= file_bytes:
                    out.close()
                    out = None
            if rows:
                files, offsets, lengths, ids, urls, digests = zip(*rows, strict=True)
                yield pa.RecordBatch.from_pydict({
                    "file": pa.array(files, pa.string()), "offset": pa.array(offsets, pa.int64()), "length": pa.array(lengths, pa.int64()),
                    "page_id": pa.array(ids, pa.int64()), "url": pa.array(urls, pa.string()), "payload_digest": pa.array(digests, pa.string())})
        if out is not None:
            out.close()

    return stage(records.mapInArrow(write, INDEX), "warc-index")


def ranges(places: list[tuple[int, int]]) -> Iterator[tuple[int, int, int, int]]:
    """Merges sorted (offset, length) places: (first row, end row, offset, length) of each read."""
    first, start, end = 0, None, 0
    for i, (offset, length) in enumerate(places):
        if start is not None and (offset > end + GAP_BYTES or offset + length - start > READ_BYTES):
            yield first, i, start, end - start
            first, start = i, None
        if start is None:
            start = offset
        end = max(end, offset + length) if i > first else offset + length
    if start is not None:
        yield first, len(places), start, end - start


def parse_record(raw: bytes) -> dict:
    """Fields of one record; the payload is null for a revisit."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda urn: None if urn is None or urn.endswith(":none>") else int(urn.rpartition(":")[2][:-1])
    revisit = fields["WARC-Type"] == "revisit"
    out = {"page_id": number(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"],
           "refers_to": number(fields.get("WARC-Refers-To")), "payload": None if revisit else payload,
           "payload_bytes": int(re.search(rb"Content-Length: (\d+)", http)[1]),
           "payload_digest": base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()}
    if not revisit and (hashlib.sha1(payload).hexdigest() != out["payload_digest"] or len(payload) != out["payload_bytes"]):
        raise ValueError(f"payload of page {out['page_id']} does not match its digest")
    return out


RECORDS = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary")


# Compressed bytes that one reading task takes.
TASK_BYTES = 8 << 20


def read_records(index: DataFrame, with_payload: bool = True, task_bytes: int = TASK_BYTES) -> DataFrame:
    """The records of the given index rows; filter the index to read only some of them.

    Tasks take neighbouring ranges of some ``task_bytes`` by the lengths in the index, so a large file is read by several.
    """
    n = pieces(index.agg(F.sum("length")).first()[0] or 0, task_bytes)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            cut = [i for i in range(1, len(rows)) if rows[i]["file"] != rows[i - 1]["file"]]
            for a, b in zip([0, *cut], [*cut, len(rows)], strict=True):
                if a == b:
                    continue
                fs, path = pafs.FileSystem.from_uri(rows[a]["file"])
                with fs.open_input_file(path) as source:
                    for i, j, offset, length in ranges([(r["offset"], r["length"]) for r in rows[a:b]]):
                        source.seek(offset)
                        raw = source.read(length)
                        found = []
                        for r in rows[a + i:a + j]:
                            at = r["offset"] - offset
                            found.append(parse_record(zlib.decompress(raw[at:at + r["length"]], 31)))
                            if not with_payload:
                                found[-1]["payload"] = None
                        yield pa.RecordBatch.from_pylist(found, schema)

    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
    return (index.select("file", "offset", "length").repartitionByRange(n, "file", "offset").sortWithinPartitions("file", "offset")
            .mapInArrow(read, RECORDS))
