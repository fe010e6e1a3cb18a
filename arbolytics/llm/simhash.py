"""SimHash fingerprints of texts, and classes of nearly equal ones by multi-index hashing.

1. A text's fingerprint has a bit set where more than half of its word shingles' hashes have it.
   Texts of one fingerprint become one node, reduced before anything is compared.
2. Fingerprints are cut into segments, each with a table from a segment's value to the fingerprints that have
   it. Two fingerprints within ``distance`` are within a small radius in one segment (pigeonhole),
   so each one enumerates the small Hamming ball around its own value in each table, fetches
   the matches and verifies the complete distance. Of the two values of a pair the greater one probes.
3. A value that very many fingerprints have (copies with few changes) is not paired. Fingerprints that are in such a
   list, or whose ball meets one, are joined by what stands half-way: two of them are within the distance
   exactly if the balls of half the radius around them share a point. All members of a point are linked, so the
   first of them stands for the point, and a list costs what its members cost, not their pairs.
4. Links make classes; the class goes back to the documents by fingerprint.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from arbolytics.llm.common import bare, batch_slices
from arbolytics.llm.components import components
from arbolytics.session import stage

BITS = 64
SEED = 42
#: A table entry with more fingerprints than this is joined by half-way points.
LONG_LIST = 64
#: Fingerprints of more than one in so many documents are looked up by a broadcast of at most so many rows.
HOT_SHARE = 1_000
SLICE_BYTES = 1 << 20
_SPACE = re.compile(rb"[ \t-\r]")
NONE = np.iinfo(np.int64).max


def shingle_hashes(text: bytes, length: int, seed: int = SEED) -> Iterator[np.ndarray]:
    """XXH64 of every run of ``length`` words, repeats included, about a megabyte of text at a time.

    Words are parted by ASCII white space and joined by one blank; fewer words are one run.
    """
    at, words, runs = 0, [], 0
    while at < len(text):
        found = _SPACE.search(text, at + SLICE_BYTES)
        end = found.start() if found else len(text)
        words += text[at:end].split()
        at = end
        if len(words) >= length:
            joined, sizes = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
            ends = np.cumsum(sizes + 1) - 1
            spans = zip((ends - sizes)[:len(words) - length + 1].tolist(), ends[length - 1:].tolist(), strict=True)
            yield np.array([xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in spans], np.uint64)
            runs += 1
            words = words[len(words) - length + 1:]
    if not runs and words:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)], np.uint64)


def fingerprint(text: str | None, length: int, seed: int = SEED) -> int:
    """The fingerprint as a signed 64-bit number; zero without words."""
    counts, n = np.zeros(BITS, np.int64), 0
    for hashes in shingle_hashes((text or "").encode("utf-8", "surrogatepass").lower(), length, seed):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, length: int = 5, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in batch_slices(whole)):
            found = [fingerprint(x.as_py(), length, seed) for x in batch.column("text")]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "fp": pa.array(found, pa.int64())})

    rows = bare(df, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def segment_radii(distance: int, segments: int) -> list[int]:
    """The radius to search in each segment (-1: none) so that no pair within the distance is missed."""
    each, rest = divmod(distance, segments)
    return [each if i <= rest else each - 1 for i in range(segments)]


def ball(width: int, radius: int) -> list[int]:
    """Masks of at most ``radius`` of ``width`` bits."""
    return [sum(1 << b for b in bits) for k in range(radius + 1) for bits in itertools.combinations(range(width), k)]


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << BITS) if mask >> (BITS - 1) else mask).cast("long")


def _rows(rows: list[tuple[int, ...]], *names: str) -> Column:
    """A constant array of structs of longs."""
    return F.array(*[F.struct(*[_signed(x).alias(name) for x, name in zip(row, names, strict=True)]) for row in rows])


def table_keys(fps: DataFrame, distance: int, segments: int) -> tuple[DataFrame, DataFrame]:
    """segment, value and fp of each fingerprint's table entries, and of its probes.

    Of the ball around a value only those not greater than it are probed.
    """
    entries, probes = [], []
    for i, radius in enumerate(segment_radii(distance, segments)):
        low, high = BITS * i // segments, BITS * (i + 1) // segments
        if radius >= 0:
            entries.append((i, low, (1 << (high - low)) - 1))
            # Flipping lowers a value if its highest flipped bit was set.
            probes += [(*entries[-1], m, 1 << (m.bit_length() - 1) if m else 0) for m in ball(high - low, radius)]
    value = F.call_function("shiftrightunsigned", F.col("fp"), F.col("k.low").cast("int")).bitwiseAND(F.col("k.part"))
    own = fps.select("fp", F.explode(_rows(entries, "segment", "low", "part")).alias("k"))
    asked = fps.select("fp", F.explode(_rows(probes, "segment", "low", "part", "mask", "highest")).alias("k"))
    return (own.select("k.segment", value.alias("value"), "fp"),
            asked.select("k.segment", value.alias("value"), "k.mask", "k.highest", "fp")
            .filter(F.col("value").bitwiseAND(F.col("highest")) == F.col("highest"))
            .select("segment", F.col("value").bitwiseXOR(F.col("mask")).alias("value"), "fp"))


def halfway(fps: DataFrame, distance: int) -> DataFrame:
    """fp and (position, value) of the points half-way to anything within the distance."""
    masks = [(m,) for m in ball(BITS, distance // 2)]
    points = fps.select("fp", F.explode(_rows(masks, "mask")).alias("k")).select("fp", F.col("fp").bitwiseXOR(F.col("k.mask")).alias("value"))
    if distance % 2 == 0:
        return points.select("fp", F.struct(F.lit(-1).cast("long").alias("position"), "value").alias("point"))
    # One more bit: both sides of it count as one point.
    rest = [(b, (1 << BITS) - 1 - (1 << b)) for b in range(BITS)]
    return points.select("fp", "value", F.explode(_rows(rest, "position", "rest")).alias("k")).select(
        "fp", F.struct("k.position", F.col("value").bitwiseAND(F.col("k.rest")).alias("value")).alias("point"))


def near_fingerprints(fps: DataFrame, distance: int, segments: int) -> DataFrame:
    """Links (u, v) between different fingerprints, enough to join all that links within the distance join."""
    entries, asked = table_keys(fps, distance, segments)
    lists = stage(entries.groupBy("segment", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > LONG_LIST), "simhash-long")
    on = ["segment", "value"]
    matches = asked.join(entries.join(lists, on, "left_anti").withColumnRenamed("fp", "other"), on)
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= distance
    links = matches.filter((F.col("fp") != F.col("other")) & near).select(
        F.greatest("fp", "other").alias("u"), F.least("fp", "other").alias("v")).distinct()
    crowded = stage(entries.join(lists, on, "left_semi").select("fp")
                    .union(asked.join(lists, on, "left_semi").select("fp")).distinct(), "simhash-crowded")
    # No more members than a ball has points.
    shared = halfway(crowded, distance).groupBy("point").agg(F.collect_set("fp").alias("members")).filter(F.size("members") > 1)
    stars = shared.select(F.array_min("members").alias("v"), F.explode("members").alias("u")).filter("u != v")
    return links.union(stars.select("u", "v"))


def near_duplicates(df: DataFrame, distance: int = 3, length: int = 5, segments: int = 2, seed: int = SEED,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row.

    A-Z count as a-z, words are runs of other than ASCII white space, shingles are runs of ``length`` words (fewer words
    are one shingle) with repeats. Rows are linked if their fingerprints differ in ``distance`` bits at most;
    component_id is the smallest id that links reach, the row's own included. Null and empty texts and texts
    without words have fingerprint zero and are linked like any other. Repeated rows give repeated results, a null id
    is never the smallest (the component of rows without any id is null), extra columns are left out, an empty
    table gives no rows.
    """
    docs = stage(fingerprints(df, length, seed, id_col, text_col), "simhash-documents")
    fps = stage(docs.groupBy("fp").agg(F.min(F.coalesce("doc_id", F.lit(NONE))).alias("doc_id"), F.count(F.lit(1)).alias("copies")),
                "simhash-fingerprints")
    found = components(near_fingerprints(fps.select("fp"), distance, segments))
    placed = stage(fps.join(found.withColumnRenamed("node", "fp"), "fp", "left")
                   .withColumn("component", F.coalesce("component", "fp")), "simhash-placed")
    smallest = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = stage(placed.join(smallest, "component").select("fp", "component_id", "copies"), "simhash-classes")
    total = named.agg(F.sum("copies")).first()[0] or 0
    # Counts add up to the rows, so there are at most HOT_SHARE such fingerprints.
    hot = F.broadcast(named.filter(F.col("copies") * HOT_SHARE > total))
    cold = docs.join(hot, "fp", "left_anti").join(named, "fp")
    both = docs.join(hot, "fp").select("fp", "doc_id", "component_id").union(cold.select("fp", "doc_id", "component_id"))
    return both.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                       F.when(F.col("component_id") != NONE, F.col("component_id")).alias("component_id"))
