"""Helpers shared by the operators: input sizes, partition counts, text batches."""

from __future__ import annotations

import math
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import arbolytics

# Fixed value: white space between words, as a set of bytes (blank and 9 to 13).
WORD_SPACES = b" \t\n\x0b\x0c\r"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package's code to the executors, once for each application."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(arbolytics.__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="arbolytics-code-")) / "arbolytics_code.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))  # the driver serves it; executors fetch a copy each
        _SHIPPED.add(context.applicationId)


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of a text column, by one aggregate."""
    return df.agg(F.sum(F.octet_length(F.col(f"`{column}`").cast("string")))).first()[0] or 0


#: Pieces of any table, so that small ones are spread over tasks as well.
LEAST_PIECES = 48


def pieces(size: int, target: int) -> int:
    """How many pieces of about ``target`` bytes hold ``size`` bytes.

    The count follows the data, so a piece stays within a task's memory at any size.
    """
    return max(LEAST_PIECES, math.ceil(size / target))


def bare(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns under the operator's own names; other columns cannot clash."""
    return df.select([F.col(f"`{old}`").alias(new) for new, old in columns.items()])


def hash_group(key: Column | str, n: int) -> Column:
    """A group number from 0 to n - 1, spread evenly for any keys (null included)."""
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def slices(texts: list[str], most_chars: int) -> Iterator[tuple[int, int]]:
    """Index ranges whose texts together hold about ``most_chars`` characters (one text at least)."""
    at, chars = 0, 0
    for i, text in enumerate(texts):
        if i > at and chars + len(text) > most_chars:
            yield at, i
            at, chars = i, 0
        chars += len(text)
    if at < len(texts):
        yield at, len(texts)


def batch_slices(batch: pa.RecordBatch, most_chars: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts (column ``text``) together hold about ``most_chars`` bytes (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
    at, total = 0, 0
    for i, size in enumerate(sizes):
        if i > at and total + size > most_chars:
            yield batch.slice(at, i - at)
            at, total = i, 0
        total += size
    if at < len(sizes):
        yield batch.slice(at)


def texts_of(column: pa.ChunkedArray | pa.Array) -> list[str]:
    """Python texts of a column; null counts as empty."""
    return [x or "" for x in column.to_pylist()]
