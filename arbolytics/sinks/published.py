"""Tables that readers see in whole versions: a version is written aside, checked, and made visible by one rename."""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from arbolytics.operators.quality import counted, require_columns
from arbolytics.session import remove_folder
from arbolytics.streaming.heavy_hitters import batch_folders

VERSIONS = "_versions"
TARGET_BYTES = 256 << 20


class NotPublished(ValueError):
    """The table did not pass its gate; the version before it stays."""


def _files(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def folder_bytes(spark: SparkSession, paths: Sequence[str]) -> int:
    total = 0
    for path in paths:
        files, p = _files(spark, path)
        total += files.getContentSummary(p).getLength()
    return total


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the published versions, in order."""
    files, p = _files(spark, f"{folder}/{VERSIONS}/*.json")
    return sorted(int(f.getPath().getName().split(".")[0]) for f in files.globStatus(p) or [])


def manifest(spark: SparkSession, folder: str, version: int | None = None) -> dict | None:
    """What a version (the newest by default) consists of; null before the first."""
    found = versions(spark, folder)
    if not found:
        return None
    text = spark.read.text(f"{folder}/{VERSIONS}/{version or found[-1]:09d}.json", wholetext=True).first()[0]
    return json.loads(text)


def publish(spark: SparkSession, folder: str, after: int, content: dict) -> int:
    """Makes a version visible that follows version ``after``.

    The manifest is written under another name and renamed; a rename never replaces a file, so of two writers that
    start from one version the second gets an error, and readers see the old version or the new one.
    """
    jvm, version = spark._jvm, after + 1
    files, draft = _files(spark, f"{folder}/{VERSIONS}/.{uuid.uuid4().hex}")
    out = files.create(draft)
    out.write(bytearray(json.dumps({**content, "version": version}).encode()))
    out.close()
    target = jvm.org.apache.hadoop.fs.Path(f"{folder}/{VERSIONS}/{version:09d}.json")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(files.makeQualified(draft), files.makeQualified(target), no_options)
    except Exception:
        files.delete(draft, False)
        raise
    return version


def write_gated(df: DataFrame, folder: str, columns: Sequence[str] = (), not_null: Sequence[str] = (),
                least_rows: int = 1) -> dict:
    """Writes a table and publishes it if it has the columns, enough rows, and no null in some columns.

    Rows and values are counted while the table is written, without a second scan. A table that fails is removed,
    ``NotPublished`` says why, and readers keep the version before. Returns the manifest with the counts.
    """
    spark = df.sparkSession
    try:
        require_columns(df, [*columns, *not_null])
    except ValueError as e:
        raise NotPublished(str(e)) from e
    before = manifest(spark, folder)
    name = f"table-{uuid.uuid4().hex}"
    watched, seen = counted(df, name, not_null)
    watched.write.parquet(f"{folder}/{name}")
    counts = seen.get
    faults = [f"{counts['rows']} rows, at least {least_rows} expected"] if counts["rows"] < least_rows else []
    faults += [f"{counts['rows'] - counts[c]} nulls in {c}" for c in not_null if counts[c] < counts["rows"]]
    if faults:
        remove_folder(spark, f"{folder}/{name}")
        raise NotPublished("; ".join(faults))
    content = {"table": name, "counts": counts}
    publish(spark, folder, before["version"] if before else 0, content)
    return content


def gated_writer(folder: str, columns: Sequence[str] = (), not_null: Sequence[str] = (),
                 least_rows: int = 1) -> Callable[[DataFrame, int], None]:
    """As ``write_gated`` for each batch of a stream that carries its whole result (complete mode).

    A batch that fails ends the query with the error; after the cause is mended the query resumes with that batch.
    A batch that is replayed publishes its rows once more as a newer version.
    """
    return lambda batch, _: write_gated(batch, folder, columns, not_null, least_rows) and None


def read_published(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The newest version; empty before the first. A reader keeps its version while newer ones are published."""
    found = manifest(spark, folder)
    return spark.read.schema(schema).parquet(f"{folder}/{found['table']}") if found else spark.createDataFrame([], schema)


def _current(spark: SparkSession, folder: str, schema: T.StructType, found: dict | None, through: int) -> tuple[DataFrame, list[str]]:
    full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    batches = [n for n in batch_folders(spark, folder) if (found["through"] if found else -1) < n <= through]
    old = [f"{folder}/{found['table']}"] if found else []
    new = [f"{folder}/batch_id={n}" for n in batches]
    rows = spark.createDataFrame([], full)
    if new:
        rows = spark.read.schema(full).option("basePath", folder).parquet(*new)
    if old:
        rows = spark.read.schema(full).parquet(*old).unionByName(rows)
    return rows, old + new


def _newest(rows: DataFrame, keys: Sequence[str], files: int | None = None) -> DataFrame:
    """The newest row per key, with its batch.

    A batch holds a key once, so rows are not combined before the shuffle; with ``files`` the shuffle is the one that
    decides the number of files.
    """
    values = [c for c in rows.columns if c not in keys]
    if files:
        rows = rows.repartition(files, *keys)
    return (rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("v"))
            .select(*[F.col(f"v.`{c}`").alias(c) if c in values else F.col(f"`{c}`") for c in rows.columns]))


def read_updates(spark: SparkSession, folder: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """The newest row per key of a table of batches: the compacted version and the batches after it."""
    rows, _ = _current(spark, folder, schema, manifest(spark, folder), 1 << 62)
    return _newest(rows, keys).drop("batch_id")


def compact(spark: SparkSession, folder: str, schema: T.StructType, keys: Sequence[str],
            target_bytes: int = TARGET_BYTES) -> dict | None:
    """Rewrites the finished batches and the version before to the newest row per key, and publishes that.

    The number of files follows the bytes read, so it does not grow with the number of batches. Batches that arrive
    meanwhile are read as they are until the next call. Nothing is removed: see ``expire``.
    """
    before, finished = manifest(spark, folder), batch_folders(spark, folder)
    if not finished or (before and before["through"] >= finished[-1]):
        return before
    rows, paths = _current(spark, folder, schema, before, finished[-1])
    files = max(1, math.ceil(folder_bytes(spark, paths) / target_bytes))
    name = f"table-{uuid.uuid4().hex}"
    _newest(rows, keys, files).write.parquet(f"{folder}/{name}")
    content = {"table": name, "through": finished[-1], "files": files}
    publish(spark, folder, before["version"] if before else 0, content)
    return content


def expire(spark: SparkSession, folder: str, keep: int = 2) -> None:
    """Removes what only versions before the newest ``keep`` need: their tables and the batches they already hold.

    Tables that no version names (a writer that failed) go too, so it must not run beside a writer.
    """
    kept = [manifest(spark, folder, v) for v in versions(spark, folder)[-keep:]]
    if not kept:
        return
    files, p = _files(spark, f"{folder}/table-*")
    for found in files.globStatus(p) or []:
        if found.getPath().getName() not in {m["table"] for m in kept}:
            files.delete(found.getPath(), True)
    for n in batch_folders(spark, folder):
        if n <= kept[0].get("through", -1):
            remove_folder(spark, f"{folder}/batch_id={n}")


def compacting_writer(folder: str, schema: T.StructType, keys: Sequence[str], every: int = 100,
                      target_bytes: int = TARGET_BYTES) -> Callable[[DataFrame, int], None]:
    """Per-batch Parquet writer that compacts and expires after each ``every`` batches.

    A replayed batch overwrites its own folder; one that a version already holds is not read again.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")
        if batch_id % every == every - 1:
            compact(batch.sparkSession, folder, schema, keys, target_bytes)
            expire(batch.sparkSession, folder)

    return write
