"""Process-once intake of landed files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from arbolytics.sources.files import CORRUPT, landed_schema
from arbolytics.sources.streams import file_source


def take_new_files(spark: SparkSession, landing: str, table: str, checkpoint: str,
                   schema: T.StructType, fmt: str = "json", partition_by: Sequence[str] = (),
                   archive: str | None = None, whole_files: bool = False,
                   rejects: str | None = None) -> None:
    """Append the files that are new since the last call to a Parquet table.

    The checkpoint remembers what was taken, so a repeated or restarted call
    adds nothing twice. JSON files hold an object per line, or with ``whole_files`` one
    object or array. Texts that are none go to the table ``rejects`` (column
    ``raw``), never as null rows to the main table; without ``rejects`` they end the call with an error.
    """
    json = fmt == "json"

    def source(move: str | None) -> DataFrame:
        options = {"multiLine": str(whole_files).lower(), "columnNameOfCorruptRecord": CORRUPT} if json else {}
        if json and not rejects:
            options["mode"] = "FAILFAST"
        return file_source(spark, landing, landed_schema(schema) if json and rejects else schema, fmt,
                           archive=move, options=options)

    def run(stream: DataFrame, path: str, state: str, columns: Sequence[str]) -> None:
        writer = (stream.writeStream.format("parquet").outputMode("append")
                  .option("checkpointLocation", state).option("path", path).trigger(availableNow=True))
        (writer.partitionBy(*columns) if columns else writer).start().awaitTermination()

    if not (json and rejects):
        run(source(archive), table, checkpoint, partition_by)
        return
    run(source(None).filter(F.col(CORRUPT).isNull()).drop(CORRUPT), table, checkpoint, partition_by)
    # Files are moved after the second reading only.
    n_read = sum((F.col(f"`{c}`").isNotNull().cast("int") for c in schema.fieldNames()), F.lit(0))
    run(source(archive).filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("raw"), n_read.alias("n_fields_read")),
        rejects, f"{checkpoint}-rejects", ())


def take_in_one_pass(spark: SparkSession, landing: str, table: str, checkpoint: str, schema: T.StructType,
                     archive: str | None = None, whole_files: bool = False,
                     max_files_per_trigger: int | None = None) -> StreamingQuery:
    """As ``take_new_files`` for JSON, with readings and rejected texts from one reading of each file.

    A batch is one folder with a partition for each, written by one job; a batch that is replayed overwrites its folder,
    so neither output gets rows twice. ``taken`` and ``rejected`` read them. Returns the ended query.
    """
    stream = file_source(spark, landing, landed_schema(schema), "json", max_files_per_trigger, archive,
                         {"multiLine": str(whole_files).lower(), "columnNameOfCorruptRecord": CORRUPT})

    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("is_rejected", F.col(CORRUPT).isNotNull()).withColumnRenamed(CORRUPT, "raw_text")
         .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("is_rejected")
         .parquet(f"{table}/batch_id={batch_id}"))

    query = (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def _pass_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("raw_text", T.StringType()), T.StructField("batch_id", T.LongType()),
                         T.StructField("is_rejected", T.BooleanType())])


def taken(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """Readings of ``take_in_one_pass``; the folders of rejected texts are not opened."""
    return spark.read.schema(_pass_schema(schema)).parquet(table).filter(~F.col("is_rejected")).select(*schema.fieldNames())


def rejected(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """Texts of ``take_in_one_pass`` that are no readings (``raw``) and their batch."""
    return (spark.read.schema(_pass_schema(schema)).parquet(table).filter("is_rejected")
            .select(F.col("raw_text").alias("raw"), "batch_id"))


def missing_inputs(found: DataFrame, expected: DataFrame, column: str) -> DataFrame:
    """Expected names that were not found."""
    return expected.select(column).join(found.select(column), column, "left_anti")


def files_below(spark: SparkSession, folder: str, suffix: str = "") -> DataFrame:
    """Paths and sizes below a folder, without folder markers."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", f"*{suffix}").load(folder)
            .select("path", "length", "modificationTime").filter(~F.endswith("path", F.lit("/"))))
