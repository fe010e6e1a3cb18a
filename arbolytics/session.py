"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the plans in this package are designed for. Values that depend on the
# cluster (memory, cores, shuffle partitions) belong to the deployment.
SCALE_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str, master: str | None = None,
                  settings: dict[str, str] | None = None, shared: str | None = None) -> SparkSession:
    """A session with the settings above; ``settings`` wins over them.

    ``shared`` names the folder that all executors see (``spark.checkpoint.dir``).
    """
    builder = SparkSession.builder.appName(app_name)
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    if master:
        builder = builder.master(master)
    for key, value in {**SCALE_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="arbolytics-")
    return _LOCAL_FOLDERS[context.applicationId]


_SCOPES: list[str] = []


@contextmanager
def staging(spark: SparkSession) -> Iterator[str]:
    """A scope that owns what is staged in it: its folder goes when the scope ends.

    Write results that must last before the end of the scope, to a folder of your own.
    """
    folder = f"{shared_folder(spark)}/scope-{uuid.uuid4().hex}"
    _SCOPES.append(folder)
    try:
        yield folder
    finally:
        _SCOPES.remove(folder)
        remove_folder(spark, folder)


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Deletes a folder on whatever file system it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the scope's folder, or below the shared folder without a scope."""
    return f"{_SCOPES[-1] if _SCOPES else shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, fixes the row
    placement, and gives the planner the true size: a later join broadcasts the
    table only if the written files are below the session's threshold.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_results(spark: SparkSession, make: Callable[[], dict[str, DataFrame]]) -> dict[str, DataFrame]:
    """Stage the tables that ``make`` plans. What it stages itself goes when they are written."""
    root = fresh_path(spark, "results")
    with staging(spark):
        frames = make()
        for name, df in frames.items():
            df.write.parquet(f"{root}/{name}")
    return {name: spark.read.schema(df.schema).parquet(f"{root}/{name}") for name, df in frames.items()}


def drop_staged(*tables: DataFrame) -> None:
    """Removes staged tables that nothing reads any more, before their scope ends."""
    for df in tables:
        for folder in {path.rsplit("/", 1)[0] for path in df.inputFiles()}:
            remove_folder(df.sparkSession, folder)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go with the action that wrote them, not when the driver next collects garbage.

    For steps that stage what they make, so that no later action reads their shuffles.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def stage_all(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Stage independent tables at the same time."""
    with ThreadPoolExecutor(max_workers=len(frames)) as pool:
        jobs = {name: pool.submit(stage, df, name) for name, df in frames.items()}
        return {name: job.result() for name, job in jobs.items()}
