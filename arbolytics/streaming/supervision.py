"""Several stream queries kept running together, their progress, and what they hold as state."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class ProgressLog(StreamingQueryListener):
    """Rows and batches of each named query, and the errors that ended one."""

    def __init__(self) -> None:
        self.rows: dict[str, int] = defaultdict(int)
        self.batches: dict[str, int] = defaultdict(int)
        self.errors: list[str] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.rows[event.progress.name] += event.progress.numInputRows
        self.batches[event.progress.name] += 1

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.errors.append(event.exception)


@dataclass
class Supervision:
    """How often each feed was started again, and why."""

    restarts: dict[str, int] = field(default_factory=dict)
    causes: dict[str, list[str]] = field(default_factory=lambda: defaultdict(list))


def supervise(feeds: Mapping[str, Callable[[], StreamingQuery]], most_restarts: int = 3, wait: float = 0.2) -> Supervision:
    """Starts all feeds and stays until each has ended by itself.

    A feed that fails is started again by its function, from its checkpoint, while the others go on. After
    ``most_restarts`` failures of one feed the others are stopped and its error is raised.
    """
    seen = Supervision(dict.fromkeys(feeds, 0))
    running = {name: begin() for name, begin in feeds.items()}
    try:
        while running:
            for name, query in list(running.items()):
                try:
                    if query.awaitTermination(wait):
                        del running[name]
                except StreamingQueryException as e:
                    seen.causes[name].append(str(e))
                    if seen.restarts[name] == most_restarts:
                        raise
                    seen.restarts[name] += 1
                    running[name] = feeds[name]()
    finally:
        for query in running.values():
            query.stop()
    return seen


def open_windows(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """State rows of a windowed aggregation after its last batch (or a given one): window bounds, further keys, buffers.

    The checkpoint is only read, so it may be that of a stopped query or of a running one.
    """
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    state = reader.load(checkpoint)
    bounds, *keys = state.schema["key"].dataType.fieldNames()
    return state.select(F.col(f"key.`{bounds}`.start").alias("window_start"), F.col(f"key.`{bounds}`.end").alias("window_end"),
                        *[F.col(f"key.`{k}`") for k in keys], "value.*")
