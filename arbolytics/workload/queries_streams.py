"""Stream queries, run to the end of the given events, and frequency sketches."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from arbolytics.operators import sketches, space_saving
from arbolytics.operators.ranking import count_per, top_k
from arbolytics.session import fresh_path, stage
from arbolytics.sinks import published
from arbolytics.sinks.messages import document_writer, table_writer
from arbolytics.streaming import aggregates as A
from arbolytics.sources.streams import file_source
from arbolytics.streaming import heavy_hitters as H
from arbolytics.streaming import runner as R
from arbolytics.streaming import supervision
from arbolytics.streaming.parse import parse_readings
from arbolytics.workload import bindings as B
from arbolytics.workload import sql
from arbolytics.workload.registry import query


def _readings(spark, folder, lateness: str | None = A.LATENESS) -> DataFrame:
    return A.with_lateness(parse_readings(B.event_stream(spark, folder)), lateness)


def _update(stream: DataFrame, name: str, keys: list[str]) -> DataFrame:
    spark = stream.sparkSession
    return R.run_update(stream, f"{name}_{fresh_path(spark, 'q')[-12:]}", fresh_path(spark, name),
                        fresh_path(spark, "checkpoint"), keys)


def _append(stream: DataFrame, name: str, folder: str | None = None, checkpoint: str | None = None) -> DataFrame:
    spark = stream.sparkSession
    return R.run_append(stream, name, folder or fresh_path(spark, name),
                        checkpoint or fresh_path(spark, "checkpoint"))


def _tidy(df: DataFrame) -> DataFrame:
    """Window bounds without zone and averages to nine places, for the comparison."""
    out = []
    for f in df.schema:
        c = F.col(f.name)
        if f.name in ("window_start", "window_end"):
            c = c.cast("timestamp_ntz")
        elif f.dataType.simpleString() == "double":
            c = F.round(c, 9)
        out.append(c.alias(f.name))
    return df.select(out)


# Metrics of the events in their roles, as in bindings.event_readings.
VALUE = {"temp": "v", "co": "k", "humidity": "100 - k", "smoke": "k / 100.0", "lpg": "v / 8.0", "rainfall": "v * 2",
         "soil_temp": "v", "soil_humidity": "100 - k", "soil_nitrogen": "v + k", "soil_potassium": "v - k",
         "soil_phosporous": "k * 2", "soil_ph": "k"}


def _windows(keys: str, columns: str, having: str = "", source: str = "er") -> str:
    return f"""SELECT time_bucket(INTERVAL 5 MINUTE, t) AS window_start,
        time_bucket(INTERVAL 5 MINUTE, t) + INTERVAL 5 MINUTE AS window_end{keys}, {columns}
        FROM {source} GROUP BY ALL {having}"""


def _averages(names: dict[str, str]) -> str:
    return ", ".join(f"round(avg({VALUE[m]}), 9) AS {out}" for m, out in names.items())


@query("stream_avg_by_window", f"WITH {sql.EVENT_READINGS} {_windows('', _averages(A.WINDOW_AVERAGES))}")
def stream_avg_by_window(spark, folder):
    plan = A.window_averages(_readings(spark, folder))
    return _tidy(_update(plan, "window_averages", ["window_start", "window_end"]))


@query("stream_avg_by_window_key",
       f"WITH {sql.EVENT_READINGS} {_windows(', species_id', _averages(A.SPECIES_AVERAGES))}")
def stream_avg_by_window_key(spark, folder):
    plan = A.species_averages(_readings(spark, folder))
    return _tidy(_update(plan, "species_averages", ["window_start", "window_end", "species_id"]))


@query("stream_count_by_window_key",
       f"WITH {sql.EVENT_READINGS} {_windows(', device_id AS garden_id', 'count(*) AS count')}")
def stream_count_by_window_key(spark, folder):
    plan = A.garden_counts(_readings(spark, folder))
    return _tidy(_update(plan, "garden_counts", ["window_start", "window_end", "garden_id"]))


@query("stream_sliding_avg", f"""WITH {sql.EVENT_READINGS}, hit AS (
    SELECT time_bucket(INTERVAL 5 MINUTE, t) - i * INTERVAL 5 MINUTE AS window_start, v FROM er, (VALUES (0), (1)) AS s(i))
    SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, round(avg(v), 9) AS average_temperature
    FROM hit GROUP BY window_start""")
def stream_sliding_avg(spark, folder):
    plan = A.window_averages(_readings(spark, folder), {"temp": "average_temperature"}, "10 minutes", "5 minutes")
    return _tidy(_update(plan, "sliding", ["window_start", "window_end"]))


@query("stream_avg_append", f"""WITH {sql.EVENT_READINGS}, w AS ({_windows('', _averages(A.WINDOW_AVERAGES))})
    SELECT * FROM w WHERE window_end <= (SELECT max(t) FROM er) - INTERVAL 5 MINUTE""")
def stream_avg_append(spark, folder):
    return _tidy(_append(A.window_averages(_readings(spark, folder)), "window_averages"))


@query("late_data", f"""WITH {sql.EVENT_READINGS}, mark AS (SELECT max(t) AS newest FROM er),
    taken AS (
      SELECT t FROM er
      UNION ALL SELECT t FROM er, mark
      WHERE time_bucket(INTERVAL 5 MINUTE, t) + INTERVAL 5 MINUTE > newest - INTERVAL 5 MINUTE
      UNION ALL SELECT t + INTERVAL 40 DAY FROM er),
    w AS (SELECT time_bucket(INTERVAL 5 MINUTE, t) AS window_start,
                 time_bucket(INTERVAL 5 MINUTE, t) + INTERVAL 5 MINUTE AS window_end, count(*) AS n FROM taken GROUP BY ALL)
    SELECT w.* FROM w, mark WHERE window_end <= newest + INTERVAL 40 DAY - INTERVAL 5 MINUTE""")
def late_data(spark, folder):
    """All events; then all of them again (late) together with newer ones."""
    events = B.table(spark, folder, "events")
    landing, out, checkpoint = (fresh_path(spark, n) for n in ("landing", "late", "checkpoint"))

    def run() -> DataFrame:
        stream = B.event_messages(spark.readStream.schema(events.schema).parquet(landing))
        counts = A.windowed(A.with_lateness(parse_readings(stream)), [], {"n": F.count(F.lit(1))})
        return _append(counts, "late_counts", out, checkpoint)

    events.write.parquet(landing)
    run()
    newer = events.withColumn("ts", F.col("ts") + F.expr("INTERVAL 40 DAYS"))
    events.unionByName(newer).write.mode("append").parquet(landing)
    return _tidy(run())


@query("stream_documents", f"WITH {sql.EVENT_READINGS}, w AS ({_windows('', 'count(*) AS n')}) "
       "SELECT strftime(window_start, '%Y-%m-%d') AS day, count(*) AS n_windows, sum(n)::BIGINT AS n FROM w GROUP BY 1")
def stream_documents(spark, folder):
    """Window counts as JSON documents, read back and counted per day."""
    counts = A.windowed(_readings(spark, folder), [], {"n": F.count(F.lit(1))})
    out = fresh_path(spark, "documents")
    R.run_to_end(R.start(counts, "documents", fresh_path(spark, "checkpoint"), document_writer(out),
                         available_now=True))
    rows = spark.read.schema("window_start timestamp, window_end timestamp, n bigint, batch_id bigint").json(out)
    newest = rows.groupBy("window_start").agg(F.max_by("n", "batch_id").alias("n"))
    return newest.groupBy(F.date_format("window_start", "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("n_windows"), F.sum("n").alias("n"))


@query("stream_top_k", "SELECT CAST(user_id AS VARCHAR) AS garden_id, count(*) AS count FROM events GROUP BY 1 "
       "ORDER BY count DESC, garden_id LIMIT 3")
def stream_top_k(spark, folder):
    totals = H.running_totals(_readings(spark, folder, None))
    out = fresh_path(spark, "hitters")
    R.run_to_end(R.start(totals, "hitters", fresh_path(spark, "checkpoint"), H.top_k_writer(out), mode="complete",
                         available_now=True))
    rows = spark.read.schema("garden_id string, count bigint, batch_id bigint").json(out)
    newest = rows.groupBy().agg(F.max("batch_id")).scalar()
    return rows.filter(F.col("batch_id") == newest).select("garden_id", "count")


def _cells(source: str, key: str) -> str:
    cell = sql.bucket32(f"\"row\" || '|' || {key}", sketches.WIDTH)
    return (f"cells AS (SELECT {key}, number, \"row\", {cell} AS bucket FROM {source}, "
            f"(SELECT unnest(range({sketches.DEPTH})) AS \"row\"))")


TYPE_COUNTS = "counts AS (SELECT l_partkey, count(*) AS number FROM lineitem GROUP BY l_partkey)"


@query("cms_table", f"WITH {TYPE_COUNTS}, {_cells('counts', 'l_partkey')} "
       "SELECT \"row\"::INTEGER AS \"row\", bucket, sum(number)::BIGINT AS cell FROM cells GROUP BY ALL")
def cms_table(spark, folder):
    return sketches.count_min_table(count_per(B.table(spark, folder, "lineitem"), "l_partkey"), "l_partkey")


@query("cms_estimate", f"""WITH {TYPE_COUNTS}, {_cells('counts', 'l_partkey')},
    sketch AS (SELECT "row", bucket, sum(number)::BIGINT AS cell FROM cells GROUP BY ALL)
    SELECT l_partkey, min(cell) AS estimate FROM cells JOIN sketch USING ("row", bucket) GROUP BY l_partkey""")
def cms_estimate(spark, folder):
    counts = count_per(B.table(spark, folder, "lineitem"), "l_partkey")
    return sketches.count_min_estimates(counts, sketches.count_min_table(counts, "l_partkey"), "l_partkey")


@query("stream_cms_estimate", """WITH counts AS (SELECT CAST(user_id AS VARCHAR) AS garden_id, count(*) AS number FROM events GROUP BY 1), """
       + _cells("counts", "garden_id") + """, sketch AS (SELECT "row", bucket, sum(number)::BIGINT AS cell FROM cells GROUP BY ALL)
    SELECT garden_id, min(cell) AS estimate FROM cells JOIN sketch USING ("row", bucket) GROUP BY garden_id""")
def stream_cms_estimate(spark, folder):
    """The sketch is kept as stream state; gardens are looked up in it at the end."""
    sketch = _update(H.running_sketch(_readings(spark, folder, None)), "sketch", ["row", "bucket"])
    gardens = B.table(spark, folder, "events").select(F.col("user_id").cast("string").alias("garden_id")).distinct()
    return sketches.count_min_estimates(gardens, sketch, "garden_id")


@query("approx_top_k", """SELECT row_number() OVER (ORDER BY number DESC)::INTEGER AS rank, number, true AS is_exact
    FROM (SELECT count(*) AS number FROM events GROUP BY user_id ORDER BY number DESC LIMIT 3)""")
def approx_top_k(spark, folder):
    """The three largest counts, and whether each is its key's true one.

    With fewer keys than are tracked the counts are exact. Keys with equal counts may stand for each
    other, so ranks have counts only.
    """
    events = B.table(spark, folder, "events").select(F.col("user_id").alias("garden_id"))
    top = sketches.approx_top_k(events, "garden_id")
    true = count_per(events, "garden_id", name="true_number")
    # k rows: one window over all of them.
    return top.join(true, "garden_id").select(
        F.row_number().over(Window.orderBy(F.desc("number"))).alias("rank"), "number",
        (F.col("number") == F.col("true_number")).alias("is_exact"))


@query("exact_top_k", "SELECT user_id AS garden_id, count(*) AS number FROM events GROUP BY 1 ORDER BY number DESC, garden_id LIMIT 3")
def exact_top_k(spark, folder):
    events = B.table(spark, folder, "events").select(F.col("user_id").alias("garden_id"))
    return top_k(count_per(events, "garden_id"), "number", 3, "garden_id")


@query("built_in_sketch", f"SELECT count(user_id) AS n_rows, {sketches.DEPTH} AS depth, {sketches.WIDTH} AS width FROM events")
def built_in_sketch(spark, folder):
    """What the head of the binary sketch says: rows taken in, depth and width."""
    def number(at: int, size: int):
        return F.conv(F.hex(F.substring("sketch", at, size)), 16, 10).cast("bigint")

    return sketches.built_in_sketch(B.table(spark, folder, "events"), "user_id").select(
        number(5, 8).alias("n_rows"), number(13, 4).cast("int").alias("depth"), number(17, 4).cast("int").alias("width"))


#: Events that one task reads of a micro-batch.
FILE_ROWS = 100_000


def _readings_in_batches(spark, folder, batches: int = 6) -> DataFrame:
    """All events as readings, in several micro-batches: the events are dealt to files, equally many are taken at a time.

    A file of this size is read by one task, so the files of a batch follow the rows.
    """
    landing, events = fresh_path(spark, "landing"), B.table(spark, folder, "events")
    each = max(1, math.ceil(events.count() / (batches * FILE_ROWS)))
    events.repartition(batches * each, "event_id").write.parquet(landing)
    return parse_readings(B.event_messages(file_source(spark, landing, events.schema, max_files_per_trigger=each)))


def _fold(stream: DataFrame, name: str, writer) -> None:
    R.run_to_end(R.start(stream, name, fresh_path(stream.sparkSession, "checkpoint"), writer, mode="append", available_now=True))


BOUNDED = 100


@query("stream_bounded_top_k", f"""WITH true_counts AS (SELECT CAST(user_id AS VARCHAR) AS garden_id, count(*) AS number FROM events GROUP BY 1)
    SELECT garden_id, number, true AS within_bounds, (SELECT least(count(*), {BOUNDED}) FROM true_counts) AS n_tracked,
           true AS floor_is_bounded FROM true_counts""")
def stream_bounded_top_k(spark, folder):
    """Every garden's true count against the bounds of a summary with a fixed number of counters, kept over micro-batches."""
    state = fresh_path(spark, "summary")
    _fold(_readings_in_batches(spark, folder), "bounded_hitters", H.bounded_hitters_writer(state, fresh_path(spark, "hitters"), capacity=BOUNDED))
    summary = H.newest_state(spark, state)
    events = B.table(spark, folder, "events").select(F.col("user_id").cast("string").alias("garden_id"))
    true_counts = count_per(events, "garden_id")
    head = summary.agg(F.count(F.lit(1)).alias("n_tracked"), F.max("floor").alias("floor")).first()  # one row
    rows = events.count()
    found = true_counts.join(space_saving.bounds(true_counts.select("garden_id"), summary, "garden_id"), "garden_id")
    return found.select("garden_id", "number", F.col("number").between(F.col("at_least"), F.col("at_most")).alias("within_bounds"),
                        F.lit(head.n_tracked).alias("n_tracked"), F.lit(head.floor * (BOUNDED + 1) <= rows).alias("floor_is_bounded"))


@query("sketch_merged", """WITH counts AS (SELECT CAST(user_id AS VARCHAR) AS garden_id, count(*) AS number FROM events GROUP BY 1), """
       + _cells("counts", "garden_id") + """, sketch AS (SELECT "row", bucket, sum(number)::BIGINT AS cell FROM cells GROUP BY ALL)
    SELECT garden_id, min(cell) AS estimate FROM cells JOIN sketch USING ("row", bucket) GROUP BY garden_id""")
def sketch_merged(spark, folder):
    """Binary sketches of micro-batches, merged as state; gardens are looked up in the merged bytes."""
    state = fresh_path(spark, "sketch-state")
    _fold(_readings_in_batches(spark, folder), "sketch_state", H.sketch_writer(state))
    gardens = B.table(spark, folder, "events").select(F.col("user_id").cast("string").alias("garden_id"))
    return sketches.estimates_from(gardens, H.newest_state(spark, state), "garden_id")


WINDOW_KEYS = ["window_start", "window_end"]


@query("compacted_updates", f"""WITH {sql.EVENT_READINGS}, w AS ({_windows('', _averages(A.WINDOW_AVERAGES))})
    SELECT *, true AS few_files FROM w""")
def compacted_updates(spark, folder):
    """Averages written batch by batch, compacted twice on the way; the newest rows, and whether one version is one file."""
    plan = A.window_averages(A.with_lateness(_readings_in_batches(spark, folder), None))
    out, target = fresh_path(spark, "updates"), 64 << 20
    R.run_to_end(R.start(plan, "compacted", fresh_path(spark, "checkpoint"),
                         published.compacting_writer(out, plan.schema, WINDOW_KEYS, every=2, target_bytes=target), available_now=True))
    found = published.manifest(spark, out)
    files = len(spark.read.parquet(f"{out}/{found['table']}").inputFiles())
    size = published.folder_bytes(spark, [f"{out}/{found['table']}"])
    # Two versions of batches may be in sight: what is compacted, and batches since.
    few = found["version"] >= 2 and files <= 1 + 4 * size // target and len(H.batch_folders(spark, out)) <= 4
    return _tidy(published.read_updates(spark, out, plan.schema, WINDOW_KEYS)).withColumn("few_files", F.lit(few))


DAY_LATENESS, HALF = "3 days", "min(t) + (max(t) - min(t)) / 2"


@query("state_after_resume", f"""WITH {sql.EVENT_READINGS}, half AS (SELECT {HALF} AS cut FROM er),
    parts AS (SELECT 1 AS run, t FROM er, half WHERE t <= cut UNION ALL SELECT 2, t FROM er),
    newest AS (SELECT run, max(t) AS t FROM parts GROUP BY run)
    SELECT parts.run::INTEGER AS run, date_trunc('day', parts.t)::TIMESTAMP AS window_start,
           date_trunc('day', parts.t)::TIMESTAMP + INTERVAL 1 DAY AS window_end, count(*) AS n
    FROM parts JOIN newest USING (run) WHERE date_trunc('day', parts.t)::TIMESTAMP + INTERVAL 1 DAY > newest.t - INTERVAL 3 DAY GROUP BY ALL""")
def state_after_resume(spark, folder):
    """The windows that are still open after the first half of the events, and after a resumed run over the rest."""
    events = B.table(spark, folder, "events")
    landing, out, checkpoint = (fresh_path(spark, n) for n in ("landing", "days", "checkpoint"))
    second = F.date_trunc("second", "ts").cast("timestamp")
    first, last = events.select(F.min(second), F.max(second)).first()
    is_first = second <= F.lit(first + (last - first) / 2)
    seen = []
    for run, part in enumerate((events.filter(is_first), events.filter(~is_first)), 1):
        part.write.mode("append").parquet(landing)
        stream = B.event_messages(file_source(spark, landing, events.schema))
        counts = A.windowed(A.with_lateness(parse_readings(stream), DAY_LATENESS), [], {"n": F.count(F.lit(1))}, "1 day", "1 day")
        R.run_append(counts, "days", out, checkpoint)
        state = supervision.open_windows(spark, f"{checkpoint}/days")
        seen.append(stage(state.select(F.lit(run).alias("run"), *WINDOW_KEYS, F.col("count").alias("n")), "state"))
    return _tidy(seen[0].union(seen[1]))


@query("live_feeds", f"""WITH {sql.EVENT_READINGS}, g AS ({_windows(', device_id AS key', 'count(*) AS n')}),
    s AS ({_windows(', species_id AS key', 'count(*) AS n')})
    SELECT 'gardens' AS feed, window_start, key, n, 1 AS restarts FROM g UNION ALL SELECT 'species', window_start, key, n, 0 FROM s""")
def live_feeds(spark, folder):
    """Counts per garden and per species from two feeds at once; the garden feed fails after half a batch and is started again."""
    failed = []

    def fails_once(write):
        def run(batch, batch_id):
            write(batch if failed else batch.limit(1), batch_id)
            if not failed:
                failed.append(batch_id)
                raise RuntimeError("the first batch fails after a part of its rows")
        return run

    n = {"n": F.count(F.lit(1))}
    plans = {"gardens": A.windowed(_readings(spark, folder), ["garden_id"], n), "species": A.windowed(_readings(spark, folder), ["species_id"], n)}
    outs, checkpoint = {name: fresh_path(spark, name) for name in plans}, fresh_path(spark, "checkpoint")
    writers = {"gardens": fails_once(table_writer(outs["gardens"])), "species": table_writer(outs["species"])}
    seen = supervision.supervise({name: (lambda name=name: R.start(plans[name], name, checkpoint, writers[name], available_now=True))
                                  for name in plans})
    rows = []
    for name, key in (("gardens", "garden_id"), ("species", "species_id")):
        newest = R.latest_updates(spark, outs[name], plans[name].schema, [*WINDOW_KEYS, key])
        rows.append(newest.select(F.lit(name).alias("feed"), F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                                  F.col(key).alias("key"), "n", F.lit(seen.restarts[name]).alias("restarts")))
    return rows[0].union(rows[1])
