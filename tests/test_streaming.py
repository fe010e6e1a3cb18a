import datetime as dt
import json
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from arbolytics.operators import sketches, space_saving
from arbolytics.sinks.messages import document_writer
from arbolytics.sources.streams import envelope, file_source
from arbolytics.streaming import aggregates as A
from arbolytics.streaming import heavy_hitters as H
from arbolytics.streaming import runner as R
from arbolytics.streaming.parse import parse_readings
from arbolytics.workload import queries_streams
from tests import fixtures as X

START = dt.datetime(2030, 5, 1, 10)


def send(spark, path, rows):
    """Write (minute, second, garden, species, temp) rows as messages."""
    data = [X.reading("d", f"p{i}", species, (garden, "", ""), i, temp=float(temp), soil_ph=float(temp) / 2,
                      timestamp=(START + dt.timedelta(minutes=m, seconds=s)).strftime("%Y-%m-%d_%H-%M-%S"))
            for i, (m, s, garden, species, temp) in enumerate(rows)]
    from arbolytics.sources.schemas import READING

    df = spark.createDataFrame([tuple(r[c] for c in READING.fieldNames()) for r in data], READING)
    envelope(df).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    return parse_readings(file_source(spark, path, spark.read.parquet(path).schema))


def minute(ts):
    return int((ts.replace(tzinfo=None) - START).total_seconds() // 60)


def test_window_bounds_and_averages(spark, folder):
    send(spark, f"{folder}/in", [(0, 0, "a", "1", 1), (4, 59, "a", "1", 3), (5, 0, "a", "2", 10), (7, 0, "b", "2", 20)])
    readings = A.with_lateness(stream(spark, f"{folder}/in"))
    out = R.run_update(A.window_averages(readings), "w", f"{folder}/w", f"{folder}/c", ["window_start", "window_end"])
    assert {(minute(r.window_start), minute(r.window_end), r.average_temperature) for r in out.collect()} == {
        (0, 5, 2.0), (5, 10, 15.0)}
    batch = A.window_averages(parse_readings(spark.read.parquet(f"{folder}/in")))
    assert X.rows_of(batch.select(sorted(batch.columns))) == X.rows_of(out.select(sorted(batch.columns)))
    species = R.run_update(A.species_averages(readings), "s", f"{folder}/s", f"{folder}/c",
                           ["window_start", "window_end", "species_id"])
    assert {(minute(r.window_start), r.species_id, r.average_soil_ph) for r in species.collect()} == {
        (0, "1", 1.0), (5, "2", 7.5)}


def test_sliding_windows(spark, folder):
    send(spark, f"{folder}/in", [(0, 0, "a", "1", 1), (6, 0, "a", "1", 3)])
    plan = A.window_averages(parse_readings(spark.read.parquet(f"{folder}/in")), {"temp": "t"}, "10 minutes", "5 minutes")
    assert {(minute(r.window_start), r.t) for r in plan.collect()} == {(-5, 1.0), (0, 2.0), (5, 3.0)}


def test_late_rows_are_dropped_and_restart_resumes(spark, folder):
    path, out, check = f"{folder}/in", f"{folder}/out", f"{folder}/c"

    def run():
        plan = A.windowed(A.with_lateness(stream(spark, path)), [], {"n": F.count(F.lit(1))})
        return {minute(r.window_start): r.n for r in R.run_append(plan, "n", out, check).collect()}

    send(spark, path, [(0, 0, "a", "1", 1), (1, 0, "a", "1", 1), (30, 0, "a", "1", 1)])
    assert run() == {0: 2}
    send(spark, path, [(2, 0, "a", "1", 1), (26, 0, "a", "1", 1), (60, 0, "a", "1", 1)])
    # The row of minute 2 is too late; the one of minute 26 is late but in time.
    assert run() == {0: 2, 25: 1, 30: 1}
    assert run() == {0: 2, 25: 1, 30: 1}


def test_documents_are_not_doubled(spark, folder):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "garden_id string, count long")
    write = document_writer(f"{folder}/docs")
    for batch in (0, 1, 1):
        write(df, batch)
    docs = [json.loads(r[0]) for r in spark.read.text(f"{folder}/docs").select("value").collect()]
    assert sorted(d["garden_id"] for d in docs) == ["a", "a", "b", "b"]


def test_top_gardens_with_ties(spark, folder):
    gardens = ["a"] * 3 + ["b"] * 2 + ["c"] * 2 + ["d"] * 2 + ["e"]
    send(spark, f"{folder}/in", [(i, 0, g, "1", 1) for i, g in enumerate(gardens)])
    totals = H.running_totals(stream(spark, f"{folder}/in"))
    R.run_to_end(R.start(totals, "top", f"{folder}/c", H.top_k_writer(f"{folder}/top"), "complete", available_now=True))
    docs = [json.loads(r[0]) for r in spark.read.text(f"{folder}/top").select("value").collect()]
    assert sorted((d["garden_id"], d["count"]) for d in docs) == [("a", 3), ("b", 2), ("c", 2)]


def test_live_feeds_start_together(spark, folder):
    send(spark, f"{folder}/in", [(0, 0, "a", "1", 1), (1, 0, "a", "1", 3)])
    queries = R.start_analytics(stream(spark, f"{folder}/in"), f"{folder}/out", f"{folder}/c", available_now=True)
    for q in queries:
        q.awaitTermination()
    counts = spark.read.json(f"{folder}/out/garden_counts")
    assert counts.select("garden_id", "count").distinct().collect() == [("a", 2)]


def test_sketch_against_counts(spark):
    true = Counter({f"g{i}": i % 9 + 1 for i in range(300)})
    counts = spark.createDataFrame(list(true.items()), "garden string, number long")
    small = sketches.count_min_table(counts, "garden", width=50, depth=3)
    assert small.count() <= 150
    got = {r.garden: r.estimate for r in sketches.count_min_estimates(counts, small, "garden", 50, 3).collect()}
    assert all(got[g] >= n for g, n in true.items())
    cells = defaultdict(int)
    for r in sketches.sketch_cells(counts, "garden", 50, 3).collect():
        cells[r.row, r.bucket] += r.number
    assert {(r.row, r.bucket): r.cell for r in small.collect()} == dict(cells)
    wide = sketches.count_min_table(counts, "garden", width=100_000)
    assert {r.garden: r.estimate for r in sketches.count_min_estimates(counts, wide, "garden", 100_000).collect()} == dict(true)


def test_approximate_top_k(spark):
    rows = spark.createDataFrame([(g,) for g, n in {"a": 9, "b": 7, "c": 5, "d": 1}.items() for _ in range(n)], "g string")
    assert {tuple(r) for r in sketches.approx_top_k(rows, "g").collect()} == {("a", 9), ("b", 7), ("c", 5)}


def counted(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "garden_id string")


def test_summaries_keep_their_bounds(spark):
    """Skewed, even and changing keys, in parts of any size, merged in one go and one after another."""
    for seed, spread in enumerate((3, 40, 400)):
        pick = random.Random(seed)
        parts = [[str(min(int(pick.expovariate(1 / spread)), 99) + shift) for _ in range(pick.randrange(1, 300))] for shift in (0, 0, 30, 0)]
        true = Counter(k for p in parts for k in p)
        capacity = 10
        tables = [space_saving.summary_of(counted(spark, p), "garden_id", capacity).withColumn("part", F.lit(i)) for i, p in enumerate(parts)]
        whole = tables[0].union(tables[1]).union(tables[2]).union(tables[3])
        step = tables[0].drop("part")
        for t in tables[1:]:
            step = space_saving.merged(t.union(step.withColumn("part", F.lit(-1))), "garden_id", "part", capacity)
        for summary in (space_saving.merged(whole, "garden_id", "part", capacity), step):
            rows = summary.collect()
            assert len(rows) == min(capacity, len(true)) and len({r.floor for r in rows}) == 1
            floor = rows[0].floor
            assert floor * (capacity + 1) <= sum(true.values())
            tracked = {r.garden_id: r for r in rows}
            for k, n in true.items():
                assert tracked[k]["count"] - tracked[k].error <= n <= tracked[k]["count"] if k in tracked else n <= floor


def test_summaries_of_odd_tables(spark):
    none = space_saving.summary_of(counted(spark, []), "garden_id", 3)
    assert none.count() == 0
    few = space_saving.summary_of(counted(spark, ["a", None, None]), "garden_id", 3)
    both = space_saving.merged(few.withColumn("p", F.lit(1)).union(none.withColumn("p", F.lit(2))), "garden_id", "p", 3)
    assert sorted((r.garden_id or "", r["count"], r.error, r.floor) for r in both.collect()) == [("", 2, 0, 0), ("a", 1, 0, 0)]
    found = {r.garden_id: (r.tracked, r.at_least, r.at_most) for r in space_saving.bounds(counted(spark, ["a", None, "z"]), both, "garden_id").collect()}
    assert found == {"a": (True, 1, 1), None: (True, 2, 2), "z": (False, 0, 0)}
    assert {r.at_most for r in space_saving.bounds(counted(spark, ["a"]), none, "garden_id").collect()} == {0}


def test_state_is_bounded_and_replays_change_nothing(spark, folder):
    write = H.bounded_hitters_writer(f"{folder}/state", f"{folder}/docs", k=2, capacity=2)
    batches = [["a", "a", "b"], ["c", "c", "c", "a"], ["b"], ["c"]]
    for n, keys in enumerate(batches):
        write(counted(spark, keys), n)
        first = sorted(map(tuple, H.newest_state(spark, f"{folder}/state").collect()))
        write(counted(spark, keys), n)  # after a failure
        assert sorted(map(tuple, H.newest_state(spark, f"{folder}/state").collect())) == first
    assert H.batch_folders(spark, f"{folder}/state") == [2, 3]
    assert [r[0] for r in first] == ["a", "c"] and first[1][1] >= 4
    docs = [json.loads(r[0]) for r in spark.read.text(f"{folder}/docs/batch_id=3").collect()]
    assert docs[0]["garden_id"] == "c" and set(docs[0]) == {"garden_id", "count", "error"}


def test_binary_sketches_merge(spark, folder):
    pick = random.Random(1)
    parts = [[str(pick.randrange(60)) for _ in range(100)] for _ in range(3)]
    write = H.sketch_writer(f"{folder}/state", width=16, depth=3)
    for n, keys in enumerate(parts):
        write(counted(spark, keys), n)
    got = H.newest_state(spark, f"{folder}/state")
    assert len(got.first().sketch) == 8 * 16 * 3
    every = counted(spark, sum(parts, []))
    counts = every.groupBy("garden_id").agg(F.count(F.lit(1)).alias("number"))
    wanted = sketches.count_min_estimates(counts, sketches.count_min_table(counts, "garden_id", width=16, depth=3), "garden_id", 16, 3)
    found = {r.garden_id: r.estimate for r in sketches.estimates_from(every, got, "garden_id", 16, 3).collect()}
    assert found == {r.garden_id: r.estimate for r in wanted.collect()}
    assert any(found[k] > n for k, n in Counter(sum(parts, [])).items())
    none = sketches.merged_sketch(got.limit(0), 16, 3)
    assert {r.estimate for r in sketches.estimates_from(every, none, "garden_id", 16, 3).collect()} == {0}


def test_files_of_a_batch_follow_the_rows(spark, folder, monkeypatch):
    """Six batches, read by as many tasks as the rows need; every event once."""
    events = spark.range(500).select(
        F.col("id").alias("event_id"), (F.col("id") % 7).alias("user_id"), F.lit("a").alias("event_type"),
        F.timestamp_seconds(F.col("id")).alias("ts"), F.lit(1.0).alias("value"), F.lit('{"k": 1}').alias("props"))
    events.write.parquet(f"{folder}/events.parquet")
    monkeypatch.setattr(queries_streams, "FILE_ROWS", 20)
    seen = []
    queries_streams._fold(queries_streams._readings_in_batches(spark, folder), "files",
                          lambda batch, _: seen.append((batch.rdd.getNumPartitions(), batch.count())))
    assert len(seen) == 6 and sum(n for _, n in seen) == 500 and all(parts > 1 for parts, _ in seen)
