"""Published versions, compaction, one-pass intake, supervised feeds, state rows, pruning by a join."""

import os

import pytest
from pyspark.sql import functions as F

from arbolytics.sinks import published as P
from arbolytics.sinks import tables
from arbolytics.sources import files, intake
from arbolytics.streaming import heavy_hitters as H
from arbolytics.streaming import runner as R
from arbolytics.streaming import supervision as S
from arbolytics.workload import bindings as B
from arbolytics.workload import QUERIES

SMALL = "/root/testdata/sf0.001"
UPDATE = "k string, v long"


def batch(spark, rows):
    return spark.createDataFrame(rows, UPDATE)


def schema(spark):
    return batch(spark, []).schema


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_compaction_keeps_the_newest_rows(spark, folder):
    write = R.table_writer(folder)
    assert P.compact(spark, folder, schema(spark), ["k"]) is None
    true = {}
    for n in range(7):
        new = {f"k{i}": 10 * n + i for i in range(n, n + 3)} | {None: n}
        true |= new
        write(batch(spark, list(new.items())), n)
        if n in (2, 3, 5):
            P.compact(spark, folder, schema(spark), ["k"])
        assert {k: v for k, v in rows_of(spark, folder)} == true
    assert P.versions(spark, folder) == [1, 2, 3]
    P.expire(spark, folder, keep=1)
    assert H.batch_folders(spark, folder) == [6]
    assert {k: v for k, v in rows_of(spark, folder)} == true


def rows_of(spark, folder):
    return set(map(tuple, P.read_updates(spark, folder, schema(spark), ["k"]).collect()))


def test_files_follow_bytes(spark, folder):
    for n in range(12):
        batch(spark, [(str(i), n) for i in range(200)]).repartition(8).write.parquet(f"{folder}/batch_id={n}")
    one = P.compact(spark, folder, schema(spark), ["k"])
    assert one["files"] == 1 and len(os.listdir(f"{folder}/{one['table']}")) <= 4  # with checksums and mark
    batch(spark, [("x", 1)]).write.parquet(f"{folder}/batch_id=12")
    many = P.compact(spark, folder, schema(spark), ["k"], target_bytes=1000)
    assert many["files"] > 1 and rows_of(spark, folder) == {(str(i), 11) for i in range(200)} | {("x", 1)}


def test_replay_unfinished_and_old_readers(spark, folder):
    write = P.compacting_writer(folder, schema(spark), ["k"], every=2)
    write(batch(spark, [("a", 1)]), 0)
    write(batch(spark, [("a", 2), ("b", 2)]), 1)
    write(batch(spark, [("a", 2), ("b", 2)]), 1)  # after a failure
    assert P.versions(spark, folder) == [1]
    reader = P.read_updates(spark, folder, schema(spark), ["k"])
    write(batch(spark, [("a", 3)]), 2)
    os.makedirs(f"{folder}/batch_id=9")  # a batch that is not finished
    write(batch(spark, [("c", 4)]), 3)
    assert rows(reader) == [("a", 2), ("b", 2)]
    assert rows_of(spark, folder) == {("a", 3), ("b", 2), ("c", 4)}


def test_two_writers_from_one_version(spark, folder):
    P.publish(spark, folder, 0, {"table": "one"})
    with pytest.raises(Exception, match="(?i)exist"):
        P.publish(spark, folder, 0, {"table": "two"})
    assert P.manifest(spark, folder) == {"table": "one", "version": 1}
    assert [f for f in os.listdir(f"{folder}/{P.VERSIONS}") if f.endswith(".json")] == ["000000001.json"]
    assert P.publish(spark, folder, 1, {"table": "two"}) == 2


def test_gate(spark, folder):
    good = batch(spark, [("a", 1), (None, 2)])
    assert P.read_published(spark, folder, good.schema).count() == 0
    assert P.write_gated(good, folder, ["k"], ["v"])["counts"] == {"rows": 2, "v": 2}
    for bad, why in ((good.limit(0), "0 rows"), (good.drop("v"), "missing columns: v"), (batch(spark, [("a", None)]), "1 nulls in v")):
        with pytest.raises(P.NotPublished, match=why):
            P.write_gated(bad, folder, ["k"], ["v"])
    assert rows(P.read_published(spark, folder, good.schema).select("v")) == [(1,), (2,)]
    assert len([n for n in os.listdir(folder) if n.startswith("table-")]) == 1


def test_gate_of_a_stream(spark, folder):
    batch(spark, [("a", 1), ("a", 2)]).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(UPDATE).parquet(f"{folder}/in").groupBy("k").agg(F.sum("v").alias("v"))

    def run():
        R.run_to_end(R.start(stream, "gated", f"{folder}/c", P.gated_writer(f"{folder}/out", not_null=["v"]), "complete", available_now=True))

    run()
    batch(spark, [("b", None)]).write.mode("append").parquet(f"{folder}/in")
    with pytest.raises(Exception, match="1 nulls in v"):
        run()
    assert rows(P.read_published(spark, f"{folder}/out", stream.schema)) == [("a", 3)]


def test_one_pass_intake(spark, folder):
    landing, table = f"{folder}/in", f"{folder}/out"
    kind = batch(spark, []).schema

    def land(lines):
        spark.createDataFrame([(x,) for x in lines], "line string").coalesce(1).write.mode("append").text(landing)
        return intake.take_in_one_pass(spark, landing, table, f"{folder}/c", kind)

    q = land(['{"k":"a","v":1}', '{"k":"b"', '{"v":7}'])
    assert sum(p.numInputRows for p in q.recentProgress) == 3
    assert sum(p.numInputRows for p in intake.take_in_one_pass(spark, landing, table, f"{folder}/c", kind).recentProgress) == 0
    land(["no object", '{"k":"c","v":"x"}'])
    assert set(map(tuple, intake.taken(spark, table, kind).collect())) == {("a", 1), (None, 7)}
    assert set(map(tuple, intake.rejected(spark, table, kind).collect())) == {('{"k":"b"', 0), ("no object", 1), ('{"k":"c","v":"x"}', 1)}
    plan = intake.taken(spark, table, kind)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(is_rejected" in plan and "raw_text" not in plan.split("ReadSchema")[1]


def test_supervised_feeds(spark, folder):
    batch(spark, [("a", 1)]).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(UPDATE).parquet(f"{folder}/in")
    calls = []

    def writer(name, failures):
        def write(df, n):
            calls.append(name)
            df.write.mode("overwrite").parquet(f"{folder}/{name}/batch_id={n}")
            if calls.count(name) <= failures:
                raise RuntimeError(f"{name} fails")
        return write

    def feeds(**failures):
        return {n: (lambda n=n, w=writer(n, k): R.start(stream, n, f"{folder}/c", w, "append", available_now=True)) for n, k in failures.items()}

    log = S.ProgressLog()
    spark.streams.addListener(log)
    try:
        seen = S.supervise(feeds(steady=0, weak=2))
    finally:
        spark.streams.removeListener(log)
    assert seen.restarts == {"steady": 0, "weak": 2} and all("weak fails" in c for c in seen.causes["weak"])
    for name in seen.restarts:
        assert rows(spark.read.parquet(f"{folder}/{name}")) == [("a", 1, 0)]
    with pytest.raises(Exception, match="broken fails"):
        S.supervise(feeds(broken=9), most_restarts=1)
    assert calls.count("broken") == 2 and not [q for q in spark.streams.active if q.name == "broken"]


def test_join_opens_wanted_partitions_only(spark, folder):
    readings = spark.createDataFrame([(f"{i:02d}", i * n) for i in range(20) for n in range(3)], "garden string, v int")
    tables.write_partitioned(readings, f"{folder}/t", ["garden"])
    spark.createDataFrame([(f"{i:02d}", "x" if i in (3, 17) else "y") for i in range(20)], "garden string, city string").write.parquet(f"{folder}/g")
    gardens = spark.read.parquet(f"{folder}/g").filter("city = 'x'")
    got = files.partitions_of(files.read_table(spark, f"{folder}/t", text_partitions=["garden"]), gardens, "garden")
    assert sorted(r.v for r in got.collect()) == [0, 0, 3, 6, 17, 34]
    assert "dynamicpruningexpression" in got._jdf.queryExecution().executedPlan().toString()


def test_query_of_pruned_scan_prunes(spark):
    got = QUERIES["scan_pruned_by_join"](spark, SMALL)
    assert "dynamicpruningexpression" in got._jdf.queryExecution().executedPlan().toString()


def test_open_windows_of_older_batch(spark, folder):
    events = B.table(spark, SMALL, "events")
    events.limit(50).coalesce(1).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{folder}/in")
    counts = stream.groupBy(F.window("ts", "1 day"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    query = R.start(counts, "days", f"{folder}/c", R.table_writer(f"{folder}/out"), available_now=True)
    R.run_to_end(query)
    state = S.open_windows(spark, f"{folder}/c/days", 0)
    assert state.columns == ["window_start", "window_end", "event_type", "count"]
    assert state.agg(F.sum("count")).first()[0] == 50
