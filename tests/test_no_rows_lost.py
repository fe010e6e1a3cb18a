"""Cases in which rows, ids or steps used to get lost."""

import json
import os

import pytest
from pyspark.sql import functions as F

from arbolytics import session
from arbolytics.operators.clean import format_readings, format_traits, format_weather
from arbolytics.operators.wide import wide_table, with_run
from arbolytics.plans import features as M
from arbolytics.plans import graph_queries as Q
from arbolytics.plans import model
from arbolytics.plans.graph_build import Graph
from arbolytics.sinks import messages, tables
from arbolytics.sources.schemas import READING
from arbolytics.sources.streams import file_source
from arbolytics.streaming import runner as R
from arbolytics.streaming.parse import parse_checked
from tests import fixtures as X


def small_graph(spark, pairs):
    edges = spark.createDataFrame([(a, b, "T", f"{i:03d}") for i, (a, b) in enumerate(pairs)],
                                  "`:START_ID` string, `:END_ID` string, `:TYPE` string, `:ID` string")
    return Graph({}, {"all": edges}), spark.createDataFrame([("v0",)], "`:ID` string")


def test_chain_of_seven(spark):
    graph, start = small_graph(spark, [(f"v{i}", f"v{i + 1}") for i in range(7)])
    found = {r.vertex: r.hops for r in Q.reachable(graph, start).collect()}
    assert found == {f"v{i}": i for i in range(1, 8)}
    assert {r.vertex for r in Q.reachable(graph, start, max_depth=2).collect()} == {"v1", "v2"}
    paths = [(r.edges.count(",") + 1, r.hops) for r in Q.paths_from(graph, start, 50).collect()]
    assert paths == [(i, i) for i in range(1, 8)]


def test_cycles_end(spark):
    graph, start = small_graph(spark, [("v0", "v1"), ("v1", "v2"), ("v2", "v0"), ("v1", "v1"), ("v2", "v3")])
    assert {r.vertex: r.hops for r in Q.reachable(graph, start).collect()} == {"v0": 3, "v1": 1, "v2": 2, "v3": 3}
    got = [r.edges for r in Q.paths_from(graph, start, 50).collect()]

    def walk(at, taken):
        for i, (a, b) in enumerate([("v0", "v1"), ("v1", "v2"), ("v2", "v0"), ("v1", "v1"), ("v2", "v3")]):
            if a == at and i not in taken:
                yield ",".join(f"{x:03d}" for x in [*taken, i])
                yield from walk(b, [*taken, i])

    assert got == sorted(walk("v0", []))
    assert [r.edges for r in Q.paths_from(graph, start, 3).collect()] == got[:3]


def test_nothing_to_reach(spark):
    graph, _ = small_graph(spark, [("a", "b")])
    start = spark.createDataFrame([("lone",)], "`:ID` string")
    assert Q.reachable(graph, start).count() == 0 and Q.paths_from(graph, start).count() == 0


def test_one_forecast_day_of_many(spark):
    weather = X.weather(spark)
    history = weather.unionByName(weather.withColumn("prediction_date", F.lit("2030-05-03")))
    feeds = format_readings(X.readings(spark)), format_weather(history), format_traits(X.traits(spark))
    one = wide_table(*feeds, forecast_day="2030-05-02")
    assert one.count() == X.wide(spark).count() and wide_table(*feeds).count() == 2 * one.count()


def test_runs_are_not_mixed(spark):
    rows = [("s", "p", "2030-05-01", 4.0, 90.0), ("s", "p", "2030-05-02", 6.0, 10.0),
            ("t", "q", "2030-05-01", 4.0, 10.0), ("t", "q", "2030-05-02", 6.0, 90.0)]
    df = spark.createDataFrame(rows, "iot_sensor_id string, iot_plant_id string, today string, iot_soil_ph double, iot_soil_humidity double")
    assert Q.unhealthy_by_own_events(df).collect() == [("PLANT_q",)]
    assert Q.unhealthy_by_sensor(df, df).collect() == [("PLANT_q",)]


def test_rows_without_a_feature_stay(spark):
    rows = M.with_split(spark.range(400).select(
        F.col("id").alias("k"), F.when(F.col("id") % 40 > 0, (F.col("id") % 20).cast("double")).alias("x"),
        (F.col("id") % 20 > 9).cast("double").alias("plant_status")), ["k"])
    scored = model.score(model.fit(rows, ["x"]), rows, ["x"])
    assert scored.count() == 400 and scored.columns == [*rows.columns, "probability_healthy", "predicted_status"]
    assert scored.filter("predicted_status is null").count() == 10 == scored.filter("x is null").count()
    assert sum(r.n_unscored for r in model.metrics(scored).collect()) == 10
    assert sum(r.n_incomplete for r in model.incomplete_rows(rows, ["x"]).collect()) == 10


def test_unknown_labels_raise(spark):
    rows = spark.createDataFrame([("a", "1"), ("b", "2")], "value_label string, value string")
    with pytest.raises(ValueError, match="b"):
        M.feature_rows(rows, ["a"])
    assert M.feature_rows(rows, ["a", "b"]).count() == 2


def test_rejected_messages_are_a_feed(spark, folder):
    good = {**X.reading_rows()[0]}
    lines = [json.dumps(good), json.dumps({**good, "timestamp": "no time"}), '{"device_id": "cut']
    os.makedirs(f"{folder}/in")
    with open(f"{folder}/in/a.txt", "w") as f:
        f.write("\n".join(lines))
    source = file_source(spark, f"{folder}/in", spark.read.text(f"{folder}/in").schema, "text")
    queries = R.start_analytics(parse_checked(source), f"{folder}/out", f"{folder}/c", available_now=True)
    for q in queries:
        q.awaitTermination()
    rejects = [json.loads(r[0])["raw"] for r in spark.read.text(f"{folder}/out/rejects").select("value").collect()]
    assert sorted(rejects) == sorted(lines[1:])
    assert spark.read.json(f"{folder}/out/garden_counts").select("count").distinct().collect() == [(1,)]


def test_scope_owns_its_folders(spark):
    with session.staging(spark) as outer:
        kept = session.stage(spark.range(3), "a")
        with session.staging(spark) as inner:
            session.stage(spark.range(2), "b")
            assert os.listdir(inner)
        assert not os.path.exists(inner) and kept.count() == 3
    assert not os.path.exists(outer)


def test_latest_date_opens_one_folder(spark, folder):
    from arbolytics.sources import files

    for day in ("2030-05-01", "2030-05-02"):
        tables.write_dated(spark.range(2), f"{folder}/d", day)
    latest = files.read_latest(spark, f"{folder}/d")
    assert {r.ingest_date for r in latest.collect()} == {"2030-05-02"}
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "2030-05-02" in plan.split("PartitionFilters: [")[1].split("]")[0] and plan.count("FileScan") == 1


def test_console_and_preview(spark, folder, capsys):
    tables.preview(spark.range(7), 2)
    shown = capsys.readouterr().out
    assert "id: long" in shown and shown.count("\n|") >= 3
    spark.range(3).write.parquet(f"{folder}/p")
    stream = file_source(spark, f"{folder}/p", spark.range(1).schema)
    query = messages.console(stream).option("checkpointLocation", f"{folder}/c").trigger(availableNow=True).start()
    query.awaitTermination()
    assert query.exception() is None
