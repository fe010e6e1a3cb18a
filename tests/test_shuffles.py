"""What is shuffled and staged: readings and not their values, short keys and not the ids of all edges."""

import glob
import os

from pyspark.sql import functions as F

from __spark_entry__ import queries
from arbolytics.operators import ranking
from arbolytics.operators.quality import id_conflicts
from arbolytics.plans import features as M, graph_build, graph_queries as Q
from arbolytics.plans.graph_build import Graph, all_edges, build_graph, build_nodes, value_conflicts
from arbolytics.plans.graph_spec import node_specs
from arbolytics.workload import queries_features
from tests import fixtures as X


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_readings_are_shuffled_before_they_become_values(spark):
    found = plan(build_nodes(X.wide(spark), node_specs()["sensor_data"]))
    assert found.index("Generate stack") < found.index("Exchange hashpartitioning")
    above = found[:found.index("Generate stack")]
    assert "Exchange" not in above


def test_id_conflicts_shuffles_once(spark):
    nodes = spark.createDataFrame([("a", "1"), ("a", None), ("b", "1"), ("b", "1")], "`:ID` string, value string")
    assert plan(id_conflicts(nodes)).count("Exchange hashpartitioning") == 1
    assert [tuple(r) for r in id_conflicts(nodes).collect()] == [("a", 2)]


def test_two_hops_stage_no_edge_table(spark, monkeypatch):
    graph, sizes = build_graph(X.wide(spark)), []
    n_edges = all_edges(graph).count()
    real = Q.stage

    def counted(df, name):
        out = real(df, name)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(Q, "stage", counted)
    found = [tuple(r) for r in Q.any_two_hops(graph, 1).collect()]
    assert len(found) == 1 and max(sizes) < n_edges
    monkeypatch.setattr(Q, "MOST_TRIED", 0)  # all edges joined
    assert [tuple(r) for r in Q.any_two_hops(graph, 1).collect()] == found


def test_two_hops_behind_many_dead_ends(spark):
    rows = [(f"e{i:03d}", "a", f"end{i}") for i in range(40)] + [("f1", "a", "b"), ("f2", "b", "c")]
    edges = spark.createDataFrame(rows, "`:ID` string, `:START_ID` string, `:END_ID` string")
    assert [(r.first_edge, r.second_edge) for r in Q.two_hops(edges, edges, 1).collect()] == [("f1", "f2")]


def test_unhealthy_plants_store_no_edges(spark, monkeypatch):
    names, real = [], graph_build.stage_all
    monkeypatch.setattr(graph_build, "stage_all", lambda frames: names.extend(frames) or real(frames))
    queries()["unhealthy_plants"](spark, "/root/testdata/sf0.001").count()
    assert names == ["node-sensor_data"]


def staged_columns(monkeypatch, *modules):
    found = []
    for module in modules:
        real = module.stage
        monkeypatch.setattr(module, "stage", lambda df, name, real=real: found.append((name, df.columns)) or real(df, name))
    return found


def test_scaled_rows_are_staged_without_ids(spark, monkeypatch):
    found = staged_columns(monkeypatch, queries_features)
    assert queries()["minmax_scaled"](spark, "/root/testdata/sf0.001").columns[:3] == ["plant_id", "sensor_id", "sdid"]
    staged = dict(found)
    assert not {"sdid", "event_id"} & set(staged["training"])
    assert staged["training-keys"] == ["iot_sensor_id", "iot_plant_id"]


def test_reach_stages_short_keys(spark, monkeypatch):
    graph = build_graph(X.wide(spark))
    start = graph.nodes["garden"]
    rows = lambda g: sorted(tuple(r) for r in Q.reachable(g, start).collect())
    expected = rows(Graph(graph.nodes, graph.edges))
    names, real = [], Q.stage_all
    monkeypatch.setattr(Q, "stage_all", lambda frames: [names.extend(df.columns) for df in frames.values()] and real(frames))
    found = staged_columns(monkeypatch, Q)
    assert rows(graph) == expected
    assert [columns for _, columns in found] == [["_id"]] and names
    assert not {"at", "next", "event_id", "_label"} & set(names)
    two = sorted(tuple(r) for r in Q.reachable(graph, start, max_depth=2).collect())
    assert two == [r for r in expected if r[2] <= 2]


def test_the_sample_is_picked_from_stored_plants(spark, monkeypatch):
    read, real = {}, queries_features.stage

    def seen(df, name):
        read[name] = {f.split("/")[-2].rsplit("-", 1)[0] for f in df.inputFiles()}
        return real(df, name)

    monkeypatch.setattr(queries_features, "stage", seen)
    monkeypatch.setattr(queries_features.B, "value_and_key_rows", lambda *_: (X.wide(spark), X.wide(spark)))
    rows, _ = queries_features._labelled(spark, "")
    assert read["model-rows"] == {"model-labelled"} and rows.count() > 0


def two_runs(spark):
    """Wide rows of two runs: a plant and sensor have several events, whose rows take turns in the order of their ids."""
    rows = X.wide(spark)
    return rows.unionByName(rows.filter("iot_sensor_id <> 'aa:00'").withColumn("today", F.lit("2030-05-09")).withColumn("iot_temp", F.col("iot_temp") + 1))


def test_indexes_number_events_and_not_values(spark, monkeypatch):
    rows, spec = two_runs(spark), node_specs()["sensor_data"]
    status = Q.all_healthy(build_graph(rows))
    values = M.training_values(rows, spec, status)
    sizes = []
    for module in (ranking, M):
        real = module.stage
        monkeypatch.setattr(module, "stage", lambda df, name, real=real: sizes.append(df.count()) or real(df, name))
    index = M.key_index(M.numbered_values(values, spec), spec)
    n_events = rows.select("iot_sensor_id", "today", "iot_plant_id").distinct().count()
    assert sizes and max(sizes) == n_events < values.count()
    monkeypatch.undo()
    by_ids = M.vertex_index(M.numbered_rows(M.with_row_ids(values, spec)))
    assert X.rows_of(M.vertex_index_of_keys(index, spec)) == X.rows_of(by_ids)


def test_unhealthy_plants_join_no_ids(spark):
    found = plan(queries()["unhealthy_plants"](spark, "/root/testdata/sf0.001"))
    assert "sha1" not in found


def test_conflicts_are_found_before_ids_are_hashed(spark):
    rows = X.wide(spark)
    rows = rows.unionByName(rows.withColumn("iot_sensor_id", F.lit(None).cast("string")))
    spec = node_specs()["sensor_data"]
    found = value_conflicts(rows, spec)
    lines = plan(found)
    assert lines.index("sha1") < lines.index("HashAggregate")  # the ids are made by the topmost step
    assert lines.count("sha1") and "sha1" not in lines[lines.index("HashAggregate"):]
    assert X.rows_of(found) == X.rows_of(id_conflicts(build_nodes(rows, spec)))
    assert found.filter("`:ID` IS NULL").count() == 1


def test_written_graph_is_compressed(spark, monkeypatch):
    """Wide rows are staged without ids, and the tables are written as gzip."""
    from arbolytics.workload import bindings, queries_graph

    columns, real, paths = [], bindings.stage, []
    monkeypatch.setattr(bindings, "stage", lambda df, name: columns.extend(df.columns) or real(df, name))
    reader = queries_graph.read_csv_by_header
    monkeypatch.setattr(queries_graph, "read_csv_by_header", lambda s, path, schema: paths.append(path) or reader(s, path, schema))
    assert queries()["graph_written"](spark, "/root/testdata/sf0.001").count() == 23
    assert columns and "event_id" not in columns
    assert len(paths) == 23 and all(glob.glob(f"{p}/part-*.csv.gz") for p in paths)


def test_only_the_training_rows_stay(spark, scope):
    rows = queries()["one_hot"](spark, "/root/testdata/sf0.001")
    left = {name.rsplit("-", 1)[0] for name in os.listdir(scope) if name.startswith("training")}
    assert left == {"training"} and rows.count() > 0
