import csv
import glob
import itertools
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from arbolytics.operators.quality import unmatched_keys
from arbolytics.operators.wide import wide_table
from arbolytics.operators.clean import format_readings, format_traits, format_weather
from arbolytics.plans import features as M
from arbolytics.plans import graph_queries as Q
from arbolytics.plans.graph_build import Graph, all_edges, all_nodes, build_graph, build_nodes, join_edges, write_graph
from arbolytics.plans.graph_spec import EDGES, node_specs
from arbolytics.sources.schemas import CITY_COORDINATES
from tests import fixtures as X


@pytest.fixture(scope="module")
def rows(spark):
    return X.wide(spark).persist()


@pytest.fixture(scope="module")
def graph(rows):
    g = build_graph(rows)
    return Graph({n: t.persist() for n, t in g.nodes.items()}, {n: t.persist() for n, t in g.edges.items()})


def test_wide_columns_and_lost_city(spark, rows):
    assert len(rows.columns) == 63  # 61 and today, event_id
    lost = unmatched_keys(format_readings(X.readings(spark)), X.weather(spark), "location", "city")
    assert lost.collect() == [("Taragona", 12)]
    fixed = wide_table(format_readings(X.readings(spark)), format_weather(X.weather(spark)),
                       format_traits(X.traits(spark)), {"Taragona": "Tarragona"})
    assert fixed.count() == rows.count() + 12


def test_ends_exist_and_ids_are_unique(graph):
    nodes = {r[0] for r in all_nodes(graph).select(":ID").collect()}
    edges = all_edges(graph).collect()
    assert all(e[":START_ID"] in nodes and e[":END_ID"] in nodes for e in edges)
    assert len({e[":ID"] for e in edges}) == len(edges)
    assert len({(e[":START_ID"], e[":END_ID"]) for e in edges}) == len(edges)
    assert {e[":TYPE"] for e in edges} == {e.type for e in EDGES.values()}


def test_node_counts(rows, graph):
    for name, key in {"garden": "iot_garden_id", "sensor": "iot_sensor_id", "event": "event_id",
                      "plant": "iot_plant_id", "species": "iot_species_id", "location": "weather_city"}.items():
        assert graph.nodes[name].count() == rows.select(key).distinct().count()
    assert graph.nodes["date"].count() == 2
    assert graph.nodes["weather_data"].count() == 6 * 3
    assert graph.nodes["species_data"].count() == 18 * 3
    conflicts = graph.nodes["sensor_data"].groupBy(":ID").count().filter("count > 1").count()
    assert conflicts > 0  # several readings of a plant and sensor on one day share ids


def test_wide_nodes(rows):
    specs = node_specs()
    wide = build_nodes(rows, specs["sensor_data_wide"])
    assert wide.count() == rows.select(*[c for c in wide.columns if c[0] != ":"]).distinct().count()
    assert build_nodes(rows, specs["species_data_wide"]).count() == 3


KEYS = {
    "plant_type": (["iot_plant_id"], ["iot_species_id"], "iot_species_id"),
    "measures": (["iot_sensor_id"], ["iot_plant_id"], "iot_plant_id"),
    "has_plant": (["iot_garden_id"], ["iot_plant_id"], "iot_garden_id"),
    "has_sensor": (["iot_garden_id"], ["iot_sensor_id"], "iot_garden_id"),
    "located_in": (["iot_garden_id"], ["weather_city"], "iot_garden_id"),
}
PREFIX = {"iot_plant_id": "PLANT_", "iot_species_id": "SPECIES_", "iot_sensor_id": "SENSOR_",
          "iot_garden_id": "GARDEN_", "weather_city": "LOCATION_"}


@pytest.mark.parametrize("name", KEYS)
def test_joined_edges_are_the_same(rows, graph, name):
    (start,), (end,), on = KEYS[name]
    left = rows.select(F.concat(F.lit(PREFIX[start]), start).alias(":ID"), on, "event_id")
    right = rows.select(F.concat(F.lit(PREFIX[end]), end).alias(":ID"), on, "event_id")
    joined = join_edges(left, right, {on: on}, EDGES[name].type)
    assert X.rows_of(joined) == X.rows_of(graph.edges[name].select(joined.columns))


def test_null_keys_give_no_edges(spark, rows):
    some = rows.withColumn("iot_plant_id", F.when(F.col("iot_sensor_id") != "aa:00", F.col("iot_plant_id")))
    edges = build_graph(some, stage_keys=False).edges["measures"]
    assert edges.filter(F.col(":START_ID") == "SENSOR_aa:00").count() == 0
    assert edges.filter(F.col(":END_ID").isNull() | F.col(":ID").isNull()).count() == 0


def adjacency(graph):
    out = defaultdict(list)
    for e in all_edges(graph).collect():
        out[e[":START_ID"]].append((e[":END_ID"], e[":ID"]))
    return out


def brute_paths(graph, depth=4):
    """All paths from gardens: (origin, edge ids, end)."""
    out = adjacency(graph)
    level = [(g, (), g) for g in {r[0] for r in graph.nodes["garden"].select(":ID").collect()}]
    for _ in range(depth):
        level = [(o, path + (edge,), nxt) for o, path, at in level for nxt, edge in out[at]]
        yield from level


def test_reachable(graph):
    want = {}
    for origin, path, end in brute_paths(graph):
        want[origin, end] = min(len(path), want.get((origin, end), 9))
    got = {(r.origin, r.vertex): r.hops for r in Q.reachable(graph, graph.nodes["garden"]).collect()}
    assert got == want


def test_first_paths(graph):
    want = sorted((",".join(p), o, e) for o, p, e in brute_paths(graph))
    got = [(r.edges, r.origin, r.vertex) for r in Q.paths_from(graph, graph.nodes["garden"], 40).collect()]
    assert got == want[:40]


def test_two_hops(graph):
    edges = all_edges(graph).collect()
    by_start = defaultdict(list)
    for e in edges:
        by_start[e[":START_ID"]].append(e)
    want = sorted((a[":ID"], b[":ID"]) for a in edges for b in by_start[a[":END_ID"]])
    got = [(r.first_edge, r.second_edge) for r in Q.any_two_hops(graph, 70).collect()]
    assert got == want[:70]
    assert Q.sensor_event_values(graph, 20).count() == 20


def test_self_loop_is_no_second_edge(spark):
    e = spark.createDataFrame([("a", "a", "e1"), ("b", "b", "e2"), ("b", "c", "e3")],
                              "`:START_ID` string, `:END_ID` string, `:ID` string")
    assert [(r.first_edge, r.second_edge) for r in Q.two_hops(e, e, 9).collect()] == [("e2", "e3")]


def test_health_rule_limits(spark, rows):
    """Strict limits: 5, 7 and 60 themselves are fine. Any bad event of a sensor counts for its plants."""
    base = rows.select("iot_sensor_id", "iot_plant_id", "today").limit(0)
    data = [("s1", "p1", 4.9, 59.9), ("s1", "p2", 6.0, 10.0), ("s2", "p3", 5.0, 10.0), ("s3", "p4", 7.0, 10.0),
            ("s4", "p5", 7.1, 60.0), ("s5", "p2", 6.0, 99.0), ("s6", "p6", 8.0, 99.0), ("s6", "p6", 6.0, 20.0)]
    rows = spark.createDataFrame(data, "iot_sensor_id string, iot_plant_id string, iot_soil_ph double, iot_soil_humidity double")
    assert base.columns[0] == rows.columns[0]
    # s6 has its bad pH and its dry soil in two readings of one event.
    assert {r[0] for r in Q.unhealthy_by_sensor(rows, rows).collect()} == {"PLANT_p1", "PLANT_p2", "PLANT_p6"}
    assert {r[0] for r in Q.unhealthy_by_own_events(rows).collect()} == {"PLANT_p1", "PLANT_p6"}


def test_health_by_graph_and_by_rows(rows, graph):
    by_graph = {r[0] for r in Q.unhealthy_plants(graph).collect()}
    assert by_graph == {r[0] for r in Q.unhealthy_by_sensor(rows, rows).collect()}
    events = defaultdict(lambda: [False, False])
    for r in rows.collect():
        events[r.event_id][0] |= r.iot_soil_ph < 5 or r.iot_soil_ph > 7
        events[r.event_id][1] |= r.iot_soil_humidity < 60
    sensors = {r.iot_sensor_id for r in rows.collect() if all(events[r.event_id])}
    assert by_graph == {"PLANT_" + r.iot_plant_id for r in rows.collect() if r.iot_sensor_id in sensors}


def test_counts_and_ties(spark, graph, rows):
    plants = Counter(n for _, n in {(r.iot_plant_id, r.plants_plant_name) for r in rows.collect()})
    want = sorted(plants.items(), key=lambda kv: (-kv[1], kv[0]))[:2]
    assert [tuple(r) for r in Q.top_species(graph, 2).collect()] == want
    assert Q.bottom_species(graph, 1).first()[1] == min(plants.values())
    cities = Q.with_coordinates(Q.gardens_per_city(graph, list(CITY_COORDINATES)), CITY_COORDINATES)
    assert {(r.city, r.garden_number, r.latitude) for r in cities.collect()} == {
        ("Madrid", 1, 40.4168), ("Lleida", 1, 41.6177), ("Girona", 1, 41.9793)}
    assert {r[0] for r in Q.gardens_per_type(graph).collect()} == {"Big Size Garden", "Middle Size Garden"}
    assert Q.sensors_of_garden(graph, "GARDEN_G1").collect() == [("GARDEN_G1", 2)]
    assert Q.nodes_by_label(graph, "Garden", 2).count() == 2
    assert Q.node_labels(graph).count() == 8 + 14 + 6 + 18
    marked = Q.mark_random(Q.all_healthy(graph), 3, 7)
    assert Q.status_totals(marked, "status").first() == (graph.nodes["plant"].count() - 3, 3)
    assert X.rows_of(marked) == X.rows_of(Q.mark_random(Q.all_healthy(graph), 3, 7))


def test_sorted_values(graph):
    texts = sorted(((r.value, r[":ID"]) for r in graph.nodes["sensor_data"].filter(
        F.col(":LABEL") == "iot_temp").collect()), key=lambda t: t[1])
    texts.sort(key=lambda t: t[0], reverse=True)
    got = sorted((r.position, r.value, r[":ID"]) for r in Q.values_sorted(graph, "iot_temp").collect())
    assert got == [(i, *t) for i, t in enumerate(texts)]
    numbers = [float(r.value) for r in Q.values_sorted(graph, "iot_temp", True).orderBy("position").collect()]
    assert numbers == sorted(numbers, reverse=True)


def test_paths_and_counts(rows):
    spec = node_specs()["sensor_data"]
    plants, measured = M.sensor_paths(rows, rows, spec)
    got = Counter((r.plant_id, r.value_label) for r in plants.join(measured, "sensor_id").collect())
    want = Counter()
    data = rows.collect()
    for (s, p) in {(r.iot_sensor_id, r.iot_plant_id) for r in data}:
        for label in spec.values[2:]:
            want["PLANT_" + p, label] += len({(r.event_id, r[label]) for r in data if r.iot_sensor_id == s})
    assert got == want
    assert {(r.plant_id, r.value_label): r.n_paths for r in M.path_counts(rows, rows, spec).collect()} == dict(want)


def test_written_graph(graph, folder):
    write_graph(graph, folder, "2030-05-01")
    files = glob.glob(f"{folder}/*/2030-05-01/*.csv")
    assert len(files) == 11 + 12
    lines = itertools.chain.from_iterable(
        list(csv.reader(open(p)))[1:] for p in glob.glob(f"{folder}/edges/2030-05-01/measures_edges.csv/part*"))
    assert len(list(lines)) == graph.edges["measures"].count()
