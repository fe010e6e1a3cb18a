"""Node tables, edge tables and graph questions."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F, types as T

from arbolytics.operators.clean import union_by_name
from arbolytics.plans import graph_queries as Q
from arbolytics.plans.graph_build import (
    NODE_TABLES, Graph, LazyTables, build_date_nodes, build_edges, build_graph, build_nodes, distinct_values, graph_path,
    join_edges, raw_keys, stored, value_conflicts, write_graph)
from arbolytics.plans.graph_spec import EDGES
from arbolytics.session import fresh_path, shuffles_dropped, stage
from arbolytics.sources.files import read_csv_by_header
from arbolytics.workload import bindings as B
from arbolytics.workload import sql
from arbolytics.workload.registry import SQL, plain, query

N = sql.NODE_IDS


def _long_nodes(labels: dict[str, str], ids: str, node: str) -> str:
    return sql.over_wide(f"SELECT DISTINCT label, value, {N[node]} AS id FROM ({sql.stacked(labels, ids)})")


NODE_SQL = {
    "garden": f"SELECT DISTINCT garden_id AS iot_garden_id, garden_name AS iot_garden_name, {N['garden']} AS id, 'Garden' AS label FROM wide",
    "sensor": f"SELECT DISTINCT sensor_id AS iot_sensor_id, {N['sensor']} AS id, 'Sensor' AS label FROM wide",
    "event": "SELECT DISTINCT event_id, event_id AS id, 'Event' AS label FROM wide",
    "plant": f"SELECT DISTINCT plant_id AS iot_plant_id, {N['plant']} AS id, 'Plant' AS label FROM wide",
    "species": f"SELECT DISTINCT species_id AS iot_species_id, plant_name AS plants_plant_name, {N['species']} AS id, 'Species' AS label FROM wide",
    "location": f"SELECT DISTINCT city AS weather_city, {N['location']} AS id, 'Location' AS label FROM wide",
    "weather": f"SELECT DISTINCT {N['weather']} AS id, 'WeatherForecast' AS label FROM wide",
}
LONG_SQL = {
    "sensor_data": _long_nodes(sql.SENSOR_LABELS, "sensor_id, event_id", "sensor_data"),
    "weather_data": _long_nodes(sql.FORECAST_LABELS, "city, today", "weather_data"),
    "species_data": _long_nodes(sql.TRAIT_LABELS, "species_id", "species_data"),
}
WIDE_NODE_SQL = {
    "sensor_data_wide": "SELECT DISTINCT sensor_id AS iot_sensor_id, garden_id AS iot_garden_id, plant_id AS iot_plant_id, "
    "event_id, " + ", ".join(f"{m} AS iot_{m}" for m in B.METRICS) +
    f", {sql.uuid_id('SENSORDATA', 'event_id', 'sensor_id')} AS id, 'SensorData' AS label FROM wide",
    "species_data_wide": "SELECT DISTINCT species_id AS iot_species_id, " +
    ", ".join(f"{t} AS plants_{t}" for t in B.TRAITS) +
    ", 'SPECIESDATA_' || species_id AS id, 'SpeciesData' AS label FROM wide",
}


def _register_nodes() -> None:
    # Metric values stand in every reading; all other nodes follow from the distinct keys.
    rows_for = {"sensor_data": B.value_rows, "sensor_data_wide": B.value_rows, "species_data_wide": B.feed_rows}

    def maker(name):
        rows = rows_for.get(name, B.key_rows)
        if name in ("weather_data", "species_data"):  # read off the readings by the product's own plan
            return lambda spark, folder: plain(B.full_graph(spark, folder).nodes[name])
        return lambda spark, folder: plain(build_nodes(rows(spark, folder), B.SPECS[name]))

    for name, body in {**NODE_SQL, **WIDE_NODE_SQL}.items():
        query(f"nodes_{name}", sql.over_wide(body))(maker(name))
    for name, text in LONG_SQL.items():
        query(f"nodes_{name}", text)(maker(name))


def _register_edges() -> None:
    def maker(name):
        return lambda spark, folder: plain(build_edges(B.key_rows(spark, folder), EDGES[name], B.SPECS))

    for name in EDGES:
        query(f"edges_{name}", sql.edge_sql(name))(maker(name))


_register_nodes()
_register_edges()


@query("nodes_date", sql.over_wide(
    "SELECT DISTINCT id, 'Date' AS label FROM (SELECT today AS id FROM wide UNION ALL SELECT prediction_date FROM wide)"))
def nodes_date(spark, folder):
    return plain(build_date_nodes(B.key_rows(spark, folder), B.SPECS))


ID_DIGEST = sql.bucket32("id", 2**32)
WRITTEN = " UNION ALL ".join(
    f"SELECT '{kind}_{name}' AS table_name, count(*) AS n_rows, sum({ID_DIGEST})::BIGINT AS id_digest FROM ({SQL[f'{kind}_{name}']})"
    for kind, names in (("nodes", NODE_TABLES), ("edges", EDGES)) for name in names)


@query("graph_written", WRITTEN)
def graph_written(spark, folder):
    """All 23 tables of one graph in the bulk-load layout, written side by side and read back."""
    root, day = fresh_path(spark, "graph"), B.AS_OF
    with shuffles_dropped(spark):
        graph = B.full_graph(spark, folder)
        write_graph(graph, root, day, compression="gzip")
    digest = F.conv(F.substring(F.md5(":ID"), 1, 8), 16, 10).cast("bigint")
    found = [read_csv_by_header(spark, graph_path(root, kind, day, name), T.StructType.fromDDL("`:ID` string"))
             .agg(F.lit(f"{kind}_{name}").alias("table_name"), F.count(F.lit(1)).alias("n_rows"), F.sum(digest).alias("id_digest"))
             for kind, tables in (("nodes", graph.nodes), ("edges", graph.edges)) for name in tables]
    return union_by_name(found)


@query("edges_joined_nodes", sql.edge_sql("has_plant"))
def edges_joined_nodes(spark, folder):
    """HAS_PLANT from two node frames with helper keys, joined on the garden."""
    keys = stage(B.key_rows(spark, folder).select("iot_garden_id", "iot_plant_id", "iot_sensor_id").distinct(),
                 "garden-keys")
    gardens = keys.withColumn(":ID", F.concat(F.lit("GARDEN_"), "iot_garden_id"))
    plants = keys.withColumn(":ID", F.concat(F.lit("PLANT_"), "iot_plant_id"))
    return plain(join_edges(gardens, plants, {"iot_garden_id": "iot_garden_id"}, "HAS_PLANT"))


@query("id_conflicts", sql.over_wide_ctes(sql.SENSOR_VALUES,
       "SELECT id, count(DISTINCT value) AS n_values FROM sensor_values GROUP BY id HAVING count(DISTINCT value) > 1"))
def find_id_conflicts(spark, folder):
    return plain(value_conflicts(B.value_rows(spark, folder), B.SPECS["sensor_data"]))


COUNTED = ("SELECT plant_name AS plant, count(*) AS number FROM (SELECT DISTINCT plant_id, species_id, plant_name FROM wide) "
           "GROUP BY plant_name")


@query("top_species", sql.over_wide(f"{COUNTED} ORDER BY number DESC, plant LIMIT 3"))
def top_species(spark, folder):
    return Q.top_species(B.graph(spark, folder))


@query("top_species_by_id", sql.over_wide(
    "SELECT 'SPECIES_' || species_id AS plant, count(DISTINCT plant_id) AS number FROM wide GROUP BY 1 "
    "ORDER BY number DESC, plant LIMIT 3"))
def top_species_by_id(spark, folder):
    return Q.top_species(B.graph(spark, folder), by_id=True)


@query("bottom_species", sql.over_wide(f"{COUNTED} ORDER BY number, plant LIMIT 3"))
def bottom_species(spark, folder):
    return Q.bottom_species(B.graph(spark, folder))


CITY_COUNTS = ("SELECT city, count(DISTINCT garden_id) AS garden_number FROM wide "
               "WHERE city IN ('AFRICA', 'AMERICA', 'ASIA') GROUP BY city")


@query("gardens_per_city", sql.over_wide(CITY_COUNTS))
def gardens_per_city(spark, folder):
    return Q.gardens_per_city(B.graph(spark, folder), B.REGIONS)


@query("gardens_per_city_geo", sql.over_wide(
    f"SELECT c.*, latitude, longitude FROM ({CITY_COUNTS}) c JOIN (VALUES " + ", ".join(
        f"('{c}', {a}::DOUBLE, {b}::DOUBLE)" for c, (a, b) in B.COORDINATES.items()) +
    ") AS p(place, latitude, longitude) ON city = place"))
def gardens_per_city_geo(spark, folder):
    return Q.with_coordinates(Q.gardens_per_city(B.graph(spark, folder), B.REGIONS), B.COORDINATES)


@query("map_centre", sql.over_wide(
    f"SELECT avg(latitude) AS latitude, avg(longitude) AS longitude FROM ({CITY_COUNTS}) c JOIN (VALUES " + ", ".join(
        f"('{c}', {a}::DOUBLE, {b}::DOUBLE)" for c, (a, b) in B.COORDINATES.items()) +
    ") AS p(place, latitude, longitude) ON city = place"))
def map_centre(spark, folder):
    return Q.centre_point(gardens_per_city_geo(spark, folder))


@query("sensors_per_garden", sql.over_wide(
    "SELECT 'GARDEN_' || garden_id AS garden, count(DISTINCT sensor_id) AS sensor_count FROM wide GROUP BY 1"))
def sensors_per_garden(spark, folder):
    return Q.sensors_per_garden(B.graph(spark, folder))


@query("sensors_of_garden", sql.over_wide(
    "SELECT 'GARDEN_' || garden_id AS garden, count(DISTINCT sensor_id) AS sensor_count FROM wide "
    "WHERE garden_id = '7' GROUP BY 1"))
def sensors_of_garden(spark, folder):
    return Q.sensors_of_garden(B.graph(spark, folder), "GARDEN_7")


@query("garden_ids", sql.over_wide("SELECT DISTINCT 'GARDEN_' || garden_id AS garden FROM wide"))
def garden_ids(spark, folder):
    return Q.garden_ids(B.graph(spark, folder))


@query("gardens_per_type", sql.over_wide(
    "SELECT garden_name AS garden_type, count(DISTINCT garden_id) AS number FROM wide "
    "WHERE garden_name <> 'NATION_3' GROUP BY 1"))
def gardens_per_type(spark, folder):
    return Q.gardens_per_type(B.graph(spark, folder), leave_out="NATION_3")


@query("plant_species_pairs", sql.over_wide(
    "SELECT DISTINCT 'PLANT_' || plant_id AS plant, 'SPECIES_' || species_id AS species FROM wide"))
def plant_species_pairs(spark, folder):
    return Q.plant_species_pairs(B.graph(spark, folder))


def _two_hops(first: str, second: str, k: int) -> str:
    return (f"SELECT a.start_id AS n, a.id AS first_edge, a.end_id AS s, b.id AS second_edge, b.end_id AS d "
            f"FROM {first} a JOIN {second} b ON a.end_id = b.start_id WHERE a.id <> b.id "
            f"ORDER BY first_edge, second_edge LIMIT {k}")


@query("paths_sensor_event_data", sql.over_edges(
    ["registers", "contains"], _two_hops("e_registers", "e_contains", 200)))
def paths_sensor_event_data(spark, folder):
    return Q.sensor_event_values(B.graph(spark, folder, stage_keys=True), 200)


@query("paths_two_hop", sql.over_edges(list(sql.EDGE_SOURCES), _two_hops("e_all", "e_all", 100),
                                       sql.all_edges_cte()))
def paths_two_hop(spark, folder):
    return Q.any_two_hops(B.graph(spark, folder, stage_keys=True), 100)


@query("described_by_triples", sql.over_edges(
    ["described_by"], "SELECT * FROM e_described_by ORDER BY id LIMIT 100"))
def described_by_triples(spark, folder):
    return plain(Q.first_rows(B.graph(spark, folder).edges["described_by"], 100))


@query("first_gardens", sql.over_wide(
    "SELECT DISTINCT 'GARDEN_' || garden_id AS id, 'Garden' AS label FROM wide ORDER BY id LIMIT 2"))
def first_gardens(spark, folder):
    g = B.graph(spark, folder)
    return plain(Q.first_rows(g.nodes["garden"].select(":ID", ":LABEL"), 2))


@query("one_node", sql.over_wide("SELECT min(id) AS id FROM (SELECT 'PLANT_' || plant_id AS id FROM wide)"))
def one_node(spark, folder):
    return plain(Q.first_rows(B.graph(spark, folder).nodes["plant"], 1).select(":ID"))


@query("reachable_from_garden", sql.over_edges(list(sql.EDGE_SOURCES), """
    SELECT origin, regexp_extract(vertex, '^[A-Z]+_') AS kind, count(*) AS n_vertices, min(hops) AS nearest, max(hops) AS farthest
    FROM (SELECT origin, vertex, min(hops) AS hops FROM r GROUP BY ALL) GROUP BY ALL""",
    sql.all_edges_cte() + """, r AS (
      WITH RECURSIVE walk(origin, vertex, hops) AS (
        SELECT DISTINCT 'GARDEN_' || garden_id, 'GARDEN_' || garden_id, 0 FROM wide
        UNION SELECT origin, end_id, hops + 1 FROM walk JOIN e_all ON start_id = vertex)
      SELECT * FROM walk WHERE hops > 0)"""))
def reachable_from_garden(spark, folder):
    g = B.graph(spark, folder, stage_keys=True)
    found = Q.reachable(g, g.nodes["garden"])
    kind = F.regexp_extract("vertex", "^[A-Z]+_", 0).alias("kind")
    return found.groupBy("origin", kind).agg(
        F.count(F.lit(1)).alias("n_vertices"), F.min("hops").alias("nearest"), F.max("hops").alias("farthest"))


@query("paths_from_garden", sql.over_edges(list(sql.EDGE_SOURCES), """
    SELECT origin, edges, vertex, hops FROM p ORDER BY edges LIMIT 50""",
    sql.all_edges_cte() + """, p AS (
      WITH RECURSIVE walk(origin, vertex, edges, hops) AS (
        SELECT start_id, end_id, id, 1 FROM e_all
        WHERE start_id IN (SELECT DISTINCT 'GARDEN_' || garden_id FROM wide)
        UNION ALL SELECT origin, end_id, edges || ',' || id, hops + 1 FROM walk JOIN e_all ON start_id = vertex
        WHERE NOT list_contains(string_split(edges, ','), id))
      SELECT * FROM walk)"""))
def paths_from_garden(spark, folder):
    g = B.graph(spark, folder, stage_keys=True)
    return Q.paths_from(g, g.nodes["garden"], 50)


BAD_EVENTS = ("bad AS (SELECT event_id FROM wide GROUP BY event_id "
              "HAVING bool_or(soil_ph < 5 OR soil_ph > 7) AND bool_or(soil_humidity < 60))")
UNHEALTHY = (f"{BAD_EVENTS}, unhealthy AS (SELECT DISTINCT plant_id FROM wide WHERE sensor_id IN "
             "(SELECT sensor_id FROM wide JOIN bad USING (event_id)))")


@query("unhealthy_plants", sql.over_wide_ctes(UNHEALTHY, "SELECT 'PLANT_' || plant_id AS plant_id FROM unhealthy"))
def unhealthy_plants(spark, folder):
    with shuffles_dropped(spark):
        rows, keys = B.value_and_key_rows(spark, folder)
        g = build_graph(rows, B.SPECS, keys)
        # The values of the health rule are stored by their short keys, as the edges are.
        values = distinct_values(rows, raw_keys(B.SPECS["sensor_data"].keys), Q.HEALTH_LABELS)
        found = stored(Graph({"sensor_data": values}, {}), ["sensor_data"]).nodes
        return Q.unhealthy_plants(replace(g, node_keys=found))


@query("unhealthy_by_own_events", sql.over_wide_ctes(
    BAD_EVENTS, "SELECT DISTINCT 'PLANT_' || plant_id AS plant_id FROM wide JOIN bad USING (event_id)"))
def unhealthy_by_own_events(spark, folder):
    return Q.unhealthy_by_own_events(B.value_rows(spark, folder))


@query("plant_status", sql.over_wide_ctes(UNHEALTHY, """
    SELECT DISTINCT 'PLANT_' || plant_id AS plant_id,
           CASE WHEN plant_id IN (SELECT plant_id FROM unhealthy) THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS status FROM wide"""))
def plant_status(spark, folder):
    rows, keys = B.value_and_key_rows(spark, folder)
    g = build_graph(rows, B.SPECS, keys, stage_keys=False)
    return Q.plant_status(Q.all_healthy(g), Q.unhealthy_by_sensor(rows, keys))


# Readings with a returned item are the later run: a bad pH of one run and a dry soil of the other are no bad event.
TWO_RUNS = ("bad AS (SELECT DISTINCT sensor_id FROM (SELECT sensor_id, plant_id, light FROM wide GROUP BY ALL "
            "HAVING bool_or(soil_ph < 5 OR soil_ph > 7) AND bool_or(soil_humidity < 60)))")


@query("plant_status_two_runs", sql.over_wide_ctes(TWO_RUNS, """
    SELECT 'PLANT_' || plant_id AS plant_id, CASE WHEN bool_or(sensor_id IN (SELECT sensor_id FROM bad)) THEN 0.0::DOUBLE
           ELSE 1.0::DOUBLE END AS status FROM wide GROUP BY plant_id"""))
def plant_status_two_runs(spark, folder):
    rows, keys = B.value_and_key_rows(spark, folder)
    rows = rows.withColumn("today", F.when(F.col("iot_light"), "1998-12-02").otherwise(F.col("today")))
    g = build_graph(rows, B.SPECS, keys, stage_keys=False)
    return Q.plant_status(Q.all_healthy(g), Q.unhealthy_by_sensor(rows, keys))


@query("all_plants_healthy", sql.over_wide("SELECT DISTINCT 'PLANT_' || plant_id AS plant_id, 1.0::DOUBLE AS status FROM wide"))
def all_plants_healthy(spark, folder):
    return Q.all_healthy(B.graph(spark, folder))


@query("random_plants", sql.over_wide("""SELECT plant_id, CASE WHEN row_number() OVER
    (ORDER BY md5(plant_id || '|42'), plant_id) <= 25 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS status
    FROM (SELECT DISTINCT 'PLANT_' || plant_id AS plant_id FROM wide)"""))
def random_plants(spark, folder):
    return Q.mark_random(Q.all_healthy(B.graph(spark, folder)), 25, 42)


@query("status_totals", sql.over_wide_ctes(UNHEALTHY, """
    SELECT count(*) FILTER (NOT bad) AS healthy, count(*) FILTER (bad) AS unhealthy
    FROM (SELECT DISTINCT plant_id, plant_id IN (SELECT plant_id FROM unhealthy) AS bad FROM wide)"""))
def status_totals(spark, folder):
    return Q.status_totals(plant_status(spark, folder), "status")


def _sorted_values(order: str) -> str:
    return sql.over_wide_ctes(sql.SENSOR_VALUES, f"""
      SELECT value, id, row_number() OVER (ORDER BY {order} DESC, id) - 1 AS position
      FROM (SELECT DISTINCT value, id FROM sensor_values WHERE label = 'iot_soil_humidity')""")


def _value_graph(spark, folder) -> Graph:
    """The sensor value nodes only."""
    rows = B.value_rows(spark, folder)
    return Graph(LazyTables({"sensor_data": lambda: build_nodes(rows, B.SPECS["sensor_data"])}), {})


@query("values_sorted_text", _sorted_values("value"))
def values_sorted_text(spark, folder):
    return plain(Q.values_sorted(_value_graph(spark, folder), "iot_soil_humidity"))


@query("values_sorted_number", _sorted_values("CAST(value AS DOUBLE)"))
def values_sorted_number(spark, folder):
    return plain(Q.values_sorted(_value_graph(spark, folder), "iot_soil_humidity", numeric=True))


@query("node_labels", sql.over_wide(
    "SELECT DISTINCT label FROM (SELECT unnest([" + ", ".join(
        f"'{x}'" for x in ["Garden", "Sensor", "Event", "Plant", "Species", "Location", "WeatherForecast", "Date",
                           *sql.SENSOR_LABELS, *sql.FORECAST_LABELS, *sql.TRAIT_LABELS]) + "]) AS label FROM wide)"))
def node_labels(spark, folder):
    return plain(Q.node_labels(B.full_graph(spark, folder)))


@query("edge_types", sql.over_edges(list(sql.EDGE_SOURCES), "SELECT DISTINCT type FROM e_all", sql.all_edges_cte()))
def edge_types(spark, folder):
    return plain(Q.edge_types(B.graph(spark, folder, stage_keys=True)))


@query("edge_list", sql.over_edges(
    ["measures", "registers", "contains"],
    " UNION ALL ".join(f"SELECT id, start_id AS start_node, end_id AS end_node, type AS lbl FROM e_{n}"
                       for n in ("measures", "registers", "contains"))))
def edge_list(spark, folder):
    return Q.edge_list(B.graph(spark, folder, stage_keys=True))
