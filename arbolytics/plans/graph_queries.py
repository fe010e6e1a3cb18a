"""Questions on the graph as joins and aggregates over its tables.

Rows are counted or flagged per vertex before they meet another table, so a
vertex with many edges is one row in the join that follows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from arbolytics.functions.ids import prefixed_id
from arbolytics.functions.scalars import to_double
from arbolytics.operators.ranking import bottom_k, count_per, number_rows, random_k, top_k
from arbolytics.plans.graph_build import Graph, add_event_id, all_edges, all_nodes, node_id, raw_keys
from arbolytics.plans.graph_spec import EDGES, NodeSpec
from arbolytics.session import stage, stage_all


def out_counts(edges: DataFrame, name: str = "number") -> DataFrame:
    return count_per(edges, ":START_ID", name=name)


def in_counts(edges: DataFrame, name: str = "number") -> DataFrame:
    return count_per(edges, ":END_ID", name=name)


def plants_per_species(graph: Graph) -> DataFrame:
    """Plants by species name; species that share a name are added up."""
    counted = in_counts(graph.edges["plant_type"])
    species = graph.nodes["species"].select(F.col(":ID").alias(":END_ID"), "plants_plant_name")
    return (counted.join(species, ":END_ID").groupBy(F.col("plants_plant_name").alias("plant"))
            .agg(F.sum("number").alias("number")))


def plants_per_species_id(graph: Graph) -> DataFrame:
    return in_counts(graph.edges["plant_type"]).withColumnRenamed(":END_ID", "plant")


def top_species(graph: Graph, k: int = 3, by_id: bool = False) -> DataFrame:
    counts = plants_per_species_id(graph) if by_id else plants_per_species(graph)
    return top_k(counts, "number", k, "plant")


def bottom_species(graph: Graph, k: int = 3) -> DataFrame:
    return bottom_k(plants_per_species(graph), "number", k, "plant")


def gardens_per_city(graph: Graph, cities: Sequence[str]) -> DataFrame:
    wanted = graph.nodes["location"].filter(F.col("weather_city").isin(list(cities)))
    return (in_counts(graph.edges["located_in"], "garden_number")
            .join(wanted.select(F.col(":ID").alias(":END_ID"), "weather_city"), ":END_ID")
            .groupBy(F.col("weather_city").alias("city"))
            .agg(F.sum("garden_number").alias("garden_number")))


def with_coordinates(city_counts: DataFrame, places: dict[str, tuple[float, float]],
                     city: str = "city") -> DataFrame:
    """Latitude and longitude from a fixed list of places."""
    def lookup(i: int):
        pairs = [F.lit(x) for name, at in places.items() for x in (name, at[i])]
        return F.try_element_at(F.create_map(*pairs), F.col(city))

    return city_counts.withColumns({"latitude": lookup(0), "longitude": lookup(1)})


def centre_point(located: DataFrame) -> DataFrame:
    return located.agg(F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude"))


def sensors_per_garden(graph: Graph) -> DataFrame:
    return out_counts(graph.edges["has_sensor"], "sensor_count").withColumnRenamed(
        ":START_ID", "garden")


def sensors_of_garden(graph: Graph, garden_id: str) -> DataFrame:
    """The count for one garden; the filter reaches the edges before they are counted."""
    return sensors_per_garden(graph).filter(F.col("garden") == garden_id)


def garden_ids(graph: Graph) -> DataFrame:
    return graph.edges["has_sensor"].select(F.col(":START_ID").alias("garden")).distinct()


def gardens_per_type(graph: Graph, leave_out: str | None = "None") -> DataFrame:
    counts = count_per(graph.nodes["garden"].withColumnRenamed("iot_garden_name", "garden_type"),
                       "garden_type")
    return counts.filter(F.col("garden_type") != leave_out) if leave_out is not None else counts


def plant_species_pairs(graph: Graph) -> DataFrame:
    return graph.edges["plant_type"].select(
        F.col(":START_ID").alias("plant"), F.col(":END_ID").alias("species"))


def first_rows(table: DataFrame, k: int, key: str = ":ID") -> DataFrame:
    """The first k rows by id."""
    return table.orderBy(key).limit(k)


def nodes_by_label(graph: Graph, label: str, k: int | None = None) -> DataFrame:
    nodes = all_nodes(graph).filter(F.col(":LABEL") == label).distinct()
    return first_rows(nodes, k) if k else nodes


def node_labels(graph: Graph) -> DataFrame:
    return all_nodes(graph).select(":LABEL").distinct()


def edge_types(graph: Graph) -> DataFrame:
    return all_edges(graph).select(":TYPE").distinct()


#: The edges that are listed as features.
LISTED = ("measures", "registers", "contains")


def edge_list(graph: Graph, names: Sequence[str] = LISTED) -> DataFrame:
    """Edges of the given types as id, start_node, end_node, lbl."""
    parts = [graph.edges[n].select(
        F.col(":ID").alias("id"), F.col(":START_ID").alias("start_node"),
        F.col(":END_ID").alias("end_node"), F.col(":TYPE").alias("lbl")) for n in names]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


#: The first edges by id among which those that go on are looked for before all edges are joined: so many times k, then more.
FEW, MORE, MOST_TRIED = 16, 16, 100_000


def two_hops(first: DataFrame, second: DataFrame, k: int) -> DataFrame:
    """The first k paths of two different edges, ordered by the edges' ids.

    Only the continuations of the k smallest first edges that go on are formed. Both tables are read several times
    and not staged: edges of staged keys (see ``build_graph``) are shorter than their ids.
    """
    e1 = first.select(F.col(":ID").alias("first_edge"), F.col(":START_ID").alias("n"),
                      F.col(":END_ID").alias("s"))
    e2 = second.select(F.col(":ID").alias("second_edge"), F.col(":START_ID").alias("s"),
                       F.col(":END_ID").alias("d"))
    # picked has at most k rows, so the broadcast is bounded. The planner puts the semi join before the hashing of the ids.
    picked = _first_that_go_on(e1, e2, k)
    e2 = e2.join(F.broadcast(picked.select("s").distinct()), "s", "left_semi")
    return (e2.join(F.broadcast(picked), "s").filter("first_edge <> second_edge")
            .select("n", "first_edge", "s", "second_edge", "d")
            .orderBy("first_edge", "second_edge").limit(k))


def _first_that_go_on(e1: DataFrame, e2: DataFrame, k: int) -> DataFrame:
    """The k first edges by id that have a continuation, staged.

    They are looked for among the first edges, then among more. If these do not hold k, all edges are joined.
    """
    def going_on(edges: DataFrame, onward: DataFrame) -> DataFrame:
        goes_on = onward.groupBy("s").agg(F.count(F.lit(1)).alias("n_on"))
        # Only an edge from a vertex to itself can be its own continuation.
        return stage(edges.join(goes_on, "s").filter((F.col("n") != F.col("s")) | (F.col("n_on") > 1))
                     .drop("n_on").orderBy("first_edge").limit(k), "hops-picked")

    many = FEW * k
    while many <= MOST_TRIED:
        some = stage(e1.orderBy("first_edge").limit(many), "hops-tried")
        picked = going_on(some, e2.select("s").join(F.broadcast(some.select("s").distinct()), "s"))
        if picked.count() == k or some.count() < many:
            return picked
        many *= MORE
    return going_on(e1, e2)


def sensor_event_values(graph: Graph, k: int = 200) -> DataFrame:
    return two_hops(graph.edges["registers"], graph.edges["contains"], k)


def any_two_hops(graph: Graph, k: int = 100) -> DataFrame:
    edges = all_edges(graph)
    return two_hops(edges, edges, k)


def reachable(graph: Graph, start: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Vertices reachable from each start vertex, with the least number of hops.

    Set based: each step keeps distinct (start, vertex) pairs that no earlier step found,
    never paths, so cycles end by themselves and a vertex is expanded once. It ends
    when a step finds nothing new, or at ``max_depth`` if the caller sets one. Every step is staged.
    Vertices of a graph with staged edge keys are told apart by their kind and short keys; ids are hashed once, at the end.
    """
    if graph.edge_keys:
        return _reachable_by_keys(graph, start, max_depth)
    edges = stage(all_edges(graph).select(
        F.col(":START_ID").alias("at"), F.col(":END_ID").alias("next")).distinct(), "reach-edges")
    frontier = start.select(F.col(":ID").alias("origin"), F.col(":ID").alias("at")).distinct()
    found, depth = None, 0
    while max_depth is None or depth < max_depth:
        depth += 1
        step = frontier.join(edges, "at").select("origin", F.col("next").alias("at")).distinct()
        if found is not None:
            step = step.join(found.select("origin", "at"), ["origin", "at"], "left_anti")
        frontier = stage(step, "reach-step")
        level = frontier.withColumn("hops", F.lit(depth))
        found = level if found is None else found.unionByName(level)
        if frontier.isEmpty():
            break
    return found.select("origin", F.col("at").alias("vertex"), "hops")


#: Date nodes are copies of one text, whichever key it comes from.
DATE = NodeSpec("date", "Date", "", ("date",), "copy")


def _reachable_by_keys(graph: Graph, start: DataFrame, max_depth: int | None) -> DataFrame:
    """``reachable`` on short keys. An edge to values leads to all of an event's, city's or species' values at once, so these
    are one row until the end."""
    def kind(node: str) -> NodeSpec:
        spec = graph.specs[node]
        return DATE if spec.kind == "copy" and spec.keys != ("event_id",) else spec

    def keys_of(rows: DataFrame, node: str, *also: str) -> DataFrame:
        """The node's keys under the names of its kind."""
        named = zip(raw_keys(kind(node).keys), raw_keys(graph.specs[node].keys), strict=True)
        return rows.select(*also, *[F.col(key).alias(name) for name, key in named])

    def ids(rows: DataFrame, spec: NodeSpec, label: Column | None = None) -> DataFrame:
        return add_event_id(rows, spec.keys).withColumn("_id", node_id(spec, label))

    starts = stage(start.select(F.col(":ID").alias("_id")).distinct(), "reach-start")
    frontier, found, depth = {}, {}, 0
    for node in dict.fromkeys(e.start for e in EDGES.values()):
        rows = _together([keys_of(graph.edge_keys[n], node) for n, e in EDGES.items() if e.start == node]).distinct()
        frontier[kind(node).name] = ids(rows, kind(node)).join(starts, "_id", "left_semi").select(F.col("_id").alias("origin"), *rows.columns)
    frontier = _not_empty(stage_all({f"reach-{n}": rows for n, rows in frontier.items()}))
    while frontier and (max_depth is None or depth < max_depth):
        depth += 1
        steps: dict[str, list[DataFrame]] = {}
        for name, edge in EDGES.items():
            if kind(edge.start).name in frontier:
                at = frontier[kind(edge.start).name]
                onward = graph.edge_keys[name].join(at, raw_keys(graph.specs[edge.start].keys))
                steps.setdefault(kind(edge.end).name, []).append(keys_of(onward, edge.end, "origin"))
        new = {}
        for name, parts in steps.items():
            new[f"reach-{name}"] = _together(parts).distinct()
            for _, before in found.get(name, []):
                new[f"reach-{name}"] = new[f"reach-{name}"].join(before, before.columns, "left_anti")
        frontier = _not_empty(stage_all(new)) if new else {}
        for name, rows in frontier.items():
            found.setdefault(name, []).append((depth, rows))
    kinds = {kind(n).name: kind(n) for e in EDGES.values() for n in (e.start, e.end)}
    out = starts.limit(0).select(F.col("_id").alias("origin"), F.col("_id").alias("vertex"), F.lit(0).alias("hops"))
    for name, levels in found.items():
        spec = kinds[name]
        rows = _together([rows.withColumn("hops", F.lit(hops)) for hops, rows in levels])
        if spec.values:
            rows = rows.select("*", F.explode(F.array(*[F.lit(v) for v in spec.values])).alias("_label"))
        out = out.union(ids(rows, spec, F.col("_label") if spec.values else None).select("origin", F.col("_id").alias("vertex"), "hops"))
    return out


def _together(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _not_empty(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name.removeprefix("reach-"): rows for name, rows in tables.items() if not rows.isEmpty()}


def paths_from(graph: Graph, start: DataFrame, k: int = 50, max_depth: int | None = None) -> DataFrame:
    """The first k paths from the start vertices, ordered by their edges' ids.

    A path takes each edge once, so cycles end. A path sorts right after its own beginnings:
    what continues a path that is not among the first k is not among them either. So only
    the paths of the last step that are among the first k so far go on, and it ends when there
    are none (or at ``max_depth`` if the caller sets one). The edges are read at each step (see ``build_graph``).
    """
    edges = all_edges(graph).select(
        F.col(":START_ID").alias("at"), F.col(":END_ID").alias("next"), F.col(":ID").alias("edge"))
    # Staged, so that few start vertices are broadcast.
    frontier = stage(start.select(F.col(":ID").alias("origin"), F.col(":ID").alias("at"),
                                  F.array().cast("array<string>").alias("taken")).distinct(), "path-start")
    best, depth = None, 0
    while max_depth is None or depth < max_depth:
        depth += 1
        # From the second step on the frontier has at most k rows.
        side = (lambda rows: rows) if depth == 1 else F.broadcast
        # The planner puts the semi join before the hashing of the ids.
        onward = edges.join(side(frontier.select("at").distinct()), "at", "left_semi")
        longer = (onward.join(side(frontier), "at").filter(~F.array_contains("taken", F.col("edge")))
                  .select("origin", F.col("next").alias("at"), F.array_append("taken", F.col("edge")).alias("taken"))
                  .withColumns({"edges": F.array_join("taken", ","), "hops": F.lit(depth)}))
        found = longer if best is None else best.unionByName(longer)
        best = stage(found.orderBy("edges", "origin").limit(k), "path-step")
        frontier = best.filter(F.col("hops") == depth).select("origin", "at", "taken")
        if frontier.isEmpty():
            break
    return best.select("origin", "edges", F.col("at").alias("vertex"), "hops").orderBy("edges").limit(k)


def values_sorted(graph: Graph, label: str, numeric: bool = False) -> DataFrame:
    """Values of one label, greatest first: as text, or as numbers."""
    nodes = graph.nodes["sensor_data"].filter(F.col(":LABEL") == label).select("value", ":ID")
    order = F.col("value")
    if numeric:
        order = to_double(order)
    return number_rows(nodes, [order.desc(), F.col(":ID").asc()], "position")


# Limits of the health rule; all comparisons are strict.
PH_LOW, PH_HIGH, HUMIDITY_LIMIT = 5.0, 7.0, 60.0


#: The labels that the health rule judges.
HEALTH_LABELS = ("iot_soil_ph", "iot_soil_humidity")


def bad_events(values: DataFrame, *event: str) -> DataFrame:
    """Events with a pH outside the limits and a soil humidity below its limit.

    ``values`` is long: the columns of an event (``event_id``), ``:LABEL`` and ``value`` as text. An
    event may hold several values; one of each kind is enough.
    """
    event = event or ("event_id",)
    number = to_double(F.col("value"))
    is_ph = F.col(":LABEL") == "iot_soil_ph"
    is_humidity = F.col(":LABEL") == "iot_soil_humidity"
    return (values.filter(is_ph | is_humidity).groupBy(*event)
            .agg(F.max(is_ph & ((number < PH_LOW) | (number > PH_HIGH))).alias("bad_ph"),
                 F.max(is_humidity & (number < HUMIDITY_LIMIT)).alias("dry"))
            .filter("bad_ph AND dry").select(*event))


def unhealthy_plants(graph: Graph) -> DataFrame:
    """Plants measured by a sensor that registered a bad event.

    Events are reduced to one flag per sensor before plants are joined, so a
    sensor with many events and plants costs their sum and not their product. A graph with staged edge keys and the
    values by short keys is joined by these.
    """
    if graph.edge_keys and "sensor_data" in graph.node_keys:
        return _unhealthy_by_keys(graph)
    contains = graph.edges["contains"].select(
        F.col(":START_ID").alias("event_id"), F.col(":END_ID").alias(":ID"))
    wanted = graph.nodes["sensor_data"].filter(
        F.col(":LABEL").isin(*HEALTH_LABELS))
    events = bad_events(wanted.join(contains, ":ID"))
    sensors = (graph.edges["registers"]
               .join(events.select(F.col("event_id").alias(":END_ID")), ":END_ID", "left_semi")
               .select(":START_ID").distinct())
    return (graph.edges["measures"].join(sensors, ":START_ID", "left_semi")
            .select(F.col(":END_ID").alias("plant_id")).distinct())


def _unhealthy_by_keys(graph: Graph) -> DataFrame:
    """``unhealthy_plants`` on short keys. The values of an event are judged before they meet the edges; only plants get ids."""
    def keys_of(node: str) -> list[str]:
        return raw_keys(graph.specs[node].keys)

    events = bad_events(graph.node_keys["sensor_data"], *keys_of("sensor_data"))
    events = events.join(graph.edge_keys["contains"], keys_of("sensor_data"), "left_semi")
    sensors = graph.edge_keys["registers"].join(events, keys_of("event"), "left_semi").select(*keys_of("sensor")).distinct()
    plants = graph.edge_keys["measures"].join(sensors, keys_of("sensor"), "left_semi").select(*keys_of("plant")).distinct()
    return plants.select(node_id(graph.specs["plant"]).alias("plant_id"))


def _flagged_pairs(rows: DataFrame) -> DataFrame:
    """Sensor and plant pairs with a bad event, from the wide rows.

    An event is a pair in one run: values of different runs are not mixed. Rows without
    a run date are of one run.
    """
    ph, humidity = F.col("iot_soil_ph"), F.col("iot_soil_humidity")
    run = [c for c in ("today",) if c in rows.columns]
    return (rows.groupBy("iot_sensor_id", "iot_plant_id", *run)
            .agg(F.max((ph < PH_LOW) | (ph > PH_HIGH)).alias("bad_ph"),
                 F.max(humidity < HUMIDITY_LIMIT).alias("dry"))
            .filter("bad_ph AND dry").select("iot_sensor_id", "iot_plant_id").distinct())


def _plant_ids(pairs: DataFrame) -> DataFrame:
    return pairs.select("iot_plant_id").distinct().select(
        prefixed_id("PLANT", "iot_plant_id").alias("plant_id"))


def unhealthy_by_sensor(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``unhealthy_plants`` straight from the wide rows and their keys, without id joins."""
    sensors = _flagged_pairs(rows).select("iot_sensor_id").distinct()
    pairs = keys.select("iot_sensor_id", "iot_plant_id").distinct()
    return _plant_ids(pairs.join(sensors, "iot_sensor_id", "left_semi"))


def unhealthy_by_own_events(rows: DataFrame) -> DataFrame:
    """Plants with a bad event of their own, from the wide rows."""
    return _plant_ids(_flagged_pairs(rows))


def all_healthy(graph: Graph) -> DataFrame:
    return graph.nodes["plant"].select(F.col(":ID").alias("plant_id"), F.lit(1.0).alias("status"))


def plant_status(plants: DataFrame, unhealthy: DataFrame) -> DataFrame:
    """Status of every plant: 0 for the listed ones, their own status otherwise."""
    flagged = unhealthy.select("plant_id").distinct().withColumn("_bad", F.lit(0.0))
    return (plants.join(flagged, "plant_id", "left")
            .select("plant_id", F.coalesce("_bad", "status").alias("status")))


def mark_random(plants: DataFrame, k: int = 25, seed: int = 42) -> DataFrame:
    """Set k random plants unhealthy."""
    return plant_status(plants, random_k(plants.select("plant_id"), "plant_id", k, seed))


def status_totals(predictions: DataFrame, column: str = "predicted_status") -> DataFrame:
    return predictions.agg(F.count_if(F.col(column) == 1.0).alias("healthy"),
                           F.count_if(F.col(column) == 0.0).alias("unhealthy"))
