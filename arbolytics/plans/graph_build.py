"""Node and edge tables of the property graph, built from the wide table."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from arbolytics.functions.ids import prefixed_id, uuid_id
from arbolytics.operators.quality import id_conflicts
from arbolytics.operators.wide import event_id
from arbolytics.plans.graph_spec import EDGES, EVENT_KEYS, KEY_COLUMNS, EdgeSpec, NodeSpec, node_specs
from arbolytics.session import stage, stage_all
from arbolytics.sinks.tables import write_csv


def node_id(spec: NodeSpec, label: Column | None = None) -> Column:
    if spec.kind == "copy":
        return F.col(spec.keys[0]).cast("string")
    if spec.kind == "prefix":
        return prefixed_id(spec.prefix, spec.keys[0])
    return uuid_id(spec.prefix, *spec.keys, *([label] if label is not None else []))


def raw_keys(columns: Iterable[str]) -> list[str]:
    """The columns without repeats, the event id replaced by the keys it is made of."""
    out = [k for c in columns for k in (EVENT_KEYS if c == "event_id" else (c,))]
    return list(dict.fromkeys(out))


def add_event_id(rows: DataFrame, columns: Iterable[str]) -> DataFrame:
    return rows.withColumn("event_id", event_id()) if "event_id" in columns else rows


def distinct_values(rows: DataFrame, keys: Sequence[str], values: Sequence[str], nulls: bool = True) -> DataFrame:
    """Distinct keys, ``:LABEL`` and ``value`` as text over the value columns. Nulls stay unless ``nulls`` is false.

    Rows with equal keys are brought together before each becomes one row per
    value column: a row is shuffled once and not once per value, and copies are
    dropped where they stand. If all values are doubles or
    booleans, copies are dropped on a column number and a double; names and
    text are put back afterwards. (-0.0 counts as 0.0.)
    """
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    if all(types[v] in ("double", "boolean") for v in values):
        def parts(i: int, v: str) -> list[Column]:
            return [F.lit(i), F.col(v).cast("double")]

        flags = [i for i, v in enumerate(values) if types[v] == "boolean"]
        label = F.get(F.array(*[F.lit(v) for v in values]), F.col("_l"))
        text = F.when(F.col("_l").isin(flags), (F.col("_v") == 1.0).cast("string")).otherwise(
            F.col("_v").cast("string"))
    else:
        def parts(i: int, v: str) -> list[Column]:
            return [F.lit(v), F.col(v).cast("string")]

        label, text = F.col("_l"), F.col("_v")
    pairs = [c for i, v in enumerate(values) for c in parts(i, v)]
    # Not by the run date: it is often one constant, which the planner takes out of the grouping.
    together = rows.select(*keys, *values).repartition(*([k for k in keys if k != "today"] or keys))
    stacked = together.select(*keys, F.stack(F.lit(len(values)), *pairs).alias("_l", "_v"))
    distinct = (stacked if nulls else stacked.filter(F.col("_v").isNotNull())).distinct()
    return distinct.select(*keys, label.alias(":LABEL"), text.alias("value"))


def long_values(rows: DataFrame, spec: NodeSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """The distinct values of a long spec: raw keys, ``:LABEL``, ``value``, ``:ID``.

    Copies are dropped on the short keys, before ids are hashed.
    """
    distinct = distinct_values(rows, raw_keys([*spec.keys, *keep]), spec.values)
    return add_event_id(distinct, spec.keys).withColumn(":ID", node_id(spec, F.col(":LABEL")))


def value_conflicts(rows: DataFrame, spec: NodeSpec) -> DataFrame:
    """``id_conflicts`` of the nodes of a long spec, told by their short keys: only ids in conflict are hashed.

    Keys that miss a part make one id, the null one, whatever their label.
    """
    keys = raw_keys(spec.keys)
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    values = distinct_values(rows.withColumns({k: F.when(complete, F.col(k)) for k in keys}), keys, spec.values)
    label = F.when(F.col(keys[0]).isNotNull(), F.col(":LABEL"))
    found = add_event_id(id_conflicts(values.withColumn(":LABEL", label), [*keys, ":LABEL"]), spec.keys)
    return found.select(node_id(spec, F.col(":LABEL")).alias(":ID"), "n_values")


def feed_values(rows: DataFrame, spec: NodeSpec) -> DataFrame:
    """The few rows of a weather or trait feed that stand in the readings: distinct before they are unpivoted."""
    return rows.select(*raw_keys(spec.keys), *spec.values).distinct()


def build_nodes(rows: DataFrame, spec: NodeSpec) -> DataFrame:
    """The distinct nodes of one kind.

    Copies are dropped on the short keys and properties, which the partial
    aggregation does before the shuffle; ids are hashed afterwards.
    """
    if spec.values:
        return long_values(rows, spec).select(":LABEL", "value", ":ID")
    columns = [*spec.keys, *spec.props]
    return add_event_id(rows.select(raw_keys(columns)).distinct(), columns).select(
        *spec.props, node_id(spec).alias(":ID"), F.lit(spec.label).alias(":LABEL"))


def build_date_nodes(rows: DataFrame, specs: Mapping[str, NodeSpec]) -> DataFrame:
    """Run dates and forecast dates, each once."""
    parts = [build_nodes(rows, specs[n]).select(":ID", ":LABEL") for n in ("prediction_date", "today")]
    return parts[0].union(parts[1]).distinct()


def edge_key_columns(edge: EdgeSpec, specs: Mapping[str, NodeSpec]) -> list[str]:
    return raw_keys([*specs[edge.start].keys, *specs[edge.end].keys])


def edge_keys(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The distinct keys of an edge type, without those that miss one."""
    # isNotNull and not dropna: the planner pushes it to the scan and knows the ids are not null.
    pairs = rows.select(*columns)
    for key in columns:
        pairs = pairs.filter(F.col(key).isNotNull())
    return pairs.distinct()


def edges_of_keys(pairs: DataFrame, edge: EdgeSpec, specs: Mapping[str, NodeSpec],
                  also: Mapping[str, Column] | None = None) -> DataFrame:
    """The edges of distinct keys, row by row. ``also`` are columns to add; those of an end with values may use its ``_label``."""
    also = also or {}
    start, end = specs[edge.start], specs[edge.end]
    pairs = add_event_id(pairs, [*start.keys, *end.keys])
    label = None
    if end.values:
        pairs = pairs.select("*", F.explode(F.array(*[F.lit(v) for v in end.values])).alias("_label"))
        label = F.col("_label")
    return finish_edges(pairs.select(node_id(start).alias(":START_ID"), node_id(end, label).alias(":END_ID"),
                                     *[c.alias(name) for name, c in also.items()]), edge.type, tuple(also))


def build_edges(rows: DataFrame, edge: EdgeSpec, specs: Mapping[str, NodeSpec]) -> DataFrame:
    """The distinct edges of one type, read off the rows that hold both keys."""
    return edges_of_keys(edge_keys(rows, edge_key_columns(edge, specs)), edge, specs)


def finish_edges(pairs: DataFrame, edge_type: str, also: Sequence[str] = ()) -> DataFrame:
    return pairs.select(":START_ID", ":END_ID", F.lit(edge_type).alias(":TYPE"),
                        uuid_id("E", ":START_ID", ":END_ID").alias(":ID"), *also)


def join_edges(start_nodes: DataFrame, end_nodes: DataFrame, on: Mapping[str, str],
               edge_type: str) -> DataFrame:
    """Edges between two separate node frames that still carry their keys.

    Both sides are reduced to their distinct (keys, id) before the join, which
    keeps helper columns from multiplying the rows.
    """
    left = start_nodes.select(
        F.col(":ID").alias(":START_ID"),
        *[F.col(a).cast("string").alias(f"_k{i}") for i, a in enumerate(on)]).distinct()
    right = end_nodes.select(
        F.col(":ID").alias(":END_ID"),
        *[F.col(b).cast("string").alias(f"_k{i}") for i, b in enumerate(on.values())]).distinct()
    joined = left.join(right, [f"_k{i}" for i in range(len(on))], "inner")
    return finish_edges(joined.select(":START_ID", ":END_ID").distinct(), edge_type)


class LazyTables(Mapping[str, DataFrame]):
    """Tables by name, each planned when it is asked for."""

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]):
        self._makers = makers

    def __getitem__(self, name: str) -> DataFrame:
        return self._makers[name]()

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


@dataclass(frozen=True)
class Graph:
    """Node and edge tables; also the staged keys that the edge tables are views of, if there are any, and the values of long
    node tables by short keys (see ``distinct_values``), if the caller adds them."""

    nodes: Mapping[str, DataFrame]
    edges: Mapping[str, DataFrame]
    edge_keys: Mapping[str, DataFrame] = field(default_factory=dict)
    specs: Mapping[str, NodeSpec] = field(default_factory=dict)
    node_keys: Mapping[str, DataFrame] = field(default_factory=dict)


NODE_TABLES = ("garden", "sensor", "sensor_data", "event", "plant", "species", "location",
               "weather", "weather_data", "date", "species_data")


def graph_keys(rows: DataFrame) -> DataFrame:
    """The distinct key rows: all edges and most nodes need nothing else."""
    return rows.select(*KEY_COLUMNS).distinct()


def build_graph(rows: DataFrame, specs: Mapping[str, NodeSpec] | None = None,
                keys: DataFrame | None = None, stage_keys: bool = True) -> Graph:
    """All node and edge tables of the wide rows (see ``wide.with_run``).

    The key rows are reduced once and staged; the 12 edge tables and the nodes
    without values are read from that small table instead of the wide one. With
    ``stage_keys`` the distinct keys of an edge type are staged when it is first asked for
    (once for types with the same keys). An edge table is then a row by row view of a short
    table, which may be read again and again: its ids are hashed on reading and written nowhere.
    """
    specs = specs or node_specs()
    keys = graph_keys(rows) if keys is None else keys
    if stage_keys:
        keys = stage(keys, "graph-keys")

    def node_maker(name: str) -> Callable[[], DataFrame]:
        if name == "date":
            return lambda: build_date_nodes(keys, specs)
        if name in ("weather_data", "species_data"):
            return lambda: build_nodes(feed_values(rows, specs[name]), specs[name])
        return lambda: build_nodes(rows if specs[name].values else keys, specs[name])

    nodes = {name: node_maker(name) for name in NODE_TABLES}
    staged: dict[tuple[str, ...], DataFrame] = {}

    def keys_of(edge: EdgeSpec) -> DataFrame:
        columns = tuple(sorted(edge_key_columns(edge, specs)))
        if columns not in staged:
            back = stage(edge_keys(keys, columns), "edge-keys")
            # No value is null, but a column read back may be: the planner would test each id, hashed anew, for null.
            staged[columns] = back.select(*[F.coalesce(F.col(f.name), F.lit(0).cast(f.dataType)).alias(f.name) for f in back.schema])
        return staged[columns]

    def edge_table(edge: EdgeSpec) -> DataFrame:
        return edges_of_keys(keys_of(edge), edge, specs) if stage_keys else build_edges(keys, edge, specs)

    edges = {name: (lambda e=edge: edge_table(e)) for name, edge in EDGES.items()}
    short = {name: (lambda e=edge: keys_of(e)) for name, edge in EDGES.items()} if stage_keys else {}
    return Graph(LazyTables(nodes), LazyTables(edges), LazyTables(short), specs)


def stored(graph: Graph, nodes: Sequence[str] = (), edges: Sequence[str] = ()) -> Graph:
    """The named tables, written out at the same time and read back.

    Questions that join on ids should run on stored tables: ids are then
    hashed once and not again in every filter and join that mentions them.
    """
    found = stage_all({**{f"node-{n}": graph.nodes[n] for n in nodes},
                       **{f"edge-{e}": graph.edges[e] for e in edges}})
    return Graph({n: found[f"node-{n}"] for n in nodes}, {e: found[f"edge-{e}"] for e in edges})


def all_nodes(graph: Graph) -> DataFrame:
    """Ids and labels of all node tables."""
    return _union([t.select(":ID", ":LABEL") for t in graph.nodes.values()])


def all_edges(graph: Graph) -> DataFrame:
    return _union(list(graph.edges.values()))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def write_graph(graph: Graph, root: str, day: str, compression: str | None = None) -> None:
    """CSV tables in the bulk-load layout: ``nodes/<day>/<name>.csv`` and ``edges/...``.

    Tables are written side by side. Stage the wide rows before ``build_graph``: several
    tables read them. ``compression`` is that of the files (bulk loaders and Spark read ``gzip``): the ids of an edge
    are most of its text.
    """
    jobs = [(graph_path(root, kind, day, name), table) for kind, tables in (("nodes", graph.nodes), ("edges", graph.edges))
            for name, table in tables.items()]
    with ThreadPoolExecutor(max_workers=6) as pool:
        list(pool.map(lambda job: write_csv(job[1], job[0], compression=compression), jobs))


def graph_path(root: str, kind: str, day: str, name: str) -> str:
    return f"{root}/{kind}/{day}/{name}_{kind}.csv"
