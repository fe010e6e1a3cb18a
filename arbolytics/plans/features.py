"""Feature rows for the health classifier."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from arbolytics.functions.ids import prefixed_id
from arbolytics.functions.scalars import min_max_scale, one_hot, to_double
from arbolytics.plans.graph_build import Graph, add_event_id, distinct_values, edges_of_keys, long_values, node_id, raw_keys
from arbolytics.plans.graph_spec import EDGES, EVENT_KEYS, NodeSpec
from arbolytics.operators.ranking import number_rows, number_weighted, random_k
from arbolytics.session import stage, stage_all

ROW_ID = ["plant_id", "sensor_id", "sdid", "event_id"]
# Labels that are no feature.
LEFT_OUT = ("iot_light", "iot_motion")


def training_values(rows: DataFrame, sensor_data: NodeSpec, status: DataFrame,
                    leave_out: Sequence[str] = LEFT_OUT) -> DataFrame:
    """The training rows (see below) with their short keys instead of ids: what is staged, sorted and shuffled."""
    known = status.select(F.col("plant_id").alias("_plant"), F.col("status").alias("plant_status"))
    rows = rows.join(known, prefixed_id("PLANT", "iot_plant_id") == F.col("_plant")).drop("_plant")
    keys = raw_keys([*sensor_data.keys, "iot_plant_id", "plant_status"])
    return distinct_values(rows, keys, _kept(sensor_data, leave_out), nulls=False).withColumnRenamed(":LABEL", "value_label")


def row_ids(sensor_data: NodeSpec) -> dict[str, Column]:
    """The ids of a training row from its short keys."""
    return {"plant_id": prefixed_id("PLANT", "iot_plant_id"), "sensor_id": prefixed_id("SENSOR", "iot_sensor_id"),
            "sdid": node_id(sensor_data, F.col("value_label")), "event_id": F.col("event_id")}


def with_row_ids(values: DataFrame, sensor_data: NodeSpec) -> DataFrame:
    """Training rows of their short form, row by row."""
    ids = [c.alias(name) for name, c in row_ids(sensor_data).items()]
    return add_event_id(values, ["event_id"]).select(*ids, "value", "value_label", "plant_status")


def training_rows(rows: DataFrame, sensor_data: NodeSpec, status: DataFrame,
                  leave_out: Sequence[str] = LEFT_OUT) -> DataFrame:
    """One row per plant, sensor, event and value of the plant's own events.

    An event belongs to one plant and one sensor, so the rows grow with the
    readings. Null values and the labels in ``leave_out`` are no features. The status
    meets the readings before they become one row per value, so the widest step is
    shuffled once.
    """
    return with_row_ids(training_values(rows, sensor_data, status, leave_out), sensor_data)


def _kept(sensor_data: NodeSpec, leave_out: Sequence[str]) -> tuple[str, ...]:
    return tuple(v for v in sensor_data.values if v not in leave_out)


def _measured(rows: DataFrame, sensor_data: NodeSpec, leave_out: Sequence[str],
              keep: tuple[str, ...] = ()) -> DataFrame:
    spec = replace(sensor_data, values=_kept(sensor_data, leave_out))
    return long_values(rows, spec, keep).filter(F.col("value").isNotNull())


def sensor_paths(rows: DataFrame, keys: DataFrame, sensor_data: NodeSpec,
                 leave_out: Sequence[str] = LEFT_OUT) -> tuple[DataFrame, DataFrame]:
    """Both halves of the Plant <- Sensor -> Event -> value paths.

    The paths of a sensor are all its plants times all its values. They are
    kept as the two tables ``(plant_id, sensor_id)`` and ``(sensor_id,
    event_id, sdid, value, value_label)``. A selection of either side can be
    joined on ``sensor_id``; counts need no such join (see ``path_counts``).
    """
    plants = keys.select("iot_plant_id", "iot_sensor_id").distinct().select(
        prefixed_id("PLANT", "iot_plant_id").alias("plant_id"),
        prefixed_id("SENSOR", "iot_sensor_id").alias("sensor_id"))
    measured = _measured(rows, sensor_data, leave_out).select(
        prefixed_id("SENSOR", "iot_sensor_id").alias("sensor_id"), "event_id",
        F.col(":ID").alias("sdid"), "value", F.col(":LABEL").alias("value_label"))
    return plants, measured


def path_counts(rows: DataFrame, keys: DataFrame, sensor_data: NodeSpec,
                leave_out: Sequence[str] = LEFT_OUT) -> DataFrame:
    """Number of those paths per plant and label.

    Values are counted per sensor first, on the raw keys and without ids; a
    plant then adds up one number per sensor.
    """
    values = distinct_values(rows, raw_keys(["event_id"]), _kept(sensor_data, leave_out)).filter(
        F.col("value").isNotNull())
    per_sensor = values.groupBy("iot_sensor_id", F.col(":LABEL").alias("value_label")).agg(
        F.count(F.lit(1)).alias("n"))
    plants = keys.select("iot_plant_id", "iot_sensor_id").distinct()
    return (plants.join(per_sensor, "iot_sensor_id").groupBy("iot_plant_id", "value_label")
            .agg(F.sum("n").alias("n_paths"))
            .select(prefixed_id("PLANT", "iot_plant_id").alias("plant_id"), "value_label", "n_paths"))


class LabelScaler:
    """Min-max scaling per label, fitted once.

    The bounds are one row per label of the given fixed list, so they fit in
    the plan as a literal and the scaling needs no join and no shuffle.
    """

    def __init__(self, bounds: dict[str, tuple[float, float]]):
        self.bounds = bounds

    @classmethod
    def fit(cls, rows: DataFrame, labels: Sequence[str], label: str = "value_label",
            value: str = "value") -> "LabelScaler":
        """Bounds of the given labels; a label of the data that is not given raises."""
        found = (rows.groupBy(label).agg(F.min(to_double(F.col(value))).alias("low"),
                                         F.max(to_double(F.col(value))).alias("high")).limit(len(labels) + 2).collect())
        unknown = sorted(str(r[label]) for r in found if r[label] is not None and r[label] not in labels)
        if unknown:
            raise ValueError(f"labels without a place among the features: {', '.join(unknown)}")
        return cls({r[label]: (r["low"], r["high"]) for r in found if r["low"] is not None})

    def scaled(self, label: Column, value: Column) -> Column:
        def bound(i: int) -> Column:
            pairs = [F.lit(x) for name, b in self.bounds.items() for x in (name, b[i])]
            return F.try_element_at(F.create_map(*pairs), label)

        return min_max_scale(to_double(value), bound(0), bound(1))

    def transform(self, rows: DataFrame, label: str = "value_label", value: str = "value") -> DataFrame:
        if not self.bounds:
            return rows.withColumn(value, F.lit(None).cast("double"))
        return rows.withColumn(value, self.scaled(F.col(label), F.col(value)))


def event_summaries(rows: DataFrame, vertex: Column, metrics: Sequence[str], together: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Least, greatest and spread of every metric over the readings of a vertex.

    For each (a, b) of ``together`` also the least and the greatest b among the readings with the least a. Metrics judged
    together at one event show in these; each metric's own summary cannot show that they coincide. All are partial aggregates.
    """
    columns = []
    for m in metrics:
        columns += [F.min(m).alias(f"least_{m}"), F.max(m).alias(f"greatest_{m}"), F.stddev_pop(m).alias(f"spread_{m}")]
    for a, b in together:
        columns += [F.min(F.struct(a, b))[b].alias(f"least_{b}_at_least_{a}"),
                    F.max(F.struct((-F.col(a)).alias(a), F.col(b)))[b].alias(f"greatest_{b}_at_least_{a}")]
    return rows.groupBy(vertex.alias("vertex")).agg(*columns)


def summary_kinds(columns: Sequence[str]) -> dict[str, str]:
    """The aggregate that carries a summary on to the neighbours: least of the least, greatest of the greatest, mean of the others."""
    return {c: "min" if c.startswith("least_") else "max" if c.startswith("greatest_") else "avg" for c in columns}


def encode_labels(rows: DataFrame, labels: Sequence[str], label: str = "value_label") -> DataFrame:
    """One 0/1 column per label instead of the label."""
    return rows.select("*", *one_hot(F.col(label), labels, label + "_")).drop(label)


def feature_rows(rows: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Training rows with scaled values and indicator columns."""
    scaler = LabelScaler.fit(rows, labels)
    return encode_labels(scaler.transform(rows), labels)


def label_codes(rows: DataFrame, label: str) -> DataFrame:
    """Code of each distinct label, from 0 in sorted order."""
    return number_rows(rows.select(label).filter(F.col(label).isNotNull()).distinct(),
                       [F.col(label).asc()], "label_encoded")


def numbered_rows(rows: DataFrame) -> DataFrame:
    """Training rows with a row index in the order of their ids, label and value."""
    order = [F.col(c).asc() for c in [*ROW_ID, "value_label", "value"] if c in rows.columns]
    return number_rows(rows, order, "row_index")


def numbered_values(values: DataFrame, sensor_data: NodeSpec, leave_out: Sequence[str] = LEFT_OUT) -> DataFrame:
    """``numbered_rows`` of training rows in their short form, as one row per event: its keys, the count of its rows by label
    (``n_...``) and of all (``n_rows``), and the ``first`` number of these.

    Ids follow their keys' text, so the rows of a plant and sensor have consecutive numbers, whichever event they are of. If they
    are of one event, ``first`` is exact; else it is exact for the least of their events, and they are marked (``several``).
    Only events are sorted and staged; the order of an event's rows by the ids of its values is left to ``key_index``.
    """
    labels = _kept(sensor_data, leave_out)
    keys = list(dict.fromkeys([*EVENT_KEYS, *raw_keys(sensor_data.keys), "iot_plant_id"]))
    # With the status, which is one for each plant, the rows are counted where copies were dropped.
    with_status = [c for c in ("plant_status",) if c in values.columns]
    events = values.groupBy(*keys, *with_status).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col("value_label") == v).alias(_count(v)) for v in labels]).drop(*with_status)

    def text(key: str) -> dict[str, Column]:
        return {key: F.col(key)} if events.schema[key].dataType == T.StringType() else {f"_{key}": F.col(key).cast("string")}

    events = stage(events, "training-events")  # the range shuffle reads its rows twice
    group = {**text("iot_plant_id"), **text("iot_sensor_id")}
    return number_weighted(events, {**group, **text("today")}, list(group), "n_rows", "first")


def _label_index(label: str) -> str:
    return f"index_{label}"


def _count(label: str) -> str:
    return f"n_{label}"


def key_index(numbered: DataFrame, sensor_data: NodeSpec, leave_out: Sequence[str] = LEFT_OUT) -> dict[str, DataFrame]:
    """The last row index of every plant, sensor and event, and of an event's values beside it, by short keys; staged.

    ``numbered`` are ``numbered_values``. Keys of one kind have equal ids only if they are equal (as in ``build_nodes``), and no two
    kinds share ids.
    """
    labels = _kept(sensor_data, leave_out)
    last = F.max(F.col("first") + F.col("n_rows") - 1).alias("vertex_index")
    complete_keys = F.lit(True)
    for k in EVENT_KEYS:
        complete_keys = complete_keys & F.col(k).isNotNull()
    last_of_event = F.array_max(F.array(*[F.col(_label_index(v)) for v in labels])).alias("vertex_index")
    parts = (_index_alone(numbered.filter(complete_keys & ~F.col("several")), sensor_data, labels),
             _index_together(numbered.filter("several"), sensor_data, labels).filter(complete_keys))
    alone, together = [part.select(*EVENT_KEYS, last_of_event, *[_label_index(v) for v in labels]) for part in parts]
    return stage_all({"plant": numbered.groupBy("iot_plant_id").agg(last), "sensor": numbered.groupBy("iot_sensor_id").agg(last),
                      "event": alone.unionByName(together)})


def _index_alone(events: DataFrame, sensor_data: NodeSpec, labels: Sequence[str]) -> DataFrame:
    """The last row index of each label of events that share their plant and sensor with no other, row by row."""
    ids = add_event_id(events, ["event_id"]).select("*", *[node_id(sensor_data, F.lit(v)).alias(f"_id_{v}") for v in labels])

    def index(label: str) -> Column:
        upto = F.lit(0)
        for v in labels:
            upto = upto + F.when(F.col(f"_id_{v}") <= F.col(f"_id_{label}"), F.col(_count(v))).otherwise(0)
        return F.when(F.col(_count(label)) > 0, F.col("first") + upto - 1).alias(_label_index(label))

    return ids.select(*EVENT_KEYS, *[index(v) for v in labels])


def _index_together(events: DataFrame, sensor_data: NodeSpec, labels: Sequence[str]) -> DataFrame:
    """The same for all events of plants and sensors that have several: their values are put in order by a window."""
    counts = F.explode(F.array(*[F.struct(F.lit(v).alias("_label"), F.col(_count(v)).alias("_n")) for v in labels]))
    values = add_event_id(events, ["event_id"]).select(*EVENT_KEYS, "event_id", "first", counts.alias("_c")).select("*", "_c.*").filter("_n > 0")
    of_pair = Window.partitionBy("iot_plant_id", "iot_sensor_id")
    upto = of_pair.orderBy("_id").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    placed = values.withColumn("_id", node_id(sensor_data, F.col("_label"))).withColumn(
        "_index", F.min("first").over(of_pair) + F.sum("_n").over(upto) - 1)
    return placed.groupBy(*EVENT_KEYS).agg(*[F.max(F.when(F.col("_label") == v, F.col("_index"))).alias(_label_index(v)) for v in labels])


def vertex_index_of_keys(index: Mapping[str, DataFrame], sensor_data: NodeSpec, leave_out: Sequence[str] = LEFT_OUT) -> DataFrame:
    """``vertex_index`` of a ``key_index``: each event becomes a row for itself and one for each of its values."""
    labels = _kept(sensor_data, leave_out)
    # Unpivoted before the ids of values are hashed: one expression of one label, which a generated loop holds with ease.
    vertices = F.array(F.struct(F.lit(None).cast("string").alias("_label"), "vertex_index"),
                       *[F.struct(F.lit(v).alias("_label"), F.col(_label_index(v)).alias("vertex_index")) for v in labels])
    events = add_event_id(index["event"], ["event_id"]).select(*EVENT_KEYS, "event_id", F.inline(vertices)).filter("vertex_index is not null")
    vertex = F.when(F.col("_label").isNull(), F.col("event_id")).otherwise(node_id(sensor_data, F.col("_label")))
    out = events.select(vertex.alias("vertex"), "vertex_index")
    for kind, prefix in (("plant", "PLANT"), ("sensor", "SENSOR")):
        out = out.union(index[kind].select(prefixed_id(prefix, f"iot_{kind}_id").alias("vertex"), "vertex_index"))
    return out


def edge_index_of_keys(graph: Graph, names: Sequence[str], index: Mapping[str, DataFrame], codes: DataFrame,
                       leave_out: Sequence[str] = LEFT_OUT) -> DataFrame:
    """``edge_index`` of the named edges from their staged keys and a ``key_index``: they meet on short keys, ids are hashed last."""
    def kind(node: str) -> str:
        return "event" if graph.specs[node].values else node

    out = None
    for name in names:
        edge, rows, also = EDGES[name], graph.edge_keys[name], {}
        for node in dict.fromkeys((kind(edge.start), kind(edge.end))):
            keys = raw_keys(graph.specs[node].keys)
            side = index[node]
            side = side.select(*keys, *[F.col(c).alias(f"{node}_{c}") for c in side.columns if c not in keys])
            rows = rows.join(side, keys, "left")
        for column, node in (("source_idx", edge.start), ("target_idx", edge.end)):
            values = [v for v in graph.specs[node].values if v not in leave_out]
            found = [F.when(F.col("_label") == v, F.col(f"event_{_label_index(v)}")) for v in values]
            also[column] = F.coalesce(*found) if found else F.col(f"{node}_vertex_index")
        part = edges_of_keys(rows, edge, graph.specs, also).select(
            F.col(":ID").alias("id"), F.col(":START_ID").alias("start_node"), F.col(":END_ID").alias("end_node"), F.col(":TYPE").alias("lbl"), *also)
        out = part if out is None else out.union(part)
    return out.join(codes, "lbl", "left").select("id", "start_node", "end_node", "lbl", "source_idx", "target_idx", "label_encoded")


def vertex_index(indexed: DataFrame, id_columns: Sequence[str] = ROW_ID) -> DataFrame:
    """The last row index of every id found in the id columns. ``key_index`` does it by short keys."""
    ids = F.explode(F.array(*[F.col(c) for c in id_columns])).alias("vertex")
    return (indexed.select("row_index", ids).groupBy("vertex")
            .agg(F.max("row_index").alias("vertex_index")))


def edge_index(edges: DataFrame, index: DataFrame, codes: DataFrame) -> DataFrame:
    """Edges with the indexes of both ends (null when an end has none) and the type's code."""
    source = index.select(F.col("vertex").alias("start_node"), F.col("vertex_index").alias("source_idx"))
    target = index.select(F.col("vertex").alias("end_node"), F.col("vertex_index").alias("target_idx"))
    return (edges.join(source, "start_node", "left").join(target, "end_node", "left")
            .join(codes, "lbl", "left")
            .select("id", "start_node", "end_node", "lbl", "source_idx", "target_idx", "label_encoded"))


def split_bucket(keys: Sequence[str], seed: int, buckets: int = 100) -> Column:
    """Bucket 0..buckets-1 of a row, from a hash of its key and the seed."""
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(buckets))


def with_split(rows: DataFrame, keys: Sequence[str], test_percent: int = 20, seed: int = 42) -> DataFrame:
    """Adds ``split``: ``train`` or ``test``, the same on every run."""
    bucket = split_bucket(keys, seed)
    return rows.withColumn("split", F.when(bucket < test_percent, "test").otherwise("train"))


def hold_out(rows: DataFrame, key: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Moves k rows of the test part to a ``sample`` part for a demonstration."""
    picked = random_k(rows.filter("split = 'test'").select(key), key, k, seed)
    # picked has k rows.
    marked = F.broadcast(picked.withColumn("_picked", F.lit(True)))
    return (rows.join(marked, key, "left")
            .withColumn("split", F.when(F.col("_picked"), "sample").otherwise(F.col("split")))
            .drop("_picked"))
