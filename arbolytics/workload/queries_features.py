"""Feature rows, graph propagation and the health model."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from arbolytics.functions.scalars import accuracy, log_loss, over_threshold, relu, sigmoid
from arbolytics.plans import features as M
from arbolytics.plans import graph_queries as Q
from arbolytics.plans import model
from arbolytics.plans.graph_build import build_graph
from arbolytics.plans.propagation import neighbour_summaries, propagate, with_self_loops
from arbolytics.session import drop_staged, fresh_path, shuffles_dropped, stage, stage_results
from arbolytics.sinks.tables import write_csv
from arbolytics.sources.files import read_csv_by_header
from arbolytics.sources.streams import file_source
from arbolytics.streaming import runner as R
from arbolytics.operators.clean import rows_not_in
from arbolytics.workload import bindings as B
from arbolytics.workload import sql
from arbolytics.workload.queries_graph import UNHEALTHY
from arbolytics.workload.registry import query

TRAINING = f"""{UNHEALTHY}, {sql.SENSOR_VALUES}, training AS (
  SELECT 'PLANT_' || plant_id AS plant_id, 'SENSOR_' || sensor_id AS sensor_id, id AS sdid,
         CASE WHEN plant_id IN (SELECT plant_id FROM unhealthy) THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS plant_status,
         event_id, value, label AS value_label
  FROM sensor_values WHERE value IS NOT NULL AND label NOT IN ('iot_light', 'iot_motion'))"""
NUMBERED = """numbered AS (SELECT *, row_number() OVER
  (ORDER BY plant_id, sensor_id, sdid, event_id, value_label, value) - 1 AS row_index FROM training)"""
VERTICES = """vertices AS (SELECT vertex, max(row_index) AS vertex_index FROM (
  SELECT plant_id AS vertex, row_index FROM numbered UNION ALL SELECT sensor_id, row_index FROM numbered
  UNION ALL SELECT sdid, row_index FROM numbered UNION ALL SELECT event_id, row_index FROM numbered) GROUP BY vertex)"""
SCALED = """scaled AS (SELECT plant_id, sensor_id, sdid, plant_status, event_id, value_label,
  CASE WHEN hi > lo THEN (CAST(value AS DOUBLE) - lo) / (hi - lo) ELSE 0.0::DOUBLE END AS value
  FROM training JOIN (SELECT value_label, min(CAST(value AS DOUBLE)) AS lo, max(CAST(value AS DOUBLE)) AS hi
  FROM training GROUP BY value_label) USING (value_label))"""


TRAINING_COLUMNS = ["iot_sensor_id", "iot_plant_id", "today", *(f"iot_{m}" for m in B.METRICS)]


def _readings_and_status(spark, folder) -> tuple[DataFrame, DataFrame]:
    with shuffles_dropped(spark):
        rows, keys = B.value_and_key_rows(spark, folder)
        # One projection of the wide rows serves the flags and the values. The status needs no other keys.
        rows = stage(rows.select(*TRAINING_COLUMNS), "training-readings")
        keys = stage(keys.select("iot_sensor_id", "iot_plant_id").distinct(), "training-keys")
        g = build_graph(rows, B.SPECS, keys, stage_keys=False)
        status = stage(Q.plant_status(Q.all_healthy(g), Q.unhealthy_by_sensor(rows, keys)), "training-status")
    drop_staged(keys)
    return rows, status


def _training(spark, folder) -> DataFrame:
    rows, status = _readings_and_status(spark, folder)
    return M.training_rows(rows, B.SPECS["sensor_data"], status)


def _staged_values(spark, folder) -> DataFrame:
    """The training rows in their short form, staged: ids are hashed on reading and written nowhere.

    What they are made from goes: nothing else is left on disk when the result is read.
    """
    rows, status = _readings_and_status(spark, folder)
    with shuffles_dropped(spark):
        values = stage(M.training_values(rows, B.SPECS["sensor_data"], status), "training")
    drop_staged(rows, status)
    return values


@query("training_rows", sql.over_wide_ctes(TRAINING, "SELECT * FROM training"))
def training_rows(spark, folder):
    return _training(spark, folder)


@query("path_counts", sql.over_wide_ctes(sql.SENSOR_VALUES, """
    SELECT 'PLANT_' || m.plant_id AS plant_id, value_label, sum(n)::BIGINT AS n_paths
    FROM (SELECT DISTINCT sensor_id, plant_id FROM wide) m JOIN
    (SELECT sensor_id, label AS value_label, count(*) AS n FROM (SELECT DISTINCT sensor_id, event_id, id, label, value
     FROM sensor_values WHERE value IS NOT NULL AND label NOT IN ('iot_light', 'iot_motion')) GROUP BY ALL) v
    USING (sensor_id) GROUP BY ALL"""))
def path_counts(spark, folder):
    return M.path_counts(*B.value_and_key_rows(spark, folder), B.SPECS["sensor_data"])


@query("minmax_scaled", sql.over_wide_ctes(f"{TRAINING}, {SCALED}", """
    SELECT plant_id, sensor_id, sdid, event_id, value_label, round(value, 6) AS value FROM scaled"""))
def minmax_scaled(spark, folder):
    rows = M.with_row_ids(_staged_values(spark, folder), B.SPECS["sensor_data"])
    scaled = M.LabelScaler.fit(rows, B.NUMERIC_LABELS).transform(rows)
    return scaled.select("plant_id", "sensor_id", "sdid", "event_id", "value_label", F.round("value", 6).alias("value"))


@query("one_hot", sql.over_wide_ctes(f"{TRAINING}, {SCALED}", "SELECT plant_id, sensor_id, sdid, plant_status, event_id, "
       "round(value, 6) AS value, " + ", ".join(
           f"(value_label = '{x}')::INTEGER::DOUBLE AS value_label_{x}" for x in B.NUMERIC_LABELS) + " FROM scaled"))
def one_hot(spark, folder):
    rows = M.with_row_ids(_staged_values(spark, folder), B.SPECS["sensor_data"])
    return M.feature_rows(rows, B.NUMERIC_LABELS).withColumn("value", F.round("value", 6))


@query("label_codes", "SELECT event_type, row_number() OVER (ORDER BY event_type) - 1 AS label_encoded "
       "FROM (SELECT DISTINCT event_type FROM events)")
def label_codes(spark, folder):
    return M.label_codes(B.table(spark, folder, "events"), "event_type")


def _key_index(spark, folder) -> dict[str, DataFrame]:
    """The indexes; what they are made from goes when the numbered events are staged."""
    spec = B.SPECS["sensor_data"]

    def numbered() -> dict[str, DataFrame]:
        rows, status = _readings_and_status(spark, folder)
        return {"numbered": M.numbered_values(M.training_values(rows, spec, status), spec)}

    with shuffles_dropped(spark):
        return M.key_index(stage_results(spark, numbered)["numbered"], spec)


@query("vertex_index", sql.over_wide_ctes(f"{TRAINING}, {NUMBERED}, {VERTICES}", "SELECT * FROM vertices"))
def vertex_index(spark, folder):
    return M.vertex_index_of_keys(_key_index(spark, folder), B.SPECS["sensor_data"])


@query("edge_index", sql.over_wide_ctes(
    f"{sql.KEY_TABLES}, " + ", ".join(sql.edge_cte(n) for n in ("measures", "registers", "contains")) +
    f", {TRAINING}, {NUMBERED}, {VERTICES}", """
    SELECT e.id, start_id AS start_node, end_id AS end_node, type AS lbl, s.vertex_index AS source_idx,
           t.vertex_index AS target_idx, CASE type WHEN 'CONTAINS' THEN 0 WHEN 'MEASURES' THEN 1 ELSE 2 END::BIGINT AS label_encoded
    FROM (SELECT * FROM e_measures UNION ALL SELECT * FROM e_registers UNION ALL SELECT * FROM e_contains) e
    LEFT JOIN vertices s ON s.vertex = start_id LEFT JOIN vertices t ON t.vertex = end_id"""))
def edge_index(spark, folder):
    graph = B.graph(spark, folder, stage_keys=True)
    codes = stage(M.label_codes(Q.edge_list(graph), "lbl"), "edge-codes")
    return M.edge_index_of_keys(graph, Q.LISTED, _key_index(spark, folder), codes)


# Sensor - plant pairs in both directions; the features of a vertex are averages of its readings.
PAIRS = """pairs AS (SELECT DISTINCT 's' || l_suppkey AS s, 'p' || l_partkey AS p FROM lineitem),
  edges AS (SELECT s AS src, p AS dst FROM pairs UNION ALL SELECT p, s FROM pairs),
  x0 AS (SELECT 's' || l_suppkey AS vertex, avg(l_quantity) AS a, avg(l_tax) AS b FROM lineitem GROUP BY 1
         UNION ALL SELECT 'p' || l_partkey, avg(l_quantity), avg(l_tax) FROM lineitem GROUP BY 1),
  looped AS (SELECT * FROM edges UNION ALL SELECT vertex, vertex FROM x0),
  d_out AS (SELECT src AS vertex, count(*) AS d FROM looped GROUP BY 1),
  d_in AS (SELECT dst AS vertex, count(*) AS d FROM looped GROUP BY 1)"""


def _round(i: int) -> str:
    return (f"x{i} AS (SELECT dst AS vertex, sum(a / sqrt(o.d)) / sqrt(max(n.d)) AS a, sum(b / sqrt(o.d)) / sqrt(max(n.d)) AS b "
            f"FROM looped JOIN x{i - 1} x ON x.vertex = src JOIN d_out o ON o.vertex = src JOIN d_in n ON n.vertex = dst GROUP BY dst)")


def _pairs(spark, folder) -> tuple[DataFrame, DataFrame]:
    rows = B.table(spark, folder, "lineitem")
    s, p = F.concat(F.lit("s"), "l_suppkey"), F.concat(F.lit("p"), "l_partkey")
    pairs = rows.select("l_suppkey", "l_partkey").distinct().select(s.alias("s"), p.alias("p"))
    edges = pairs.select(F.explode(F.array(
        F.struct(F.col("s").alias("src"), F.col("p").alias("dst")),
        F.struct(F.col("p").alias("src"), F.col("s").alias("dst")))).alias("e")).select("e.*")
    means = [F.avg("l_quantity").alias("a"), F.avg("l_tax").alias("b")]
    features = rows.groupBy(s.alias("vertex")).agg(*means).unionByName(
        rows.groupBy(p.alias("vertex")).agg(*means))
    return edges, features


def _propagated(spark, folder, hops: int) -> DataFrame:
    edges, features = _pairs(spark, folder)
    features = stage(features, "vertex-features")
    out = propagate(with_self_loops(edges, features), features, ["a", "b"], hops)
    return out.select("vertex", F.round("a", 6).alias("a"), F.round("b", 6).alias("b"))


@query("self_loops", f"WITH {PAIRS} SELECT * FROM looped")
def self_loops(spark, folder):
    edges, features = _pairs(spark, folder)
    return with_self_loops(edges, features)


@query("propagate_1hop", f"WITH {PAIRS}, {_round(1)} SELECT vertex, round(a, 6) AS a, round(b, 6) AS b FROM x1")
def propagate_1hop(spark, folder):
    return _propagated(spark, folder, 1)


@query("propagate_2hop", f"WITH {PAIRS}, {_round(1)}, {_round(2)} SELECT vertex, round(a, 6) AS a, round(b, 6) AS b FROM x2")
def propagate_2hop(spark, folder):
    return _propagated(spark, folder, 2)


SPLIT = f"""flagged AS (SELECT p_partkey, CASE WHEN {sql.bucket32("p_partkey || '|42'", 100)} < 20 THEN 'test' ELSE 'train' END AS split FROM part),
  held AS (SELECT p_partkey, CASE WHEN split = 'test' AND row_number() OVER (PARTITION BY split ORDER BY md5(p_partkey || '|42'), p_partkey) <= 5
           THEN 'sample' ELSE split END AS split FROM flagged)"""


@query("split_flags", f"WITH {SPLIT} SELECT * FROM held")
def split_flags(spark, folder):
    rows = M.with_split(B.table(spark, folder, "part").select("p_partkey"), ["p_partkey"])
    return M.hold_out(rows, "p_partkey")


@query("test_minus_sample", f"WITH {SPLIT} SELECT p_partkey FROM held WHERE split = 'test'")
def test_minus_sample(spark, folder):
    rows = M.with_split(B.table(spark, folder, "part").select("p_partkey"), ["p_partkey"])
    sample = M.hold_out(rows, "p_partkey").filter("split = 'sample'")
    return rows_not_in(rows.filter("split = 'test'"), sample, ["p_partkey"]).select("p_partkey")


@query("metric_formulas", """WITH scored AS (SELECT l_returnflag AS split, (l_linestatus = 'O')::INTEGER::DOUBLE AS y,
      1.0::DOUBLE / (1.0::DOUBLE + exp(-greatest((l_quantity - 25.0::DOUBLE) / 10.0::DOUBLE, 0.0::DOUBLE))) AS p FROM lineitem)
    SELECT split, count(*) AS n_rows, round(avg((y = (p > 0.5)::INTEGER)::INTEGER), 6) AS accuracy,
           round(-avg(y * ln(p) + (1 - y) * ln(1 - p)), 6) AS log_loss FROM scored GROUP BY split""")
def metric_formulas(spark, folder):
    x = relu((F.col("l_quantity") - 25.0) / 10.0)
    rows = B.table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("split"), (F.col("l_linestatus") == "O").cast("double").alias("y"),
        sigmoid(x).alias("p"))
    return rows.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(accuracy(F.col("y"), over_threshold(F.col("p"))), 6).alias("accuracy"),
        F.round(log_loss(F.col("y"), F.col("p")), 6).alias("log_loss"))


@query("class_count", "SELECT count(DISTINCT l_returnflag) AS n_classes FROM lineitem")
def class_count(spark, folder):
    return model.class_count(B.table(spark, folder, "lineitem"), "l_returnflag")


MODEL_METRICS = [f"iot_{m}" for m in ("co", "smoke", "temp", "rainfall", "soil_ph", "soil_humidity")]
TOGETHER = [("iot_soil_humidity", "iot_soil_ph")]


def _labelled(spark, folder) -> tuple[DataFrame, list[str]]:
    """Staged plants with features of two rounds and their status as label, and the names of the features.

    A sensor sums up the readings of its events, a plant the summaries of its sensors.
    """
    rows, keys = B.value_and_key_rows(spark, folder)
    rows = stage(rows.select("iot_sensor_id", "iot_plant_id", "today", *MODEL_METRICS), "model-readings")
    keys = stage(keys.select("iot_sensor_id", "iot_plant_id").distinct(), "model-keys")
    sensors = M.event_summaries(rows, F.concat(F.lit("SENSOR_"), "iot_sensor_id"), MODEL_METRICS, TOGETHER)
    g = build_graph(rows, B.SPECS, keys, stage_keys=False)
    measures = g.edges["measures"].select(F.col(":START_ID").alias("src"), F.col(":END_ID").alias("dst"))
    columns = [c for c in sensors.columns if c != "vertex"]
    spread = neighbour_summaries(measures, stage(sensors, "sensor-summaries"), M.summary_kinds(columns))
    status = Q.plant_status(Q.all_healthy(g), Q.unhealthy_by_sensor(rows, keys))
    labelled = status.join(spread, F.col("vertex") == F.col("plant_id")).select(
        "plant_id", F.col("status").alias("plant_status"), *columns)
    # Staged before the sample is picked from it, which reads it once more, and after, as every pass of the fit reads it.
    labelled = stage(M.with_split(labelled, ["plant_id"]), "model-labelled")
    return stage(M.hold_out(labelled, "plant_id"), "model-rows"), columns


def _scored(spark, folder) -> DataFrame:
    labelled, columns = _labelled(spark, folder)
    return model.score(model.fit(labelled, columns, epochs=200), labelled, columns)


LABELLED = f"""{UNHEALTHY}, status AS (SELECT DISTINCT 'PLANT_' || plant_id AS plant_id,
    CASE WHEN plant_id IN (SELECT plant_id FROM unhealthy) THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS plant_status FROM wide),
  parted AS (SELECT *, CASE WHEN {sql.bucket32("plant_id || '|42'", 100)} < 20 THEN 'test' ELSE 'train' END AS part FROM status),
  labelled AS (SELECT plant_id, plant_status, CASE WHEN part = 'test' AND row_number() OVER
    (PARTITION BY part ORDER BY md5(plant_id || '|42'), plant_id) <= 5 THEN 'sample' ELSE part END AS split FROM parted)"""


@query("model_scores", sql.over_wide_ctes(LABELLED, "SELECT plant_id, split, plant_status, true AS is_probability, true AS fits FROM labelled"))
def model_scores(spark, folder):
    """Every plant has a probability, and a prediction that fits it."""
    p = F.col("probability_healthy")
    return _scored(spark, folder).select(
        "plant_id", "split", "plant_status", p.between(0.0, 1.0).alias("is_probability"),
        (F.col("predicted_status") == (p > 0.5).cast("double")).alias("fits"))


@query("model_metrics", sql.over_wide_ctes(LABELLED, """
    SELECT split, count(*) AS n_rows, 0::BIGINT AS n_unscored, true AS beats_constant FROM labelled GROUP BY split"""))
def model_metrics(spark, folder):
    """Rows per part, and whether the fit is at least as good as the best constant prediction on its own part."""
    scored = stage(_scored(spark, folder), "scored")
    share = F.avg("plant_status")
    constant = scored.groupBy("split").agg(F.greatest(share, 1 - share).alias("larger"), log_loss(
        F.col("plant_status"), F.lit(scored.filter("split = 'train'").agg(share).first()[0])).alias("constant_loss"))
    better = (F.col("accuracy") >= F.col("larger")) & (F.col("log_loss") <= F.col("constant_loss") + 1e-9)
    return model.metrics(scored).join(constant, "split").select(
        "split", "n_rows", "n_unscored", F.when(F.col("split") == "train", better).otherwise(True).alias("beats_constant"))


@query("predictions_table", sql.over_wide_ctes(LABELLED, """
    SELECT split, count(*) AS n_rows, count(*) AS n_predicted FROM labelled GROUP BY split"""))
def predictions_table(spark, folder):
    """The predictions as a CSV table, read back: each plant has one that is healthy or not."""
    path = fresh_path(spark, "predictions")
    columns = "plant_id string, split string, predicted_status double"
    write_csv(_scored(spark, folder).select("plant_id", "split", "predicted_status"), path)
    back = read_csv_by_header(spark, path, T.StructType.fromDDL(columns))
    return back.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(
        F.col("predicted_status").isin(0.0, 1.0)).alias("n_predicted"))


@query("model_reload", sql.over_wide_ctes(TRAINING, """
    SELECT value_label, count(*) AS n_rows, count(*) AS n_same, count(*) AS n_streamed, count(*) AS n_streamed_same
    FROM training GROUP BY value_label"""))
def model_reload(spark, folder):
    """Scaler, encoder and network over all training rows, saved and loaded: rows with equal predictions before and after.

    The loaded pipeline also scores the rows as a stream.
    """
    path = fresh_path(spark, "reload-rows")
    _training(spark, folder).select("plant_id", "value_label", "value", "plant_status").write.parquet(path)
    rows = M.with_split(spark.read.parquet(path), ["plant_id"])
    fitted = model.row_pipeline(B.NUMERIC_LABELS, epochs=10).fit(rows.filter("split = 'train'"))
    saved = fresh_path(spark, "model")
    model.save(fitted, saved)
    loaded = model.load(saved)

    def both(df: DataFrame) -> DataFrame:
        before = model.score_rows(fitted, df).withColumnsRenamed({"probability_healthy": "p", "predicted_status": "s"})
        return model.score_rows(loaded, before).select("value_label", (
            (F.col("p") == F.col("probability_healthy")) & (F.col("s") == F.col("predicted_status"))).alias("same"))

    streamed = R.run_append(both(file_source(spark, path, rows.drop("split").schema)), "reload", fresh_path(spark, "scored"), fresh_path(spark, "checkpoint"))
    count = lambda df, n, same: df.groupBy("value_label").agg(F.count(F.lit(1)).alias(n), F.count_if("same").alias(same))
    return count(both(rows), "n_rows", "n_same").join(count(streamed, "n_streamed", "n_streamed_same"), "value_label")
