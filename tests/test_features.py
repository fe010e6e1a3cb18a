import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from arbolytics.operators import ranking
from arbolytics.operators.quality import counted
from arbolytics.operators.ranking import number_rows
from arbolytics.plans import features as M
from arbolytics.plans import graph_queries as Q
from arbolytics.plans import model
from arbolytics.plans.graph_build import build_graph
from arbolytics.plans.graph_spec import node_specs
from arbolytics.plans.propagation import neighbour_summaries, propagate, with_self_loops
from arbolytics.sources.schemas import NUMERIC_METRICS
from tests import fixtures as X

LABELS = [f"iot_{m}" for m in NUMERIC_METRICS]


@pytest.fixture(scope="module")
def training(spark):
    rows = X.wide(spark)
    g = build_graph(rows)
    status = Q.plant_status(Q.all_healthy(g), Q.unhealthy_by_sensor(rows, rows))
    return M.training_rows(rows, node_specs()["sensor_data"], status).persist()


def test_training_rows_belong_to_the_plant(spark, training):
    events = {(r.event_id, "PLANT_" + r.iot_plant_id, "SENSOR_" + r.iot_sensor_id) for r in X.wide(spark).collect()}
    got = training.collect()
    assert {(r.event_id, r.plant_id, r.sensor_id) for r in got} == events
    assert {r.value_label for r in got} == set(LABELS)


def test_feature_rows(training):
    rows = M.feature_rows(training, LABELS)
    assert rows.columns[-12:] == [f"value_label_{x}" for x in sorted(LABELS)]
    got = rows.collect()
    assert all(0.0 <= r.value <= 1.0 and sum(r[c] for c in rows.columns[-12:]) == 1.0 for r in got)
    values = defaultdict(list)
    for r in training.collect():
        values[r.value_label].append(float(r.value))
    for label, v in values.items():
        want = sorted((x - min(v)) / (max(v) - min(v)) for x in v)
        have = sorted(r.value for r in got if r[f"value_label_{label}"] == 1.0)
        assert have == pytest.approx(want)


def test_constant_group_scales_to_zero(spark):
    rows = spark.createDataFrame([("a", "2.5"), ("a", "2.5"), ("b", "1"), ("b", "3"), ("b", "x")], "value_label string, value string")
    got = M.LabelScaler.fit(rows, ["a", "b"]).transform(rows).collect()
    assert [r.value for r in got] == [0.0, 0.0, 0.0, 1.0, None]


def test_row_numbers(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), F.lit("x").alias("same"))
    got = number_rows(rows, [F.col("same").asc(), F.col("k").desc()]).select("k", "row_index").collect()
    assert {(r.k, r.row_index) for r in got} == {(4999 - i, i) for i in range(5000)}


def test_indexes(spark, training):
    numbered = M.numbered_rows(training)
    index = {r.vertex: r.vertex_index for r in M.vertex_index(numbered).collect()}
    last = {}
    for r in sorted(numbered.collect(), key=lambda r: r.row_index):
        for c in M.ROW_ID:
            last[r[c]] = r.row_index
    assert index == last
    edges = spark.createDataFrame([("e", next(iter(last)), "nowhere", "CONTAINS")], "id string, start_node string, end_node string, lbl string")
    codes = M.label_codes(edges.unionByName(edges.withColumn("lbl", F.lit("AAA"))), "lbl")
    row = M.edge_index(edges, M.vertex_index(numbered), codes).first()
    assert (row.source_idx, row.target_idx, row.label_encoded) == (last[row.start_node], None, 1)


def test_propagation_by_hand(spark):
    """A hub, a doubled edge and a lone vertex."""
    pairs = [("h", "a"), ("h", "b"), ("h", "c"), ("a", "h"), ("a", "h"), ("b", "c")]
    x = {"h": 1.0, "a": 2.0, "b": 3.0, "c": 4.0, "lone": 5.0}
    edges = spark.createDataFrame(pairs, "src string, dst string")
    features = spark.createDataFrame(list(x.items()), "vertex string, v double")
    looped = pairs + [(v, v) for v in x]
    for hops in (1, 2):
        now = x
        for _ in range(hops):
            out_deg, in_deg, sums = defaultdict(int), defaultdict(int), defaultdict(float)
            for s, d in looped:
                out_deg[s] += 1
                in_deg[d] += 1
            for s, d in looped:
                sums[d] += now[s] / math.sqrt(out_deg[s])
            now = {v: sums[v] / math.sqrt(in_deg[v]) for v in x}
        got = {r.vertex: r.v for r in propagate(with_self_loops(edges, features), features, ["v"], hops).collect()}
        assert got == pytest.approx(now)


def test_split_and_hold_out(spark):
    rows = M.with_split(spark.range(2000).select(F.col("id").alias("k")), ["k"])
    share = rows.filter("split = 'test'").count() / 2000
    assert 0.15 < share < 0.25
    held = M.hold_out(rows, "k")
    assert held.filter("split = 'sample'").count() == 5
    assert held.count() == 2000
    assert X.rows_of(held) == X.rows_of(M.hold_out(rows, "k"))


def test_model(spark, folder):
    rows = M.with_split(spark.range(400).select(
        F.col("id").alias("k"), (F.col("id") % 20).cast("double").alias("x"),
        (F.col("id") % 20 > 9).cast("double").alias("plant_status")), ["k"])
    fitted = model.fit(rows, ["x"])
    model.save(fitted, f"{folder}/m")
    scored = model.score(model.load(f"{folder}/m"), rows, ["x"])
    found = {r.split: r for r in model.metrics(scored).collect()}
    assert found["test"].accuracy > 0.9 and found["train"].n_rows + found["test"].n_rows == 400
    by_hand = [r for r in scored.collect() if r.split == "test"]
    loss = -sum(math.log(r.probability_healthy if r.plant_status else 1 - r.probability_healthy) for r in by_hand) / len(by_hand)
    assert found["test"].log_loss == pytest.approx(loss)
    assert model.class_count(rows).first()[0] == 2
    with pytest.raises(ValueError, match="label"):
        model.fit(rows, ["x", "plant_status"])


def health_rows(spark, n=600):
    """Two metrics that are bad only together, which no single bound can tell."""
    rows = spark.range(n).select(F.col("id").alias("k"), (F.col("id") * 7 % 20).cast("double").alias("x"), (F.col("id") * 11 % 13).cast("double").alias("y"))
    return M.with_split(rows.withColumn("plant_status", F.when((F.col("x") > 9) == (F.col("y") > 6), 1.0).otherwise(0.0)), ["k"])


def test_hidden_layer_learns_what_lines_cannot(spark):
    rows = health_rows(spark).cache()
    found = {r.split: r for r in model.metrics(model.score(model.fit(rows, ["x", "y"], epochs=200), rows, ["x", "y"])).collect()}
    assert found["train"].accuracy > 0.95 and found["test"].accuracy > 0.9


def test_rows_without_a_feature_have_no_prediction(spark, folder):
    rows = health_rows(spark, 80).withColumn("x", F.when(F.col("k") % 5 > 0, F.col("x")))
    fitted = model.fit(rows, ["x", "y"], epochs=5)
    model.save(fitted, f"{folder}/m")
    scored = model.score(model.load(f"{folder}/m"), rows, ["x", "y"])
    assert scored.columns == [*rows.columns, "probability_healthy", "predicted_status"]
    assert {(r.k % 5 > 0, r.predicted_status is not None, r.probability_healthy is not None) for r in scored.collect()} == {(True,) * 3, (False,) * 3}
    assert sum(r.n_incomplete for r in model.incomplete_rows(rows, ["x", "y"]).collect()) == 16


def long_rows(spark):
    rows = [(["ph", "dry"][i % 2], str(float(i % 20)), 1.0 if i % 20 > 9 else 0.0) for i in range(400)]
    return spark.createDataFrame(rows, "value_label string, value string, plant_status double")


def test_label_bounds_are_saved_with_the_pipeline(spark, folder):
    rows = long_rows(spark)
    fitted = model.row_pipeline(["dry", "ph"], epochs=20).fit(rows)
    model.save(fitted, f"{folder}/pipeline")
    loaded = model.load(f"{folder}/pipeline")
    bounds = loaded.stages[0]
    assert isinstance(bounds, model.LabelBoundsModel)
    assert (bounds.getOrDefault("labels"), bounds.getOrDefault("least"), bounds.getOrDefault("greatest")) == (["dry", "ph"], [1.0, 0.0], [19.0, 18.0])
    order = ["value_label", "value"]
    before, after = (model.score_rows(m, rows).orderBy(order).collect() for m in (fitted, loaded))
    assert before == after and sum(r.predicted_status == r.plant_status for r in after) > 380
    odd = model.score_rows(loaded, spark.createDataFrame([("ph", "no number"), ("ph", None), ("ph", "3")], "value_label string, value string")).collect()
    assert [r.predicted_status is None for r in odd] == [True, True, False] and odd[0].value == "no number"


def test_label_bounds_of_odd_rows(spark):
    with pytest.raises(ValueError, match="without a place"):
        model.LabelBounds(labels=["ph"]).fit(long_rows(spark))
    empty = model.LabelBounds(labels=["ph"]).fit(long_rows(spark).limit(0))
    assert [r.scaled_value for r in empty.transform(long_rows(spark).limit(2)).collect()] == [None, None]
    same = model.LabelBounds(labels=["ph"]).fit(spark.createDataFrame([("ph", "4")], "value_label string, value string"))
    assert [r.scaled_value for r in same.transform(spark.createDataFrame([("ph", "4"), ("new", "4")], "value_label string, value string")).collect()] == [0.0, None]


def test_summaries_of_events_and_neighbours(spark):
    rows = spark.createDataFrame([("a", 1.0, 5.0), ("a", 1.0, 7.0), ("a", 3.0, 9.0), ("b", 2.0, None), ("c", None, 4.0)], "s string, dry double, ph double")
    found = {r.vertex: r for r in M.event_summaries(rows, F.col("s"), ["dry", "ph"], [("dry", "ph")]).collect()}
    a = found["a"]
    assert (a.least_dry, a.greatest_dry, a.least_ph, a.greatest_ph, a.spread_dry) == (1.0, 3.0, 5.0, 9.0, pytest.approx((8 / 9) ** 0.5))
    assert (a.least_ph_at_least_dry, a.greatest_ph_at_least_dry) == (5.0, 7.0)
    assert found["b"].greatest_ph_at_least_dry is None and found["c"].greatest_ph_at_least_dry == 4.0
    edges = spark.createDataFrame([("a", "p"), ("b", "p"), ("x", "p"), ("b", "q")], "src string, dst string")
    features = spark.createDataFrame([("a", 1.0, 4.0), ("b", 3.0, 2.0)], "vertex string, least_m double, spread_m double")
    kinds = M.summary_kinds(["least_m", "spread_m"])
    assert kinds == {"least_m": "min", "spread_m": "avg"}
    assert sorted(map(tuple, neighbour_summaries(edges, features, kinds).collect())) == [("p", 1.0, 3.0), ("q", 3.0, 2.0)]


def test_one_class_is_a_constant(spark):
    rows = health_rows(spark, 60).withColumn("plant_status", F.lit(0.0))
    scored = model.score(model.fit(rows, ["x", "y"]), rows, ["x", "y"])
    assert {(r.probability_healthy, r.predicted_status) for r in scored.collect()} == {(0.0, 0.0)}


def test_indexes_by_short_keys(spark, monkeypatch):
    """The same indexes as from the ids, and no id is staged."""
    wide, spec = X.wide(spark), node_specs()["sensor_data"]
    graph = build_graph(wide)
    status = Q.all_healthy(graph)
    values = M.training_values(wide, spec, status)
    columns, real = [], ranking.stage
    monkeypatch.setattr(ranking, "stage", lambda df, name: columns.extend(df.columns) or real(df, name))
    numbered = M.numbered_values(values, spec)
    assert columns and not {"sdid", "_sdid", "event_id", "plant_id"} & set(columns)
    by_ids = M.vertex_index(M.numbered_rows(M.with_row_ids(values, spec)))
    index = M.key_index(numbered, spec)
    assert X.rows_of(M.vertex_index_of_keys(index, spec)) == X.rows_of(by_ids)
    edges = Q.edge_list(graph)
    codes = M.label_codes(edges, "lbl")
    expected = X.rows_of(M.edge_index(edges, by_ids, codes))
    assert X.rows_of(M.edge_index_of_keys(graph, Q.LISTED, index, codes)) == expected
    assert any(r[4] is None or r[5] is None for r in expected) and any(r[4] is not None for r in expected)


def test_one_class_after_an_observation(spark):
    """A session that has observed a table scores with the constant model as before."""
    counted(spark.range(3), "seen")[0].collect()
    rows = health_rows(spark, 60).withColumn("plant_status", F.lit(1.0))
    scored = model.score(model.fit(rows, ["x", "y"]), rows, ["x", "y"])
    assert {(r.probability_healthy, r.predicted_status) for r in scored.collect()} == {(1.0, 1.0)}
