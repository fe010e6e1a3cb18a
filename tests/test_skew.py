"""One key holds a third of the rows: results stay whole and plans stay parallel."""

from collections import Counter

from pyspark.sql import functions as F

from arbolytics.operators.clean import dedup
from arbolytics.operators.quality import unmatched_keys
from arbolytics.operators.ranking import count_per, top_k
from arbolytics.plans.graph_build import build_graph
from arbolytics.plans.propagation import propagate, with_self_loops
from arbolytics.sinks import tables
from tests import fixtures as X


def hot(spark, n=6000):
    """A third of the rows have key 0; half of those are exact copies."""
    i = F.col("id")
    return spark.range(n).select(
        F.when(i % 3 == 0, 0).otherwise(i % 500 + 1).alias("key"),
        F.when(i % 6 == 0, 0).otherwise(i).alias("v"))


def test_counts_and_copies(spark):
    rows = hot(spark)
    keys = Counter(r.key for r in rows.collect())
    assert top_k(count_per(rows, "key"), "number", 1, "key").first() == (0, keys[0])
    assert dedup(rows).count() == len({tuple(r) for r in rows.collect()})
    lost = unmatched_keys(rows, spark.range(1, 400), "key", "id")
    assert {r.key: r.n_rows for r in lost.collect()} == {k: n for k, n in keys.items() if not 1 <= k < 400}


def test_hot_vertex(spark):
    edges = hot(spark, 3000).select(F.concat(F.lit("s"), "key").alias("src"), F.concat(F.lit("d"), "v").alias("dst"))
    vertices = edges.select(F.explode(F.array("src", "dst")).alias("vertex")).distinct().withColumn("x", F.lit(1.0))
    out = propagate(with_self_loops(edges, vertices), vertices, ["x"], 2)
    assert out.count() == vertices.count()


def test_hot_value_is_split_when_written(spark, folder):
    tables.write_partitioned(hot(spark), f"{folder}/t", ["key"], rows_per_file=500)
    assert spark.read.parquet(f"{folder}/t").count() == 6000
    files = spark.read.parquet(f"{folder}/t").filter("key = 0").select(F.input_file_name()).distinct().count()
    assert files >= 4


def test_hot_sensor_keys(spark):
    """Edges of a hot sensor come from its distinct keys; the plan joins nothing."""
    rows = X.wide(spark)
    many = rows.unionByName(rows.filter("iot_sensor_id = 'aa:00'").withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(50)))).drop("_n"))
    a, b = (build_graph(r, stage_keys=False).edges["measures"] for r in (rows, many))
    assert X.rows_of(a) == X.rows_of(b)
    keyed = build_graph(many).edges["has_plant"]._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in keyed
