import uuid

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from arbolytics.functions import scalars as S
from arbolytics.functions.ids import prefixed_id, register_id_function, uuid5, uuid_id


@pytest.fixture(autouse=True, scope="module")
def started(spark):
    """Hypothesis tests take no function-scoped fixtures."""


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.text(max_size=12), st.text(max_size=12)), min_size=1, max_size=200))
def test_uuid5_equals_python(pairs):
    from pyspark.sql import SparkSession

    spark = SparkSession.active()
    clean = [(a.replace("\x00", ""), b.replace("\x00", "")) for a, b in pairs]
    clean = [(a, b) for a, b in clean if not any(0xD800 <= ord(c) <= 0xDFFF for c in a + b)]
    if not clean:
        return
    got = spark.createDataFrame(clean, "a string, b string").select("a", "b", uuid5("a", "b").alias("u"))
    for a, b, u in got.collect():
        assert u == str(uuid.uuid5(uuid.NAMESPACE_DNS, f"{a}-{b}"))


def test_null_parts(spark):
    """Null parts give no id and do not collide with shorter keys."""
    df = spark.createDataFrame([("é", "x"), ("a", None), (None, "a")], "a string, b string")
    got = [r[0] for r in df.select(uuid_id("E", "a", "b")).collect()]
    assert got == ["E_" + str(uuid.uuid5(uuid.NAMESPACE_DNS, "é-x")), None, None]
    assert [r[0] for r in df.select(prefixed_id("P", "b")).collect()] == ["P_x", None, "P_a"]


def test_sql_function(spark):
    register_id_function(spark)
    df = spark.createDataFrame([("a", "b"), ("c", None)], "x string, y string")
    got = [r[0] for r in df.selectExpr("uuid5_id('EVENT', array(x, y))").collect()]
    assert got == ["EVENT_" + str(uuid.uuid5(uuid.NAMESPACE_DNS, "a-b")), None]


def one(spark, column, value, schema):
    return spark.createDataFrame([(value,)], f"v {schema}").select(column).first()[0]


def test_times(spark):
    v = F.col("v")
    assert str(one(spark, S.parse_reading_time(v), "2030-05-01_10-11-12", "string")) == "2030-05-01 10:11:12"
    for bad in ("2030-05-01 10:11:12", "x", None):
        assert one(spark, S.parse_reading_time(v), bad, "string") is None
    assert one(spark, S.format_reading_time(F.to_timestamp(v)), "2030-05-01 10:11:12", "string") == "2030-05-01_10-11-12"
    assert one(spark, S.date_text(F.to_date(v), 1), "2030-02-28", "string") == "2030-03-01"
    assert str(one(spark, S.folder_date(v), "a/2030-05-01/b", "string")) == "2030-05-01"
    assert one(spark, S.folder_date(v), "a/b", "string") is None


def test_paths_and_pairs(spark):
    v = F.col("v")
    path = "s/iot/device_id=b8%3A27/part.PARQUET"
    assert one(spark, S.partition_value(v, "device_id"), path, "string") == "b8:27"
    assert one(spark, S.partition_value(v, "other"), path, "string") is None
    assert one(spark, S.has_suffix(v, ".parquet"), path, "string") is True
    assert one(spark, S.path_part(v, -2), path, "string") == "device_id=b8%3A27"
    assert one(spark, S.plant_of_pair(v), "p:12", "string") == "p"
    assert one(spark, S.species_of_pair(v), "p:12", "string") == "12"


def test_casts(spark):
    v = F.col("v")
    assert [one(spark, S.to_int(v), x, "string") for x in ("12", "12.0", "abc", None)] == [12, 12, None, None]
    assert [one(spark, S.to_double(v), x, "string") for x in ("1.5", "abc")] == [1.5, None]
    assert one(spark, S.first_element(v), [], "array<double>") is None
    assert one(spark, S.first_element(v), [3.0, 4.0], "array<double>") == 3.0


def test_numbers(spark):
    v = F.col("v")
    assert one(spark, S.min_max_scale(v, F.lit(1.0), F.lit(3.0)), 2.0, "double") == 0.5
    assert one(spark, S.min_max_scale(v, F.lit(2.0), F.lit(2.0)), 2.0, "double") == 0.0
    assert one(spark, S.relu(v), -2.0, "double") == 0.0
    assert one(spark, S.sigmoid(v), 0.0, "double") == 0.5
    assert one(spark, S.over_threshold(v), 0.5, "double") == 0.0
    assert one(spark, S.map_values(v, {"a": "b"}, "Unknown"), "z", "string") == "Unknown"
    assert one(spark, S.map_values(v, {"a": "b"}), "z", "string") is None
    assert one(spark, S.message_key(v, F.lit("t")), "d", "string") == "d_t"
