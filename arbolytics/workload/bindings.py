"""The given tables in the roles of the three feeds.

A line item is a reading, its supplier the sensor, the supplier's nation the
garden, the region the city, the part the plant and its brand the species.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from arbolytics.functions.scalars import date_text, format_reading_time, to_int
from arbolytics.operators.wide import wide_table, with_run
from arbolytics.plans.graph_build import Graph, build_graph, raw_keys
from arbolytics.plans.graph_spec import KEY_COLUMNS, node_specs
from arbolytics.session import stage, stage_all
from arbolytics.sources.schemas import FORECAST_METRICS
from arbolytics.sources.streams import envelope

AS_OF = "1998-12-01"
METRICS = ["light", "motion", "co", "smoke", "temp", "rainfall", "soil_ph", "soil_humidity"]
NUMERIC_LABELS = [f"iot_{m}" for m in METRICS[2:]]
TRAITS = ["Species_name_standardized_against_TPL", "Genus", "Growth_Form", "Leaf_area_mm2",
          "Plant_height_m"]
SPECS = node_specs(METRICS, TRAITS, FORECAST_METRICS)
REGIONS = ["AFRICA", "AMERICA", "ASIA"]
COORDINATES = {"AFRICA": (1.5, 17.25), "AMERICA": (39.5, -98.25), "ASIA": (34.0, 100.5)}


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table. Its schema is read from the files once, not on every use."""
    path = f"{folder}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def sensors(spark: SparkSession, folder: str) -> DataFrame:
    """Sensor, garden and city of every supplier; joined once on the small side."""
    return (table(spark, folder, "supplier")
            .join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("s_suppkey", F.col("s_suppkey").cast("string").alias("sensor_id"),
                    F.col("s_nationkey").cast("string").alias("garden_id"),
                    F.col("n_name").alias("garden_name"), F.col("r_name").alias("location")))


def plants(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        "p_partkey", F.col("p_partkey").cast("string").alias("plant_id"),
        F.expr("substring(p_brand, 7)").alias("species_id"))


def metric_columns() -> dict[str, Column]:
    return {
        "light": F.col("l_returnflag") == "R",
        "motion": F.col("l_linestatus") == "O",
        "co": F.col("l_discount"),
        "smoke": F.col("l_tax"),
        "temp": F.col("l_quantity"),
        "rainfall": F.col("l_extendedprice"),
        # The odd divisor leaves no value half-way between two roundings to three places.
        "soil_ph": F.lit(5.5) + F.col("l_extendedprice") / F.lit(69827.0),
        "soil_humidity": F.lit(158.0) - F.lit(2.0) * F.col("l_quantity"),
    }


def readings(spark: SparkSession, folder: str, sensor_rows: DataFrame | None = None) -> DataFrame:
    """One reading per line item. ``sensor_rows`` are ``sensors``, staged or not.

    Plants are joined first: if they are too many to broadcast, the line items are shuffled before they get the sensors' texts.
    """
    rows = table(spark, folder, "lineitem").select(
        "l_suppkey", "l_partkey", *[c.alias(m) for m, c in metric_columns().items()],
        format_reading_time(F.col("l_shipdate")).alias("timestamp"))
    return _joined(rows, spark, folder, sensor_rows)


def _joined(rows: DataFrame, spark: SparkSession, folder: str, sensor_rows: DataFrame | None) -> DataFrame:
    found = sensors(spark, folder) if sensor_rows is None else sensor_rows
    return (rows.join(plants(spark, folder), F.col("l_partkey") == F.col("p_partkey"))
            .join(found, F.col("l_suppkey") == F.col("s_suppkey"))
            .drop("l_suppkey", "s_suppkey", "l_partkey", "p_partkey"))


def reading_keys(spark: SparkSession, folder: str, sensor_rows: DataFrame | None = None) -> DataFrame:
    """The distinct keys of the readings, reduced before any table is joined."""
    pairs = table(spark, folder, "lineitem").select("l_suppkey", "l_partkey").distinct()
    return _joined(pairs, spark, folder, sensor_rows)


def weather(spark: SparkSession, folder: str) -> DataFrame:
    """Forecast metrics per region from its orders.

    Orders are summed per customer first: a customer with many orders is one
    row in the join that follows.
    """
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")

    def part(s: str) -> Column:
        return F.when(status == s, price)

    per_customer = table(spark, folder, "orders").groupBy("o_custkey").agg(
        F.max(price).alias("hi"), F.min(price).alias("lo"),
        F.sum(price).alias("s"), F.count(price).alias("n"),
        F.sum(part("F")).alias("s_f"), F.count(part("F")).alias("n_f"),
        F.sum(part("P")).alias("s_p"), F.count(part("P")).alias("n_p"),
        F.max(F.dayofmonth("o_orderdate")).alias("day"))
    return (per_customer
            .join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .groupBy(F.col("r_name").alias("city"))
            .agg(F.max("hi").alias("temperature_2m_max"),
                 F.min("lo").alias("temperature_2m_min"),
                 (F.sum("s") / F.sum("n")).alias("rain_sum"),
                 (F.sum("s_f") / F.nullif(F.sum("n_f"), F.lit(0))).alias("showers_sum"),
                 (F.sum("s_p") / F.nullif(F.sum("n_p"), F.lit(0))).alias("snowfall_sum"),
                 F.max("day").cast("double").alias("precipitation_probability_max"))
            .withColumn("prediction_date", date_text(F.lit(AS_OF), 1)))


def traits(spark: SparkSession, folder: str) -> DataFrame:
    """Species traits from the parts of a brand."""
    return (table(spark, folder, "part").groupBy("p_brand")
            .agg(F.min("p_type").alias("Genus"), F.max("p_type").alias("Growth_Form"),
                 F.min("p_retailprice").alias("Leaf_area_mm2"),
                 F.max("p_size").cast("double").alias("Plant_height_m"))
            .select(to_int(F.expr("substring(p_brand, 7)")).alias("Species_id"),
                    F.col("p_brand").alias("Species_name_standardized_against_TPL"), "Genus",
                    "Growth_Form", "Leaf_area_mm2", "Plant_height_m",
                    F.col("p_brand").alias("plant_name")))


# What the keys of a wide row need of the two smaller feeds.
WEATHER_KEYS = ["city", "prediction_date"]
TRAIT_KEYS = ["Species_id", "plant_name"]


def _feeds(spark: SparkSession, folder: str, keys_only: bool) -> dict[str, DataFrame]:
    """Weather, traits and sensors, staged.

    The first two are aggregates of whole tables, the last is a join whose size the planner overrates, so that it would
    shuffle all readings for it. Staged, they are computed once and their true size decides how they are joined. Columns
    that are not asked for are not aggregated.
    """
    w, t = weather(spark, folder), traits(spark, folder)
    return stage_all({"weather": w.select(WEATHER_KEYS) if keys_only else w,
                      "traits": t.select(TRAIT_KEYS) if keys_only else t, "sensors": sensors(spark, folder)})


def _wide(base: DataFrame, feeds: dict[str, DataFrame]) -> DataFrame:
    return with_run(wide_table(base, feeds["weather"], feeds["traits"]), AS_OF)


def _all_readings(spark: SparkSession, folder: str, feeds: dict[str, DataFrame]) -> DataFrame:
    return _wide(readings(spark, folder, feeds["sensors"]), feeds)


def _all_keys(spark: SparkSession, folder: str, feeds: dict[str, DataFrame]) -> DataFrame:
    return _wide(reading_keys(spark, folder, feeds["sensors"]), feeds)


def wide_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Every reading with all columns of the three feeds."""
    return _all_readings(spark, folder, _feeds(spark, folder, keys_only=False))


def value_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Every reading with its metrics and the keys of the other feeds."""
    return _all_readings(spark, folder, _feeds(spark, folder, keys_only=True))


def key_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Wide rows of the distinct reading keys: enough for keys, edges and counts."""
    return _all_keys(spark, folder, _feeds(spark, folder, keys_only=True))


def value_and_key_rows(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Both of the above over the same staged feeds."""
    feeds = _feeds(spark, folder, keys_only=True)
    return _all_readings(spark, folder, feeds), _all_keys(spark, folder, feeds)


def feed_rows(spark: SparkSession, folder: str) -> DataFrame:
    """As ``key_rows``, with all columns of weather and traits."""
    return _all_keys(spark, folder, _feeds(spark, folder, keys_only=False))


def graph(spark: SparkSession, folder: str, stage_keys: bool = False) -> Graph:
    """The graph without the nodes that hold values; see ``full_graph``. The key rows are distinct pairs already."""
    rows = key_rows(spark, folder)
    return build_graph(rows, SPECS, rows.select(*KEY_COLUMNS), stage_keys)


def full_graph(spark: SparkSession, folder: str) -> Graph:
    """All tables. The rows are staged once, without ids, which follow from their keys; every table is read from them."""
    columns = [c for spec in SPECS.values() for c in raw_keys([*spec.keys, *spec.props, *spec.values])]
    rows = stage(wide_rows(spark, folder).select(*dict.fromkeys([*KEY_COLUMNS, *columns])), "wide")
    return build_graph(rows, SPECS)


def event_readings(events: DataFrame) -> DataFrame:
    """Events as readings: user is device and garden, event type is species."""
    k = F.get_json_object("props", "$.k").cast("double")
    value = F.col("value")
    return events.select(
        F.col("user_id").cast("string").alias("device_id"),
        k.alias("co"), (F.lit(100.0) - k).alias("humidity"), (k / 100.0).alias("smoke"),
        value.alias("temp"), (value / 8.0).alias("lpg"), k.alias("soil_ph"),
        (value * 2.0).alias("rainfall"), value.alias("soil_temp"),
        (F.lit(100.0) - k).alias("soil_humidity"), (value + k).alias("soil_nitrogen"),
        (value - k).alias("soil_potassium"), (k * 2.0).alias("soil_phosporous"),
        F.col("user_id").cast("string").alias("garden_id"),
        F.col("event_type").alias("species_id"), F.col("event_id").cast("string").alias("plant_id"),
        format_reading_time(F.col("ts")).alias("timestamp"))


def event_messages(events: DataFrame) -> DataFrame:
    return envelope(event_readings(events))


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The events file as a stream of messages."""
    schema = table(spark, folder, "events").schema
    return event_messages(spark.readStream.schema(schema).parquet(f"{folder}/events*.parquet"))
