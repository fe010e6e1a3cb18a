"""The wide table: readings with their weather and species traits."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from arbolytics.functions.ids import uuid_id
from arbolytics.functions.scalars import map_values, to_int
from arbolytics.operators.clean import prefix_columns, round_doubles


def wide_table(readings: DataFrame, weather: DataFrame, traits: DataFrame,
               city_aliases: Mapping[str, str] | None = None, forecast_day: str | None = None) -> DataFrame:
    """Inner join of the three feeds; columns get the prefixes of their feed.

    ``forecast_day`` (ISO text) selects one day of a weather table that holds
    several, before the join: else a reading is repeated for each stored day of its city.

    No side carries a broadcast hint: the planner broadcasts weather and traits
    when their (staged or stored) size is below the session threshold and
    otherwise sorts and merges, where adaptive execution splits a frequent
    location or species.
    """
    r = prefix_columns(readings, "iot_")
    if city_aliases:
        fixed = map_values(F.col("iot_location"), city_aliases)
        r = r.withColumn("iot_location", F.coalesce(fixed, F.col("iot_location")))
    r = r.withColumn("iot_species_id", to_int(F.col("iot_species_id")))
    if forecast_day is not None:
        weather = weather.filter(F.col("prediction_date").cast("string") == forecast_day)
    w = prefix_columns(weather, "weather_")
    t = prefix_columns(traits, "plants_").withColumn(
        "plants_Species_id", to_int(F.col("plants_Species_id")))
    return (r.join(w, r["iot_location"] == w["weather_city"], "inner")
            .join(t, r["iot_species_id"] == t["plants_Species_id"], "inner"))


def event_id() -> Column:
    """Id of a sensor's readings of one plant in one run."""
    return uuid_id("EVENT", "iot_sensor_id", "today", "iot_plant_id")


def with_run(wide: DataFrame, as_of: str) -> DataFrame:
    """Run date, event id and rounded values; the input of the graph build."""
    dated = wide.withColumn("today", F.lit(as_of)).withColumn("event_id", event_id())
    return round_doubles(dated)
