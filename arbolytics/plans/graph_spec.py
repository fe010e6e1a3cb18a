"""The property graph as data: which keys make a node, which keys make an edge."""

from __future__ import annotations

from dataclasses import dataclass

from arbolytics.sources.schemas import FORECAST_METRICS, GRAPH_TRAITS, SENSOR_METRICS


@dataclass(frozen=True)
class NodeSpec:
    """One node table.

    ``kind`` tells how the id is made from ``keys``: ``prefix`` (prefix and the
    single key), ``uuid5`` (prefix and the hash of the keys) or ``copy`` (the
    key itself). With ``values`` the table is long: one node per value column,
    whose name becomes the label and the last id part.
    """

    name: str
    label: str
    prefix: str
    keys: tuple[str, ...]
    kind: str = "prefix"
    props: tuple[str, ...] = ()
    values: tuple[str, ...] = ()


@dataclass(frozen=True)
class EdgeSpec:
    """One edge table between two node tables.

    The endpoints' keys stand in the same wide row, so the distinct key
    combinations of the rows are the edges and no join is needed.
    """

    type: str
    start: str
    end: str


def node_specs(metrics: list[str] = SENSOR_METRICS, traits: list[str] = GRAPH_TRAITS,
               forecasts: list[str] = FORECAST_METRICS) -> dict[str, NodeSpec]:
    sensor_values = tuple(f"iot_{m}" for m in metrics)
    trait_values = tuple(f"plants_{t}" for t in traits)
    weather_values = tuple(f"weather_{m}" for m in forecasts)
    specs = [
        NodeSpec("garden", "Garden", "GARDEN", ("iot_garden_id",),
                 props=("iot_garden_id", "iot_garden_name")),
        NodeSpec("sensor", "Sensor", "SENSOR", ("iot_sensor_id",), props=("iot_sensor_id",)),
        NodeSpec("sensor_data", "", "SENSORDATA", ("event_id", "iot_sensor_id"), "uuid5",
                 values=sensor_values),
        NodeSpec("sensor_data_wide", "SensorData", "SENSORDATA", ("event_id", "iot_sensor_id"),
                 "uuid5", props=("iot_sensor_id", "iot_garden_id", "iot_plant_id", "event_id",
                                 *sensor_values)),
        NodeSpec("event", "Event", "", ("event_id",), "copy", props=("event_id",)),
        NodeSpec("plant", "Plant", "PLANT", ("iot_plant_id",), props=("iot_plant_id",)),
        NodeSpec("species", "Species", "SPECIES", ("iot_species_id",),
                 props=("iot_species_id", "plants_plant_name")),
        NodeSpec("location", "Location", "LOCATION", ("weather_city",), props=("weather_city",)),
        NodeSpec("weather", "WeatherForecast", "WEATHER", ("weather_city", "today"), "uuid5"),
        NodeSpec("weather_data", "", "WEATHERDATA", ("weather_city", "today"), "uuid5",
                 values=weather_values),
        NodeSpec("today", "Date", "", ("today",), "copy"),
        NodeSpec("prediction_date", "Date", "", ("weather_prediction_date",), "copy"),
        NodeSpec("species_data", "", "SPECIESDATA", ("iot_species_id",), "uuid5",
                 values=(*trait_values, "plants_plant_name")),
        NodeSpec("species_data_wide", "SpeciesData", "SPECIESDATA", ("iot_species_id",),
                 props=("iot_species_id", *trait_values)),
    ]
    return {s.name: s for s in specs}


EDGES = {
    "described_by": EdgeSpec("DESCRIBED_BY", "species", "species_data"),
    "plant_type": EdgeSpec("PLANT_TYPE", "plant", "species"),
    "measures": EdgeSpec("MEASURES", "sensor", "plant"),
    "has_plant": EdgeSpec("HAS_PLANT", "garden", "plant"),
    "has_sensor": EdgeSpec("HAS_SENSOR", "garden", "sensor"),
    "registers": EdgeSpec("REGISTERS", "sensor", "event"),
    "located_in": EdgeSpec("LOCATED_IN", "garden", "location"),
    "predicted_for": EdgeSpec("PREDICTED_FOR", "weather", "location"),
    "tomorrow_date": EdgeSpec("TOMORROW_DATE", "weather", "prediction_date"),
    "predicted_data": EdgeSpec("PREDICTED_DATA", "weather", "weather_data"),
    "today_date": EdgeSpec("TODAY_DATE", "event", "today"),
    "contains": EdgeSpec("CONTAINS", "event", "sensor_data"),
}

# Columns from which every edge and every node without metric values follows.
KEY_COLUMNS = ("iot_garden_id", "iot_garden_name", "iot_sensor_id", "iot_plant_id",
               "iot_species_id", "plants_plant_name", "weather_city", "weather_prediction_date",
               "today")

# The event id is a hash of these; tables are reduced on them and hashed afterwards.
EVENT_KEYS = ("iot_sensor_id", "today", "iot_plant_id")
