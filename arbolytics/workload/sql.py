"""Building blocks of the comparison SQL (DuckDB) over the same tables."""

from __future__ import annotations

from arbolytics.functions.ids import DNS_NAMESPACE_HEX
from arbolytics.workload.bindings import AS_OF, METRICS, SPECS, TRAITS
from arbolytics.sources.schemas import FORECAST_METRICS


def uuid5(name: str) -> str:
    h = f"sha1(unhex('{DNS_NAMESPACE_HEX}') || encode({name}))"
    return (f"(substr({h},1,8) || '-' || substr({h},9,4) || '-5' || substr({h},14,3) || '-' || "
            f"translate(substr({h},17,1), '0123456789abcdef', '{'89ab' * 4}') || substr({h},18,3) "
            f"|| '-' || substr({h},21,12))")


def uuid_id(prefix: str, *parts: str) -> str:
    return f"('{prefix}_' || {uuid5(' || chr(45) || '.join(parts))})"


READINGS = """
readings AS (
  SELECT l_suppkey, l_partkey,
         CAST(l_suppkey AS VARCHAR) AS sensor_id, CAST(s_nationkey AS VARCHAR) AS garden_id,
         n_name AS garden_name, r_name AS location, CAST(l_partkey AS VARCHAR) AS plant_id,
         CAST(substr(p_brand, 7) AS INTEGER) AS species_id,
         l_returnflag = 'R' AS light, l_linestatus = 'O' AS motion,
         round(l_discount, 3) AS co, round(l_tax, 3) AS smoke, round(l_quantity, 3) AS temp,
         round(l_extendedprice, 3) AS rainfall,
         round(5.5::DOUBLE + l_extendedprice / 69827.0::DOUBLE, 3) AS soil_ph,
         round(158.0::DOUBLE - 2.0::DOUBLE * l_quantity, 3) AS soil_humidity,
         strftime(l_shipdate, '%Y-%m-%d_%H-%M-%S') AS reading_time
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey)"""

WEATHER = """
weather AS (
  SELECT r_name AS city, CAST(DATE '%s' + 1 AS VARCHAR) AS prediction_date,
         round(max(o_totalprice), 3) AS temperature_2m_max,
         round(min(o_totalprice), 3) AS temperature_2m_min,
         round(avg(o_totalprice), 3) AS rain_sum,
         round(avg(o_totalprice) FILTER (o_orderstatus = 'F'), 3) AS showers_sum,
         round(avg(o_totalprice) FILTER (o_orderstatus = 'P'), 3) AS snowfall_sum,
         CAST(max(day(o_orderdate)) AS DOUBLE) AS precipitation_probability_max
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey GROUP BY r_name)""" % AS_OF

TRAIT_TABLE = """
traits AS (
  SELECT CAST(substr(p_brand, 7) AS INTEGER) AS trait_species_id,
         p_brand AS Species_name_standardized_against_TPL, min(p_type) AS Genus,
         max(p_type) AS Growth_Form, round(min(p_retailprice), 3) AS Leaf_area_mm2,
         CAST(max(p_size) AS DOUBLE) AS Plant_height_m, p_brand AS plant_name
  FROM part GROUP BY p_brand)"""

WIDE = f"""
wide AS (
  SELECT r.*, w.*, t.*, '{AS_OF}' AS today,
         {uuid_id('EVENT', 'sensor_id', f"'{AS_OF}'", 'plant_id')} AS event_id
  FROM readings r JOIN weather w ON r.location = w.city
  JOIN traits t ON r.species_id = t.trait_species_id)"""


def over_wide(body: str) -> str:
    """A statement over ``wide`` (names without feed prefix)."""
    return f"WITH {READINGS}, {WEATHER}, {TRAIT_TABLE}, {WIDE} {body}"


def over_wide_ctes(ctes: str, body: str) -> str:
    return f"WITH {READINGS}, {WEATHER}, {TRAIT_TABLE}, {WIDE}, {ctes} {body}"


def stacked(labels: dict[str, str], ids: str, source: str = "wide") -> str:
    """Value columns as (ids, label, value) rows, nulls included."""
    return " UNION ALL ".join(
        f"SELECT {ids}, '{label}' AS label, CAST({column} AS VARCHAR) AS value FROM {source}"
        for label, column in labels.items())


SENSOR_LABELS = {f"iot_{m}": m for m in METRICS}
FORECAST_LABELS = {f"weather_{m}": m for m in FORECAST_METRICS}
TRAIT_LABELS = {f"plants_{t}": t for t in [*TRAITS, "plant_name"]}

NODE_IDS = {
    "garden": "'GARDEN_' || garden_id",
    "sensor": "'SENSOR_' || sensor_id",
    "plant": "'PLANT_' || plant_id",
    "species": "'SPECIES_' || species_id",
    "location": "'LOCATION_' || city",
    "event": "event_id",
    "weather": uuid_id("WEATHER", "city", "today"),
    "today": "today",
    "prediction_date": "prediction_date",
    "sensor_data": uuid_id("SENSORDATA", "event_id", "sensor_id", "label"),
    "weather_data": uuid_id("WEATHERDATA", "city", "today", "label"),
    "species_data": uuid_id("SPECIESDATA", "CAST(species_id AS VARCHAR)", "label"),
}

SENSOR_VALUES = (f"sensor_values AS (SELECT DISTINCT sensor_id, plant_id, event_id, label, value, "
                 f"{NODE_IDS['sensor_data']} AS id FROM "
                 f"({stacked(SENSOR_LABELS, 'sensor_id, plant_id, event_id')}))")

# Distinct keys of each side; the edge statements join them.
KEY_TABLES = """
k_garden AS (SELECT DISTINCT garden_id FROM wide),
k_sensor AS (SELECT DISTINCT sensor_id, garden_id, plant_id, event_id FROM wide),
k_plant AS (SELECT DISTINCT plant_id, garden_id, species_id FROM wide),
k_species AS (SELECT DISTINCT species_id FROM wide),
k_location AS (SELECT DISTINCT city, garden_id FROM wide),
k_event AS (SELECT DISTINCT event_id, sensor_id, today FROM wide),
k_weather AS (SELECT DISTINCT city, today, prediction_date FROM wide),
k_date AS (SELECT today AS day FROM wide UNION SELECT prediction_date FROM wide)"""


def labels_table(labels: dict[str, str]) -> str:
    return "(VALUES " + ", ".join(f"('{x}')" for x in labels) + ") AS l(label)"


def edge(edge_type: str, start: str, end: str, source: str) -> str:
    """Distinct edges of a joined source."""
    return over_wide_ctes(KEY_TABLES, f"""
      SELECT start_id, end_id, '{edge_type}' AS type, {uuid_id('E', 'start_id', 'end_id')} AS id
      FROM (SELECT DISTINCT {start} AS start_id, {end} AS end_id FROM {source})""")


EDGE_SOURCES = {
    "described_by": ("species", "species_data", f"k_species, {labels_table(TRAIT_LABELS)}"),
    "plant_type": ("plant", "species", "k_plant JOIN k_species USING (species_id)"),
    "measures": ("sensor", "plant",
                 "(SELECT DISTINCT sensor_id, plant_id FROM k_sensor) JOIN "
                 "(SELECT DISTINCT plant_id FROM k_plant) USING (plant_id)"),
    "has_plant": ("garden", "plant", "k_garden JOIN k_plant USING (garden_id)"),
    "has_sensor": ("garden", "sensor", "k_garden JOIN k_sensor USING (garden_id)"),
    "registers": ("sensor", "event",
                  "(SELECT sensor_id, event_id FROM k_sensor) JOIN (SELECT event_id FROM k_event) USING (event_id)"),
    "located_in": ("garden", "location", "k_garden JOIN k_location USING (garden_id)"),
    "predicted_for": ("weather", "location", "k_weather JOIN (SELECT DISTINCT city FROM k_location) USING (city)"),
    "tomorrow_date": ("weather", "prediction_date", "k_weather JOIN k_date ON prediction_date = day"),
    "predicted_data": ("weather", "weather_data", f"k_weather, {labels_table(FORECAST_LABELS)}"),
    "today_date": ("event", "today", "k_event JOIN k_date ON today = day"),
    "contains": ("event", "sensor_data", f"k_event, {labels_table(SENSOR_LABELS)}"),
}
EDGE_TYPES = {name: name.upper() for name in EDGE_SOURCES}


def edge_sql(name: str) -> str:
    start, end, source = EDGE_SOURCES[name]
    return edge(EDGE_TYPES[name], NODE_IDS[start], NODE_IDS[end], source)


def edge_cte(name: str) -> str:
    """The same edges as a table expression ``e_<name>`` after KEY_TABLES."""
    start, end, source = EDGE_SOURCES[name]
    return (f"e_{name} AS (SELECT start_id, end_id, '{EDGE_TYPES[name]}' AS type, "
            f"{uuid_id('E', 'start_id', 'end_id')} AS id FROM (SELECT DISTINCT {NODE_IDS[start]} AS start_id, "
            f"{NODE_IDS[end]} AS end_id FROM {source}))")


def over_edges(names: list[str], body: str, more: str = "") -> str:
    ctes = ", ".join([KEY_TABLES, *[edge_cte(n) for n in names], *([more] if more else [])])
    return over_wide_ctes(ctes, body)


def all_edges_cte() -> str:
    return "e_all AS (" + " UNION ALL ".join(f"SELECT * FROM e_{n}" for n in EDGE_SOURCES) + ")"


EVENT_READINGS = """
er AS (
  SELECT CAST(user_id AS VARCHAR) AS device_id, event_type AS species_id, date_trunc('second', ts) AS t,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, value AS v
  FROM events)"""


def bucket32(text: str, modulo: int) -> str:
    """First 32 bits of an md5 as a bucket."""
    return f"(CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT) % {modulo})"
