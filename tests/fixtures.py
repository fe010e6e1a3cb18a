"""Invented feeds in the full schemas."""

from __future__ import annotations

import itertools

from arbolytics.sources.schemas import (
    COMMON_NAMES, FORECAST_METRICS, GRAPH_TRAITS, NUMERIC_METRICS, READING, TRAIT_COLUMNS, TRAITS, WEATHER)

GARDENS = [("G1", "Big Size Garden", "Madrid"), ("G2", "Middle Size Garden", "Lleida"),
           ("G3", "Small Garden With Lamp", "Taragona"), ("G4", "None", "Girona")]
AS_OF = "2030-05-01"


def reading(device, plant, species, garden, i, **changes):
    row = {"device_id": device, "light": i % 2 == 0, "motion": i % 3 == 0}
    row |= {m: float(i % 7) + k / 10 for k, m in enumerate(NUMERIC_METRICS)}
    row |= {"garden_id": garden[0], "garden_name": garden[1], "location": garden[2],
            "species_id": species, "plant_id": plant,
            "timestamp": f"2030-05-01_10-{i % 60:02d}-00"}
    return row | changes


def reading_rows():
    """Two sensors per garden, three plants per sensor, several readings of a plant on one day."""
    rows, i = [], 0
    for g, s, p in itertools.product(range(4), range(2), range(3)):
        plant = f"p{g}{(s + p) % 4}"
        for _ in range(2):
            i += 1
            rows.append(reading(f"aa:{g}{s}", plant, str(1 + (s + p) % 3), GARDENS[g], i))
    return rows


def readings(spark):
    rows = reading_rows()
    return spark.createDataFrame([tuple(r[c] for c in READING.fieldNames()) for r in rows], READING)


def weather(spark):
    cities = ["Madrid", "Lleida", "Tarragona", "Girona", "Barcelona"]
    rows = [("2030-05-02", "2030-05-02", c, *[float(i) + k for k in range(len(FORECAST_METRICS))])
            for i, c in enumerate(cities)]
    return spark.createDataFrame(rows, WEATHER)


def traits(spark):
    names = list(COMMON_NAMES)[:3] + ["Rosa canina"]
    rows = []
    for i, name in enumerate(names, start=1):
        row = {c: f"{c}-{i}" for c in TRAIT_COLUMNS}
        row |= {f.name: float(i) for f in TRAITS if f.dataType.simpleString() == "double"}
        row |= {"Species_id": i, "Species_name_standardized_against_TPL": name, "Family": "Rosaceae"}
        rows.append(tuple(row[c] for c in TRAIT_COLUMNS))
    return spark.createDataFrame(rows, TRAITS)


def wide(spark):
    from arbolytics.operators.clean import format_readings, format_traits, format_weather
    from arbolytics.operators.wide import wide_table, with_run

    return with_run(wide_table(format_readings(readings(spark)), format_weather(weather(spark)),
                               format_traits(traits(spark))), AS_OF)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


__all__ = ["GRAPH_TRAITS", "readings", "weather", "traits", "wide", "rows_of", "reading", "reading_rows"]
