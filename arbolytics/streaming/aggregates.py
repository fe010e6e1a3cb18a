"""Windowed aggregates; the same plans run on streams and on tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Window, slide and lateness of the live averages.
WINDOW = "5 minutes"
SLIDE = "5 minutes"
LATENESS = "5 minutes"
# Averaged metrics per window and their output names.
WINDOW_AVERAGES = {
    "temp": "average_temperature",
    "co": "average_co",
    "humidity": "average_humidity",
    "smoke": "average_smoke",
    "lpg": "average_lpg",
    "rainfall": "average_rainfall",
}
# Averaged metrics per window and species.
SPECIES_AVERAGES = {
    "soil_temp": "average_soil_temp",
    "soil_humidity": "average_soil_humidity",
    "soil_nitrogen": "average_soil_nitrogen",
    "soil_potassium": "average_soil_potassium",
    "soil_phosporous": "average_soil_phosporous",
    "soil_ph": "average_soil_ph",
}


def with_lateness(readings: DataFrame, lateness: str | None = LATENESS) -> DataFrame:
    """Rows later than this behind the newest seen are dropped, and their state is freed."""
    return readings.withWatermark("event_time", lateness) if lateness else readings


def windowed(readings: DataFrame, keys: Sequence[str], aggregates: Mapping[str, Column],
             size: str = WINDOW, slide: str = SLIDE) -> DataFrame:
    """Aggregates per time window and key. Size and slide may differ."""
    return (readings.groupBy(F.window("event_time", size, slide).alias("time_window"), *keys)
            .agg(*[c.alias(name) for name, c in aggregates.items()])
            .select(F.col("time_window.start").alias("window_start"),
                    F.col("time_window.end").alias("window_end"), *keys, *aggregates))


def window_averages(readings: DataFrame, metrics: Mapping[str, str] = WINDOW_AVERAGES,
                    size: str = WINDOW, slide: str = SLIDE) -> DataFrame:
    """All averages of a window in one query with one state."""
    return windowed(readings, [], {out: F.avg(m) for m, out in metrics.items()}, size, slide)


def species_averages(readings: DataFrame, metrics: Mapping[str, str] = SPECIES_AVERAGES,
                     size: str = WINDOW, slide: str = SLIDE) -> DataFrame:
    return windowed(readings, ["species_id"], {out: F.avg(m) for m, out in metrics.items()}, size, slide)


def garden_counts(readings: DataFrame, size: str = WINDOW, slide: str = SLIDE) -> DataFrame:
    """Readings per window and garden."""
    return windowed(readings, ["garden_id"], {"count": F.count(F.lit(1))}, size, slide)
