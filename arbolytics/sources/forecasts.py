"""Nested forecast payloads to weather rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from arbolytics.functions.scalars import date_text, first_element
from arbolytics.sources.schemas import FORECAST_METRICS, FORECAST_PAYLOAD


def read_forecasts(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(FORECAST_PAYLOAD).option("multiLine", True).json(folder)


def label_forecasts(payloads: DataFrame, as_of: str, days_ahead: int = 1) -> DataFrame:
    """Dates of a collection run; both columns hold the labelled day."""
    day = date_text(F.lit(as_of), days_ahead)
    return payloads.withColumns({"pr_date": day, "prediction_date": day})


def flatten_forecasts(payloads: DataFrame) -> DataFrame:
    """One weather row per payload: the first element of each daily array."""
    return payloads.select(
        "pr_date", "prediction_date", "city",
        *[first_element(F.col(f"daily.{m}")).alias(m) for m in FORECAST_METRICS])


def rows_of_city_map(payloads: DataFrame, column: str = "forecasts") -> DataFrame:
    """A map ``city -> payload`` as one payload row per city."""
    return (payloads.select(F.explode(column).alias("map_city", "payload"))
            .select("payload.*", "map_city").drop("city").withColumnRenamed("map_city", "city"))
