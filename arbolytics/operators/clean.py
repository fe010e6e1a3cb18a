"""Cleaning steps between the landing and the formatted tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from arbolytics.functions.scalars import map_values
from arbolytics.operators.quality import require_columns
from arbolytics.sources.schemas import COMMON_NAMES, FAMILIES, TRAIT_COLUMNS


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    return df.select([F.col(f"`{c}`").alias(prefix + c) for c in df.columns])


def conform(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The expected columns in order; extra ones go, missing ones raise."""
    return require_columns(df, columns).select(*[F.col(f"`{c}`") for c in columns])


def relax_nullability(df: DataFrame) -> DataFrame:
    """All columns nullable, nested ones included."""
    def loose(dt: T.DataType) -> T.DataType:
        if isinstance(dt, T.StructType):
            return T.StructType([T.StructField(f.name, loose(f.dataType), True, f.metadata) for f in dt])
        if isinstance(dt, T.ArrayType):
            return T.ArrayType(loose(dt.elementType), True)
        if isinstance(dt, T.MapType):
            return T.MapType(dt.keyType, loose(dt.valueType), True)
        return dt

    # A union is nullable where one side is; the optimizer removes the empty side.
    return df.sparkSession.createDataFrame([], loose(df.schema)).union(df)


def round_doubles(df: DataFrame, places: int = 3) -> DataFrame:
    """Round every double column, half up, in one projection."""
    return df.select([
        F.round(F.col(f"`{f.name}`"), places).alias(f.name) if isinstance(f.dataType, T.DoubleType)
        else F.col(f"`{f.name}`") for f in df.schema])


def all_text(df: DataFrame) -> DataFrame:
    return df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def dedup(df: DataFrame) -> DataFrame:
    """Drop exact copies. A group of copies shrinks before the shuffle."""
    return df.distinct()


def dedup_per_source(df: DataFrame, source: str) -> DataFrame:
    """Drop copies within a source; copies in different sources stay."""
    return df.distinct().drop(source)


def union_by_name(frames: Sequence[DataFrame], fill_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=fill_missing), frames)


def rows_not_in(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(other.select(*keys), list(keys), "left_anti")


def keep_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.filter(F.col(column).isin(list(values)))


def name_species(df: DataFrame, column: str, names: Mapping[str, str], out: str = "plant_name",
                 otherwise: str = "Unknown") -> DataFrame:
    return df.withColumn(out, map_values(F.col(column), names, otherwise))


def format_readings(readings: DataFrame) -> DataFrame:
    """Formatted readings: ``sensor_id`` instead of ``device_id``, no copies."""
    if "device_id" in readings.columns:
        readings = readings.withColumnRenamed("device_id", "sensor_id")
    return dedup(readings)


def format_weather(weather: DataFrame, source: str | None = None) -> DataFrame:
    """Formatted weather: no collection date and no copies.

    With ``source`` (a file-name column) copies are dropped per file only.
    """
    rows = weather.drop("pr_date")
    return dedup_per_source(rows, source) if source else dedup(rows)


def format_traits(traits: DataFrame, names: Mapping[str, str] = COMMON_NAMES,
                  families: Sequence[str] = FAMILIES) -> DataFrame:
    """Traits of the species of interest, with their common name."""
    species = "Species_name_standardized_against_TPL"
    rows = keep_values(conform(traits, TRAIT_COLUMNS), "Family", families)
    return name_species(keep_values(rows, species, list(names)), species, names).drop("Family")
