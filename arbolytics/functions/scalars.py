"""Small column expressions shared by the plans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F, types as T

# Fixed value: text form of a reading's time.
READING_TIME_PATTERN = "yyyy-MM-dd_HH-mm-ss"


def parse_reading_time(text: Column) -> Column:
    """Timestamp of a reading; null for text in another form."""
    return F.try_to_timestamp(text, F.lit(READING_TIME_PATTERN))


def format_reading_time(ts: Column) -> Column:
    return F.date_format(ts, READING_TIME_PATTERN)


def date_text(day: Column, plus_days: int = 0) -> Column:
    """ISO text of a date, moved by ``plus_days``."""
    return F.date_format(F.date_add(day.cast("date"), plus_days), "yyyy-MM-dd")


def folder_date(path: Column) -> Column:
    """The first ISO date in a path; null if there is none."""
    return F.try_to_date(F.regexp_extract(path, r"(\d{4}-\d{2}-\d{2})", 1), "yyyy-MM-dd")


def decode_url(text: Column) -> Column:
    """Percent codes decoded; a plus sign stays one."""
    return F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def partition_value(path: Column, key: str) -> Column:
    """The value of ``key=value`` in a folder's path, without the escapes of folder names.

    Paths of ``_metadata.file_path`` are escaped once more; ``with_source_file`` undoes that.
    """
    raw = F.regexp_extract(path, f"(?:^|/){key}=([^/]*)", 1)
    return F.when(raw == "", None).otherwise(decode_url(raw))


def has_suffix(path: Column, suffix: str) -> Column:
    """Suffix test without regard to case."""
    return F.endswith(F.lower(path), F.lit(suffix.lower()))


def path_part(path: Column, index: int) -> Column:
    """Part of a ``/`` path; negative indexes count from the end."""
    return F.split_part(path, F.lit("/"), F.lit(index))


def message_key(device: Column, time_text: Column) -> Column:
    return F.concat_ws("_", device, time_text)


def plant_of_pair(pair: Column) -> Column:
    """First half of a ``plant:species`` pair."""
    return F.split_part(pair, F.lit(":"), F.lit(1))


def species_of_pair(pair: Column) -> Column:
    return F.split_part(pair, F.lit(":"), F.lit(2))


def to_int(value: Column) -> Column:
    """Integer of a number or a text; null instead of an error.

    Text is read as a number first, so ``"12.0"`` gives 12 as a plain cast does
    outside ANSI mode.
    """
    return value.cast("string").try_cast("double").try_cast("int")


def to_double(value: Column) -> Column:
    return value.try_cast("double")


def first_element(values: Column) -> Column:
    """Element 0 of an array; null for an empty array."""
    return F.get(values, 0)


def map_values(value: Column, names: Mapping[str, str], otherwise: str | None = None) -> Column:
    """Replace a value by its name in a small fixed mapping."""
    lookup = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    mapped = F.try_element_at(lookup, value)
    return F.coalesce(mapped, F.lit(otherwise)) if otherwise is not None else mapped


def min_max_scale(value: Column, low: Column, high: Column) -> Column:
    """Position of a value between two bounds; 0 when the bounds are equal."""
    return F.when(high > low, (value - low) / (high - low)).when(high == low, F.lit(0.0))


def one_hot(value: Column, categories: Sequence[str], prefix: str) -> list[Column]:
    """One 0/1 column per category, in sorted order."""
    return [(value == F.lit(c)).cast("double").alias(prefix + c) for c in sorted(categories)]


def sigmoid(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def relu(x: Column) -> Column:
    return F.greatest(x, F.lit(0.0))


def over_threshold(p: Column, threshold: float = 0.5) -> Column:
    return F.when(p > threshold, 1.0).when(p.isNotNull(), 0.0)


def log_loss(label: Column, p: Column, floor: float = 1e-15) -> Column:
    """Binary cross-entropy, aggregated over rows."""
    safe = F.least(F.greatest(p, F.lit(floor)), F.lit(1.0 - floor))
    return -F.avg(label * F.log(safe) + (1.0 - label) * F.log(1.0 - safe))


def accuracy(label: Column, predicted: Column) -> Column:
    return F.avg((label == predicted).cast("double"))
