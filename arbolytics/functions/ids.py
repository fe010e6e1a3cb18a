"""Deterministic ids as built-in expressions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

# Fixed value: the DNS namespace of RFC 9562 name-based UUIDs.
DNS_NAMESPACE_HEX = "6ba7b8109dad11d180b400c04fd430c8"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def prefixed_id(prefix: str, key: Column | str) -> Column:
    """``PREFIX_key``; null when the key is null."""
    return F.concat(F.lit(prefix + "_"), _col(key).cast("string"))


def uuid5(*parts: Column | str) -> Column:
    """Version-5 UUID (DNS namespace) of the parts joined with ``-``.

    ``concat`` and not ``concat_ws``: a null part gives a null id instead of
    the id of a shorter key.
    """
    name = _col(parts[0]).cast("string")
    for part in parts[1:]:
        name = F.concat(name, F.lit("-"), _col(part).cast("string"))
    # A cast and not encode(): the planner then knows that the id of non-null keys is not null.
    digest = F.sha1(F.concat(F.lit(bytes.fromhex(DNS_NAMESPACE_HEX)), name.cast("binary")))
    # The variant digit keeps its low two bits and gets the high bits 10.
    variant = F.translate(digest.substr(17, 1), "0123456789abcdef", "89ab" * 4)
    return F.concat(
        digest.substr(1, 8), F.lit("-"), digest.substr(9, 4), F.lit("-5"), digest.substr(14, 3),
        F.lit("-"), variant, digest.substr(18, 3), F.lit("-"), digest.substr(21, 12))


def uuid_id(prefix: str, *parts: Column | str) -> Column:
    return F.concat(F.lit(prefix + "_"), uuid5(*parts))


def register_id_function(spark: SparkSession, name: str = "uuid5_id") -> None:
    """Register ``name(prefix, array_of_parts)`` for use from SQL text."""
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(prefix STRING, parts ARRAY<STRING>)
        RETURNS STRING
        RETURN SELECT concat(prefix, '_', substr(h, 1, 8), '-', substr(h, 9, 4), '-5', substr(h, 14, 3), '-',
                      translate(substr(h, 17, 1), '0123456789abcdef', '{"89ab" * 4}'),
                      substr(h, 18, 3), '-', substr(h, 21, 12))
          FROM (SELECT sha1(concat(unhex('{DNS_NAMESPACE_HEX}'),
                       CAST(CASE WHEN exists(parts, p -> p IS NULL) THEN NULL
                                 ELSE array_join(parts, '-') END AS BINARY))) AS h)""")
