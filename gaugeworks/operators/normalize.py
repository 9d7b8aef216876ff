"""Inventory staging text to dimension, entity and fact tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions import blank_to_null, point_part, to_decimal, to_instant, to_int
from gaugeworks.operators.lookup import lookup_join


def sensor_types(staging: DataFrame) -> DataFrame:
    code = blank_to_null("sensor_type")
    return staging.select(code.alias("code"), code.alias("label")).dropna().distinct()


def traffic_zones(staging: DataFrame) -> DataFrame:
    """Distinct (code, label) pairs: ``'1'`` and ``'01'`` give two rows with one code,
    which the key check on this table reports."""
    label = blank_to_null("zone")
    return (
        staging.select(label.alias("source_label"))
        .dropna()
        .distinct()
        .select(F.col("source_label").try_cast("int").alias("zone_code"), "source_label")
    )


def sensors(staging: DataFrame, source_tz: str = "UTC") -> DataFrame:
    """One typed row per inventory line with a gid. Values that do not convert are NULL."""
    return staging.filter(blank_to_null("gid").isNotNull()).select(
        to_int("gid").alias("gid"),
        F.trim("ident").alias("ident"),
        F.trim("libelle").alias("libelle"),
        F.trim("sensor_type").alias("type_code"),
        to_int("zone").alias("zone_code"),
        to_decimal(point_part("geo_point", 1), 10, 7).alias("latitude"),
        to_decimal(point_part("geo_point", 2), 10, 7).alias("longitude"),
        F.col("geo_point").alias("geo_point_source"),
        "geo_shape",
        to_instant("cdate", source_tz).alias("cdate"),
        to_instant("mdate", source_tz).alias("mdate"),
    )


def measurements(staging: DataFrame, source_tz: str = "UTC") -> DataFrame:
    """Current count of the sites that have one; the modification time stands for its date."""
    return staging.filter(blank_to_null("comptage_5m").isNotNull()).select(
        to_int("gid").alias("sensor_gid"),
        to_int("comptage_5m").alias("comptage_5m"),
        to_instant("mdate", source_tz).alias("observed_at"),
    )


def manual_measurement(
    sensor: DataFrame, ident: str, count: int, observed_at: datetime | Column
) -> DataFrame:
    """Update row for the site known as ``ident``; no row when there is none."""
    at = observed_at if isinstance(observed_at, Column) else F.lit(observed_at)
    return sensor.filter(F.col("ident") == ident).select(
        F.col("gid").alias("sensor_gid"),
        F.lit(count).alias("comptage_5m"),
        at.cast("timestamp").alias("observed_at"),
    )


def count_by(entities: DataFrame, dimension: DataFrame, fk: str, pk: str) -> DataFrame:
    """Entities per key of a dimension, ordered by key.

    Counting comes first, so the join sees one row per foreign key value. Each
    dimension row with that key counts, as in a plain inner join.
    """
    counted = entities.groupBy(F.col(fk).alias(pk)).agg(F.count("*").alias("__n"))
    matches = dimension.groupBy(pk).agg(F.count("*").alias("__m"))
    return (
        counted.join(matches, pk)
        .select(pk, (F.col("__n") * F.col("__m")).alias("site_count"))
        .orderBy(pk)
    )


def without_measurement(entities: DataFrame, facts: DataFrame, pk: str, fk: str) -> DataFrame:
    """Number of entities that no fact refers to."""
    seen = facts.select(F.col(fk).alias(pk)).dropna().distinct()
    return entities.join(seen, pk, "left_anti").agg(F.count("*").alias("without_measurement"))


def keep_children(children: DataFrame, parents: DataFrame, fk: str, pk: str) -> DataFrame:
    """Rows whose parent still exists, as after a cascading delete."""
    kept = parents.select(F.col(pk).alias(fk)).distinct()
    return lookup_join(children, kept, [fk], "left_semi")
