"""Payloads whose fields change type: landed as VARIANT, typed when they are read."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def land_variants(df: DataFrame, text: str = "value") -> DataFrame:
    """JSON text as ``payload`` VARIANT; text that does not parse stays in ``unreadable``."""
    payload = F.try_parse_json(F.col(text).cast("string"))
    keep = [c for c in df.columns if c != text]
    bad = F.when(F.col(text).isNotNull() & F.col("payload").isNull(), F.col(text))
    return df.withColumn("payload", payload).select(*keep, "payload", bad.alias("unreadable"))


def payload_schema(df: DataFrame, payload: str = "payload") -> str:
    """The type that holds every payload, as DDL; a field of several types is a VARIANT."""
    return df.agg(F.schema_of_variant_agg(payload)).first()[0]


def field(payload: str, path: str, kind: str) -> Column:
    """A field as a type, or NULL. Text that reads as the type counts, as do other numbers."""
    value = F.try_variant_get(payload, path, kind)
    if kind.lower().startswith(("string", "array", "map", "struct", "variant")):
        return value
    return F.coalesce(value, F.trim(F.try_variant_get(payload, path, "string")).try_cast(kind))


def typed(df: DataFrame, fields: Mapping[str, tuple[str, str]], payload: str = "payload") -> DataFrame:
    """``df`` with output columns (path, type) of the payload in its place."""
    kept = [c for c in df.columns if c != payload]
    return df.select(*kept, *(field(payload, *of).alias(name) for name, of in fields.items()))
