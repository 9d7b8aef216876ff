"""Distributed append to Parquet or a relational table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def append_rows(df: DataFrame, location: str | dict[str, str]) -> None:
    """Append to a Parquet path or, given JDBC options, to a database table."""
    if isinstance(location, dict):
        df.write.format("jdbc").options(**location).mode("append").save()
    else:
        df.write.mode("append").parquet(location)
