"""Table scans from Parquet or a relational database."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def scan_table(
    spark: SparkSession, location: str | dict[str, str], schema: str | None = None
) -> DataFrame:
    """A Parquet path, or JDBC options (url, dbtable, and for a parallel read
    partitionColumn, lowerBound, upperBound, numPartitions).

    With a ``schema``, a Parquet path that does not exist yet has no rows.
    """
    if isinstance(location, dict):
        return spark.read.format("jdbc").options(**location).load()
    reader = spark.read.schema(schema) if schema else spark.read
    try:
        return reader.parquet(location)
    except AnalysisException as error:
        if schema is None or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def register_views(tables: dict[str, DataFrame]) -> None:
    """Make tables available to ``spark.sql`` under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
