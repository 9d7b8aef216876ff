"""Streaming sources. Kafka needs its connector on the cluster; files work everywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_options(
    brokers: str, topic: str, starting_offsets: str = "earliest", max_offsets: int | None = None
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def kafka_stream(spark: SparkSession, brokers: str, topic: str, **options: object) -> DataFrame:
    """Message values as text. Offsets live in the checkpoint of the query that reads them."""
    reader = spark.readStream.format("kafka").options(**kafka_options(brokers, topic, **options))
    return reader.load().selectExpr("cast(value AS string) AS value")


def json_file_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Lines of text files as they arrive, in the same shape as message values."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)
