"""File and message sinks."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gaugeworks.operators.reports import latest


def messages(df: DataFrame) -> DataFrame:
    """Each row as one JSON text in ``value``; NULL fields are left out."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def publish_messages(df: DataFrame, brokers: str, topic: str) -> None:
    """Send rows to Kafka as JSON. The connector must be on the cluster."""
    writer = messages(df).write.format("kafka")
    writer.option("kafka.bootstrap.servers", brokers).option("topic", topic).save()


def write_json_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).json(path)


def land_snapshot(df: DataFrame, path: str) -> int:
    """Replace the raw copy of a source and return its row count, counted while writing.

    Values are kept as they are, blanks at their ends too.
    """
    seen = Observation("snapshot")
    writer = df.observe(seen, F.count("*").alias("rows")).write.mode("overwrite")
    writer = writer.option("sep", ";").option("header", True).option("escape", '"')
    writer = writer.option("emptyValue", "").option("ignoreLeadingWhiteSpace", False)
    writer.option("ignoreTrailingWhiteSpace", False).csv(path)
    return seen.get["rows"]


def write_clean(df: DataFrame, path: str, partition_by: str = "observed_date") -> int:
    """Full overwrite of the clean Parquet data, by observation day. Returns the row count.

    Rebalancing gathers the rows of a day, so that not every task writes a file
    for every day, and adaptive execution splits a day that is too large for one
    task. ``path`` must not be one that ``df`` reads.
    """
    seen = Observation("clean")
    dated = df.withColumn(partition_by, F.to_date("observed_at")).hint("rebalance", partition_by)
    # Days differ in size: rows of one day are spread over the tasks by their key.
    writer = dated.observe(seen, F.count("*").alias("rows")).write.mode("overwrite")
    writer.partitionBy(partition_by).parquet(path)
    return seen.get["rows"]


def export_latest(df: DataFrame, path: str, n: int = 10) -> None:
    """The newest clean events as one semicolon CSV sample."""
    newest = latest(df, "observed_at", n, ["event_id"])
    newest.coalesce(1).write.mode("overwrite").option("sep", ";").option("header", True).csv(path)


def write_report(df: DataFrame, folder: str, report: str, run_at: datetime) -> str:
    """One CSV with a header under ``folder/report=…/run_ts=…``; older runs stay.

    For reports of a fixed number of lines: they go through one task. A time without
    a zone is UTC.
    """
    run_at = run_at.astimezone(timezone.utc) if run_at.tzinfo else run_at
    stamp = run_at.strftime("%Y%m%dT%H%M%S.%fZ")  # fixed value: the form of the run's name
    path = f"{folder}/report={report}/run_ts={stamp}"
    df.coalesce(1).write.option("header", True).csv(path)
    return path


def read_report(path: str, like: DataFrame) -> DataFrame:
    """A written report, in the columns and types of the frame it was written from."""
    rows = like.sparkSession.read.schema(like.schema).option("header", True).csv(path)
    return rows.coalesce(1)
