"""A clean table of which only the days that arrive are replaced.

Each write puts its days into a folder of its own; a manifest version says which folder holds each
day. Files of other days stay where they are, a reader of the version before is not disturbed, and
writers of different days at the same time both count. Of two writers of one day the later one
stands.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks import files
from gaugeworks.sinks import manifest


def replace_days(
    df: DataFrame, root: str, day: str = "observed_date", value: Column | None = None
) -> manifest.Version:
    """Replace the days that ``df`` has rows of; ``value`` makes the day (date of observed_at)."""
    spark = df.sparkSession
    dated = df.withColumn(day, F.to_date("observed_at") if value is None else value)
    run = f"data/run={uuid.uuid4().hex}"
    dated.hint("rebalance", day).write.partitionBy(day).parquet(f"{root}/{run}")
    found = [n for n in files.names(spark, f"{root}/{run}") if n.startswith(f"{day}=")]
    schema = T.StructType([f for f in dated.schema.fields if f.name != day] + [dated.schema[day]])

    def change(base: manifest.Version | None) -> dict:
        held = base.content["days"] if base else {}
        if base and base.content["schema"] != schema.json():
            raise ValueError(f"{root} has other columns than these rows")
        return {"days": held | {n: f"{run}/{n}" for n in found}, "schema": schema.json(), "written": found}

    return manifest.extend(spark, f"{root}/manifest", change)


def read_days(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The table as of its newest version, or of an earlier one."""
    log = f"{root}/manifest"
    if version is None:
        found = manifest.newest(spark, log)
    else:
        found = next(v for v in manifest.history(spark, log) if v.number == version)
    schema = T.StructType.fromJson(json.loads(found.content["schema"]))
    folders = [f"{root}/{f}" for f in found.content["days"].values()]
    if not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.option("basePath", f"{root}/data")
    return reader.schema(schema).parquet(*folders).select(*schema.names)
