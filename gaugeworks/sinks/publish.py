"""All-or-nothing publication of several tables, by any number of publishers."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from gaugeworks.sinks import manifest


def publish(
    tables: dict[str, DataFrame],
    root: str,
    check: Callable[[dict[str, DataFrame]], None] | None = None,
) -> str:
    """Write every table to a new run folder, check them, then add one manifest version.

    Readers follow the manifest, so a run that fails half way is never seen.
    ``check`` gets the written tables and raises to refuse them. Publishers at the same
    time each get their own version; the later one stands for the tables both wrote, and
    both are in the history.
    """
    spark = next(iter(tables.values())).sparkSession
    run_id = uuid.uuid4().hex
    for name, df in tables.items():
        df.write.parquet(f"{root}/run={run_id}/{name}")
    if check:
        check({name: spark.read.parquet(f"{root}/run={run_id}/{name}") for name in tables})

    def add(base: manifest.Version | None) -> dict:
        runs = dict(base.content["runs"]) if base else {}
        at = datetime.now(timezone.utc).isoformat()
        names = sorted(tables)
        return {"run_id": run_id, "published_at": at, "tables": names, "runs": runs | dict.fromkeys(names, run_id)}

    manifest.extend(spark, f"{root}/manifest", add)
    return run_id


def published_runs(spark: SparkSession, root: str) -> list[str]:
    """Ids of all runs, the first one first."""
    return [v.content["run_id"] for v in manifest.history(spark, f"{root}/manifest")][::-1]


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The table as of the latest run that published it, or None when there is none."""
    last = manifest.newest(spark, f"{root}/manifest")
    run_id = last.content["runs"].get(name) if last else None
    return spark.read.parquet(f"{root}/run={run_id}/{name}") if run_id else None
