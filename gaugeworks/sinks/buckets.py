"""A keyed table in hash buckets, updated by writing only the buckets that change.

A manifest version says which folder holds each bucket. An upsert reads and writes the buckets of
its own keys and takes the folders of all others over by name, so its cost follows the touched
buckets and readers of the version before are not disturbed. Two writers on one base: when their
buckets differ, the later one keeps the other's folders; when they share a bucket, the later one
does its work again on the new base.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks import files
from gaugeworks.operators.dedupe import first_per_key
from gaugeworks.operators.merge import upsert
from gaugeworks.session import materialise, remove_path
from gaugeworks.sinks import manifest

_BUCKET = "__bucket"


class Conflict(RuntimeError):
    """Another writer changed a bucket that this one changed, too."""


def _log(root: str) -> str:
    return f"{root}/manifest"


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _write(rows: DataFrame, root: str) -> dict[str, str]:
    """Write rows by bucket under a new run; the folder of each bucket by its number.

    A bucket that is too large for one task is split by adaptive execution.
    """
    run = f"data/run={uuid.uuid4().hex}"
    spread = rows.hint("rebalance", _BUCKET)
    spread.write.partitionBy(_BUCKET).parquet(f"{root}/{run}")
    found = (n for n in files.names(rows.sparkSession, f"{root}/{run}") if n.startswith(f"{_BUCKET}="))
    return {n.split("=")[1]: f"{run}/{n}" for n in found}


def create_buckets(
    df: DataFrame, root: str, keys: Sequence[str], buckets: int, order: Sequence[Column | str] = ()
) -> manifest.Version:
    """The first version of a table: the first row of each key by ``order``, none without a key.

    ``buckets`` is fixed from then on: choose it so that a bucket at the table's final size is
    a few files.
    """
    rows = first_per_key(df.dropna(subset=list(keys)), list(keys), list(order) or list(keys))
    folders = _write(rows.withColumn(_BUCKET, _bucket(keys, buckets)), root)

    def first(base: manifest.Version | None) -> dict:
        if base:
            raise Conflict(f"{root} is a table already")
        return {"keys": list(keys), "n": buckets, "schema": df.schema.json(), "buckets": folders, "run": None}

    return manifest.extend(df.sparkSession, _log(root), first)


def _read(spark: SparkSession, root: str, content: dict, only: Sequence[str] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(content["schema"]))
    folders = [f for b, f in content["buckets"].items() if only is None or b in only]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{root}/{f}" for f in folders))


def read_buckets(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The table as of its newest version, or of an earlier one that was not removed."""
    if version is None:
        return _read(spark, root, manifest.newest(spark, _log(root)).content)
    content = next(v.content for v in manifest.history(spark, _log(root)) if v.number == version)
    return _read(spark, root, content)


def upsert_buckets(
    updates: DataFrame, root: str, order: Sequence[Column | str], attempts: int = 10
) -> manifest.Version:
    """Insert or update by key; the first update of a key by ``order`` counts.

    Updates without a key are left to ``without_key``. Rows of untouched buckets are not read.
    """
    spark = updates.sparkSession
    for _ in range(attempts):
        base = manifest.newest(spark, _log(root))
        keys, n = base.content["keys"], base.content["n"]
        columns = T.StructType.fromJson(json.loads(base.content["schema"])).names
        chosen = first_per_key(updates.dropna(subset=keys).select(*columns), keys, list(order))
        chosen = materialise(chosen, "updates")
        rows = chosen.select(_bucket(keys, n).cast("string").alias("b")).distinct().collect()
        touched = {r["b"] for r in rows}  # at most one per bucket
        held = _read(spark, root, base.content, touched)
        merged = upsert(held, chosen, keys, list(order))
        folders = _write(merged.withColumn(_BUCKET, _bucket(keys, n)), root) if touched else {}

        def change(now: manifest.Version | None, base=base, folders=folders, touched=touched) -> dict:
            was, held = base.content["buckets"], now.content["buckets"]
            if any(was.get(b) != held.get(b) for b in touched):
                raise Conflict(root)
            return now.content | {"buckets": held | folders}

        try:
            return manifest.extend(spark, _log(root), change)
        except Conflict:
            continue
    raise Conflict(f"{root}: {attempts} times another writer was first")


def remove_unused(spark: SparkSession, root: str, keep_versions: int) -> int:
    """Delete the bucket folders that the last ``keep_versions`` versions do not name.

    Run it while nobody writes: folders of a version that is being made are not named yet.
    """
    used: set[str] = set()
    for version in manifest.history(spark, _log(root)):
        if keep_versions <= 0:
            break
        used |= set(version.content["buckets"].values())
        keep_versions -= 1
    removed = 0
    for run in files.names(spark, f"{root}/data"):
        for name in files.names(spark, f"{root}/data/{run}"):
            if name.startswith(f"{_BUCKET}=") and f"data/{run}/{name}" not in used:
                remove_path(spark, f"{root}/data/{run}/{name}")
                removed += 1
    return removed
