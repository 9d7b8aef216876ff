"""The audit of a table kept by day, from counts that are stored per day.

A run compares the files of each day with those of the run before, scans the days that differ,
and stores their counts and their keys with the number of rows per key. The report adds up the
counts of all days. Keys that occur more than once, within a day or across days, are followed by
difference: only the keys of changed days can change, so their numbers of rows before and after are
compared and the stored total is moved. A change of the site list makes every day count as changed.

Versions are kept in a manifest: two audits at once do not mix.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.operators.lookup import BROADCAST_ROWS, fits_broadcast, lookup_join
from gaugeworks.operators.quality import (
    CONTROLS,
    action_report,
    audit_report,
    canonical_rows,
    metadata_differs,
    row_rules,
    source_padded,
)
from gaugeworks.session import materialise, scratch
from gaugeworks.sinks import manifest

_DAY = "__day"
#: A day's number in the run that scanned it: names of folders hold signs that a path escapes.
_SLOT = "slot"
_KEYS = "event_id STRING, n BIGINT"


def day_files(spark: SparkSession, path: str, day: str) -> dict[str, str]:
    """Version of every day's folder, by folder name: a digest of the names of its files.

    Spark gives every written file a name of its own, so a day that was written again differs.
    """
    held: dict[str, list[str]] = {}
    for name in spark.read.parquet(path).inputFiles():
        parts = name.split("/")
        found = [p for p in parts if p.startswith(f"{day}=")]
        held.setdefault(found[0] if found else "", []).append(parts[-1])
    return {d: hashlib.sha256("\n".join(sorted(n)).encode()).hexdigest() for d, n in held.items()}


def read_days(spark: SparkSession, path: str, days: Sequence[str], day: str) -> DataFrame:
    """Rows of the named day folders only, each with the name of its folder."""
    folders = [f"{path}/{unquote(d)}" if d else path for d in days]
    reader = spark.read.option("basePath", path).schema(spark.read.parquet(path).schema)
    name = F.regexp_extract("_metadata.file_path", f"/({day}=[^/]*)/", 1)
    return reader.parquet(*folders).withColumn(_DAY, name)


def _site_version(sensor: DataFrame) -> str:
    """Fingerprint of the site list, whatever the order of its rows."""
    canonical = canonical_rows(sensor)
    names = [F.col(c).cast("string") for c in canonical.columns]
    digest = F.xxhash64(*(F.coalesce(n, F.lit("\u0000")) for n in names)).cast("decimal(38,0)")
    row = canonical.agg(F.count("*"), F.sum(digest)).first()
    return f"{row[0]}:{row[1]}"


def _day_counts(rows: DataFrame, sensor: DataFrame, max_rows: int) -> DataFrame:
    """One row per day: rows checked and the violations of every rule but the key's."""
    joined = lookup_join(rows, canonical_rows(sensor), ["sensor_gid"], max_rows=max_rows)
    known = F.col("__known").isNotNull()
    counted = {**row_rules(), "source": source_padded()}
    counted |= {"metadata": known & metadata_differs(), "orphans": ~known}
    return joined.groupBy(_SLOT).agg(
        F.count("*").alias("checked_rows"), *(F.count_if(bad).alias(key) for key, bad in counted.items())
    )


def _keys(
    spark: SparkSession, root: str, days: dict[str, dict], only: Sequence[str] | None = None
) -> DataFrame:
    """(key, rows of it) of each of the days, or of some of them."""
    some = (e for d, e in sorted(days.items()) if only is None or d in only)
    paths = [f"{root}/keys/run={e['run']}/{_SLOT}={e['slot']}" for e in some]
    return spark.read.schema(_KEYS).parquet(*paths) if paths else spark.createDataFrame([], _KEYS)


def _repeated(held: DataFrame, wanted: DataFrame) -> int:
    """How many of the wanted keys have more than one row; NULL is one key."""
    key = F.struct(F.col("event_id").isNull(), F.coalesce("event_id", F.lit(""))).alias("k")
    held, wanted = held.select(key, "n"), wanted.select(key)
    if fits_broadcast(wanted):
        wanted = F.broadcast(wanted)
    totals = held.join(wanted, "k", "left_semi").groupBy("k").agg(F.sum("n").alias("n"))
    return totals.filter("n > 1").count()


def audit_days(
    spark: SparkSession,
    path: str,
    sensor: DataFrame,
    root: str,
    day: str = "observed_date",
    max_rows: int = BROADCAST_ROWS,
) -> manifest.Version:
    """Bring the audit of the table at ``path``, in folders by ``day``, up to date.

    Under ``root``: ``days`` has the counts, ``keys`` the keys of each day. The version names
    what belongs to each day and which days this run has scanned.
    """
    log = f"{root}/manifest"
    base = manifest.newest(spark, log)
    before: dict[str, dict] = base.content["days"] if base else {}
    sites = _site_version(sensor)
    same_sites = base is not None and base.content["sites"] == sites
    now = day_files(spark, path, day)
    kept = {d: e for d, e in before.items() if same_sites and now.get(d) == e["files"]}
    changed = sorted(d for d in now if d not in kept)
    gone = sorted(d for d in before if d not in kept)
    if base and not changed and not gone:
        return base
    run = uuid.uuid4().hex
    fresh = {d: {"run": run, "slot": i, "files": now[d]} for i, d in enumerate(changed)}
    if changed:
        slots = spark.createDataFrame([(d, e["slot"]) for d, e in fresh.items()], f"{_DAY} string, {_SLOT} int")
        rows = read_days(spark, path, changed, day).join(F.broadcast(slots), _DAY)
        with scratch(spark):
            counts = _day_counts(rows, sensor, max_rows)
            counts.coalesce(1).write.parquet(f"{root}/days/run={run}")  # one row per day
            keys = rows.groupBy(_SLOT, "event_id").agg(F.count("*").alias("n"))
            keys.hint("rebalance", _SLOT).write.partitionBy(_SLOT).parquet(f"{root}/keys/run={run}")
    after = kept | fresh
    if kept:
        with scratch(spark):
            touched = _keys(spark, root, before, gone).unionByName(_keys(spark, root, fresh))
            touched = materialise(touched.select("event_id").distinct(), "touched-keys")
            moved = _repeated(_keys(spark, root, after), touched)
            moved -= _repeated(_keys(spark, root, before), touched)
        duplicates = base.content["duplicates"] + moved
    else:
        everything = _keys(spark, root, after)
        totals = everything.groupBy("event_id").agg(F.sum("n").alias("n"))
        duplicates = totals.filter("n > 1").count()

    def change(newest: manifest.Version | None) -> dict:
        if (newest and newest.number) != (base and base.number):
            raise RuntimeError(f"{root}: another audit was first")
        return {"days": after, "duplicates": duplicates, "sites": sites, "scanned": changed}

    return manifest.extend(spark, log, change)


def _totals(spark: SparkSession, root: str) -> DataFrame:
    content = manifest.newest(spark, f"{root}/manifest").content
    names = ["checked_rows", *(c for c in CONTROLS if c != "duplicates"), "source"]
    schema = ", ".join(f"{n} BIGINT" for n in names)
    used = [(e["run"], e["slot"]) for e in content["days"].values()]
    rows = spark.createDataFrame([], schema)
    if used:
        folders = sorted({f"{root}/days/run={run}" for run, _ in used})
        reader = spark.read.option("basePath", f"{root}/days").schema(f"{_SLOT} INT, {schema}, run STRING")
        listed = spark.createDataFrame(used, f"run string, {_SLOT} int")  # one per day
        rows = reader.parquet(*folders).join(F.broadcast(listed), ["run", _SLOT], "left_semi")
    sums = rows.agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names))
    return sums.withColumn("duplicates", F.lit(content["duplicates"]).cast("bigint"))


def stored_audit(spark: SparkSession, root: str) -> DataFrame:
    """The eleven controls over all days, from the stored counts."""
    return audit_report(_totals(spark, root))


def stored_actions(spark: SparkSession, root: str) -> DataFrame:
    """Rows that each correction would change, from the stored counts."""
    return action_report(_totals(spark, root))
