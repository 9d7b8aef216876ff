"""Loading each event once with the loaded ids in keyed state.

``load_clean`` compares a batch with the ids that are stored as a table, so its time grows with all
that was ever loaded. Here the ids are Spark state, in an embedded store (RocksDB) beside the tasks,
with changelogs in the checkpoint: a batch touches only its own ids. With a time to live an id is
forgotten that long after its first copy. The state belongs to the checkpoint: one checkpoint per
target, and a cleared one starts without ids.

The state operator is Spark's own de-duplication of a key column, so no Python runs per event; only
a time to live needs a state function, called once per id of a batch, which is a fixed cost. Which
copy of a batch is kept is not its concern: it says which ids are new, and the batch's own rows are
compared for those.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from gaugeworks.operators.constraints import clean_row_checks, flag_violations
from gaugeworks.operators.dedupe import first_per_key
from gaugeworks.operators.lookup import fits_broadcast
from gaugeworks.operators.merge import to_target
from gaugeworks.plans.flows import KEY_COLUMNS, type_events
from gaugeworks.schemas import WEATHER_SENSOR_CLEAN
from gaugeworks.session import materialise, scratch
from gaugeworks.streaming import commits
from gaugeworks.streaming.flows import _count, _together, trigger_options

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
_NEW = "__new"


class NewKey(StatefulProcessor):
    """A key, if it is not held."""

    def __init__(self, key: str, ttl_ms: int) -> None:
        self.key, self.ttl_ms = key, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "held BOOLEAN", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for _ in rows:
            pass
        if not self.seen.exists():
            self.seen.update((True,))
            yield pd.DataFrame({self.key: [key[0]]})

    def close(self) -> None:
        pass


def new_keys(stream: DataFrame, key: str, ttl_ms: int | None = None) -> DataFrame:
    """Each key in the first batch that has it, once. Needs the embedded store, see ``keyed_settings``.

    With a time to live a key is new again that long after it was, by the clock.
    """
    keys = stream.select(key)
    if not ttl_ms:
        return keys.dropDuplicates([key])
    processor = NewKey(key, ttl_ms)
    return keys.groupBy(key).transformWithStateInPandas(processor, keys.schema, "Append", "ProcessingTime")


def keyed_settings() -> dict[str, str]:
    """Session settings that a query with keyed state starts under."""
    return {_STORE: _ROCKS, _CHANGELOG: "true"}


def _checked(
    enriched: DataFrame, run_at: datetime | None, source_tz: str, sensor: DataFrame | None
) -> DataFrame:
    """Typed rows of the stream with all they violate, judged row by row."""
    rows = enriched.drop("query_id", "batch_id")
    typed = type_events(rows, run_at or datetime.now(timezone.utc), source_tz)
    if run_at is None:
        typed = typed.withColumn("processed_at", F.current_timestamp())
    gaps = [F.when(F.col(c).isNull(), F.lit(f"{c} not null")) for c in KEY_COLUMNS]
    typed = typed.withColumn("__gaps", F.array_compact(F.array(*gaps)))
    checked = flag_violations(typed, clean_row_checks())
    unknown = F.lit(None).cast("string")
    if sensor is not None:
        known = sensor.select(F.col("gid").cast("int").alias("sensor_gid")).dropna().distinct()
        known = known.withColumn("__known", F.lit(True))
        checked = checked.join(F.broadcast(known) if fits_broadcast(known) else known, "sensor_gid", "left")
        unknown = F.when(F.col("sensor_gid").isNotNull() & F.col("__known").isNull(), "sensor_gid exists")
    # A row without key, time or site is told only what it lacks, as in ``load_clean``.
    violations = F.when(F.size("__gaps") > 0, F.col("__gaps")).otherwise(
        F.array_compact(F.concat(F.array(unknown), "violations"))
    )
    return checked.withColumn("violations", violations).select(*typed.drop("__gaps").columns, "violations")


def load_clean_keyed(
    enriched: DataFrame,
    target: str,
    checkpoint: str,
    every: str | None = None,
    run_at: datetime | None = None,
    source_tz: str = "UTC",
    sensor: DataFrame | None = None,
    ttl_ms: int | None = None,
) -> StreamingQuery:
    """Clean the stream and append each loadable event once; its id is kept as state.

    Under ``target``: ``loaded``, ``rejected`` and ``counters`` as ``load_clean`` writes them,
    committed batch by batch. Refused rows take no state, so a broken copy never hides a good one.
    """
    spark = enriched.sparkSession
    query = commits.query_id(spark, checkpoint)
    checked = _checked(enriched, run_at, source_tz, sensor)
    good = F.size("violations") == 0
    new = new_keys(checked.filter(good), "event_id", ttl_ms).withColumn(_NEW, F.lit(True))
    marked = checked.withColumn(_NEW, F.lit(False)).unionByName(new, allowMissingColumns=True)

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if commits.is_committed(session, target, query, batch_id):
            return
        with scratch(session):
            found = materialise(batch, "keyed")  # once: the state is asked and changed by it
            fresh, rows = found.filter(_NEW).select("event_id"), found.filter(f"NOT {_NEW}").drop(_NEW)
            first = first_per_key(rows.filter(good).drop("violations"), ["event_id"], ["collected_at"])
            loaded = to_target(first.join(fresh, "event_id", "left_semi"), WEATHER_SENSOR_CLEAN)
            loaded, n_loaded = _count(loaded, "loaded", "n")
            refused, n_refused = _count(rows.filter(~good), "rejected", "n")
            _together(
                session,
                lambda: commits.land(loaded, f"{target}/loaded", query, batch_id, "parquet"),
                lambda: commits.land(refused, f"{target}/rejected", query, batch_id, "parquet"),
            )
            counts = {"loaded": n_loaded.get["n"], "rejected": n_refused.get["n"]}
        commits.commit(session, target, query, batch_id, counts)

    settings = keyed_settings()
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:  # a query keeps the settings it was started under
        writer = marked.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        return writer.outputMode("append").trigger(**trigger_options(every)).start()
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
