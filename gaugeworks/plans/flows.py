"""The three end-to-end flows: inventory load, event cleaning, quality run."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.functions import ntz_instant, to_double, to_instant, to_int
from gaugeworks.operators.constraints import (
    Validation,
    clean_row_checks,
    measurement_checks,
    require_rows,
    sensor_checks,
    type_checks,
    validate,
    zone_checks,
)
from gaugeworks.operators.dedupe import first_per_key
from gaugeworks.operators.merge import to_target
from gaugeworks.operators.normalize import measurements, sensor_types, sensors, traffic_zones
from gaugeworks.operators.quality import audit, audit_and_actions, repair
from gaugeworks.schemas import WEATHER_SENSOR_CLEAN
from gaugeworks.session import materialise
from gaugeworks.sinks import publish, read_report, write_report
from gaugeworks.sources import read_inventory

# The event row keeps its key, its time and its site, or it is not usable.
KEY_COLUMNS = ("event_id", "observed_at", "sensor_gid")


def load_inventory(
    spark: SparkSession, path: str, source_tz: str = "UTC", multi_line: bool = False
) -> dict[str, Validation]:
    """Normalised tables of an inventory file, each split into valid and quarantined rows.

    Sites are checked against the types and zones that are valid themselves: a zone
    code that is written in two ways is quarantined, and its sites with it.
    """
    staging = read_inventory(spark, path, multi_line=multi_line)
    types = validate(sensor_types(staging), type_checks())
    zones = validate(traffic_zones(staging), zone_checks())
    sensor = validate(sensors(staging, source_tz), sensor_checks(types.valid, zones.valid))
    return {
        "sensor_type": types,
        "traffic_zone": zones,
        "sensor": sensor,
        "sensor_measurement": validate(
            measurements(staging, source_tz), measurement_checks(sensor.valid)
        ),
    }


def type_events(enriched: DataFrame, run_at: datetime, source_tz: str = "UTC") -> DataFrame:
    """Typed columns; a value that does not convert is NULL, missing rain is 0."""
    kinds = dict(enriched.dtypes)

    def number(c: str) -> Column:
        return to_double(c) if kinds[c] == "string" else F.col(c).try_cast("double")

    def integer(c: str) -> Column:
        return to_int(c) if kinds[c] == "string" else F.col(c).try_cast("int")

    def instant(c: str) -> Column:
        if kinds[c] == "timestamp":
            return F.col(c)
        if kinds[c] == "timestamp_ntz":
            return ntz_instant(c) if source_tz == "UTC" else to_instant(F.col(c).cast("string"), source_tz)
        return to_instant(c, source_tz)

    return enriched.withColumns(
        {
            "observed_at": instant("observed_at"),
            "collected_at": instant("collected_at"),
            "temperature_c": number("temperature_c"),
            "humidity_pct": number("humidity_pct"),
            "wind_speed_kmh": number("wind_speed_kmh"),
            "precipitation_mm": F.coalesce(number("precipitation_mm"), F.lit(0.0)),
            "sensor_gid": integer("sensor_gid"),
            "zone": integer("zone"),
            "comptage_5m": integer("comptage_5m"),
            "processed_at": F.lit(run_at).cast("timestamp"),
        }
    )


def split_usable(typed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with key, time and site, the others with ``violations``)."""
    gaps = F.array_compact(
        F.array(*(F.when(F.col(c).isNull(), F.lit(f"{c} not null")) for c in KEY_COLUMNS))
    )
    marked = typed.withColumn("violations", gaps)
    good = F.size("violations") == 0
    return marked.filter(good).drop("violations"), marked.filter(~good)


def clean_events(enriched: DataFrame, run_at: datetime, source_tz: str = "UTC") -> DataFrame:
    """Type, set rows without key, time or site aside, then keep the first copy of each event.

    Rows are judged before copies are removed, so a broken copy never hides a
    good one. ``unusable_events`` has the rows that are set aside.
    """
    usable, _ = split_usable(type_events(enriched, run_at, source_tz))
    return first_per_key(usable, ["event_id"], ["collected_at"])


def unusable_events(enriched: DataFrame, run_at: datetime, source_tz: str = "UTC") -> DataFrame:
    """The rows that ``clean_events`` sets aside, with what they lack in ``violations``."""
    return split_usable(type_events(enriched, run_at, source_tz))[1]


def loadable_events(cleaned: DataFrame, sensor: DataFrame | None = None) -> Validation:
    """Rows that the final table accepts, in its columns and types, and the others.

    With the site table, the event's site must exist in it.
    """
    checked = validate(cleaned, clean_row_checks(sensor))
    return Validation(
        to_target(checked.valid, WEATHER_SENSOR_CLEAN), checked.quarantined, checked.summary
    )


@dataclass(frozen=True)
class QualityRun:
    before: DataFrame
    actions: DataFrame
    after: DataFrame
    repaired: DataFrame
    run_id: str
    reports: tuple[str, ...]


def quality_run(
    events: DataFrame, sensor: DataFrame, root: str, run_at: datetime, immutable: bool = False
) -> QualityRun:
    """Audit, repair and audit again on one snapshot of the events.

    The events are written once as a snapshot, so that the audit, the counts and
    the repair cannot see different rows; set ``immutable`` for a table that does
    not change, such as one that was published. The repaired table is written
    once, audited as written, and becomes visible through the manifest under
    ``root`` after the three reports.
    """
    snapshot = require_rows(events if immutable else materialise(events, "snapshot"), "events")
    before, actions = audit_and_actions(snapshot, sensor)
    written: dict[str, DataFrame] = {}
    reports: list[str] = []

    def report(tables: dict[str, DataFrame]) -> None:
        written.update(tables, after=audit(tables["events"], sensor))
        for name, df in (
            ("quality_before", before),
            ("cleaning_actions", actions),
            ("quality_after", written["after"]),
        ):
            reports.append(write_report(df, f"{root}/reports", name, run_at))

    run_id = publish({"events": repair(snapshot, sensor)}, root, report)
    frames = [read_report(path, df) for path, df in zip(reports, (before, actions, written["after"]))]
    return QualityRun(*frames, written["events"], run_id, tuple(reports))
