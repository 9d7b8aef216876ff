"""Quality rules as data, the audit that counts violations and the repair that removes them.

The fixed values below (names, policies, bounds, rank) are the report format.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions import blank_to_null, differs, outside
from gaugeworks.operators.lookup import BROADCAST_ROWS, fits_broadcast, lookup_join
from gaugeworks.schemas import METADATA

MAX_DOUBLE = 1.7976931348623157e308

# Category -> place in the report.
CATEGORY_RANK = {"Completeness": 1, "Uniqueness": 2, "Validity": 3, "Consistency": 4, "Integrity": 5}

# Key -> (category, control name, severity, policy).
CONTROLS = {
    "required": (
        "Completeness",
        "Required fields missing or blank",
        "HIGH",
        "Required columns should be populated; metadata is repaired from sensor when possible.",
    ),
    "optional": (
        "Completeness",
        "Optional weather fields missing (informational)",
        "INFO",
        "Weather fields are optional; absence is reported, not imputed.",
    ),
    "duplicates": (
        "Uniqueness",
        "Duplicate event_id",
        "HIGH",
        "event_id is the primary key; duplicates are also prevented by PostgreSQL.",
    ),
    "temperature": (
        "Validity",
        "Temperature outside -90..60 C",
        "MEDIUM",
        "Out-of-range optional values are set to NULL; no value is invented.",
    ),
    "humidity": (
        "Validity",
        "Humidity outside 0..100 percent",
        "MEDIUM",
        "Out-of-range optional values are set to NULL; no value is invented.",
    ),
    "wind": (
        "Validity",
        "Negative wind speed",
        "MEDIUM",
        "Negative optional values are set to NULL; no value is invented.",
    ),
    "precipitation": (
        "Validity",
        "Negative precipitation",
        "MEDIUM",
        "Substituted with 0 because the target schema requires a nonnegative value.",
    ),
    "coordinates": (
        "Validity",
        "Coordinates outside latitude/longitude bounds",
        "HIGH",
        "Coordinates are replaced by the canonical sensor coordinates.",
    ),
    "count": (
        "Validity",
        "Negative bicycle count",
        "MEDIUM",
        "The target table CHECK constraint prevents negative counts.",
    ),
    "metadata": (
        "Consistency",
        "Sensor metadata differs from canonical sensor row",
        "HIGH",
        "Denormalized metadata is replaced with values from sensor using sensor_gid.",
    ),
    "orphans": (
        "Integrity",
        "Events referencing a missing sensor",
        "CRITICAL",
        "The foreign key should prevent orphan references.",
    ),
}

# Columns that must hold a value, and those whose text must not be blank either.
REQUIRED_VALUES = (
    "event_id",
    "observed_at",
    "collected_at",
    "sensor_gid",
    "zone",
    "sensor_latitude",
    "sensor_longitude",
    "processed_at",
)
REQUIRED_TEXT = ("source", "sensor_ident", "sensor_type", "sensor_label")
OPTIONAL_WEATHER = ("temperature_c", "humidity_pct", "wind_speed_kmh")


@dataclass(frozen=True)
class ValueRule:
    """A measured column, its valid range, what replaces a bad value and the action's name."""

    key: str
    column: str
    low: float
    high: float
    replacement: float | None
    action: str

    def bad(self) -> Column:
        return F.coalesce(outside(self.column, self.low, self.high), F.lit(False))

    def repaired(self) -> Column:
        value = F.col(self.column)
        return F.when(self.bad(), F.lit(self.replacement)).otherwise(value)


VALUE_RULES = (
    ValueRule("temperature", "temperature_c", -90.0, 60.0, None, "Set invalid temperature to NULL"),
    ValueRule("humidity", "humidity_pct", 0.0, 100.0, None, "Set invalid humidity to NULL"),
    ValueRule("wind", "wind_speed_kmh", 0.0, MAX_DOUBLE, None, "Set negative wind speed to NULL"),
    ValueRule(
        "precipitation",
        "precipitation_mm",
        0.0,
        MAX_DOUBLE,
        0.0,
        "Replace negative precipitation with 0",
    ),
)
METADATA_ACTION = "Restore sensor metadata from canonical sensor row"
SOURCE_ACTION = "Trim source text"


def required_missing() -> Column:
    gaps = [F.col(c).isNull() for c in REQUIRED_VALUES]
    return reduce(or_, gaps + [blank_to_null(c).isNull() for c in REQUIRED_TEXT])


def optional_missing() -> Column:
    return reduce(or_, [F.col(c).isNull() for c in OPTIONAL_WEATHER])


def coordinates_outside() -> Column:
    return outside("sensor_latitude", -90, 90) | outside("sensor_longitude", -180, 180)


def source_padded() -> Column:
    return differs("source", F.trim("source")) & blank_to_null("source").isNotNull()


def row_rules() -> dict[str, Column]:
    """Violation predicate of every rule that looks at one row only."""
    return {
        "required": required_missing(),
        "optional": optional_missing(),
        **{rule.key: rule.bad() for rule in VALUE_RULES},
        "coordinates": coordinates_outside(),
        "count": F.col("comptage_5m") < 0,
    }


def canonical_rows(sensor: DataFrame) -> DataFrame:
    """Metadata by gid in the types of the event table; gid must be unique."""
    return sensor.select(
        F.col("gid").alias("sensor_gid"),
        *(F.col(source).alias(f"__c_{target}") for target, source in METADATA.items()),
        F.lit(True).alias("__known"),
    )


def _comparable(column: str, side: str) -> Column:
    name = F.col(f"{side}{column}")
    # Events carry floats; the canonical positions are numeric(10,7).
    if column in ("sensor_latitude", "sensor_longitude"):
        return name.try_cast("decimal(10,7)")
    return name


def metadata_differs() -> Column:
    return reduce(or_, [differs(_comparable(c, ""), _comparable(c, "__c_")) for c in METADATA])


def metadata_counts(events: DataFrame, sensor: DataFrame, max_rows: int) -> DataFrame:
    """One row: events whose metadata differs and events without a site.

    Events are first counted per (gid, metadata), so the join sees each variant
    once and not each event.
    """
    variants = events.groupBy("sensor_gid", *METADATA).agg(F.count("*").alias("__n"))
    joined = lookup_join(variants, canonical_rows(sensor), ["sensor_gid"], max_rows=max_rows)
    known = F.col("__known").isNotNull()

    def rows_where(predicate: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(predicate, F.col("__n"))), F.lit(0)).alias(name)

    return joined.agg(
        rows_where(known & metadata_differs(), "metadata"), rows_where(~known, "orphans")
    )


def duplicate_key_count(events: DataFrame, key: str = "event_id") -> DataFrame:
    """Number of keys, not rows, that occur more than once; NULL is one key."""
    return (
        events.groupBy(key)
        .agg(F.count("*").alias("__n"))
        .agg(F.count_if(F.col("__n") > 1).alias("duplicates"))
    )


def _one_row(parts: list[DataFrame], names: list[str]) -> DataFrame:
    """Merge one-row results with different columns into one row."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*(F.max(n).cast("bigint").alias(n) for n in names))


def rule_counts(events: DataFrame, sensor: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row: rows checked, violations of every rule but the key's, padded sources.

    With a canonical list that may be broadcast this is one pass over the events and
    no shuffle. A longer list meets the events counted per variant instead.
    """
    counted = {**row_rules(), "source": source_padded()}
    canonical = canonical_rows(sensor)
    if not fits_broadcast(canonical, max_rows):
        rows = events.agg(
            F.count("*").alias("checked_rows"),
            *(F.count_if(bad).alias(key) for key, bad in counted.items()),
        )
        names = ["checked_rows", *counted, "metadata", "orphans"]
        return _one_row([rows, metadata_counts(events, sensor, max_rows)], names)
    known = F.col("__known").isNotNull()
    counted |= {"metadata": known & metadata_differs(), "orphans": ~known}
    joined = events.join(F.broadcast(canonical), "sensor_gid", "left")
    return joined.agg(
        F.count("*").alias("checked_rows"),
        *(F.count_if(bad).alias(key) for key, bad in counted.items()),
    )


def audit_report(counts: DataFrame) -> DataFrame:
    lines = F.array(
        *(
            F.struct(
                F.lit(CATEGORY_RANK[category]).alias("rank"),
                F.lit(category).alias("category"),
                F.lit(name).alias("control_name"),
                F.col("checked_rows"),
                F.col(key).alias("issue_count"),
                F.lit(severity).alias("severity"),
                F.lit(policy).alias("policy"),
            )
            for key, (category, name, severity, policy) in CONTROLS.items()
        )
    )
    return (
        counts.select(F.explode(lines).alias("line"))
        .select("line.*")
        .orderBy("rank", "control_name")
        .drop("rank")
    )


def action_report(counts: DataFrame) -> DataFrame:
    actions = {rule.key: rule.action for rule in VALUE_RULES}
    actions |= {"metadata": METADATA_ACTION, "source": SOURCE_ACTION}
    lines = F.array(
        *(
            F.struct(F.lit(name).alias("action"), F.col(key).alias("corrected_rows"))
            for key, name in actions.items()
        )
    )
    return counts.select(F.explode(lines).alias("line")).select("line.*").orderBy("action")


def _all_counts(events: DataFrame, sensor: DataFrame, max_rows: int) -> DataFrame:
    return _one_row(
        [rule_counts(events, sensor, max_rows), duplicate_key_count(events)],
        ["checked_rows", *CONTROLS, "source"],
    )


def audit(events: DataFrame, sensor: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The eleven controls as report rows, in report order.

    One pass counts every rule that looks at a row and its site; a second reads
    only the key column.
    """
    return audit_report(_all_counts(events, sensor, max_rows))


def audit_and_actions(
    events: DataFrame, sensor: DataFrame, max_rows: int = BROADCAST_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Both reports from the same two passes, which are run here."""
    counts = _all_counts(events, sensor, max_rows)
    counts = events.sparkSession.createDataFrame([counts.first()], counts.schema)
    return audit_report(counts), action_report(counts)


def repair_metadata(
    events: DataFrame, sensor: DataFrame, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Site columns that differ from those of a known site become the canonical ones.

    The condition is the one the report counts by, so a row it counts as unchanged
    is unchanged.
    """
    joined = lookup_join(events, canonical_rows(sensor), ["sensor_gid"], max_rows=max_rows)
    wrong = F.col("__known").isNotNull() & metadata_differs()
    types = dict(events.dtypes)
    fixed = {
        c: F.when(wrong, F.col(f"__c_{c}").cast(types[c])).otherwise(F.col(c)) for c in METADATA
    }
    return joined.withColumns(fixed).select(*events.columns)


def repair_values(events: DataFrame) -> DataFrame:
    return events.withColumns(
        {
            **{rule.column: rule.repaired() for rule in VALUE_RULES},
            "source": F.when(source_padded(), F.trim("source")).otherwise(F.col("source")),
        }
    )


def repair(events: DataFrame, sensor: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """All six corrections as one projection. No row is added or removed.

    The corrections write disjoint columns and read only those and the gid, so
    their order does not matter.
    """
    return repair_metadata(repair_values(events), sensor, max_rows)


def repair_actions(
    events: DataFrame, sensor: DataFrame, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Rows each correction changes, from the table as it is before the repair."""
    return action_report(rule_counts(events, sensor, max_rows))


def audit_rule(
    events: DataFrame, sensor: DataFrame | None, key: str, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """(control_name, checked_rows, issue_count) of one control, computing no other.

    One scan, unless the site list is too long to broadcast.
    """
    total = F.count("*").alias("checked_rows")
    rules = row_rules()
    if key in rules:
        counts = events.agg(total, F.count_if(rules[key]).alias("issue_count"))
    elif key == "duplicates":
        per_key = events.groupBy("event_id").agg(F.count("*").alias("__n"))
        counts = per_key.agg(
            F.coalesce(F.sum("__n"), F.lit(0)).alias("checked_rows"), F.count_if(F.col("__n") > 1).alias("issue_count")
        )
    else:
        canonical = canonical_rows(sensor)
        if fits_broadcast(canonical, max_rows):
            known = F.col("__known").isNotNull()
            bad = {"metadata": known & metadata_differs(), "orphans": ~known}[key]
            joined = events.join(F.broadcast(canonical), "sensor_gid", "left")
            counts = joined.agg(total, F.count_if(bad).alias("issue_count"))
        else:
            found = metadata_counts(events, sensor, max_rows).select(F.col(key).alias("issue_count"))
            counts = _one_row([events.agg(total), found], ["checked_rows", "issue_count"])
    return counts.select(F.lit(CONTROLS[key][1]).alias("control_name"), "checked_rows", "issue_count")
