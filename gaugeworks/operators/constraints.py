"""Declared table constraints, checked and quarantined instead of refused by an engine."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions import is_uuid, outside
from gaugeworks.operators.lookup import lookup_join
from gaugeworks.schemas import REQUIRED_CLEAN
from gaugeworks.session import materialise


class ConstraintError(ValueError):
    """A table that must be valid is not."""


@dataclass(frozen=True)
class RowCheck:
    """``violated`` is a SQL predicate or a callable giving a column; NULL passes."""

    name: str
    violated: object

    def column(self) -> Column:
        predicate = F.expr(self.violated) if isinstance(self.violated, str) else self.violated()
        return F.coalesce(predicate, F.lit(False))


@dataclass(frozen=True)
class UniqueCheck:
    """No two rows agree on ``keys``. Rows with a NULL key pass, as under SQL UNIQUE."""

    name: str
    keys: tuple[str, ...]


@dataclass(frozen=True)
class ReferenceCheck:
    """A key that is not NULL exists in the parent."""

    name: str
    key: str
    parent: DataFrame
    parent_key: str


def not_null(*columns: str) -> list[RowCheck]:
    return [RowCheck(f"{c} not null", lambda c=c: F.col(c).isNull()) for c in columns]


def in_range(column: str, low: float, high: float) -> RowCheck:
    return RowCheck(f"{column} in [{low}, {high}]", lambda: outside(column, low, high))


def non_negative(column: str) -> RowCheck:
    return RowCheck(f"{column} >= 0", lambda: F.col(column) < 0)


def max_length(column: str, length: int) -> RowCheck:
    return RowCheck(f"{column} at most {length}", lambda: F.length(column) > length)


def fits_decimal(column: str, precision: int, scale: int) -> RowCheck:
    """The value, rounded to ``scale``, has at most ``precision`` digits."""
    return RowCheck(
        f"{column} as decimal({precision},{scale})",
        lambda: F.col(column).isNotNull()
        & F.col(column).try_cast(f"decimal({precision},{scale})").isNull(),
    )


def well_formed_uuid(column: str) -> RowCheck:
    return RowCheck(f"{column} is a uuid", lambda: ~is_uuid(column))


def json_field(column: str, path: str, value: str) -> RowCheck:
    """The JSON text has ``value`` at ``path``. Text that is not JSON fails as well."""
    return RowCheck(
        f"{column} {path} = {value}",
        lambda: F.col(column).isNotNull()
        & ~F.get_json_object(column, path).eqNullSafe(F.lit(value)),
    )


def not_before(later: str, earlier: str) -> RowCheck:
    return RowCheck(f"{later} >= {earlier}", lambda: F.col(later) < F.col(earlier))


def primary_key(*keys: str) -> list[RowCheck | UniqueCheck]:
    return [*not_null(*keys), UniqueCheck(f"unique ({', '.join(keys)})", keys)]


def duplicated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each key that occurs more than once, NULL included, with its row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1")


def missing_references(check: ReferenceCheck, df: DataFrame) -> DataFrame:
    """Key values without a parent and their row counts. The child side is counted first."""
    counted = df.groupBy(F.col(check.key).alias("__k")).agg(F.count("*").alias("rows"))
    parents = check.parent.select(F.col(check.parent_key).alias("__k"))
    return (
        counted.filter("__k IS NOT NULL")
        .join(parents, "__k", "left_anti")
        .withColumnRenamed("__k", check.key)
    )


def summarise(df: DataFrame, checks: Sequence[object]) -> DataFrame:
    """(constraint_name, violating_rows), one row per check.

    All row checks share one pass. Keys and references are pre-aggregated.
    """
    row_checks = [c for c in checks if isinstance(c, RowCheck)]
    parts = []
    if row_checks:
        counts = df.agg(*(F.count_if(c.column()).alias(f"c{i}") for i, c in enumerate(row_checks)))
        parts.append(
            counts.select(
                F.explode(
                    F.array(
                        *(
                            F.struct(
                                F.lit(c.name).alias("constraint_name"),
                                F.col(f"c{i}").alias("violating_rows"),
                            )
                            for i, c in enumerate(row_checks)
                        )
                    )
                ).alias("r")
            ).select("r.*")
        )
    for check in checks:
        if isinstance(check, UniqueCheck):
            found = duplicated_keys(df.dropna(subset=list(check.keys)), check.keys)
        elif isinstance(check, ReferenceCheck):
            found = missing_references(check, df)
        else:
            continue
        total = F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint")
        parts.append(
            found.agg(total.alias("violating_rows")).select(
                F.lit(check.name).alias("constraint_name"), "violating_rows"
            )
        )
    return reduce(DataFrame.unionByName, parts)


def flag_violations(df: DataFrame, checks: Sequence[object]) -> DataFrame:
    """Rows with ``violations``, the names of the checks each row fails.

    Duplicated keys and missing references are found first and kept as tables:
    they are measured and then joined, without being computed twice.
    """
    row_checks = [c for c in checks if isinstance(c, RowCheck)]
    marks = [F.when(c.column(), F.lit(c.name)) for c in row_checks]
    flagged, extra = df, []
    for i, check in enumerate(checks):
        mark = f"__mark{i}"
        if isinstance(check, UniqueCheck):
            dups = duplicated_keys(df.dropna(subset=list(check.keys)), check.keys)
            marked = materialise(dups.select(*check.keys, F.lit(check.name).alias(mark)), "duplicates")
            flagged = lookup_join(flagged, marked, check.keys)
        elif isinstance(check, ReferenceCheck):
            missing = missing_references(check, df)
            marked = materialise(missing.select(check.key, F.lit(check.name).alias(mark)), "orphans")
            flagged = lookup_join(flagged, marked, [check.key])
        else:
            continue
        extra.append(mark)
    found = F.array_compact(F.array(*marks, *(F.col(m) for m in extra)))
    return flagged.select(*df.columns, found.alias("violations"))


@dataclass(frozen=True)
class Validation:
    valid: DataFrame
    quarantined: DataFrame
    summary: DataFrame


def validate(df: DataFrame, checks: Sequence[object], mode: str = "quarantine") -> Validation:
    """Split a table into valid and quarantined rows. Mode ``fail`` raises instead."""
    summary = summarise(df, checks)
    if mode == "fail":
        broken = summary.filter("violating_rows > 0").collect()
        if broken:
            found = ", ".join(f"{r.constraint_name}: {r.violating_rows}" for r in broken)
            raise ConstraintError(found)
    elif mode != "quarantine":
        raise ValueError(f"unknown mode {mode!r}")
    flagged = flag_violations(df, checks)
    empty = F.size("violations") == 0
    return Validation(flagged.filter(empty).drop("violations"), flagged.filter(~empty), summary)


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """Gate before a step that makes no sense on an empty table."""
    if df.isEmpty():
        raise ConstraintError(f"{name} has no rows")
    return df


def sensor_checks(types: DataFrame, zones: DataFrame) -> list[object]:
    """Constraints of the site table."""
    required = (
        "ident", "libelle", "type_code", "zone_code", "latitude", "longitude",
        "geo_point_source", "geo_shape", "cdate", "mdate",
    )
    return [
        *primary_key("gid"),
        UniqueCheck("unique (ident)", ("ident",)),
        *not_null(*required),
        ReferenceCheck("type_code exists", "type_code", types, "code"),
        ReferenceCheck("zone_code exists", "zone_code", zones, "zone_code"),
        in_range("latitude", -90, 90),
        in_range("longitude", -180, 180),
        json_field("geo_shape", "$.type", "Point"),
        not_before("mdate", "cdate"),
        max_length("ident", 30),
        max_length("type_code", 30),
    ]


def type_checks() -> list[object]:
    return [
        *primary_key("code"), *not_null("label"), max_length("code", 30), max_length("label", 120)
    ]


def zone_checks() -> list[object]:
    return [*primary_key("zone_code"), *not_null("source_label"), max_length("source_label", 30)]


def measurement_checks(sensor: DataFrame) -> list[object]:
    return [
        *primary_key("sensor_gid"),
        ReferenceCheck("sensor_gid exists", "sensor_gid", sensor, "gid"),
        non_negative("comptage_5m"),
        *not_null("observed_at"),
    ]


def clean_row_checks(sensor: DataFrame | None = None) -> list[object]:
    """Constraints of the clean event table, for typed rows before their final cast."""
    known: list[object] = []
    if sensor is not None:
        known.append(ReferenceCheck("sensor_gid exists", "sensor_gid", sensor, "gid"))
    return [
        *known,
        *not_null(*REQUIRED_CLEAN),
        well_formed_uuid("event_id"),
        max_length("source", 80),
        max_length("sensor_ident", 30),
        max_length("sensor_type", 30),
        fits_decimal("temperature_c", 6, 2),
        fits_decimal("humidity_pct", 6, 2),
        fits_decimal("wind_speed_kmh", 8, 2),
        fits_decimal("precipitation_mm", 8, 2),
        fits_decimal("sensor_latitude", 10, 7),
        fits_decimal("sensor_longitude", 10, 7),
        non_negative("comptage_5m"),
    ]
