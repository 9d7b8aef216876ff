"""The given tables, read as sites, inventory lines and weather events.

Each mapping is output column -> SQL expression. The expressions use only what
both engines share, so the same derivation feeds the jobs and their SQL twins.
Defects come from the values themselves: no row is left out. Positions are
multiples of a quarter degree, hence squared distances are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.operators.lookup import lookup_join


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _quarter(expr: str, steps: int, start: int) -> str:
    return f"CAST(({expr}) % {steps} AS DOUBLE) / 4 - {start}"


_LAT = _quarter("c_custkey * 7919", 681, 85)
_LON = _quarter("c_custkey * 104729", 1401, 175)
_LAT_TEXT = f"CAST(CAST({_LAT} AS DECIMAL(10,7)) AS STRING)"
_LON_TEXT = f"CAST(CAST({_LON} AS DECIMAL(10,7)) AS STRING)"

# customer -> canonical site.
CANONICAL = {
    "gid": "CAST(c_custkey AS INT)",
    "ident": "c_name",
    "libelle": "'Site ' || c_name",
    "type_code": "c_mktsegment",
    "zone_code": "c_nationkey",
    "latitude": f"CAST({_LAT} AS DECIMAL(10,7))",
    "longitude": f"CAST({_LON} AS DECIMAL(10,7))",
}

# supplier -> site of a short list; one in a while has no position.
SHORT_SITES = {
    "gid": "CAST(s_suppkey AS INT)",
    "ident": "s_name",
    "zone_code": "s_nationkey",
    "latitude": f"CASE WHEN s_acctbal < -500 THEN NULL ELSE {_quarter('s_suppkey * 7919', 681, 85)} END",
    "longitude": _quarter("s_suppkey * 104729", 1401, 175),
}

# customer -> inventory line, all text, with the defects of a hand-kept file.
INVENTORY = {
    "geo_point": f"CASE WHEN c_acctbal < -950 THEN 'unknown' ELSE {_LAT_TEXT} || ', ' || {_LON_TEXT} END",
    "geo_shape": (
        f"'{{\"coordinates\":[' || {_LON_TEXT} || ',' || {_LAT_TEXT} || '],\"type\":\"' ||"
        " CASE WHEN c_acctbal < -900 THEN 'LineString' ELSE 'Point' END || '\"}'"
    ),
    "gid": "CASE WHEN c_acctbal > 9950 THEN '  ' ELSE CAST(c_custkey AS STRING) END",
    "libelle": "' Site ' || c_name",
    "ident": "CASE WHEN c_acctbal < -980 THEN 'P1.2' ELSE c_name || ' ' END",
    "sensor_type": (
        "CASE WHEN c_acctbal > 9900 THEN ' ' WHEN c_acctbal > 5000 THEN ' ' || c_mktsegment"
        " ELSE c_mktsegment || ' ' END"
    ),
    "zone": (
        "CASE WHEN c_acctbal < -990 THEN '' WHEN c_acctbal > 9000 THEN '0' || CAST(c_nationkey AS STRING)"
        " ELSE CAST(c_nationkey AS STRING) || ' ' END"
    ),
    "comptage_5m": (
        "CASE WHEN c_acctbal < 1000 THEN '' WHEN c_acctbal < 1500 THEN '  '"
        " ELSE CAST(CAST(floor(c_acctbal / 100) AS INT) - 20 AS STRING) END"
    ),
    "cdate": "'2021-04-' || lpad(CAST(1 + c_nationkey AS STRING), 2, '0') || 'T12:57:13+02:00'",
    "mdate": "'2021-04-' || lpad(CAST(1 + c_custkey % 28 AS STRING), 2, '0') || 'T10:15:00+02:00'",
}

# events -> position of an event; some have none.
POSITIONED = {
    "event_id": "event_id",
    "latitude": (
        "CASE WHEN event_type = 'error' AND value > 150 THEN NULL"
        f" ELSE {_quarter('event_id * 31 + user_id * 17', 721, 90)} END"
    ),
    "longitude": _quarter("event_id * 97 + user_id * 13", 1441, 180),
}

# events -> enriched record as text, the way a sender that types nothing lands it.
LANDED = {
    "event_id": "lpad(CAST(event_id AS STRING), 8, '0') || '-0000-4000-8000-000000000000'",
    "collected_at": (
        "CASE WHEN event_type = 'error' AND value > 120 THEN 'zz' ELSE CAST(ts AS STRING) || '+02:00' END"
    ),
    "observed_at": "CASE WHEN event_type = 'view' AND value > 120 THEN 'soon' ELSE CAST(ts AS STRING) END",
    "source": "'open-meteo'",
    "temperature_c": "CASE WHEN value < 1 THEN 'n/a' ELSE CAST(value AS STRING) END",
    "humidity_pct": "CAST(value AS STRING)",
    "wind_speed_kmh": "CASE WHEN value > 200 THEN '' ELSE CAST(value AS STRING) END",
    "precipitation_mm": "CASE WHEN event_type = 'click' THEN NULL ELSE CAST(value AS STRING) END",
    "sensor_gid": "CASE WHEN event_type = 'signup' AND value > 120 THEN '' ELSE CAST(user_id AS STRING) END",
    "zone": "CASE WHEN value > 150 THEN 'x' ELSE CAST(user_id % 25 AS STRING) END",
    "comptage_5m": "CASE WHEN value > 100 THEN NULL ELSE CAST(CAST(floor(value) AS INT) AS STRING) END",
}

# events joined to the canonical sites -> clean table with defects of every rule.
WEATHER_GID = "CASE WHEN value > 250 THEN NULL ELSE CAST(user_id * 11 AS INT) END"
WEATHER = {
    "row_id": "row_id",
    "event_id": (
        "CASE WHEN event_type = 'error' AND value > 180 THEN NULL"
        " ELSE lpad(CAST(event_id AS STRING), 8, '0') || '-0000-4000-8000-000000000000' END"
    ),
    "observed_at": "ts",
    "collected_at": "CASE WHEN value > 270 THEN NULL ELSE ts END",
    "source": (
        "CASE WHEN event_type = 'view' THEN ' open-meteo ' WHEN event_type <> 'purchase' THEN 'open-meteo'"
        " WHEN value < 1 THEN '   ' WHEN value < 2 THEN NULL ELSE 'open-meteo' END"
    ),
    "temperature_c": (
        "CASE WHEN event_type = 'error' AND value > 150 THEN CAST('NaN' AS DOUBLE)"
        " WHEN event_type = 'error' AND value < 3 THEN CAST('Infinity' AS DOUBLE)"
        " WHEN event_type = 'view' AND value < 2 THEN NULL ELSE value - 95 END"
    ),
    "humidity_pct": (
        "CASE WHEN event_type = 'click' AND value > 150 THEN CAST('NaN' AS DOUBLE)"
        " WHEN event_type = 'view' AND value < 2 THEN NULL ELSE value - 3 END"
    ),
    "wind_speed_kmh": (
        "CASE WHEN event_type = 'click' AND value > 200 THEN CAST('-Infinity' AS DOUBLE)"
        " WHEN event_type = 'signup' AND value > 180 THEN CAST('NaN' AS DOUBLE)"
        " WHEN event_type = 'purchase' AND value > 180 THEN CAST('Infinity' AS DOUBLE)"
        " WHEN event_type = 'click' AND value < 1 THEN NULL ELSE value - 1 END"
    ),
    "precipitation_mm": (
        "CASE WHEN event_type = 'purchase' AND value > 200 THEN CAST('NaN' AS DOUBLE)"
        " WHEN event_type = 'purchase' AND value > 150 THEN CAST('Infinity' AS DOUBLE)"
        " WHEN event_type = 'signup' AND value < 1 THEN NULL ELSE value - 2 END"
    ),
    "sensor_gid": "sensor_gid",
    "sensor_ident": (
        "CASE WHEN event_type = 'view' AND value > 150 THEN ident || ' ' ELSE coalesce(ident, 'unknown') END"
    ),
    "sensor_type": "CASE WHEN event_type = 'view' AND value > 230 THEN ' ' ELSE coalesce(type_code, 'unknown') END",
    "zone": (
        "CASE WHEN event_type = 'purchase' AND value > 90 AND value < 95 THEN zone_code + 1"
        " ELSE coalesce(zone_code, 0) END"
    ),
    "sensor_latitude": (
        "CASE WHEN event_type = 'error' AND value > 120 THEN CAST(95.5 AS DECIMAL(10,7))"
        " WHEN event_type = 'error' AND value < 2 THEN CAST(latitude + 0.0000001 AS DECIMAL(10,7))"
        " ELSE coalesce(latitude, CAST(10 AS DECIMAL(10,7))) END"
    ),
    "sensor_longitude": (
        "CASE WHEN event_type = 'click' AND value > 220 THEN CAST(-180.1 AS DECIMAL(10,7))"
        " ELSE coalesce(longitude, CAST(10 AS DECIMAL(10,7))) END"
    ),
    "sensor_label": "CASE WHEN event_type = 'signup' AND value > 180 THEN NULL ELSE coalesce(libelle, 'unknown') END",
    "comptage_5m": "CASE WHEN value > 100 THEN NULL ELSE CAST(floor(value) AS INT) - 3 END",
    "processed_at": "ts",
}


def project(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.selectExpr(*(f"{expr} AS {name}" for name, expr in mapping.items()))


def canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(table(spark, sf_dir, "customer"), CANONICAL)


def short_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(table(spark, sf_dir, "supplier"), SHORT_SITES)


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(table(spark, sf_dir, "customer"), INVENTORY)


def positioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(table(spark, sf_dir, "events"), POSITIONED)


def delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with sign-ups delivered twice; ``row_id`` tells the deliveries apart."""
    events = table(spark, sf_dir, "events")
    again = events.filter("event_type = 'signup'")
    return events.withColumn("row_id", F.col("event_id") * 2).unionByName(
        again.withColumn("row_id", F.col("event_id") * 2 + 1)
    )


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(delivered(spark, sf_dir), LANDED)


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = canonical(spark, sf_dir).withColumnRenamed("gid", "sensor_gid")
    events = delivered(spark, sf_dir).withColumn("sensor_gid", F.expr(WEATHER_GID))
    return project(lookup_join(events, sites, ["sensor_gid"]), WEATHER)


def _columns(mapping: dict[str, str]) -> str:
    return ", ".join(f"{expr} AS {name}" for name, expr in mapping.items())


# The same derivations as named subqueries for the SQL twins.
SQL_VIEWS = {
    "canonical": f"SELECT {_columns(CANONICAL)} FROM customer",
    "short_sites": f"SELECT {_columns(SHORT_SITES)} FROM supplier",
    "inventory": f"SELECT {_columns(INVENTORY)} FROM customer",
    "positioned": f"SELECT {_columns(POSITIONED)} FROM events",
    "delivered": (
        "SELECT *, event_id * 2 AS row_id FROM events UNION ALL"
        " SELECT *, event_id * 2 + 1 AS row_id FROM events WHERE event_type = 'signup'"
    ),
    "landed": f"SELECT {_columns(LANDED)} FROM delivered",
    "weather": (
        f"SELECT {_columns(WEATHER)} FROM (SELECT e.*, {WEATHER_GID} AS sensor_gid FROM delivered e) e"
        " LEFT JOIN canonical c ON c.gid = e.sensor_gid"
    ),
}
_NEEDS = {"landed": ["delivered"], "weather": ["delivered", "canonical"]}


def with_views(names: list[str], sql: str) -> str:
    """``sql`` with the named derivations in front of it."""
    ordered: list[str] = []
    for name in names:
        for each in (*_NEEDS.get(name, []), name):
            if each not in ordered:
                ordered.append(each)
    heads = ", ".join(f"{name} AS ({SQL_VIEWS[name]})" for name in ordered)
    return f"WITH {heads} {sql}"
