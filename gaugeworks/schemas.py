"""Declared schemas. The names and types are the data model and are fixed values."""

from __future__ import annotations

# Inventory export: header name -> staging name, in file order, all text.
INVENTORY_HEADER = (
    ("Geo Point", "geo_point"),
    ("Geo Shape", "geo_shape"),
    ("gid", "gid"),
    ("libelle", "libelle"),
    ("ident", "ident"),
    ("type", "sensor_type"),
    ("zone", "zone"),
    ("comptage_5m", "comptage_5m"),
    ("cdate", "cdate"),
    ("mdate", "mdate"),
)
INVENTORY_RAW = ", ".join(f"{name} STRING" for _, name in INVENTORY_HEADER)

# Response of the weather service; every measured field may be absent.
PAYLOAD = (
    "current STRUCT<time: STRING, temperature_2m: DOUBLE, relative_humidity_2m: DOUBLE,"
    " wind_speed_10m: DOUBLE, precipitation: DOUBLE>"
)

EVENT = (
    "event_id STRING, collected_at STRING, source STRING, latitude DOUBLE,"
    " longitude DOUBLE, observed_at STRING, temperature_c DOUBLE, humidity_pct DOUBLE,"
    " wind_speed_kmh DOUBLE, precipitation_mm DOUBLE"
)

SITE_COLUMNS = (
    "sensor_gid INT, sensor_ident STRING, sensor_type STRING, zone INT,"
    " sensor_latitude DOUBLE, sensor_longitude DOUBLE, sensor_label STRING,"
    " comptage_5m INT"
)

ENRICHED = f"{EVENT}, {SITE_COLUMNS}"

# The same record as landed by a sender that does not type its values.
ENRICHED_TEXT = ", ".join(f"{part.split()[0]} STRING" for part in ENRICHED.split(", "))

# Final relational table: column -> type, in load order.
WEATHER_SENSOR_CLEAN = {
    "event_id": "string",
    "observed_at": "timestamp",
    "collected_at": "timestamp",
    "source": "string",
    "temperature_c": "decimal(6,2)",
    "humidity_pct": "decimal(6,2)",
    "wind_speed_kmh": "decimal(8,2)",
    "precipitation_mm": "decimal(8,2)",
    "sensor_gid": "int",
    "sensor_ident": "string",
    "sensor_type": "string",
    "zone": "int",
    "sensor_latitude": "decimal(10,7)",
    "sensor_longitude": "decimal(10,7)",
    "sensor_label": "string",
    "comptage_5m": "int",
    "processed_at": "timestamp",
}
NULLABLE_CLEAN = ("temperature_c", "humidity_pct", "wind_speed_kmh", "comptage_5m")
REQUIRED_CLEAN = tuple(c for c in WEATHER_SENSOR_CLEAN if c not in NULLABLE_CLEAN)

SENSOR = (
    "gid INT, ident STRING, libelle STRING, type_code STRING, zone_code INT,"
    " latitude DECIMAL(10,7), longitude DECIMAL(10,7), geo_point_source STRING,"
    " geo_shape STRING, cdate TIMESTAMP, mdate TIMESTAMP"
)

# Event column -> canonical column it must agree with.
METADATA = {
    "sensor_ident": "ident",
    "sensor_type": "type_code",
    "zone": "zone_code",
    "sensor_latitude": "latitude",
    "sensor_longitude": "longitude",
    "sensor_label": "libelle",
}
