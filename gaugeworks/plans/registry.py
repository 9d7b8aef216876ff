"""Every query on the given tables, next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.functions import ntz_instant, strip
from gaugeworks.operators import constraints as C
from gaugeworks.operators import quality as Q
from gaugeworks.operators.dedupe import first_per_key
from gaugeworks.operators.merge import insert_if_absent, upsert
from gaugeworks.operators.nearest import nearest_site
from gaugeworks.operators.normalize import (
    count_by,
    keep_children,
    manual_measurement,
    measurements,
    sensor_types,
    sensors,
    traffic_zones,
    without_measurement,
)
from gaugeworks.operators.reports import event_rate, latest, profile_columns, stage_counts
from gaugeworks.plans import adapters as A
from gaugeworks.plans.flows import (
    KEY_COLUMNS,
    clean_events,
    load_inventory,
    loadable_events,
    quality_run,
    type_events,
    unusable_events,
)
from gaugeworks.schemas import ENRICHED_TEXT, INVENTORY_HEADER, METADATA, REQUIRED_CLEAN
from gaugeworks.session import fresh_path, materialise
from gaugeworks.sinks import export_latest, land_snapshot, read_published, write_clean
from gaugeworks.sinks.files import messages
from gaugeworks.sources import (
    count_lines,
    decode_events,
    flatten_payload,
    json_file_stream,
    read_inventory,
    read_json_lines,
)
from gaugeworks.streaming import deduplicated, enrich_messages, load_clean, rate

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

RUN_AT = datetime(2024, 6, 1, tzinfo=timezone.utc)


def query(sql: str | None = None, views: tuple[str, ...] = (), name: str | None = None):
    def register(job: Query) -> Query:
        key = name or job.__name__
        QUERIES[key] = job
        if sql is not None:
            SQL[key] = A.with_views(list(views), sql) if views else sql
        return job

    return register


# --- sources -----------------------------------------------------------------

_STAGING = ", ".join(f"nullif({name}, '') AS {name}" for _, name in INVENTORY_HEADER)


@query(f"SELECT {_STAGING} FROM inventory", ("inventory",))
def csv_roundtrip(spark, sf):
    lines = A.inventory(spark, sf)
    path = fresh_path(spark, "inventory")
    named = lines.select(*(F.col(name).alias(header) for header, name in INVENTORY_HEADER))
    writer = named.write.option("sep", ";").option("header", True).option("escape", '"')
    writer = writer.option("emptyValue", "").option("ignoreLeadingWhiteSpace", False)
    writer.option("ignoreTrailingWhiteSpace", False).csv(path)
    return read_inventory(spark, path)


_BROKEN = "event_type = 'error' AND value > 100"
_MESSAGE = {
    "event_id": A.LANDED["event_id"],
    "temperature_c": "value",
    "humidity_pct": "CASE WHEN event_type = 'click' THEN NULL ELSE value END",
}


@query(
    f"""SELECT row_id, CASE WHEN {_BROKEN} THEN NULL ELSE {_MESSAGE["event_id"]} END AS event_id,
        CASE WHEN {_BROKEN} THEN NULL ELSE {_MESSAGE["temperature_c"]} END AS temperature_c,
        CASE WHEN {_BROKEN} THEN NULL ELSE {_MESSAGE["humidity_pct"]} END AS humidity_pct,
        {_BROKEN} AS unreadable FROM delivered""",
    ("delivered",),
)
def json_parse(spark, sf):
    events = A.delivered(spark, sf)
    body = F.to_json(F.struct(*(F.expr(e).alias(c) for c, e in _MESSAGE.items())))
    texts = events.select(
        "row_id", F.when(F.expr(_BROKEN), F.substr(body, F.lit(1), F.lit(40))).otherwise(body).alias("value")
    )
    decoded = decode_events(texts)
    return decoded.select(
        "row_id", "event_id", "temperature_c", "humidity_pct",
        F.col("_corrupt_record").isNotNull().alias("unreadable"),
    )


@query("SELECT event_id, source, sensor_gid, zone, comptage_5m FROM landed", ("landed",))
def jsonl_scan(spark, sf):
    path = fresh_path(spark, "landed")
    A.landed(spark, sf).write.json(path)
    lines = read_json_lines(spark, path, ENRICHED_TEXT)
    return lines.select("event_id", "source", "sensor_gid", "zone", "comptage_5m")


@query(
    f"""SELECT {A.LANDED["event_id"]} AS event_id, 'open-meteo' AS source,
        CAST(44.8378 AS DOUBLE) AS latitude, CAST(-0.5792 AS DOUBLE) AS longitude,
        CAST(event_id AS STRING) AS observed_at, value AS temperature_c,
        CASE WHEN value > 100 THEN NULL ELSE value / 2 END AS humidity_pct, value * 2 AS wind_speed_kmh,
        CASE WHEN event_type = 'click' THEN NULL ELSE value END AS precipitation_mm FROM events"""
)
def payload_flatten(spark, sf):
    current = F.struct(
        F.expr("CAST(event_id AS STRING)").alias("time"),
        F.col("value").alias("temperature_2m"),
        F.expr("CASE WHEN value > 100 THEN NULL ELSE value / 2 END").alias("relative_humidity_2m"),
        F.expr("value * 2").alias("wind_speed_10m"),
        F.expr("CASE WHEN event_type = 'click' THEN NULL ELSE value END").alias("precipitation"),
    )
    responses = A.table(spark, sf, "events").select(
        F.expr(A.LANDED["event_id"]).alias("id"),
        F.to_json(F.struct(current.alias("current"))).alias("body"),
    )
    flat = flatten_payload(
        responses, "body", latitude=44.8378, longitude=-0.5792, source="open-meteo", event_id=F.col("id")
    )
    return flat.drop("collected_at")


_LINES = "SELECT 'landed' AS source, count(*) AS lines FROM landed UNION ALL SELECT 'absent', 0"


@query(_LINES, ("landed",))
def landed_lines(spark, sf):
    """Lines behind a path with a wildcard; a path that does not exist has none."""
    path = fresh_path(spark, "lines")
    A.landed(spark, sf).write.json(path)
    counts = [("landed", count_lines(spark, f"{path}/*.json")), ("absent", count_lines(spark, f"{path}-no/*"))]
    missing = read_json_lines(spark, f"{path}-no", ENRICHED_TEXT)
    rows = spark.createDataFrame(counts, "source string, lines long")
    return rows.unionByName(missing.select(F.col("source"), F.lit(0).cast("long").alias("lines")))


@query(
    f"SELECT {_STAGING}, (SELECT count(*) FROM inventory) AS landed_rows FROM inventory", ("inventory",)
)
def snapshot_landing(spark, sf):
    """The raw copy of a source as landed, with the row count that landing reports."""
    path = fresh_path(spark, "snapshot")
    named = A.inventory(spark, sf).select(*(F.col(name).alias(header) for header, name in INVENTORY_HEADER))
    rows = land_snapshot(named, path)
    return read_inventory(spark, path).withColumn("landed_rows", F.lit(rows))


# --- typing and de-duplication -----------------------------------------------

_TYPED = """SELECT event_id, observed_at AS observed_us, collected_at AS collected_us, source, temperature_c,
    humidity_pct, wind_speed_kmh, precipitation_mm, sensor_gid, zone, comptage_5m,
    epoch_us(TIMESTAMP '2024-06-01 00:00:00') AS processed_us FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY collected_at NULLS FIRST) AS rn FROM (
    SELECT event_id, epoch_us(TRY_CAST(observed_at AS TIMESTAMP)) AS observed_at,
    epoch_us(TRY_CAST(collected_at AS TIMESTAMPTZ)) AS collected_at,
    source, TRY_CAST(temperature_c AS DOUBLE) AS temperature_c, TRY_CAST(humidity_pct AS DOUBLE) AS humidity_pct,
    TRY_CAST(wind_speed_kmh AS DOUBLE) AS wind_speed_kmh,
    coalesce(TRY_CAST(precipitation_mm AS DOUBLE), 0) AS precipitation_mm,
    TRY_CAST(sensor_gid AS INT) AS sensor_gid, TRY_CAST(zone AS INT) AS zone,
    TRY_CAST(comptage_5m AS INT) AS comptage_5m FROM landed)
    WHERE event_id IS NOT NULL AND observed_at IS NOT NULL AND sensor_gid IS NOT NULL) WHERE rn = 1"""


@query(_TYPED, ("landed",))
def typed_clean(spark, sf):
    """From landed JSON lines, as the flow reads them, to clean rows."""
    path = fresh_path(spark, "landed")
    A.landed(spark, sf).write.json(path)
    lines = read_json_lines(spark, path, ENRICHED_TEXT).drop("_corrupt_record")
    cleaned = clean_events(lines, RUN_AT)
    return cleaned.select(
        "event_id",
        F.unix_micros("observed_at").alias("observed_us"),
        F.unix_micros("collected_at").alias("collected_us"),
        "source",
        "temperature_c",
        "humidity_pct",
        "wind_speed_kmh",
        "precipitation_mm",
        "sensor_gid",
        "zone",
        "comptage_5m",
        F.unix_micros("processed_at").alias("processed_us"),
    )


@query(
    """SELECT event_id, concat_ws(', ', CASE WHEN event_id IS NULL THEN 'event_id not null' END,
        CASE WHEN TRY_CAST(observed_at AS TIMESTAMP) IS NULL THEN 'observed_at not null' END,
        CASE WHEN TRY_CAST(sensor_gid AS INT) IS NULL THEN 'sensor_gid not null' END) AS violations, collected_at
       FROM (SELECT *, TRY_CAST(observed_at AS TIMESTAMP) AS o FROM landed)
       WHERE event_id IS NULL OR o IS NULL OR TRY_CAST(sensor_gid AS INT) IS NULL""".replace(
        "collected_at\n", "epoch_us(TRY_CAST(collected_at AS TIMESTAMPTZ)) AS collected_us\n"
    ),
    ("landed",),
)
def typed_unusable(spark, sf):
    """Rows that cleaning sets aside, with what they lack."""
    found = unusable_events(A.landed(spark, sf), RUN_AT)
    return found.select(
        "event_id",
        F.array_join("violations", ", ").alias("violations"),
        F.unix_micros("collected_at").alias("collected_us"),
    )


@query(
    f"""SELECT event_id, observed_us, sensor_gid, zone, temperature_c, precipitation_mm, processed_us,
        CAST(CAST(make_timestamp(observed_us) AS DATE) AS VARCHAR) AS observed_date,
        (SELECT count(*) FROM ({_TYPED})) AS written FROM ({_TYPED})""",
    ("landed",),
)
def clean_written(spark, sf):
    """The clean table as written, one folder per day, with the row count that writing reports."""
    path = fresh_path(spark, "clean")
    rows = write_clean(clean_events(A.landed(spark, sf), RUN_AT), path)
    return spark.read.parquet(path).select(
        "event_id", F.unix_micros("observed_at").alias("observed_us"), "sensor_gid", "zone",
        "temperature_c", "precipitation_mm", F.unix_micros("processed_at").alias("processed_us"),
        F.col("observed_date").cast("string").alias("observed_date"), F.lit(rows).alias("written"),
    )


@query(
    f"SELECT event_id, sensor_gid, zone, temperature_c FROM ({_TYPED}) ORDER BY observed_us DESC, event_id LIMIT 10",
    ("landed",),
)
def latest_exported(spark, sf):
    """The sample of the newest clean events, read back from its file."""
    path = fresh_path(spark, "sample")
    export_latest(clean_events(A.landed(spark, sf), RUN_AT), path)
    rows = spark.read.option("sep", ";").option("header", True).csv(path)
    return rows.selectExpr(
        "event_id", "CAST(sensor_gid AS INT) AS sensor_gid", "CAST(zone AS INT) AS zone",
        "CAST(temperature_c AS DOUBLE) AS temperature_c",
    )


@query(
    """SELECT event_id, row_id, user_id, value FROM (SELECT *, row_number() OVER
       (PARTITION BY event_id ORDER BY row_id DESC) AS rn FROM delivered) WHERE rn = 1""",
    ("delivered",),
)
def dedup_by_key(spark, sf):
    kept = first_per_key(A.delivered(spark, sf), ["event_id"], [F.col("row_id").desc()])
    return kept.select("event_id", "row_id", "user_id", "value")


# --- normalised inventory ----------------------------------------------------


@query(
    """SELECT DISTINCT trim(sensor_type) AS code, trim(sensor_type) AS label FROM inventory
       WHERE nullif(trim(sensor_type), '') IS NOT NULL""",
    ("inventory",),
)
def dim_type(spark, sf):
    return sensor_types(A.inventory(spark, sf))


_ZONES = """SELECT DISTINCT CAST(trim(zone) AS INT) AS zone_code, trim(zone) AS source_label
    FROM inventory WHERE nullif(trim(zone), '') IS NOT NULL"""


@query(_ZONES, ("inventory",))
def dim_zone(spark, sf):
    return traffic_zones(A.inventory(spark, sf))


_SENSORS = """SELECT CAST(trim(gid) AS INT) AS gid, trim(ident) AS ident, trim(libelle) AS libelle,
    trim(sensor_type) AS type_code, TRY_CAST(nullif(trim(zone), '') AS INT) AS zone_code,
    CAST(TRY_CAST(trim(split_part(trim(geo_point), ',', 1)) AS DECIMAL(10,7)) AS DOUBLE) AS latitude,
    CAST(TRY_CAST(trim(split_part(trim(geo_point), ',', 2)) AS DECIMAL(10,7)) AS DOUBLE) AS longitude,
    geo_shape, epoch_us(CAST(cdate AS TIMESTAMPTZ)) AS cdate_us, epoch_us(CAST(mdate AS TIMESTAMPTZ)) AS mdate_us
    FROM inventory WHERE nullif(trim(gid), '') IS NOT NULL"""


@query(_SENSORS, ("inventory",))
def site_normalise(spark, sf):
    return sensors(A.inventory(spark, sf)).select(
        "gid", "ident", "libelle", "type_code", "zone_code",
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        "geo_shape",
        F.unix_micros("cdate").alias("cdate_us"),
        F.unix_micros("mdate").alias("mdate_us"),
    )


_MEASURED = """SELECT TRY_CAST(nullif(trim(gid), '') AS INT) AS sensor_gid,
    CAST(trim(comptage_5m) AS INT) AS comptage_5m, epoch_us(CAST(mdate AS TIMESTAMPTZ)) AS observed_us
    FROM inventory WHERE nullif(trim(comptage_5m), '') IS NOT NULL"""


@query(_MEASURED, ("inventory",))
def measurement_subset(spark, sf):
    found = measurements(A.inventory(spark, sf))
    return found.select("sensor_gid", "comptage_5m", F.unix_micros("observed_at").alias("observed_us"))


@query(
    f"""SELECT code, count(*) AS site_count FROM ({_SENSORS}) s JOIN (SELECT DISTINCT trim(sensor_type) AS code
        FROM inventory WHERE nullif(trim(sensor_type), '') IS NOT NULL) t ON t.code = s.type_code GROUP BY code""",
    ("inventory",),
)
def count_by_type(spark, sf):
    staging = A.inventory(spark, sf)
    return count_by(sensors(staging), sensor_types(staging), "type_code", "code")


@query(
    f"""SELECT z.zone_code, count(*) AS site_count FROM ({_SENSORS}) s JOIN ({_ZONES}) z
        ON z.zone_code = s.zone_code GROUP BY z.zone_code""",
    ("inventory",),
)
def count_by_zone(spark, sf):
    staging = A.inventory(spark, sf)
    return count_by(sensors(staging), traffic_zones(staging), "zone_code", "zone_code")


@query(
    f"""SELECT count(*) AS without_measurement FROM ({_SENSORS}) s LEFT JOIN ({_MEASURED}) m
        ON m.sensor_gid = s.gid WHERE m.sensor_gid IS NULL""",
    ("inventory",),
)
def missing_measurement(spark, sf):
    staging = A.inventory(spark, sf)
    return without_measurement(sensors(staging), measurements(staging), "gid", "sensor_gid")


@query(
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE EXISTS
       (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal >= 0)"""
)
def cascade_semi(spark, sf):
    kept = A.table(spark, sf, "customer").filter("c_acctbal >= 0")
    children = keep_children(A.table(spark, sf, "orders"), kept, "o_custkey", "c_custkey")
    return children.select("o_orderkey", "o_custkey", "o_totalprice")


# --- nearest site ------------------------------------------------------------


def _nearest_sql(sites: str) -> str:
    return f"""SELECT event_id, gid AS sensor_gid, ident AS sensor_ident, sqrt(d2) AS distance FROM (
        SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY d2, gid) AS rn FROM (
        SELECT event_id, gid, ident, (e.latitude - s.latitude) * (e.latitude - s.latitude)
        + (e.longitude - s.longitude) * (e.longitude - s.longitude) AS d2
        FROM positioned e LEFT JOIN (SELECT gid, ident, CAST(latitude AS DOUBLE) AS latitude,
        CAST(longitude AS DOUBLE) AS longitude FROM {sites}) s
        ON e.latitude IS NOT NULL AND s.latitude IS NOT NULL)) WHERE rn = 1"""


_TAKE = {"sensor_gid": "gid", "sensor_ident": "ident"}


def _nearest(events, sites, **options):
    found = nearest_site(events, sites, take=_TAKE, **options)
    return found.select("event_id", *_TAKE, "distance")


@query(_nearest_sql("short_sites"), ("positioned", "short_sites"), name="nearest_site")
def nearest_short(spark, sf):
    return _nearest(A.positioned(spark, sf), A.short_sites(spark, sf))


@query(_nearest_sql("canonical"), ("positioned", "canonical"), name="nearest_site_grid")
def nearest_packed(spark, sf):
    return _nearest(A.positioned(spark, sf), A.canonical(spark, sf), strategy="packed")


# Ids beyond what a double can hold, and events without a position among the others.
_BIG = "9007199254740992 + CAST(gid AS BIGINT)"
_BIG_SITES = f"(SELECT * REPLACE ({_BIG} AS gid) FROM short_sites)"


@query(
    " UNION ALL ".join(
        f"SELECT '{way}' AS way, * FROM ({_nearest_sql(_BIG_SITES)})" for way in ("inline", "packed")
    ),
    ("positioned", "short_sites"),
)
def nearest_site_ids(spark, sf):
    """Both ways to the nearest site, which must agree to the last digit of an id.

    The list grows with the data: the first way answers in the event's row, from a list or from a
    tree, for as many sites as every task may hold, and goes down the packed levels beyond.
    """
    sites = A.short_sites(spark, sf).withColumn("gid", F.expr(_BIG))
    found = [
        _nearest(A.positioned(spark, sf), sites, strategy=strategy).select(F.lit(way).alias("way"), "*")
        for way, strategy in (("inline", "auto"), ("packed", "packed"))
    ]
    return found[0].unionByName(found[1])


# --- constraints -------------------------------------------------------------


def _count(name: str, predicate: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS constraint_name, count(*) FILTER (WHERE {predicate}) AS violating_rows FROM {source}"
    )


def _union(*parts: str) -> str:
    return " UNION ALL ".join(parts)


def _dup_rows(name: str, keys: str, source: str, not_null: str) -> str:
    return f"""SELECT '{name}' AS constraint_name, CAST(coalesce(sum(n), 0) AS BIGINT) AS violating_rows FROM
        (SELECT count(*) AS n FROM {source} WHERE {not_null} GROUP BY {keys} HAVING count(*) > 1)"""


@query(
    _union(
        _count("l_orderkey not null", "l_orderkey IS NULL", "lineitem"),
        _count("l_linenumber not null", "l_linenumber IS NULL", "lineitem"),
        _dup_rows(
            "unique (l_orderkey, l_linenumber)",
            "l_orderkey, l_linenumber",
            "lineitem",
            "l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL",
        ),
    )
)
def constraint_pk(spark, sf):
    return C.summarise(A.table(spark, sf, "lineitem"), C.primary_key("l_orderkey", "l_linenumber"))


@query(_dup_rows("unique (ident)", "ident", f"({_SENSORS})", "ident IS NOT NULL"), ("inventory",))
def constraint_unique(spark, sf):
    check = C.UniqueCheck("unique (ident)", ("ident",))
    return C.summarise(sensors(A.inventory(spark, sf)), [check])


@query(_union(*(_count(f"{c} not null", f"{c} IS NULL", "weather") for c in REQUIRED_CLEAN)), ("weather",))
def constraint_not_null(spark, sf):
    return C.summarise(A.weather(spark, sf), C.not_null(*REQUIRED_CLEAN))


@query(
    _count(
        "sensor_gid exists",
        "sensor_gid IS NOT NULL AND NOT EXISTS (SELECT 1 FROM canonical WHERE gid = sensor_gid)",
        "weather",
    ),
    ("weather",),
)
def constraint_fk(spark, sf):
    check = C.ReferenceCheck("sensor_gid exists", "sensor_gid", A.canonical(spark, sf), "gid")
    return C.summarise(A.weather(spark, sf), [check])


@query(
    _union(
        _count("sensor_latitude in [-90, 90]", "sensor_latitude NOT BETWEEN -90 AND 90", "weather"),
        _count("sensor_longitude in [-180, 180]", "sensor_longitude NOT BETWEEN -180 AND 180", "weather"),
        _count("comptage_5m >= 0", "comptage_5m < 0", "weather"),
    ),
    ("weather",),
)
def constraint_range(spark, sf):
    checks = [
        C.in_range("sensor_latitude", -90, 90),
        C.in_range("sensor_longitude", -180, 180),
        C.non_negative("comptage_5m"),
    ]
    return C.summarise(A.weather(spark, sf), checks)


@query(_count("mdate >= cdate", "mdate_us < cdate_us", f"({_SENSORS})"), ("inventory",))
def constraint_order(spark, sf):
    return C.summarise(sensors(A.inventory(spark, sf)), [C.not_before("mdate", "cdate")])


@query(
    _union(
        _count("o_orderpriority at most 8", "length(o_orderpriority) > 8", "orders"),
        _count("o_orderstatus at most 1", "length(o_orderstatus) > 1", "orders"),
    )
)
def constraint_length(spark, sf):
    checks = [C.max_length("o_orderpriority", 8), C.max_length("o_orderstatus", 1)]
    return C.summarise(A.table(spark, sf, "orders"), checks)


@query(
    _union(
        _count(
            "o_totalprice as decimal(7,2)", "TRY_CAST(o_totalprice AS DECIMAL(7,2)) IS NULL", "orders"
        ),
        _count(
            "o_totalprice as decimal(8,2)", "TRY_CAST(o_totalprice AS DECIMAL(8,2)) IS NULL", "orders"
        ),
    )
)
def constraint_decimal(spark, sf):
    checks = [C.fits_decimal("o_totalprice", 7, 2), C.fits_decimal("o_totalprice", 8, 2)]
    return C.summarise(A.table(spark, sf, "orders"), checks)


_SENDER_ID = f"CASE WHEN event_type = 'error' THEN CAST(event_id AS STRING) ELSE {A.LANDED['event_id']} END"


@query(
    _count(
        "event_id is a uuid",
        f"NOT regexp_matches({_SENDER_ID}, '^[0-9a-fA-F]{{8}}(-[0-9a-fA-F]{{4}}){{3}}-[0-9a-fA-F]{{12}}$')",
        "events",
    )
)
def constraint_uuid(spark, sf):
    ids = A.table(spark, sf, "events").select(F.expr(_SENDER_ID).alias("event_id"))
    return C.summarise(ids, [C.well_formed_uuid("event_id")])


@query(
    _count(
        "geo_shape $.type = Point",
        "geo_shape IS NOT NULL AND json_extract_string(geo_shape, '$.type') IS DISTINCT FROM 'Point'",
        f"({_SENSORS})",
    ),
    ("inventory",),
)
def constraint_json_type(spark, sf):
    return C.summarise(sensors(A.inventory(spark, sf)), [C.json_field("geo_shape", "$.type", "Point")])


@query(
    f"""SELECT gid, ident, concat_ws('; ',
        CASE WHEN latitude IS NULL THEN 'latitude not null' END,
        CASE WHEN zone_code IS NULL THEN 'zone_code not null' END,
        CASE WHEN json_extract_string(geo_shape, '$.type') <> 'Point' THEN 'geo_shape $.type = Point' END,
        CASE WHEN mdate_us < cdate_us THEN 'mdate >= cdate' END,
        CASE WHEN ident IN (SELECT ident FROM ({_SENSORS}) GROUP BY ident HAVING count(*) > 1)
             THEN 'unique (ident)' END,
        CASE WHEN type_code NOT IN (SELECT trim(sensor_type) FROM inventory
             WHERE nullif(trim(sensor_type), '') IS NOT NULL) THEN 'type_code exists' END) AS violations
        FROM ({_SENSORS})""",
    ("inventory",),
)
def constraint_quarantine(spark, sf):
    staging = A.inventory(spark, sf)
    checks = [
        *C.not_null("latitude", "zone_code"),
        C.json_field("geo_shape", "$.type", "Point"),
        C.not_before("mdate", "cdate"),
        C.UniqueCheck("unique (ident)", ("ident",)),
        C.ReferenceCheck("type_code exists", "type_code", sensor_types(staging), "code"),
    ]
    flagged = C.flag_violations(sensors(staging), checks)
    return flagged.select("gid", "ident", F.array_join("violations", "; ").alias("violations"))


_VALID_ZONES = f"SELECT zone_code FROM ({_ZONES}) GROUP BY zone_code HAVING count(*) = 1"
_SITE_FAULTS = {
    "gid not null": "gid IS NULL",
    "unique (gid)": f"gid IN (SELECT gid FROM ({_SENSORS}) GROUP BY gid HAVING count(*) > 1)",
    "unique (ident)": f"ident IN (SELECT ident FROM ({_SENSORS}) GROUP BY ident HAVING count(*) > 1)",
    "zone_code not null": "zone_code IS NULL",
    "latitude not null": "latitude IS NULL",
    "longitude not null": "longitude IS NULL",
    "type_code exists": """type_code NOT IN (SELECT trim(sensor_type) FROM inventory
        WHERE nullif(trim(sensor_type), '') IS NOT NULL)""",
    "zone_code exists": f"zone_code IS NOT NULL AND zone_code NOT IN ({_VALID_ZONES})",
    "geo_shape $.type = Point": "json_extract_string(geo_shape, '$.type') <> 'Point'",
    "mdate >= cdate": "mdate_us < cdate_us",
}


@query(
    f"""SELECT 'sensor' AS part, CAST(gid AS VARCHAR) AS name, concat_ws('; ', {", ".join(
        f"CASE WHEN {bad} THEN '{name}' END" for name, bad in sorted(_SITE_FAULTS.items())
    )}) AS violations FROM ({_SENSORS})
    UNION ALL SELECT 'zone', source_label, CASE WHEN zone_code NOT IN ({_VALID_ZONES})
        THEN 'unique (zone_code)' ELSE '' END FROM ({_ZONES})""",
    ("inventory",),
)
def inventory_load(spark, sf):
    """Sites and zones of a loaded inventory file, valid or with what is wrong with them."""
    path = fresh_path(spark, "inventory")
    named = A.inventory(spark, sf).select(*(F.col(name).alias(header) for header, name in INVENTORY_HEADER))
    land_snapshot(named, path)
    tables = load_inventory(spark, path)

    def judged(part, name):
        good = tables[part].valid.withColumn("violations", F.array().cast("array<string>"))
        rows = good.unionByName(tables[part].quarantined)
        return rows.select(
            F.lit(part.removeprefix("traffic_")).alias("part"),
            F.col(name).cast("string").alias("name"),
            F.array_join(F.array_sort("violations"), "; ").alias("violations"),
        )

    return judged("sensor", "gid").unionByName(judged("traffic_zone", "source_label"))


# --- audit -------------------------------------------------------------------

_BAD = {
    "required": " OR ".join(
        [f"{c} IS NULL" for c in Q.REQUIRED_VALUES]
        + [f"nullif(trim({c}), '') IS NULL" for c in Q.REQUIRED_TEXT]
    ),
    "optional": "temperature_c IS NULL OR humidity_pct IS NULL OR wind_speed_kmh IS NULL",
    "temperature": "NOT isfinite(temperature_c) OR temperature_c < -90 OR temperature_c > 60",
    "humidity": "humidity_pct < 0 OR humidity_pct > 100",
    "wind": "NOT isfinite(wind_speed_kmh) OR wind_speed_kmh < 0",
    "precipitation": "NOT isfinite(precipitation_mm) OR precipitation_mm < 0",
    "coordinates": "sensor_latitude NOT BETWEEN -90 AND 90 OR sensor_longitude NOT BETWEEN -180 AND 180",
    "count": "comptage_5m < 0",
    "orphans": "NOT EXISTS (SELECT 1 FROM canonical s WHERE s.gid = w.sensor_gid)",
}
_DIFFERS = " OR ".join(f"w.{c} IS DISTINCT FROM s.{source}" for c, source in METADATA.items())


def _issues(key: str, source: str = "weather") -> str:
    if key == "duplicates":
        return f"""(SELECT count(*) FROM (SELECT event_id FROM {source} GROUP BY event_id HAVING count(*) > 1))"""
    if key == "metadata":
        return f"""(SELECT count(*) FILTER (WHERE {_DIFFERS}) FROM {source} w JOIN canonical s
            ON s.gid = w.sensor_gid)"""
    return f"(SELECT count(*) FILTER (WHERE {_BAD[key]}) FROM {source} w)"


def _report_sql(source: str = "weather") -> str:
    return _union(
        *(
            f"""SELECT '{category}' AS category, '{name}' AS control_name,
                (SELECT count(*) FROM {source}) AS checked_rows, {_issues(key, source)} AS issue_count,
                '{severity}' AS severity, '{policy}' AS policy"""
            for key, (category, name, severity, policy) in Q.CONTROLS.items()
        )
    )


def _register_rule(key: str) -> None:
    sql = f"""SELECT '{Q.CONTROLS[key][1]}' AS control_name, (SELECT count(*) FROM weather) AS checked_rows,
        {_issues(key)} AS issue_count"""

    @query(sql, ("weather",), name=f"audit_{key}")
    def one_rule(spark, sf):
        return Q.audit_rule(A.weather(spark, sf), A.canonical(spark, sf), key)


for _key in Q.CONTROLS:
    _register_rule(_key)


@query(_report_sql(), ("weather",))
def audit_report(spark, sf):
    return Q.audit(A.weather(spark, sf), A.canonical(spark, sf))


# --- repair ------------------------------------------------------------------

_FIXED = {
    rule.column: (
        f"CASE WHEN {_BAD[rule.key]} THEN {'NULL' if rule.replacement is None else rule.replacement}"
        f" ELSE {rule.column} END"
    )
    for rule in Q.VALUE_RULES
}
_PADDED = "source IS DISTINCT FROM trim(source) AND nullif(trim(source), '') IS NOT NULL"
_FIXED["source"] = f"CASE WHEN {_PADDED} THEN trim(source) ELSE source END"
_REPAIRED = f"""SELECT w.* REPLACE ({", ".join(f"{e} AS {c}" for c, e in _FIXED.items())},
    {", ".join(f"CASE WHEN s.gid IS NULL THEN w.{c} ELSE s.{source} END AS {c}" for c, source in METADATA.items())})
    FROM weather w LEFT JOIN canonical s ON s.gid = w.sensor_gid"""


def _register_repair(key: str, column: str) -> None:
    @query(f"SELECT row_id, {_FIXED[column]} AS {column} FROM weather", ("weather",), name=f"repair_{key}")
    def one_repair(spark, sf):
        return Q.repair_values(A.weather(spark, sf)).select("row_id", column)


for _key, _column in [(r.key, r.column) for r in Q.VALUE_RULES] + [("source", "source")]:
    _register_repair(_key, _column)


def _plain(c: str) -> str:
    numeric = c in ("sensor_latitude", "sensor_longitude")
    return f"CAST({c} AS DOUBLE) AS {c}" if numeric else c


@query(
    f"SELECT row_id, {', '.join(_plain(c) for c in METADATA)} FROM ({_REPAIRED})", ("weather",)
)
def repair_metadata(spark, sf):
    fixed = Q.repair_metadata(A.weather(spark, sf), A.canonical(spark, sf))
    return fixed.selectExpr("row_id", *(_plain(c) for c in METADATA))


@query(
    _union(
        *(
            f"SELECT '{r.action}' AS action, {_issues(r.key)} AS corrected_rows" for r in Q.VALUE_RULES
        ),
        f"SELECT '{Q.METADATA_ACTION}', {_issues('metadata')}",
        f"SELECT '{Q.SOURCE_ACTION}', (SELECT count(*) FILTER (WHERE {_PADDED}) FROM weather)",
    ),
    ("weather",),
)
def repair_actions(spark, sf):
    return Q.repair_actions(A.weather(spark, sf), A.canonical(spark, sf))


SQL["audit_after"] = (
    A.with_views(["weather"], "").rstrip() + f", repaired AS ({_REPAIRED}) {_report_sql('repaired')}"
)


@query()
def audit_after(spark, sf):
    sites = A.canonical(spark, sf)
    return Q.audit(Q.repair(A.weather(spark, sf), sites), sites)


_CHECKED = A.with_views(["weather"], "").rstrip() + f", repaired AS ({_REPAIRED}) "
_ACTIONS_SQL = _union(
    *(f"SELECT '{r.action}' AS name, {_issues(r.key)} AS found" for r in Q.VALUE_RULES),
    f"SELECT '{Q.METADATA_ACTION}', {_issues('metadata')}",
    f"SELECT '{Q.SOURCE_ACTION}', (SELECT count(*) FILTER (WHERE {_PADDED}) FROM weather)",
)
SQL["quality_run_reports"] = _CHECKED + _union(
    f"SELECT 'before' AS report, control_name AS name, issue_count AS found, checked_rows FROM ({_report_sql()})",
    f"SELECT 'actions', name, found, NULL FROM ({_ACTIONS_SQL})",
    f"SELECT 'after', control_name, issue_count, checked_rows FROM ({_report_sql('repaired')})",
)


def _run_quality(spark, sf):
    root = fresh_path(spark, "quality")
    return root, quality_run(A.weather(spark, sf), A.canonical(spark, sf), root, RUN_AT)


@query()
def quality_run_reports(spark, sf):
    """The three reports of a quality run, read back as they were written."""
    _, done = _run_quality(spark, sf)

    def report(df, label):
        checked = F.col("checked_rows") if "checked_rows" in df.columns else F.lit(None).cast("long")
        name, found = ("action", "corrected_rows") if label == "actions" else ("control_name", "issue_count")
        return df.select(
            F.lit(label).alias("report"), F.col(name).alias("name"), F.col(found).alias("found"),
            checked.alias("checked_rows"),
        )

    parts = [report(done.before, "before"), report(done.actions, "actions"), report(done.after, "after")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_ROW_COLUMNS = ("row_id", "event_id", "source", "sensor_gid", "comptage_5m", *METADATA)
_MEASURED_COLUMNS = tuple(rule.column for rule in Q.VALUE_RULES)


@query(
    f"SELECT {', '.join(_plain(c) for c in (*_ROW_COLUMNS, *_MEASURED_COLUMNS))} FROM ({_REPAIRED})", ("weather",)
)
def quality_run_rows(spark, sf):
    """The repaired table as readers see it after publication."""
    root, _ = _run_quality(spark, sf)
    return read_published(spark, root, "events").selectExpr(
        *(_plain(c) for c in (*_ROW_COLUMNS, *_MEASURED_COLUMNS))
    )


# Sites with more decimals than the target keeps: rounding alone is no difference.
_FINE = "sensor_latitude + 0.00000001"


@query("SELECT count(*) AS rows, 0 AS changed FROM weather", ("weather",))
def repair_rounding(spark, sf):
    """Rows that differ from their site by rounding only are counted and left as they are."""
    sites = A.canonical(spark, sf)
    sound = Q.repair(A.weather(spark, sf), sites).withColumn("sensor_latitude", F.expr(f"CAST({_FINE} AS DOUBLE)"))
    again = Q.repair_metadata(sound, sites)
    before = sound.select("row_id", F.col("sensor_latitude").alias("was"))
    both = again.join(before, "row_id")
    changed = F.sum(F.when(F.col("sensor_latitude").eqNullSafe(F.col("was")), 0).otherwise(1))
    return both.agg(F.count("*").alias("rows"), changed.cast("int").alias("changed"))


# --- merges ------------------------------------------------------------------

# Loaded: orders before 2000. Arriving: orders since 1999, dearer, those of status F twice.
_LOADED = "o_orderdate < TIMESTAMP '2000-01-01 00:00:00'"
_ARRIVING = "o_orderdate >= TIMESTAMP '1999-01-01 00:00:00'"
_BATCH_SQL = f"""SELECT o_orderkey, o_totalprice + 1 AS o_totalprice FROM orders WHERE {_ARRIVING}
    UNION ALL SELECT o_orderkey, o_totalprice + 2 FROM orders WHERE {_ARRIVING} AND o_orderstatus = 'F'"""
_FIRST_SQL = f"SELECT o_orderkey, min(o_totalprice) AS o_totalprice FROM ({_BATCH_SQL}) GROUP BY o_orderkey"


def _target_and_batch(spark, sf):
    orders = A.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    arriving = orders.filter(_ARRIVING)
    once = arriving.selectExpr("o_orderkey", "o_totalprice + 1 AS o_totalprice")
    twice = arriving.filter("o_orderstatus = 'F'").selectExpr("o_orderkey", "o_totalprice + 2 AS o_totalprice")
    return orders.filter(_LOADED).select("o_orderkey", "o_totalprice"), once.unionByName(twice)


@query(
    f"""SELECT o_orderkey, o_totalprice FROM orders WHERE {_LOADED} UNION ALL SELECT * FROM ({_FIRST_SQL}) b
        WHERE NOT EXISTS (SELECT 1 FROM orders t WHERE t.o_orderkey = b.o_orderkey AND {_LOADED})""",
    name="insert_if_absent",
)
def insert_orders(spark, sf):
    target, batch = _target_and_batch(spark, sf)
    return insert_if_absent(target, batch, ["o_orderkey"], ["o_totalprice"])


@query(
    f"""SELECT * FROM ({_FIRST_SQL}) UNION ALL SELECT o_orderkey, o_totalprice FROM orders t WHERE {_LOADED}
        AND NOT EXISTS (SELECT 1 FROM ({_FIRST_SQL}) b WHERE t.o_orderkey = b.o_orderkey)"""
)
def upsert_update(spark, sf):
    target, batch = _target_and_batch(spark, sf)
    return upsert(target, batch, ["o_orderkey"], ["o_totalprice"])


@query(
    f"""SELECT sensor_gid, comptage_5m FROM ({_MEASURED}) WHERE sensor_gid IS NULL OR sensor_gid NOT IN (SELECT gid
        FROM ({_SENSORS}) WHERE ident IN ('Customer#000000007', 'Customer#000000011')) UNION ALL
        SELECT gid, CASE ident WHEN 'Customer#000000007' THEN 42 ELSE 18 END FROM ({_SENSORS})
        WHERE ident IN ('Customer#000000007', 'Customer#000000011')""",
    ("inventory",),
)
def upsert_measurement(spark, sf):
    staging = A.inventory(spark, sf)
    sensor, stored = sensors(staging), measurements(staging)
    for ident, count in (("Customer#000000007", 42), ("Customer#000000011", 18)):
        update = manual_measurement(sensor, ident, count, RUN_AT)
        stored = upsert(stored, update, ["sensor_gid"], ["comptage_5m"])
    return stored.select("sensor_gid", "comptage_5m")


# --- reports -----------------------------------------------------------------

@query("SELECT event_id, epoch_us(ts) AS ts_us, value FROM events ORDER BY ts DESC, event_id LIMIT 10")
def latest_n(spark, sf):
    newest = latest(A.table(spark, sf, "events"), "ts", 10, ["event_id"])
    return newest.select("event_id", F.unix_micros(ntz_instant("ts")).alias("ts_us"), "value")


def _profile_sql(c: str, value: str, equal: str = "CAST(NULL AS BIGINT)") -> str:
    return f"""SELECT '{c}' AS column_name, count(*) AS rows, count({value}) AS filled,
        count(DISTINCT {value}) AS distinct_values, {equal} AS equal_to_value,
        CAST(min({value}) AS STRING) AS min_value, CAST(max({value}) AS STRING) AS max_value FROM profiled"""


SQL["profile_columns"] = (
    A.with_views(["inventory"], "").rstrip()
    + ", profiled AS (SELECT *, CAST(trim(zone) AS STRING) AS z FROM inventory) "
    + _union(
        _profile_sql("ident", "nullif(trim(ident), '')"),
        _profile_sql("comptage_5m", "nullif(trim(comptage_5m), '')"),
        _profile_sql("zone", "nullif(trim(zone), '')", "count(*) FILTER (WHERE zone = '0 ')"),
        _profile_sql("mdate", "nullif(trim(mdate), '')"),
    )
)


@query(name="profile_columns")
def profile_inventory(spark, sf):
    staging = A.inventory(spark, sf)
    return profile_columns(staging, ["ident", "comptage_5m", "zone", "mdate"], {"zone": "0 "})


@query(
    f"""SELECT position, stage, rows, lag(rows, 1, rows) OVER (ORDER BY position) - rows AS lost_vs_previous
        FROM (SELECT 1 AS position, 'raw' AS stage, count(*) AS rows FROM landed UNION ALL
        SELECT 2, 'aggregated', count(*) FROM landed WHERE event_id IS NOT NULL
        AND TRY_CAST(observed_at AS TIMESTAMP) IS NOT NULL AND TRY_CAST(sensor_gid AS INT) IS NOT NULL
        UNION ALL SELECT 3, 'clean', count(*) FROM ({_TYPED}))""",
    ("landed",),
    name="stage_counts",
)
def stages(spark, sf):
    raw = A.landed(spark, sf)
    usable = type_events(raw, RUN_AT).dropna(subset=list(KEY_COLUMNS))
    return stage_counts([("raw", raw), ("aggregated", usable), ("clean", clean_events(raw, RUN_AT))])


_SECONDS = "epoch_us(ts) // 1000000"


@query(
    f"""SELECT s - s % 300 AS window_start, s - s % 300 + 300 AS window_end, count(*) AS events,
        CAST(count(*) AS DOUBLE) / 300 AS events_per_second
        FROM (SELECT {_SECONDS} AS s FROM events) GROUP BY ALL"""
)
def throughput_rate(spark, sf):
    return event_rate(A.table(spark, sf, "events").select(ntz_instant("ts").alias("at")), "at")


@query(
    f"""SELECT w AS window_start, w + 300 AS window_end, count(*) AS events,
        CAST(count(*) AS DOUBLE) / 300 AS events_per_second
        FROM (SELECT s - s % 60 - 60 * i AS w FROM (SELECT {_SECONDS} AS s FROM events),
        (SELECT unnest([0, 1, 2, 3, 4]) AS i)) GROUP BY ALL"""
)
def throughput_rate_sliding(spark, sf):
    return event_rate(A.table(spark, sf, "events").select(ntz_instant("ts").alias("at")), "at", 300, 60)


# --- end to end --------------------------------------------------------------


def _enriched(spark, sf):
    """Events with their nearest site of the short list, in the shape of the clean table."""
    values = {
        c: e for c, e in A.WEATHER.items() if not c.startswith("sensor_") and c != "zone"
    }
    events = A.table(spark, sf, "events").withColumn("row_id", F.col("event_id"))
    position = {k: v for k, v in A.POSITIONED.items() if k != "event_id"}
    shaped = A.project(events, {**values, **position})
    take = {
        "sensor_gid": "gid", "sensor_ident": "ident", "sensor_type": "type_code", "zone": "zone_code",
        "sensor_latitude": "latitude", "sensor_longitude": "longitude", "sensor_label": "libelle",
    }
    sites = A.short_sites(spark, sf).withColumns({"type_code": F.lit("PONCTUEL"), "libelle": strip("ident")})
    return nearest_site(shaped, sites, take=take), sites


_NO_SITE = "event_type = 'error' AND value > 150"
# The twin finds the sites itself, over the same short list.
_SITE_VALUES = {
    "sensor_gid": "gid", "sensor_ident": "s.ident", "sensor_type": "CASE WHEN gid IS NULL THEN NULL ELSE 'PONCTUEL' END",
    "zone": "s.zone_code", "sensor_latitude": "s.latitude", "sensor_longitude": "s.longitude",
    "sensor_label": "trim(s.ident)",
}
_ENRICHED_SQL = ", ".join(
    f"{e} AS {c}" for c, e in {**{k: v for k, v in A.WEATHER.items()}, **_SITE_VALUES}.items()
)
_ENRICHED_VIEWS = (
    f", assigned AS ({_nearest_sql('short_sites')}), canonical AS (SELECT gid, ident, 'PONCTUEL' AS type_code,"
    " zone_code, latitude, longitude, trim(ident) AS libelle FROM short_sites),"
    f" weather AS (SELECT {_ENRICHED_SQL} FROM (SELECT *, event_id AS row_id FROM events) e"
    " LEFT JOIN assigned USING (event_id) LEFT JOIN short_sites s ON s.gid = assigned.sensor_gid) "
)
SQL["enrich_and_audit"] = (
    A.with_views(["positioned", "short_sites"], "").rstrip() + _ENRICHED_VIEWS + _report_sql()
)
SQL["enriched_sites"] = (
    A.with_views(["positioned", "short_sites"], "").rstrip()
    + _ENRICHED_VIEWS
    + "SELECT row_id, sensor_gid, sensor_ident, zone, sensor_latitude, sensor_longitude, sensor_label FROM weather"
)


@query()
def enrich_and_audit(spark, sf):
    """The flagship: nearest site for every event, then the full audit of the result.

    The enriched rows are written once; the audit reads the columns it needs.
    """
    events, sites = _enriched(spark, sf)
    return Q.audit(materialise(events, "enriched"), sites)


@query()
def enriched_sites(spark, sf):
    """Which site each event of the flagship got, with its columns."""
    events, _ = _enriched(spark, sf)
    return events.select(
        "row_id", "sensor_gid", "sensor_ident", "zone", "sensor_latitude", "sensor_longitude",
        "sensor_label",
    )


@query(
    f"""SELECT event_id, observed_us, collected_us, source, CAST(CAST(temperature_c * 100 AS DECIMAL(6,2)) AS DOUBLE)
        AS temperature_c, CAST(CAST(humidity_pct AS DECIMAL(6,2)) AS DOUBLE) AS humidity_pct,
        CAST(CAST(wind_speed_kmh AS DECIMAL(8,2)) AS DOUBLE) AS wind_speed_kmh,
        CAST(CAST(precipitation_mm AS DECIMAL(8,2)) AS DOUBLE) AS precipitation_mm, sensor_gid,
        'P52.1' AS sensor_ident, 'PONCTUEL' AS sensor_type, zone, CAST(44.8361999 AS DOUBLE) AS sensor_latitude,
        CAST(-0.5786028 AS DOUBLE) AS sensor_longitude, 'rue' AS sensor_label, comptage_5m, processed_us
        FROM ({_TYPED}) WHERE collected_us IS NOT NULL AND zone IS NOT NULL
        AND precipitation_mm < 1000000 AND (temperature_c IS NULL OR temperature_c < 100)""",
    ("landed",),
)
def loadable_rows(spark, sf):
    """Clean events the final table accepts. Site columns are filled in, so only values decide."""
    cleaned = clean_events(A.landed(spark, sf), RUN_AT).withColumns(
        {
            "sensor_ident": F.lit("P52.1"),
            "sensor_type": F.lit("PONCTUEL"),
            "sensor_latitude": F.lit(44.8361999),
            "sensor_longitude": F.lit(-0.5786028),
            "sensor_label": F.lit("rue"),
            "temperature_c": F.col("temperature_c") * 100,
        }
    )
    kept = loadable_events(cleaned).valid
    decimals = [c for c, kind in kept.dtypes if kind.startswith("decimal")]
    kept = kept.withColumns({c: F.col(c).cast("double") for c in decimals})
    instants = {"observed_at": "observed_us", "collected_at": "collected_us", "processed_at": "processed_us"}
    return kept.select(
        *(F.unix_micros(c).alias(instants[c]) if c in instants else F.col(c) for c in kept.columns)
    )


@query(
    f"""SELECT event_id, CASE WHEN sensor_gid NOT IN (SELECT gid FROM canonical) THEN 'sensor_gid exists' END
        AS violation FROM ({_TYPED}) WHERE sensor_gid NOT IN (SELECT gid FROM canonical WHERE gid % 7 > 0)""".replace(
        "FROM canonical) THEN", "FROM canonical WHERE gid % 7 > 0) THEN"
    ),
    ("landed", "canonical"),
)
def rejected_reference(spark, sf):
    """Events whose site is not in the site table: here every seventh site is missing."""
    cleaned = clean_events(A.landed(spark, sf), RUN_AT)
    sites = A.canonical(spark, sf).filter("gid % 7 > 0")
    filled = {c: F.lit("x") for c in ("sensor_ident", "sensor_type", "sensor_label")}
    filled |= {c: F.lit(1.0) for c in ("sensor_latitude", "sensor_longitude")}
    refused = loadable_events(cleaned.withColumns(filled), sites).quarantined
    return refused.select("event_id", F.explode("violations").alias("violation")).filter(
        "violation = 'sensor_gid exists'"
    )


# --- streaming ---------------------------------------------------------------

_STREAMED = {
    "event_id": A.LANDED["event_id"],
    "collected_at": A.LANDED["collected_at"],
    "source": "'open-meteo'",
    "latitude": A.POSITIONED["latitude"],
    "longitude": A.POSITIONED["longitude"],
    "observed_at": "CAST(ts AS STRING)",
    "temperature_c": "value",
    "precipitation_mm": A.LANDED["precipitation_mm"].replace("CAST(value AS STRING)", "value"),
}


_BATCHES = 4


def _streamed_messages(spark, sf):
    """Delivered events as JSON text files, read back as a stream in several batches."""
    path = fresh_path(spark, "messages")
    rows = A.project(A.delivered(spark, sf), _STREAMED)
    n = _BATCHES * int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    # A fixed number of batches, which grow with the data; each is read by all tasks.
    messages(rows.repartition(n)).write.text(path)
    return json_file_stream(spark, path, max_files=n // _BATCHES)


def _stream_sites(spark, sf):
    """The short list with every column that the final table wants."""
    return A.short_sites(spark, sf).withColumns(
        {"type_code": F.lit("PONCTUEL"), "libelle": strip("ident"), "comptage_5m": F.lit(None).cast("int")}
    )


def _run_enrich(spark, sf, sites=None):
    out = fresh_path(spark, "stream")
    sites = _stream_sites(spark, sf) if sites is None else sites
    enrich_messages(_streamed_messages(spark, sf), sites, out, f"{out}/checkpoint").awaitTermination()
    return out


@query(
    f"SELECT {A.LANDED['event_id']} AS event_id, value AS temperature_c FROM delivered", ("delivered",)
)
def stream_ingest(spark, sf):
    raw = spark.read.text(f"{_run_enrich(spark, sf)}/raw").select("value")
    return decode_events(raw).select("event_id", "temperature_c")


@query(
    f"""SELECT {A.LANDED["event_id"]} AS event_id, value AS temperature_c, sensor_gid, sensor_ident
        FROM delivered JOIN ({_nearest_sql("short_sites")}) USING (event_id) WHERE NOT ({_NO_SITE})""",
    ("delivered", "positioned", "short_sites"),
)
def stream_enrich(spark, sf):
    enriched = spark.read.parquet(f"{_run_enrich(spark, sf)}/enriched")
    return enriched.select("event_id", "temperature_c", "sensor_gid", "sensor_ident")


_MIRROR = {"gid": "gid + 1000000", "latitude": "-latitude", "longitude": "-longitude"}
_LONG_SITES = (
    "(SELECT gid, ident, latitude, longitude FROM canonical UNION ALL SELECT"
    f" {_MIRROR['gid']}, ident, {_MIRROR['latitude']}, {_MIRROR['longitude']} FROM canonical)"
)


@query(
    f"""SELECT {A.LANDED["event_id"]} AS event_id, sensor_gid, sensor_ident
        FROM delivered JOIN ({_nearest_sql(_LONG_SITES)}) USING (event_id) WHERE NOT ({_NO_SITE})""",
    ("delivered", "positioned", "canonical"),
)
def stream_enrich_long(spark, sf):
    """Stream against a list that is too long for the inline way: it is packed once."""
    sites = A.canonical(spark, sf).withColumn("comptage_5m", F.lit(None).cast("int"))
    both = sites.unionByName(sites.withColumns({c: F.expr(e) for c, e in _MIRROR.items()}))
    enriched = spark.read.parquet(f"{_run_enrich(spark, sf, both)}/enriched")
    return enriched.select("event_id", "sensor_gid", "sensor_ident")


@query(
    f"""SELECT 'messages' AS counter, count(*) AS n FROM delivered UNION ALL SELECT 'enriched',
        count(*) FILTER (WHERE NOT ({_NO_SITE})) FROM delivered UNION ALL SELECT 'rejected',
        count(*) FILTER (WHERE {_NO_SITE}) FROM delivered""",
    ("delivered",),
)
def stream_counters(spark, sf):
    """What the enriching stream counted, added up over its batches."""
    found = spark.read.json(f"{_run_enrich(spark, sf)}/counters")
    names = ("messages", "enriched", "rejected")
    sums = found.agg(*(F.sum(c).alias(c) for c in names))
    lines = F.array(*(F.struct(F.lit(c).alias("counter"), F.col(c).alias("n")) for c in names))
    return sums.select(F.explode(lines).alias("x")).select("x.*")


_BAD_TIME = "event_type = 'error' AND value > 120"
_LOADED_EVENTS = f"""SELECT event_id, epoch_us(observed_at) AS observed_us,
    CAST(CAST(temperature_c AS DECIMAL(6,2)) AS DOUBLE) AS temperature_c, sensor_gid, zone_code AS zone FROM (
    SELECT DISTINCT {A.LANDED["event_id"]} AS event_id, ts AS observed_at, value AS temperature_c, sensor_gid
    FROM delivered JOIN ({_nearest_sql("short_sites")}) USING (event_id) WHERE NOT ({_NO_SITE})
    AND NOT ({_BAD_TIME})) JOIN short_sites ON gid = sensor_gid"""


def _load(spark, out, target, checkpoint, glob="*"):
    enriched = spark.read.parquet(f"{out}/enriched")
    schema = enriched.drop("query_id", "batch_id").schema
    # As many batches for all rows as they were enriched in: they grow with the data, not their number.
    most = -(-len(enriched.inputFiles()) // _BATCHES)
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", most)
    stream = reader.option("recursiveFileLookup", True).parquet(f"{out}/enriched/query_id=*/batch_id={glob}")
    load_clean(stream, target, checkpoint, run_at=RUN_AT).awaitTermination()


def _loaded(spark, target):
    return spark.read.parquet(f"{target}/loaded").select(
        "event_id", F.unix_micros("observed_at").alias("observed_us"),
        F.col("temperature_c").cast("double").alias("temperature_c"), "sensor_gid", "zone",
    )


_STREAM_VIEWS = ("delivered", "positioned", "short_sites")


@query(_LOADED_EVENTS, _STREAM_VIEWS)
def stream_load(spark, sf):
    out, target = _run_enrich(spark, sf), fresh_path(spark, "clean")
    _load(spark, out, target, f"{target}-checkpoint")
    return _loaded(spark, target)


@query(_LOADED_EVENTS, _STREAM_VIEWS)
def stream_load_resumed(spark, sf):
    """Two checkpoints on one target: the second meets what the first has loaded."""
    out, target = _run_enrich(spark, sf), fresh_path(spark, "clean")
    _load(spark, out, target, f"{target}-checkpoint-a", "0")
    _load(spark, out, target, f"{target}-checkpoint-b")
    return _loaded(spark, target)


@query(
    f"""SELECT {A.LANDED["event_id"]} AS event_id, 'collected_at not null' AS violations
        FROM delivered WHERE NOT ({_NO_SITE}) AND {_BAD_TIME}""",
    ("delivered",),
)
def stream_load_rejected(spark, sf):
    """Rows that the final table refuses, kept beside it with the reason."""
    out, target = _run_enrich(spark, sf), fresh_path(spark, "clean")
    _load(spark, out, target, f"{target}-checkpoint")
    rejected = spark.read.parquet(f"{target}/rejected")
    return rejected.select("event_id", F.array_join("violations", ", ").alias("violations"))


def _drained(spark, sf, label, job):
    """``job`` on the events as they arrive in four stretches of time, one run of the query for each.

    Every stretch is written by all tasks and is a micro-batch of its own; state and watermark
    cross them through the checkpoint.
    """
    events = A.table(spark, sf, "events")
    inbox, out = fresh_path(spark, "event-files"), fresh_path(spark, label)
    at = F.unix_micros(ntz_instant("ts"))
    low, high = events.select(at.alias("t")).agg(F.min("t"), F.max("t")).first()
    step = (high - low) // 4 + 1
    for part in range(4):  # in this order, as they would arrive
        rows = events.filter((at >= low + part * step) & (at < low + (part + 1) * step))
        rows.write.parquet(f"{inbox}/part={part}")
        reader = spark.readStream.schema(events.schema).option("recursiveFileLookup", True)
        found = job(reader.parquet(inbox).withColumn("at", ntz_instant("ts")))
        writer = found.writeStream.format("parquet").option("path", out)
        writer = writer.option("checkpointLocation", f"{out}-checkpoint")
        writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(found.schema).parquet(out)


@query("SELECT event_id, user_id, value FROM events")
def stream_dedup(spark, sf):
    """Sign-ups arrive twice; the copies lie within the delay and one of each is kept."""
    twice = F.when(F.col("event_type") == "signup", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))

    def job(stream):
        copies = stream.withColumn("copy", F.explode(twice)).select("event_id", "user_id", "value", "at")
        return deduplicated(copies, "event_id", "at", "10 minutes").select("event_id", "user_id", "value")

    return _drained(spark, sf, "stream-dedup", job)


@query(
    f"""SELECT w AS window_start, w + 300 AS window_end, count(*) AS events,
        CAST(count(*) AS DOUBLE) / 300 AS events_per_second
        FROM (SELECT s - s % 300 AS w FROM (SELECT {_SECONDS} AS s FROM events)) GROUP BY w
        HAVING (w + 300) * 1000 <= (SELECT max(epoch_us(ts)) // 1000 - 600000 FROM events)"""
)
def stream_rate(spark, sf):
    """Windows that are final: those that end ten minutes before the newest event."""
    return _drained(spark, sf, "stream-rate", lambda stream: rate(stream, "at", "10 minutes"))
