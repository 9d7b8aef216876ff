"""Inventory load, constraints, merges and reports."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import constraints as C
from gaugeworks.operators.merge import absent_rows, insert_if_absent, to_target, upsert, without_key
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
from gaugeworks.plans.flows import load_inventory
from gaugeworks.schemas import INVENTORY_RAW
from gaugeworks.sources import decode_events

POINT = '{"coordinates":[-0.578552,44.8362039],"type":"Point"}'
MADE, CHANGED = "2021-04-28T12:57:13+02:00", "2026-09-24T10:15:00+02:00"
LINES = [
    ("44.8362039, -0.578552", POINT, "2616", " rue A ", "P52.2 ", "PONCTUEL", "0", None, MADE, CHANGED),
    ("44.8361999, -0.5786028", POINT, "2615", "rue B", "P52.1", " PONCTUEL", "0 ", "12", MADE, CHANGED),
    ("44.9, -0.5", POINT, "7", "rue C", "P1.2", "BOUCLE", "1", "  ", MADE, CHANGED),
    ("44.9, -0.6", POINT, "8", "rue D", "P1.3", "BOUCLE", "01", "0", CHANGED, MADE),
    ("nowhere", POINT.replace("Point", "Line"), "9", "rue E", "P1.3", " ", None, "-4", MADE, CHANGED),
    ("95.0, -0.6", "no json", " ", "rue F", "P9", "4G", "2", "3", MADE, CHANGED),
]


@pytest.fixture(scope="module")
def staging(spark):
    return spark.createDataFrame(LINES, INVENTORY_RAW)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_dimensions(staging):
    assert rows(sensor_types(staging)) == [("4G", "4G"), ("BOUCLE", "BOUCLE"), ("PONCTUEL", "PONCTUEL")]
    assert rows(traffic_zones(staging)) == [(0, "0"), (1, "01"), (1, "1"), (2, "2")]


def test_sensors(staging):
    found = {r.gid: r for r in sensors(staging).collect()}
    assert set(found) == {2616, 2615, 7, 8, 9}
    assert (found[2616].ident, found[2616].libelle) == ("P52.2", "rue A")
    assert str(found[2616].longitude) == "-0.5785520"
    assert found[9].latitude is None and found[9].zone_code is None


def test_measurements_and_counts(staging):
    found = measurements(staging)
    assert [(r.sensor_gid, r.comptage_5m) for r in found.orderBy("comptage_5m").collect()] == [
        (9, -4), (8, 0), (None, 3), (2615, 12)
    ]
    sensor = sensors(staging)
    assert rows(count_by(sensor, sensor_types(staging), "type_code", "code")) == [
        ("BOUCLE", 2), ("PONCTUEL", 2)
    ]
    assert rows(count_by(sensor, traffic_zones(staging).dropDuplicates(["zone_code"]), "zone_code", "zone_code")) == [
        (0, 2), (1, 2)
    ]
    assert without_measurement(sensor, found, "gid", "sensor_gid").first()[0] == 2
    assert keep_children(found, sensor.filter("gid <> 8"), "sensor_gid", "gid").count() == 2


def test_manual_measurements(spark, staging):
    sensor, stored = sensors(staging), measurements(staging).filter("sensor_gid = 2615")
    at = datetime(2026, 1, 1)
    for ident, count in (("P52.1", 42), ("P1.2", 18), ("none", 1)):
        stored = upsert(stored, manual_measurement(sensor, ident, count, at), ["sensor_gid"], ["observed_at"])
    assert [(r.sensor_gid, r.comptage_5m) for r in stored.orderBy("sensor_gid").collect()] == [(7, 18), (2615, 42)]


def test_constraints_on_sensors(staging):
    checks = C.sensor_checks(sensor_types(staging), traffic_zones(staging))
    result = C.validate(sensors(staging), checks)
    broken = {r.constraint_name: r.violating_rows for r in result.summary.collect() if r.violating_rows}
    assert broken == {
        "unique (ident)": 2,
        "zone_code not null": 1,
        "latitude not null": 1,
        "longitude not null": 1,
        "type_code exists": 1,
        "geo_shape $.type = Point": 1,
        "mdate >= cdate": 1,
    }
    assert {r.gid for r in result.valid.collect()} == {2616, 2615, 7}
    flagged = {r.gid: set(r.violations) for r in result.quarantined.collect()}
    assert flagged[8] == {"mdate >= cdate", "unique (ident)"}
    with pytest.raises(C.ConstraintError, match="ident"):
        C.validate(sensors(staging), checks, mode="fail")


def test_zone_labels_break_the_key(staging):
    summary = C.summarise(traffic_zones(staging), C.zone_checks())
    assert {r.constraint_name: r.violating_rows for r in summary.collect()}["unique (zone_code)"] == 2


@pytest.mark.parametrize(
    ("check", "values", "bad"),
    [
        (C.in_range("c", -90, 90), ["-90", "90", "90.1", None, "NaN"], 2),
        (C.non_negative("c"), ["0", "-1", None], 1),
        (C.fits_decimal("c", 6, 2), ["9999.99", "9999.996", "-1.005", None, "NaN"], 2),
    ],
)
def test_value_checks(spark, check, values, bad):
    df = spark.createDataFrame([(v,) for v in values], "c string").select(F.col("c").cast("double"))
    assert C.summarise(df, [check]).first().violating_rows == bad


def test_text_checks(spark):
    df = spark.createDataFrame(
        [("d1dc40d4-5ca2-4bb0-9b3a-92665deaba6a", '{"type":"Point"}'), ("x", "{"), (None, None)], "c string, j string"
    )
    checks = [C.well_formed_uuid("c"), C.max_length("c", 5), C.json_field("j", "$.type", "Point")]
    assert [r.violating_rows for r in C.summarise(df, checks).collect()] == [1, 1, 1]


def test_references_and_keys_with_null(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (5,)], "k int")
    parent = spark.createDataFrame([(1,)], "p int")
    checks = [*C.primary_key("k"), C.ReferenceCheck("ref", "k", parent, "p")]
    found = {r.constraint_name: r.violating_rows for r in C.summarise(df, checks).collect()}
    assert found == {"k not null": 2, "unique (k)": 2, "ref": 1}


def test_require_rows(spark):
    with pytest.raises(C.ConstraintError, match="sites"):
        C.require_rows(spark.range(0), "sites")


def test_load_inventory(spark, tmp_path):
    text = (
        "﻿Geo Point;Geo Shape;gid;libelle;ident;type;zone;comptage_5m;cdate;mdate\n"
        '"44.8362039, -0.578552";"{""coordinates"":[-0.578552,44.8362039],""type"":""Point""}";2616;'
        f'"Quai\nnord; é";P52.2;PONCTUEL;0;;{MADE};{CHANGED}\n'
        f'"44.8, -0.5";"{{""type"":""Point""}}";2617;x;P52.3;PONCTUEL;0;12;{MADE};{CHANGED}\n'
    )
    (tmp_path / "sites.csv").write_text(text, encoding="utf-8")
    tables = load_inventory(spark, str(tmp_path / "sites.csv"), multi_line=True)
    assert {name: (t.valid.count(), t.quarantined.count()) for name, t in tables.items()} == {
        "sensor_type": (1, 0),
        "traffic_zone": (1, 0),
        "sensor": (2, 0),
        "sensor_measurement": (1, 0),
    }
    labels = {r.libelle for r in tables["sensor"].valid.collect()}
    assert labels == {"Quai\nnord; é", "x"}


def test_insert_if_absent_twice_is_once(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    batch = spark.createDataFrame([("b", 9), ("c", 5), ("c", 4), (None, 1)], "k string, v int")
    once = insert_if_absent(target, batch, ["k"], ["v"])
    assert rows(once) == [("a", 1), ("b", 2), ("c", 4)]
    assert rows(insert_if_absent(once, batch, ["k"], ["v"])) == rows(once)


def test_large_batches_take_the_other_way(spark, monkeypatch):
    from gaugeworks.operators import merge

    monkeypatch.setattr(merge, "fits_broadcast", lambda df: False)
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    batch = spark.createDataFrame([("a", 9), ("c", 5)], "k string, v int")
    assert rows(absent_rows(batch, target, ["k"], ["v"])) == [("c", 5)]


def test_upsert(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    updates = spark.createDataFrame([(7, "b"), (8, "b"), (3, "c")], "v int, k string")
    assert rows(upsert(target, updates, ["k"], [F.col("v").desc()])) == [("a", 1), ("b", 8), ("c", 3)]


def test_to_target_fills_and_casts(spark):
    df = spark.createDataFrame([("x", 1.239)], "a string, b double")
    row = to_target(df, {"b": "decimal(6,2)", "c": "int", "a": "string"}).first()
    assert (str(row.b), row.c, row.a) == ("1.24", None, "x")


@pytest.mark.parametrize("approximate", [False, True])
def test_profile(staging, approximate):
    found = {r.column_name: r for r in profile_columns(staging, ["ident", "comptage_5m", "zone"], {"zone": "0"}, approximate).collect()}
    assert (found["ident"].rows, found["ident"].distinct_values) == (6, 5)
    assert found["comptage_5m"].filled == 4
    assert (found["zone"].equal_to_value, found["zone"].min_value, found["ident"].equal_to_value) == (1, "0", None)


def test_stage_counts(spark):
    found = stage_counts([("raw", spark.range(10)), ("aggregated", spark.range(9)), ("clean", spark.range(4))])
    assert rows(found) == [(1, "raw", 10, 0), (2, "aggregated", 9, 1), (3, "clean", 4, 5)]


def test_latest(spark):
    df = spark.createDataFrame([(1, 5), (2, 9), (3, 9), (4, None)], "id int, t int")
    assert [r.id for r in latest(df, "t", 2, ["id"]).collect()] == [2, 3]


def test_sliding_rate_equals_brute_force(spark):
    seconds = [0, 10, 59, 60, 299, 300, 301, 1000, 1000]
    df = spark.createDataFrame([(s,) for s in seconds], "s int").select(F.timestamp_seconds("s").alias("at"))
    found = {r.window_start: r.events for r in event_rate(df, "at", 300, 60).collect()}
    want = {}
    for start in range(-300, 1200, 60):
        hits = sum(start <= s < start + 300 for s in seconds)
        if hits:
            want[start] = hits
    assert found == want
    with pytest.raises(ValueError, match="multiple"):
        event_rate(df, "at", 300, 7)


def test_zone_written_in_two_ways(spark, tmp_path):
    """No site is valid whose zone is not."""
    head = "Geo Point;Geo Shape;gid;libelle;ident;type;zone;comptage_5m;cdate;mdate\n"
    point = '"1, 2";"{""type"":""Point""}"'
    rows = "".join(f"{point};{g};l;P{g};T;{z};;{MADE};{CHANGED}\n" for g, z in ((1, "1"), (2, "01"), (3, "2")))
    (tmp_path / "sites.csv").write_text(head + rows, encoding="utf-8")
    tables = load_inventory(spark, str(tmp_path / "sites.csv"))
    zones = {r.zone_code for r in tables["traffic_zone"].valid.collect()}
    sites = {(r.gid, r.zone_code) for r in tables["sensor"].valid.collect()}
    assert zones == {2} and sites == {(3, 2)}


def test_rows_without_key_are_kept_apart(spark):
    rows = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    assert [r.v for r in without_key(rows, ["k"]).collect()] == ["b"]


def test_decimal_fields_in_messages(spark):
    texts = spark.createDataFrame([('{"a": 1.5, "b": "x"}',)], "value string")
    (row,) = decode_events(texts, schema="a DECIMAL(10, 7), b STRING").collect()
    assert float(row.a) == 1.5 and row.b == "x"
