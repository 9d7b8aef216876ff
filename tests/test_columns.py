from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from gaugeworks import functions as G


def one(spark, text, column):
    df = spark.createDataFrame([(text,)], "c string")
    return df.select(column.alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("text", "tz", "expected"),
    [
        ("2026-09-25T16:15", "UTC", "2026-09-25 16:15:00"),
        ("2026-09-25T16:15", "Europe/Paris", "2026-09-25 14:15:00"),
        ("2026-09-25T14:25:16.390422+00:00", "Europe/Paris", "2026-09-25 14:25:16.390422"),
        ("2026-09-25 14:25:16+00", "Europe/Paris", "2026-09-25 14:25:16"),
        ("2021-04-28T12:57:13+02:00", "UTC", "2021-04-28 10:57:13"),
        ("2021-04-28T12:57:13Z", "Europe/Paris", "2021-04-28 12:57:13"),
        ("2026-09-25T16:15+02:00", "UTC", "2026-09-25 14:15:00"),
        ("2026-09-25 16:15Z", "UTC", "2026-09-25 16:15:00"),
        ("2021-04-28", "UTC", "2021-04-28 00:00:00"),
        ("zz", "UTC", None),
        ("16:15", "UTC", None),
        ("16:15:00+02:00", "UTC", None),
        ("", "UTC", None),
        (None, "UTC", None),
    ],
)
def test_to_instant(spark, text, tz, expected):
    micros = one(spark, text, F.unix_micros(G.to_instant("c", tz)))
    if expected is None:
        assert micros is None
    else:
        want = datetime.fromisoformat(expected).replace(tzinfo=timezone.utc)
        assert micros == round(want.timestamp() * 1_000_000)


@pytest.mark.parametrize("zone", ["Asia/Tokyo", "Europe/Paris", "America/New_York"])
@pytest.mark.parametrize("text", ["2026-09-25T16:15", "1969-01-02 03:04:05.000006", "2026-10-25 02:30", "2026-12-31 23:59:59.999999"])
def test_to_instant_ignores_the_session_zone(spark, zone, text):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        micros = one(spark, text, F.unix_micros(G.to_instant("c")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    since = datetime.fromisoformat(text).replace(tzinfo=timezone.utc) - datetime(1970, 1, 1, tzinfo=timezone.utc)
    assert micros == since // timedelta(microseconds=1)


@pytest.mark.parametrize(
    ("text", "expected"), [(" 12 ", 12), ("", None), ("  ", None), ("x", None), (None, None)]
)
def test_to_int(spark, text, expected):
    assert one(spark, text, G.to_int("c")) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [(" 1.5 ", 1.5), ("-.5", -0.5), ("2.", 2.0), ("1e3", 1000.0), ("Infinity", float("inf")),
     ("-inf", float("-inf")), ("", None), ("n/a", None), (None, None)],
)
def test_to_double(spark, text, expected):
    assert one(spark, text, G.to_double("c")) == expected


def test_to_double_nan(spark):
    assert one(spark, "NaN", F.isnan(G.to_double("c")))


def test_trim_rules_differ(spark):
    assert one(spark, "\t7\n ", G.strip("c")) == "7"
    assert one(spark, "\t ", G.blank_to_null("c")) == "\t"


def test_point_parts(spark):
    assert one(spark, "44.8362039, -0.578552", G.point_part("c", 2)) == "-0.578552"
    assert one(spark, "nowhere", G.to_decimal(G.point_part("c", 2), 10, 7)) is None


@pytest.mark.parametrize(
    ("value", "bad"),
    [(-90.0, False), (60.0, False), (-90.01, True), (60.01, True), (float("nan"), True),
     (float("inf"), True), (float("-inf"), True), (None, None)],
)
def test_outside(spark, value, bad):
    df = spark.createDataFrame([(value,)], "c double")
    assert df.select(G.outside("c", -90, 60).alias("r")).first()["r"] is bad


def test_is_finite(spark):
    rows = [(1.0,), (float("nan"),), (float("inf"),), (float("-inf"),), (None,)]
    df = spark.createDataFrame(rows, "c double")
    assert [r.r for r in df.select(G.is_finite("c").alias("r")).collect()] == [True] + [False] * 4


def test_uuid(spark):
    assert one(spark, "d1dc40d4-5ca2-4bb0-9b3a-92665deaba6a", G.is_uuid("c"))
    assert not one(spark, "d1dc40d4", G.is_uuid("c"))
