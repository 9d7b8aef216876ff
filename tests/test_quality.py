from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import quality as Q
from gaugeworks.plans.flows import quality_run
from gaugeworks.schemas import SENSOR, WEATHER_SENSOR_CLEAN
from gaugeworks.sinks import read_published

NAN, INF = float("nan"), float("inf")
AT = datetime(2026, 9, 25, 16, 15)
GOOD = {
    "event_id": "d1dc40d4-5ca2-4bb0-9b3a-92665deaba6a",
    "observed_at": AT,
    "collected_at": AT,
    "source": "open-meteo",
    "temperature_c": 25.9,
    "humidity_pct": 58.0,
    "wind_speed_kmh": 15.6,
    "precipitation_mm": 0.0,
    "sensor_gid": 2615,
    "sensor_ident": "P52.1",
    "sensor_type": "PONCTUEL",
    "zone": 0,
    "sensor_latitude": 44.8361999,
    "sensor_longitude": -0.5786028,
    "sensor_label": "18 rue",
    "comptage_5m": None,
    "processed_at": AT,
}
# Floats everywhere: NaN must reach the audit.
DDL = ", ".join(f"{c} {'double' if t.startswith('decimal') else t}" for c, t in WEATHER_SENSOR_CLEAN.items())


@pytest.fixture(scope="module")
def sensor(spark):
    lat, lon = Decimal("44.8361999"), Decimal("-0.5786028")
    rows = [(2615, "P52.1", "18 rue", "PONCTUEL", 0, lat, lon, "44.8361999, -0.5786028", "{}", AT, AT)]
    return spark.createDataFrame(rows, SENSOR)


def table(spark, *changes):
    """One row per change; each gets an id of its own unless the change sets it."""
    rows = [{**GOOD, "event_id": f"id-{i}", **change} for i, change in enumerate(changes)]
    return spark.createDataFrame([tuple(r[c] for c in WEATHER_SENSOR_CLEAN) for r in rows], DDL)


def issues(report):
    by_name = {name: key for key, (_, name, _, _) in Q.CONTROLS.items()}
    return {by_name[r.control_name]: r.issue_count for r in report.collect() if r.issue_count}


CASES = [
    ({}, set()),
    ({"event_id": None}, {"required"}),
    ({"observed_at": None}, {"required"}),
    ({"collected_at": None}, {"required"}),
    ({"processed_at": None}, {"required"}),
    ({"source": None}, {"required"}),
    ({"source": ""}, {"required"}),
    ({"source": "   "}, {"required"}),
    ({"source": " open-meteo "}, set()),
    ({"temperature_c": -90.0}, set()),
    ({"temperature_c": 60.0}, set()),
    ({"temperature_c": -90.01}, {"temperature"}),
    ({"temperature_c": 60.01}, {"temperature"}),
    ({"temperature_c": NAN}, {"temperature"}),
    ({"temperature_c": INF}, {"temperature"}),
    ({"temperature_c": -INF}, {"temperature"}),
    ({"temperature_c": None}, {"optional"}),
    ({"humidity_pct": 0.0}, set()),
    ({"humidity_pct": 100.0}, set()),
    ({"humidity_pct": -0.01}, {"humidity"}),
    ({"humidity_pct": 100.01}, {"humidity"}),
    ({"humidity_pct": NAN}, {"humidity"}),
    ({"humidity_pct": None}, {"optional"}),
    ({"wind_speed_kmh": 0.0}, set()),
    ({"wind_speed_kmh": -1.0}, {"wind"}),
    ({"wind_speed_kmh": NAN}, {"wind"}),
    ({"wind_speed_kmh": INF}, {"wind"}),
    ({"wind_speed_kmh": -INF}, {"wind"}),
    ({"wind_speed_kmh": None}, {"optional"}),
    ({"precipitation_mm": -1.0}, {"precipitation"}),
    ({"precipitation_mm": NAN}, {"precipitation"}),
    ({"precipitation_mm": INF}, {"precipitation"}),
    ({"precipitation_mm": None}, set()),
    ({"sensor_latitude": 90.0}, {"metadata"}),
    ({"sensor_latitude": 90.1}, {"coordinates", "metadata"}),
    ({"sensor_longitude": -180.1}, {"coordinates", "metadata"}),
    ({"sensor_latitude": None}, {"required", "metadata"}),
    ({"sensor_latitude": 44.83619990001}, set()),
    ({"comptage_5m": 0}, set()),
    ({"comptage_5m": -1}, {"count"}),
    ({"sensor_ident": "P52.1 "}, {"metadata"}),
    ({"sensor_ident": " "}, {"required", "metadata"}),
    ({"sensor_type": "BOUCLE"}, {"metadata"}),
    ({"zone": 1}, {"metadata"}),
    ({"zone": None}, {"required", "metadata"}),
    ({"sensor_label": None}, {"required", "metadata"}),
    ({"sensor_gid": 99}, {"orphans"}),
    ({"sensor_gid": None}, {"required", "orphans"}),
    ({"temperature_c": NAN, "humidity_pct": 101.0, "source": ""}, {"temperature", "humidity", "required"}),
]


@pytest.fixture(scope="module")
def judged(spark, sensor):
    """Violations per row, judged row by row for all cases in one pass."""
    df = table(spark, *(change for change, _ in CASES)).withColumn("n", F.monotonically_increasing_id())
    joined = df.join(Q.canonical_rows(sensor), "sensor_gid", "left")
    known = F.col("__known").isNotNull()
    rules = {**Q.row_rules(), "metadata": known & Q.metadata_differs(), "orphans": ~known}
    rows = joined.select("n", *(F.coalesce(v, F.lit(False)).alias(k) for k, v in rules.items())).orderBy("n")
    return [{k for k in rules if r[k]} for r in rows.collect()]


@pytest.mark.parametrize("i", range(len(CASES)))
def test_rule_matrix(judged, i):
    assert judged[i] == CASES[i][1], CASES[i][0]


def test_report_adds_up(spark, sensor):
    df = table(spark, *(change for change, _ in CASES))
    want = {}
    for _, keys in CASES:
        for key in keys:
            want[key] = want.get(key, 0) + 1
    assert issues(Q.audit(df, sensor)) == want
    assert issues(Q.audit(df, sensor, max_rows=0)) == want


def test_duplicate_keys_are_counted_once(spark, sensor):
    twice, thrice = {"event_id": "a"}, {"event_id": "b"}
    df = table(spark, twice, twice, thrice, thrice, thrice, {"event_id": None}, {"event_id": None}, {})
    assert issues(Q.audit(df, sensor))["duplicates"] == 3


def test_report_shape(spark, sensor):
    rows = Q.audit(table(spark, {}, {}), sensor).collect()
    assert [r.category for r in rows] == (
        ["Completeness"] * 2 + ["Uniqueness"] + ["Validity"] * 6 + ["Consistency", "Integrity"]
    )
    assert rows[0].control_name.startswith("Optional") and rows[1].control_name.startswith("Required")
    assert {r.checked_rows for r in rows} == {2} and {r.issue_count for r in rows} == {0}
    assert rows[0].asDict().keys() == {
        "category", "control_name", "checked_rows", "issue_count", "severity", "policy"
    }


def test_empty_table(spark, sensor):
    rows = Q.audit(table(spark), sensor).collect()
    assert len(rows) == 11 and {(r.checked_rows, r.issue_count) for r in rows} == {(0, 0)}


def test_single_rule_agrees_with_report(spark, sensor):
    df = table(spark, *(change for change, _ in CASES))
    report = issues(Q.audit(df, sensor))
    for key in Q.CONTROLS:
        row = Q.audit_rule(df, sensor, key).first()
        assert (row.checked_rows, row.issue_count) == (len(CASES), report.get(key, 0))


@pytest.mark.parametrize("max_rows", [0, 1000])
def test_repair(spark, sensor, max_rows):
    df = table(spark, *(change for change, _ in CASES))
    fixed = Q.repair(df, sensor, max_rows)
    assert fixed.columns == df.columns and fixed.dtypes == df.dtypes and fixed.count() == df.count()
    left = issues(Q.audit(fixed, sensor))
    for key in ("temperature", "humidity", "wind", "precipitation", "metadata", "coordinates"):
        assert key not in left
    assert left["orphans"] == 2 and left["count"] == 1
    assert {r.corrected_rows for r in Q.repair_actions(fixed, sensor).collect()} == {0}
    again = Q.repair(fixed, sensor, max_rows)
    assert sorted(map(str, again.collect())) == sorted(map(str, fixed.collect()))


def test_repair_values(spark, sensor):
    changes = [
        {"temperature_c": NAN, "precipitation_mm": -1.0, "source": " open-meteo "},
        {"precipitation_mm": None, "source": "  "},
    ]
    first, second = sorted(Q.repair(table(spark, *changes), sensor).collect(), key=lambda r: r.event_id)
    assert (first.temperature_c, first.precipitation_mm, first.source) == (None, 0.0, "open-meteo")
    assert (second.precipitation_mm, second.source) == (None, "  ")


def test_actions_report(spark, sensor):
    changes = [{"temperature_c": NAN}, {"temperature_c": INF}, {"source": " x"}, {"zone": 4}, {"source": " "}]
    rows = Q.repair_actions(table(spark, *changes), sensor).collect()
    assert [(r.action, r.corrected_rows) for r in rows] == [
        ("Replace negative precipitation with 0", 0),
        ("Restore sensor metadata from canonical sensor row", 1),
        ("Set invalid humidity to NULL", 0),
        ("Set invalid temperature to NULL", 2),
        ("Set negative wind speed to NULL", 0),
        ("Trim source text", 1),
    ]


def test_one_scan_counts_all_row_rules(spark, sensor, plan, tmp_path):
    table(spark, {}, {}).write.parquet(f"{tmp_path}/t")
    text = plan(Q.audit(spark.read.parquet(f"{tmp_path}/t"), sensor))
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert len(scans) == 2
    assert sum("ReadSchema: struct<event_id:string>" in line for line in scans) == 1


def test_quality_run(spark, sensor, tmp_path):
    root = str(tmp_path)
    df = table(spark, {"temperature_c": NAN}, {"zone": 3}, {})
    first = quality_run(df, sensor, root, datetime(2026, 9, 28, 8, 40))
    assert issues(first.before) == {"temperature": 1, "metadata": 1}
    assert issues(first.after) == {"optional": 1}
    published = read_published(spark, root, "events")
    second = quality_run(published, sensor, root, datetime(2026, 9, 28, 8, 42), immutable=True)
    assert second.run_id != first.run_id
    assert {r.corrected_rows for r in second.actions.collect()} == {0}
    for report in first.reports + second.reports:
        assert spark.read.option("header", True).csv(report).count() in (6, 11)
    line = spark.read.option("header", True).csv(first.reports[0]).first()
    assert line.policy == "Weather fields are optional; absence is reported, not imputed."


def test_rounding_alone_is_not_repaired(spark, sensor):
    """The correction changes the rows that its report counts, and no others."""
    df = table(spark, {}, {}).withColumn("sensor_latitude", F.col("sensor_latitude").cast("double") + 1e-8)
    fixed = Q.repair_metadata(df, sensor)
    changed = Q.repair_actions(df, sensor).filter("action LIKE 'Restore%'").first().corrected_rows
    assert changed == 0
    assert fixed.select("sensor_latitude").collect() == df.select("sensor_latitude").collect()
