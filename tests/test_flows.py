"""Sources, sinks, event cleaning and the streaming twins."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from gaugeworks.operators.constraints import ConstraintError
from gaugeworks.plans.flows import clean_events, loadable_events, type_events
from gaugeworks.schemas import ENRICHED, ENRICHED_TEXT, EVENT, WEATHER_SENSOR_CLEAN
from gaugeworks.session import shared_dir
from gaugeworks.sinks import (
    append_rows,
    export_latest,
    land_snapshot,
    publish,
    read_published,
    write_clean,
    write_json_lines,
)
from gaugeworks.sources import (
    count_lines,
    decode_events,
    flatten_payload,
    json_file_stream,
    kafka_stream,
    read_inventory,
    read_json_lines,
    scan_table,
    split_corrupt,
)
from gaugeworks.sources.tables import register_views
from gaugeworks.streaming import (
    compact_keys,
    deduplicated,
    enrich_messages,
    keep_running,
    load_clean,
    rate,
    rows_processed,
)
from gaugeworks.streaming.flows import enriched_file_stream

RUN = datetime(2026, 9, 25, 17, 0, tzinfo=timezone.utc)


def event(n, **changes):
    base = {
        "event_id": f"00000000-0000-4000-8000-{n:012d}",
        "collected_at": f"2026-09-25T14:25:{n % 60:02d}.390422+00:00",
        "source": "open-meteo",
        "latitude": 44.8378,
        "longitude": -0.5792,
        "observed_at": "2026-09-25T16:15",
        "temperature_c": 25.9,
        "humidity_pct": 58,
        "wind_speed_kmh": 15.6,
        "precipitation_mm": None,
    }
    return {**base, **changes}


SITE = {
    "sensor_gid": 2615, "sensor_ident": "P52.1", "sensor_type": "PONCTUEL", "zone": 0,
    "sensor_latitude": 44.8361999, "sensor_longitude": -0.5786028, "sensor_label": "rue", "comptage_5m": None,
}


def lines(path, *records):
    path.write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in records))
    return str(path)


def test_json_lines(spark, tmp_path):
    path = lines(tmp_path / "a.jsonl", {**event(1), **SITE, "extra": 1}, {"event_id": "x"}, '{"event_id": "br')
    good, bad = split_corrupt(read_json_lines(spark, path, ENRICHED).cache())
    assert good.count() == 2 and [r[0] for r in bad.collect()] == ['{"event_id": "br']
    assert good.filter("event_id = 'x'").first().temperature_c is None
    assert count_lines(spark, f"{tmp_path}/*.jsonl") == 3


def test_missing_input_has_no_rows(spark, tmp_path):
    assert read_json_lines(spark, f"{tmp_path}/none", ENRICHED).isEmpty()
    assert count_lines(spark, f"{tmp_path}/none/*.jsonl") == 0
    assert scan_table(spark, f"{tmp_path}/none", "k int").isEmpty()
    with pytest.raises(AnalysisException):
        scan_table(spark, f"{tmp_path}/none")


def test_decode(spark):
    df = spark.createDataFrame([(1, json.dumps(event(1))), (2, "{oops"), (3, "{}")], "n int, value string")
    found = {r.n: r for r in decode_events(df).collect()}
    assert found[1].latitude == 44.8378 and found[1]._corrupt_record is None
    assert found[2]._corrupt_record == "{oops" and found[2].event_id is None
    assert found[3].event_id is None and found[3]._corrupt_record is None


def test_flatten_payload(spark):
    body = json.dumps({"current": {"time": "2026-09-25T16:15", "temperature_2m": 25.9}})
    df = spark.createDataFrame([(body,)], "body string")
    flat = flatten_payload(df, "body", latitude=44.8378, longitude=-0.5792, source="open-meteo")
    assert [f.name for f in flat.schema] == [p.split()[0] for p in EVENT.split(", ")]
    row = flat.first()
    assert (row.temperature_c, row.humidity_pct, row.observed_at) == (25.9, None, "2026-09-25T16:15")
    assert len(row.event_id) == 36 and row.collected_at.endswith("+00:00")


def test_clean_events(spark, tmp_path):
    good = {**event(1), **SITE}
    records = [
        good,
        {**good, "collected_at": "2026-09-25T14:25:00+00:00", "observed_at": "zz"},  # earlier, but broken
        {**good, "collected_at": "2026-09-25T14:30:00+00:00", "temperature_c": 1},  # later copy
        {**event(2), **SITE, "sensor_gid": None},
        {**event(3), **SITE, "temperature_c": "warm", "zone": "x", "precipitation_mm": 1.5},
        {**event(4), **SITE, "event_id": None},
    ]
    raw = read_json_lines(spark, lines(tmp_path / "e.jsonl", *records), ENRICHED_TEXT).drop("_corrupt_record")
    found = {r.event_id[-1]: r for r in clean_events(raw, RUN).collect()}
    assert set(found) == {"1", "3"}
    assert (found["1"].temperature_c, found["1"].precipitation_mm) == (25.9, 0.0)
    assert (found["3"].temperature_c, found["3"].zone, found["3"].precipitation_mm) == (None, None, 1.5)
    cleaned = clean_events(raw, RUN, source_tz="Europe/Paris")
    assert cleaned.select(F.date_format("observed_at", "HH:mm")).first()[0] == "14:15"
    assert {r.processed_at for r in cleaned.collect()} == {found["1"].processed_at}


def test_loadable_events(spark, tmp_path):
    records = [{**event(1), **SITE}, {**event(2, event_id="not-a-uuid"), **SITE}, {**event(3), **SITE, "zone": None}]
    raw = read_json_lines(spark, lines(tmp_path / "e.jsonl", *records), ENRICHED).drop("_corrupt_record")
    result = loadable_events(clean_events(raw, RUN))
    assert result.valid.dtypes == list(WEATHER_SENSOR_CLEAN.items())
    assert result.valid.count() == 1
    assert {tuple(r.violations) for r in result.quarantined.collect()} == {
        ("event_id is a uuid",), ("zone not null",)
    }


def test_clean_is_partitioned_by_day(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, datetime(2026, 1, 1, 5)), (2, datetime(2026, 1, 2, 5))], "k int, observed_at timestamp"
    )
    assert write_clean(df, f"{tmp_path}/clean") == 2
    assert write_clean(df, f"{tmp_path}/clean") == 2
    back = spark.read.parquet(f"{tmp_path}/clean")
    export_latest(back.withColumn("event_id", F.col("k")), f"{tmp_path}/sample", 1)
    assert spark.read.option("sep", ";").option("header", True).csv(f"{tmp_path}/sample").first().k == "2"
    assert back.filter("observed_date = '2026-01-02'").select("k").first()[0] == 2 and back.count() == 2


def test_snapshot_and_append(spark, tmp_path):
    path = lines(tmp_path / "s.csv", "Geo Point;Geo Shape;gid;libelle;ident;type;zone;comptage_5m;cdate;mdate", *[f"1, 2;{{}};{i};;P{i};T;0;;;" for i in range(3)])
    staging = read_inventory(spark, path)
    for _ in range(2):
        assert land_snapshot(staging, f"{tmp_path}/raw") == 3
    assert read_inventory(spark, f"{tmp_path}/raw").count() == 3
    append_rows(staging, f"{tmp_path}/t")
    append_rows(staging, f"{tmp_path}/t")
    assert scan_table(spark, f"{tmp_path}/t").count() == 6
    write_json_lines(staging, f"{tmp_path}/j")
    assert count_lines(spark, f"{tmp_path}/j") == 3


def test_publish_is_all_or_nothing(spark, tmp_path):
    root = str(tmp_path)
    assert read_published(spark, root, "a") is None
    publish({"a": spark.range(3), "b": spark.range(1)}, root)

    def refuse(tables):
        assert tables["a"].count() == 5
        raise ConstraintError("no")

    with pytest.raises(ConstraintError):
        publish({"a": spark.range(5), "b": spark.range(1)}, root, refuse)
    assert read_published(spark, root, "a").count() == 3
    publish({"a": spark.range(7)}, root)
    assert read_published(spark, root, "a").count() == 7
    assert read_published(spark, root, "b").count() == 1


def test_views(spark):
    register_views({"numbers": spark.range(4)})
    assert spark.sql("SELECT count(*) FROM numbers").first()[0] == 4


def test_kafka_needs_its_connector(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        kafka_stream(spark, "broker:9092", "weather")


def test_shared_dir_follows_the_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert not configured or shared_dir(spark) == configured.rstrip("/")


@pytest.fixture
def sites(spark):
    rows = [(2616, "P52.2", "P", 0, 44.8362039, -0.578552, "a", 5), (2615, "P52.1", "P", 0, 44.8361999, -0.5786028, "b", None)]
    ddl = "gid int, ident string, type_code string, zone_code int, latitude double, longitude double, libelle string, comptage_5m int"
    return spark.createDataFrame(rows, ddl)


def test_stream_enrich_and_load(spark, sites, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    out, read = f"{tmp_path}/out", []

    def run():
        stream = json_file_stream(spark, str(inbox), max_files=1)
        query = enrich_messages(stream, sites, out, f"{tmp_path}/cp1")
        query.awaitTermination()
        read.append(rows_processed(query))
        landed = enriched_file_stream(spark, f"{out}/enriched", max_files=1)
        load_clean(landed, f"{tmp_path}/clean", f"{tmp_path}/cp2", run_at=RUN).awaitTermination()

    lines(inbox / "1", *[event(n) for n in range(3)], "{broken")
    lines(inbox / "2", *[event(n) for n in (2, 3, 4)], event(9, latitude=None))
    run()
    lines(inbox / "3", *[event(n) for n in (0, 5)])
    run()
    run()
    assert read == [8, 2, 0]
    assert spark.read.text(f"{out}/raw").count() == 10
    assert spark.read.parquet(f"{out}/enriched").count() == 8
    reasons = spark.read.json(f"{out}/rejected").groupBy("reason").count()
    assert {tuple(r) for r in reasons.collect()} == {("unreadable", 1), ("no position", 1)}
    clean = spark.read.parquet(f"{tmp_path}/clean/loaded")
    assert sorted(r.event_id[-1] for r in clean.collect()) == list("012345")
    assert {r.sensor_gid for r in clean.collect()} == {2615}


def test_stream_needs_sites(spark, sites, tmp_path):
    (tmp_path / "in").mkdir()
    with pytest.raises(ConstraintError, match="sites"):
        enrich_messages(json_file_stream(spark, f"{tmp_path}/in"), sites.limit(0), f"{tmp_path}/o", f"{tmp_path}/c")


def test_stream_dedup_and_rate(spark, tmp_path):
    base = datetime(2026, 1, 1)
    rows = [(i % 50, base.replace(minute=i % 50)) for i in range(100)]
    spark.createDataFrame(rows, "k int, at timestamp").repartition(3).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("k int, at timestamp").parquet(f"{tmp_path}/in")

    def drain(df, name):
        query = df.writeStream.format("parquet").option("path", f"{tmp_path}/{name}")
        query = query.option("checkpointLocation", f"{tmp_path}/cp-{name}").trigger(availableNow=True)
        query.start().awaitTermination()
        return spark.read.schema(df.schema).parquet(f"{tmp_path}/{name}")

    assert drain(deduplicated(stream, "k", "at", "1 hour"), "dedup").count() == 50
    final = drain(rate(stream, "at", "10 minutes"), "rate").orderBy("window_start").collect()
    assert [r.events for r in final] == [10] * 7
    assert final[0].events_per_second == 10 / 300


def test_second_checkpoint_keeps_what_was_loaded(spark, sites, tmp_path):
    """Another checkpoint on the same target neither overwrites nor repeats."""
    rows = [{**event(n), **SITE} for n in range(3)]
    target = f"{tmp_path}/clean"
    for name, some in (("a", rows[:2]), ("b", rows[1:])):
        path = lines(tmp_path / f"{name}.jsonl", *some)
        batch = read_json_lines(spark, path, ENRICHED).drop("_corrupt_record")
        batch.write.parquet(f"{tmp_path}/in-{name}")
        stream = spark.readStream.schema(batch.schema).parquet(f"{tmp_path}/in-{name}")
        load_clean(stream, target, f"{tmp_path}/cp-{name}", run_at=RUN).awaitTermination()
    loaded = spark.read.parquet(f"{target}/loaded")
    assert sorted(r.event_id[-1] for r in loaded.collect()) == list("012")
    assert loaded.drop("query_id", "batch_id").dtypes == list(WEATHER_SENSOR_CLEAN.items())
    counters = spark.read.json(f"{target}/counters").groupBy().sum("loaded", "rejected").first()
    assert tuple(counters) == (3, 0)


def test_gate_on_the_stream(spark, sites, tmp_path):
    rows = [{**event(1), **SITE, "zone": None, "comptage_5m": -5}, {**event(2), **SITE}, {**event(3), **SITE, "sensor_gid": 77}]
    path = lines(tmp_path / "e.jsonl", *rows)
    batch = read_json_lines(spark, path, ENRICHED).drop("_corrupt_record")
    batch.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(batch.schema).parquet(f"{tmp_path}/in")
    load_clean(stream, f"{tmp_path}/t", f"{tmp_path}/cp", run_at=RUN, sensor=sites).awaitTermination()
    assert [r.event_id[-1] for r in spark.read.parquet(f"{tmp_path}/t/loaded").collect()] == ["2"]
    reasons = {r.event_id[-1]: sorted(r.violations) for r in spark.read.parquet(f"{tmp_path}/t/rejected").collect()}
    assert reasons == {"1": ["comptage_5m >= 0", "zone not null"], "3": ["sensor_gid exists"]}


def test_compacted_keys_still_count(spark, tmp_path):
    rows = [{**event(n), **SITE} for n in range(4)]
    target = f"{tmp_path}/t"

    def load(name, some):
        batch = read_json_lines(spark, lines(tmp_path / f"{name}.jsonl", *some), ENRICHED).drop("_corrupt_record")
        batch.write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(batch.schema).parquet(f"{tmp_path}/in")
        load_clean(stream, target, f"{tmp_path}/cp", run_at=RUN).awaitTermination()

    load("a", rows[:1])
    load("b", rows[1:2])
    held = spark.read.parquet(f"{target}/keys")
    query_id = held.first()["query_id"]
    compact_keys(spark, target, query_id, 2)
    held = spark.read.parquet(f"{target}/keys")
    assert held.count() == 2 and held.select("batch_id").distinct().count() == 1
    load("c", rows)
    assert spark.read.parquet(f"{target}/loaded").count() == 4


def test_failed_query_is_started_again(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/in")
    failures = []

    def handle(batch, batch_id):
        if len(failures) < 2:
            failures.append(batch_id)
            raise RuntimeError("not yet")
        batch.write.mode("overwrite").parquet(f"{tmp_path}/out/batch_id={batch_id}")

    def start():
        stream = spark.readStream.schema("id long").parquet(f"{tmp_path}/in")
        writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", f"{tmp_path}/cp")
        return writer.trigger(availableNow=True).start()

    assert keep_running(start, attempts=4, pause_seconds=0) == 2
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3


def test_instants_of_typed_columns(spark):
    """A point in time is taken as it is, whatever the session's zone."""
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        row = spark.sql("SELECT timestamp'2026-09-25 16:15:00Z' AS t, timestamp_ntz'2026-09-25 16:15:00' AS u")
        texts = {c: F.lit(None).cast("string") for c in ("temperature_c", "humidity_pct", "wind_speed_kmh", "precipitation_mm", "sensor_gid", "zone", "comptage_5m")}
        typed = type_events(row.select(F.col("t").alias("observed_at"), F.col("u").alias("collected_at")).withColumns(texts), RUN)
        found = typed.select(F.unix_micros("observed_at"), F.unix_micros("collected_at")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found[0] == found[1] == 1790352900000000
