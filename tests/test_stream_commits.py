"""Streams that stop between outputs, lose their checkpoint, or keep their ids in state."""

import json
import shutil

import pytest
from pyspark.errors import StreamingQueryException

from gaugeworks import files
from gaugeworks.schemas import ENRICHED, WEATHER_SENSOR_CLEAN
from gaugeworks.sources import json_file_stream, read_json_lines
from gaugeworks.streaming import (
    committed_batches,
    enrich_messages,
    load_clean,
    load_clean_keyed,
    read_committed,
)
from gaugeworks.streaming import commits
from test_flows import RUN, SITE, event, lines, sites  # noqa: F401


def test_ids_follow_the_checkpoint(spark, tmp_path):
    checkpoint = f"{tmp_path}/cp"
    first = commits.query_id(spark, checkpoint)
    assert commits.query_id(spark, checkpoint) != first  # nothing was planned under the first one
    name = commits.query_id(spark, checkpoint)
    (tmp_path / "cp" / "offsets").mkdir()
    (tmp_path / "cp" / "offsets" / "0").write_text("v1")
    assert commits.query_id(spark, checkpoint + "/") == name
    (tmp_path / "cp" / commits._ID).unlink()
    spark.createDataFrame([("old",)], "value string").coalesce(1).write.text(f"{checkpoint}-id")
    assert commits.query_id(spark, checkpoint) == "old" == commits.query_id(spark, checkpoint)


def test_half_a_batch_is_not_seen(spark, sites, tmp_path):
    inbox, out = tmp_path / "in", f"{tmp_path}/out"
    inbox.mkdir()

    def run(broken=None):
        def after(name, batch_id):
            if name == broken:
                raise RuntimeError("stop")

        stream = json_file_stream(spark, str(inbox))
        query = enrich_messages(stream, sites, out, f"{tmp_path}/cp", after_output=after)
        if broken:
            with pytest.raises(StreamingQueryException):
                query.awaitTermination()
        else:
            query.awaitTermination()

    def seen():
        raw = read_committed(spark, out, "raw", "value STRING", "text")
        enriched = read_committed(spark, out, "enriched", ENRICHED)
        rejected = read_committed(spark, out, "rejected", "reason STRING", "json")
        return raw.count(), enriched.count(), rejected.count()

    assert seen() == (0, 0, 0)
    lines(inbox / "1", event(1), "{broken")
    run()
    assert seen() == (2, 1, 1)
    lines(inbox / "2", event(2), event(3), event(4, latitude=None))
    for broken in ("raw", "enriched", "rejected"):
        run(broken)
        assert seen() == (2, 1, 1)
    assert spark.read.text(f"{out}/raw").count() == 5  # written, not committed
    run()
    run()
    assert seen() == (5, 3, 2)
    totals = spark.read.json(f"{out}/counters").groupBy().sum("messages", "enriched", "rejected").first()
    assert tuple(totals) == (5, 3, 2) and committed_batches(spark, out).count() == 2


def test_a_committed_batch_is_left_alone(spark, sites, tmp_path):
    """The marker was written but Spark's own commit was not: the batch comes again."""
    inbox, out = tmp_path / "in", f"{tmp_path}/out"
    inbox.mkdir()
    lines(inbox / "1", event(1))

    def run():
        enrich_messages(json_file_stream(spark, str(inbox)), sites, out, f"{tmp_path}/cp").awaitTermination()

    run()
    before = spark.read.parquet(f"{out}/enriched").inputFiles()
    for name in ("0", ".0.crc"):
        (tmp_path / "cp" / "commits" / name).unlink()
    run()
    assert spark.read.parquet(f"{out}/enriched").inputFiles() == before


def inbox(spark, tmp_path, name, *records):
    batch = read_json_lines(spark, lines(tmp_path / f"{name}.jsonl", *records), ENRICHED).drop("_corrupt_record")
    batch.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    return spark.readStream.schema(batch.schema).parquet(f"{tmp_path}/in")


def loaded(spark, target):
    rows = read_committed(spark, target, "loaded", "event_id STRING")
    return sorted(int(r.event_id[-3:]) for r in rows.collect())


def test_cleared_checkpoint_keeps_what_was_loaded(spark, tmp_path):
    target, checkpoint = f"{tmp_path}/t", f"{tmp_path}/cp"
    rows = [{**event(n), **SITE} for n in range(4)]
    load_clean(inbox(spark, tmp_path, "a", *rows[:2]), target, checkpoint, run_at=RUN).awaitTermination()
    load_clean(inbox(spark, tmp_path, "b", rows[2]), target, checkpoint, run_at=RUN).awaitTermination()
    shutil.rmtree(checkpoint)
    load_clean(inbox(spark, tmp_path, "c", *rows[2:]), target, checkpoint, run_at=RUN).awaitTermination()
    assert loaded(spark, target) == [0, 1, 2, 3]
    assert len(files.names(spark, f"{target}/loaded")) == 2


def test_keys_of_a_stopped_batch_do_not_count(spark, tmp_path):
    """A checkpoint that stopped before its commit does not hold its events back from another one."""
    target = f"{tmp_path}/t"
    rows = [{**event(n), **SITE} for n in range(3)]
    load_clean(inbox(spark, tmp_path, "a", *rows[:2]), target, f"{tmp_path}/cp1", run_at=RUN).awaitTermination()
    query = files.names(spark, f"{target}/keys")[0].removeprefix("query_id=")
    shutil.rmtree(f"{target}/counters")
    assert not commits.is_committed(spark, target, query, 0)
    load_clean(inbox(spark, tmp_path, "b", rows[2]), target, f"{tmp_path}/cp2", run_at=RUN).awaitTermination()
    assert loaded(spark, target) == [0, 1, 2]


def test_keys_are_compacted_while_loading(spark, tmp_path):
    target, checkpoint = f"{tmp_path}/t", f"{tmp_path}/cp"
    for n in range(5):
        stream = inbox(spark, tmp_path, f"f{n}", *[{**event(i), **SITE} for i in range(n + 1)])
        load_clean(stream, target, checkpoint, run_at=RUN, compact_every=2).awaitTermination()
    query = files.names(spark, f"{target}/keys")[0]
    assert files.names(spark, f"{target}/keys/{query}") == ["batch_id=-4", "batch_id=4"]
    assert loaded(spark, target) == [0, 1, 2, 3, 4]


def test_load_with_keyed_state(spark, sites, tmp_path):
    target, checkpoint = f"{tmp_path}/t", f"{tmp_path}/cp"

    def run(name, *records):
        stream = inbox(spark, tmp_path, name, *records)
        load_clean_keyed(stream, target, checkpoint, run_at=RUN, sensor=sites).awaitTermination()

    late = {"collected_at": "2026-09-25T15:00:00+00:00", "temperature_c": 1.0}
    run("a", {**event(1, **late), **SITE}, {**event(1), **SITE}, {**event(2), **SITE, "zone": None},
        {**event(3), **SITE, "sensor_gid": 77}, {**event(4, observed_at="soon"), **SITE})
    run("b", {**event(1), **SITE}, {**event(2), **SITE}, {**event(5, event_id=None), **SITE})
    run("c", {**event(2), **SITE}, {**event(3), **SITE})
    assert loaded(spark, target) == [1, 2, 3]
    rows = spark.read.parquet(f"{target}/loaded")
    assert rows.drop("query_id", "batch_id").dtypes == list(WEATHER_SENSOR_CLEAN.items())
    assert float(rows.filter("event_id LIKE '%1'").first().temperature_c) == 25.9  # the earlier copy
    refused = spark.read.parquet(f"{target}/rejected").collect()
    assert sorted((r.event_id or "null")[-1] + ":" + ",".join(r.violations) for r in refused) == [
        "2:zone not null", "3:sensor_gid exists", "4:observed_at not null", "l:event_id not null",
    ]
    counters = spark.read.json(f"{target}/counters").groupBy().sum("loaded", "rejected").first()
    assert tuple(counters) == (3, 4)
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass", "")


def test_state_is_kept_in_the_checkpoint(spark, tmp_path):
    """A batch that stops after its outputs comes again and loads the same events."""
    target, checkpoint = f"{tmp_path}/t", tmp_path / "cp"
    stream = inbox(spark, tmp_path, "a", *[{**event(n), **SITE} for n in (1, 2, 2)])
    load_clean_keyed(stream, target, str(checkpoint), run_at=RUN).awaitTermination()
    for name in ("0", ".0.crc"):
        (checkpoint / "commits" / name).unlink()
    shutil.rmtree(f"{target}/counters")
    load_clean_keyed(stream, target, str(checkpoint), run_at=RUN).awaitTermination()
    assert loaded(spark, target) == [1, 2]
    marks = [json.loads(r.value) for r in spark.read.text(f"{target}/counters").collect()]
    assert marks == [{"loaded": 2, "rejected": 0}]
