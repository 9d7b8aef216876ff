"""Days that are replaced, sketches, progress tables, payloads whose fields change type."""

import json
from datetime import date

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from gaugeworks.operators.sketches import profile_from_sketches, sketch_days
from gaugeworks.sinks.days import read_days, replace_days
from gaugeworks.sources.variants import field, land_variants, payload_schema, typed
from gaugeworks.streaming.progress import ProgressLog, read_progress, runs


def test_only_arriving_days_are_replaced(spark, tmp_path):
    root = f"{tmp_path}/t"
    rows = spark.range(30).selectExpr("id", "id * 1.0D AS v", "timestamp('2024-01-01') + make_interval(0, 0, 0, cast(id % 3 AS int)) AS observed_at")
    replace_days(rows, root)
    before = {f.split("/")[-2]: f for f in read_days(spark, root).inputFiles()}
    replace_days(rows.filter("id = 1").withColumn("v", F.lit(-1.0)), root)
    after = {f.split("/")[-2]: f for f in read_days(spark, root).inputFiles()}
    assert {d for d in before if before[d] != after[d]} == {"observed_date=2024-01-02"}
    got = read_days(spark, root)
    assert got.count() == 21 and got.filter("v < 0").first().observed_date == date(2024, 1, 2)
    assert read_days(spark, root, 1).count() == 30
    replace_days(rows.limit(0), root)  # nothing arrives, nothing goes
    replace_days(rows.filter("id = 0").withColumn("observed_at", F.lit(None).cast("timestamp")), root)
    assert read_days(spark, root).count() == 22 and read_days(spark, root).filter("observed_date IS NULL").count() == 1
    with pytest.raises(ValueError, match="columns"):
        replace_days(rows.drop("v"), root)


def test_sketches_of_days_add_up(spark):
    rows = spark.range(20000).selectExpr(
        "id % 5 AS day", "cast(id % 3000 AS string) AS s", "cast(id AS double) AS n", "cast(NULL AS int) AS none",
        "CASE WHEN id % 2 = 0 THEN ' ' END AS blank", "CASE WHEN id = 0 THEN double('NaN') WHEN id < 5 THEN 1.0D END AS odd",
    )
    stored = sketch_days(rows, "day", ["s", "n", "none", "blank", "odd"])
    assert stored.count() == 25 and stored.filter("day = 1 AND column_name = 'n'").first().min_value == "1.0"
    got = {r.column_name: r for r in profile_from_sketches(stored, (0.5, 0.9)).collect()}
    assert all(r.rows == 20000 for r in got.values())
    assert abs(got["s"].distinct_values - 3000) < 150 and got["s"].quantiles is None
    assert abs(got["n"].quantiles[0] - 10000) < 600 and abs(got["n"].quantiles[1] - 18000) < 600
    assert (got["none"].filled, got["none"].distinct_values, got["none"].quantiles) == (0, 0, None)
    assert (got["blank"].filled, got["odd"].filled) == (0, 5) and got["odd"].quantiles == [1.0, 1.0]
    part = {r.column_name: r for r in profile_from_sketches(stored.filter("day < 2")).collect()}
    assert part["n"].rows == 8000
    assert profile_from_sketches(stored.limit(0)).collect() == []


def test_progress_is_landed(spark, tmp_path):
    spark.range(10).repartition(2).write.parquet(f"{tmp_path}/in")
    path = f"{tmp_path}/progress"
    assert runs(read_progress(spark, path)).collect() == []
    log = ProgressLog(spark, path)
    spark.streams.addListener(log)

    def run(name, broken):
        def handle(batch, batch_id):
            batch.count()
            if broken and batch_id == 1:
                raise RuntimeError("broken")

        stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", f"{tmp_path}/{name}")
        query = writer.queryName(name).trigger(availableNow=True).start()
        try:
            query.awaitTermination()
        except StreamingQueryException:
            assert broken
        log.wait(query)
        return str(query.runId)

    try:
        good, bad = run("good", False), run("bad", True)
    finally:
        spark.streams.removeListener(log)
    got = {r.run_id: r for r in runs(read_progress(spark, path)).collect()}
    assert (got[good].batches, got[good].input_rows, got[good].outcome) == (2, 10, "ended")
    assert (got[bad].batches, got[bad].outcome) == (1, "failed") and got[good].busy_ms > 0
    failed = read_progress(spark, path).filter("kind = 'failed'").first()
    assert failed.run_id == bad and failed.error


def test_payloads_that_change_type(spark, tmp_path):
    texts = ['{"a": 1, "b": "x"}', '{"a": "2"}', '{"a": {"v": 3.5}}', '{"a": null, "c": [1, "z"]}', '{"a": tr', None, " 7 "]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, value string")
    land_variants(rows).write.parquet(f"{tmp_path}/v")
    landed = spark.read.parquet(f"{tmp_path}/v")
    assert [r.i for r in landed.filter("unreadable IS NOT NULL").collect()] == [4]
    objects = landed.filter("i < 4")
    assert "VARIANT" in payload_schema(objects)
    got = typed(objects, {"whole": ("$.a", "int"), "inner": ("$.a.v", "double"), "b": ("$.b", "string"), "c": ("$.c", "array<string>")})
    assert sorted((r.i, r.whole, r.inner, r.b, r.c) for r in got.collect()) == [
        (0, 1, None, "x", None), (1, 2, None, None, None), (2, None, 3.5, None, None), (3, None, None, None, ["1", "z"]),
    ]
    assert landed.filter("i = 6").select(field("payload", "$", "int")).first()[0] == 7
    assert json.loads(landed.filter("i = 2").select(F.to_json("payload")).first()[0]) == {"a": {"v": 3.5}}
