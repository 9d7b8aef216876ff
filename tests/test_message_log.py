"""A partitioned message log as a stream source."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from gaugeworks.sources.message_log import append_messages, message_log_stream, register_message_log


def texts(spark, low, high):
    return spark.range(low, high).select(F.concat(F.lit("m"), "id").alias("value"), (F.col("id") % 5).alias("k"))


def drain(spark, root, tmp_path, name="a", **options):
    stream = message_log_stream(spark, root, **options)
    writer = stream.writeStream.format("parquet").option("path", f"{tmp_path}/{name}")
    query = writer.option("checkpointLocation", f"{tmp_path}/{name}-cp").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema("partition int, offset long, value string").parquet(f"{tmp_path}/{name}")


def whole(rows):
    """Every partition's offsets from 0 on, without a gap."""
    per = {}
    for r in rows:
        per.setdefault(r.partition, []).append(r.offset)
    return all(sorted(o) == list(range(len(o))) for o in per.values())


def test_runs_go_on_where_they_stopped(spark, tmp_path):
    root = f"{tmp_path}/log"
    append_messages(texts(spark, 0, 30), root, 3, key=F.col("k"))
    append_messages(texts(spark, 30, 40), root, 3, key=F.col("k"))
    assert drain(spark, root, tmp_path).count() == 40
    assert drain(spark, root, tmp_path).count() == 40
    append_messages(texts(spark, 40, 45), root, 3, key=F.col("k"))
    append_messages(texts(spark, 0, 0), root, 3)
    rows = drain(spark, root, tmp_path).collect()
    assert sorted(r.value for r in rows) == sorted(f"m{i}" for i in range(45)) and whole(rows)
    by_key = {}
    for r in rows:
        by_key.setdefault(int(r.value[1:]) % 5, set()).add(r.partition)
    assert all(len(p) == 1 for p in by_key.values())
    register_message_log(spark)
    batch = spark.read.format("message_log").option("path", root).load()
    assert sorted(map(tuple, batch.collect())) == sorted(map(tuple, rows))
    with pytest.raises(ValueError, match="partitions"):
        append_messages(texts(spark, 0, 1), root, 4)


def test_latest_and_an_empty_log(spark, tmp_path):
    root = f"{tmp_path}/log"
    assert drain(spark, root, tmp_path, "empty").count() == 0
    append_messages(texts(spark, 0, 10), root, 2)
    assert drain(spark, root, tmp_path, "late", startingOffsets="latest").count() == 0
    append_messages(texts(spark, 10, 14), root, 2)
    late = drain(spark, root, tmp_path, "late", startingOffsets="latest")
    assert sorted(r.value for r in late.collect()) == ["m10", "m11", "m12", "m13"]
    assert drain(spark, root, tmp_path, "empty").count() == 14


def test_awkward_texts(spark, tmp_path):
    root = f"{tmp_path}/log"
    rows = [("",), ("a\nb\r\nc",), (None,), ("é " * 50_000,), ("same",), ("same",)]
    append_messages(spark.createDataFrame(rows, "value string"), root, 1)
    got = drain(spark, root, tmp_path)
    assert sorted(r.value for r in got.collect()) == sorted(["", "a b  c", "é " * 50_000, "same", "same"])


def test_appends_at_the_same_time(spark, tmp_path):
    root = f"{tmp_path}/log"
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: append_messages(texts(spark, 10 * n, 10 * n + 10), root, 2), range(4)))
    rows = drain(spark, root, tmp_path).collect()
    assert sorted(r.value for r in rows) == sorted(f"m{i}" for i in range(40)) and whole(rows)
