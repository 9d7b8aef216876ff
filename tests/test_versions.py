"""Small files, manifests, publication by several writers, tables in buckets."""

import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from gaugeworks import files
from gaugeworks.operators.merge import upsert
from gaugeworks.sinks import (
    buckets,
    create_buckets,
    manifest,
    publish,
    published_runs,
    read_buckets,
    read_published,
    remove_unused,
    upsert_buckets,
)


def test_small_files(spark, tmp_path):
    path = f"{tmp_path}/a b/c.txt"
    assert not files.exists(spark, path) and files.names(spark, f"{tmp_path}/a b") == []
    files.write_text(spark, path, "é\n")
    files.write_text(spark, path, "other")
    assert files.read_text(spark, path) == "other" and files.names(spark, f"{tmp_path}/a b") == ["c.txt"]
    assert not files.put_if_absent(spark, path, "late")
    assert files.put_if_absent(spark, f"file://{tmp_path}/new/d", "first")
    assert not files.put_if_absent(spark, f"{tmp_path}/new/d", "second")
    assert files.read_text(spark, f"{tmp_path}/new/d") == "first"
    assert files.names(spark, f"{tmp_path}/new") == ["d"]


def test_one_writer_makes_a_file(spark, tmp_path):
    start = threading.Barrier(8)

    def write(n):
        start.wait()
        return files.put_if_absent(spark, f"{tmp_path}/x", str(n))

    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(write, range(8)))
    assert sum(made) == 1 and files.read_text(spark, f"{tmp_path}/x") == str(made.index(True))


def test_manifest_keeps_every_version(spark, tmp_path):
    log = f"{tmp_path}/log"
    assert manifest.newest(spark, log) is None and list(manifest.history(spark, log)) == []

    def add(n):
        return manifest.extend(spark, log, lambda base: {"seen": (base.content["seen"] if base else []) + [n]})

    with ThreadPoolExecutor(6) as pool:
        numbers = [v.number for v in pool.map(add, range(12))]
    assert sorted(numbers) == list(range(1, 13))
    last = manifest.newest(spark, log)
    assert last.number == 12 and sorted(last.content["seen"]) == list(range(12))
    for version in manifest.history(spark, log):  # each one extends the one before
        assert version.content["seen"] == last.content["seen"][: version.number]
    files.write_text(spark, f"{log}/{manifest.HINT}", "3")  # a hint that is behind
    assert manifest.newest(spark, log).number == 12


def test_extend_gives_up(spark, tmp_path):
    log = f"{tmp_path}/log"

    def overtaken(base):
        number = base.number + 1 if base else 1
        files.put_if_absent(spark, f"{log}/{number:020d}.json", "{}")
        return {}

    with pytest.raises(RuntimeError, match="another writer"):
        manifest.extend(spark, log, overtaken, attempts=3)


def test_two_publishers(spark, tmp_path):
    root, both = f"{tmp_path}/p", threading.Barrier(2)

    def run(n):
        def check(tables):
            both.wait()  # both have written and checked before either publishes

        return publish({"shared": spark.range(n), f"own{n}": spark.range(n)}, root, check)

    with ThreadPoolExecutor(2) as pool:
        one, two = pool.map(run, (3, 5))
    order = published_runs(spark, root)
    assert sorted(order) == sorted((one, two))
    assert read_published(spark, root, "shared").count() == (3 if order[-1] == one else 5)
    assert read_published(spark, root, "own3").count() == 3 and read_published(spark, root, "own5").count() == 5
    assert read_published(spark, root, "none") is None


KINDS = "k long, s string, v double"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    root = f"{tmp_path}/t"
    base = spark.createDataFrame([(i, "a", float(i)) for i in range(200)] + [(None, "n", 0.0), (5, "z", 9.0)], KINDS)
    create_buckets(base, root, ["k"], 8, ["s"])
    assert read_buckets(spark, root).count() == 200
    before = set(read_buckets(spark, root).inputFiles())
    updates = spark.createDataFrame([(7, "b", 1.0), (7, "a", 2.0), (None, "b", 1.0)], KINDS)
    upsert_buckets(updates, root, ["s"])
    after = set(read_buckets(spark, root).inputFiles())
    folders = lambda names: {n.split("__bucket=")[1].split("/")[0] for n in names}
    assert len(folders(before - after)) == 1 and folders(before - after) == folders(after - before)
    want = upsert(base.dropna().filter("s = 'a'"), updates, ["k"], ["s"])
    assert rows_of(read_buckets(spark, root)) == rows_of(want)
    assert rows_of(read_buckets(spark, root, 1)) == rows_of(base.dropna().filter("s = 'a'"))
    with pytest.raises(buckets.Conflict):
        create_buckets(base, root, ["k"], 8)


def test_upserts_many_keys_and_none(spark, tmp_path):
    root = f"{tmp_path}/t"
    create_buckets(spark.createDataFrame([], KINDS), root, ["k", "s"], 4)
    assert read_buckets(spark, root).count() == 0
    rows = spark.range(1000).selectExpr("id AS k", "'x' AS s", "1.0D AS v", "2 AS extra")
    upsert_buckets(rows, root, ["v"])
    upsert_buckets(rows.limit(0), root, ["v"])
    upsert_buckets(rows.withColumn("v", F.col("k") * 2.0).filter("k >= 500"), root, ["v"])
    got = {r.k: r.v for r in read_buckets(spark, root).collect()}
    assert got == {k: (1.0 if k < 500 else 2.0 * k) for k in range(1000)}
    assert read_buckets(spark, root).columns == ["k", "s", "v"]


def test_writers_of_one_table(spark, tmp_path):
    """Upserts at the same time: none is lost, whether their buckets differ or not."""
    root, n = f"{tmp_path}/t", 4
    create_buckets(spark.range(400).selectExpr("id AS k", "'a' AS s", "0.0D AS v"), root, ["k"], 16)

    def run(w):
        mine = spark.createDataFrame([(w, f"w{w}", 1.0), (100 + w, f"w{w}", 1.0), (1000, f"w{w}", float(w))], KINDS)
        return upsert_buckets(mine, root, ["s"], attempts=50).number

    with ThreadPoolExecutor(n) as pool:
        numbers = list(pool.map(run, range(n)))
    assert sorted(numbers) == list(range(2, n + 2))
    got = {r.k: r for r in read_buckets(spark, root).collect()}
    assert len(got) == 401 and all(got[w].s == got[100 + w].s == f"w{w}" for w in range(n))
    assert got[1000].v == numbers.index(max(numbers))


def test_unused_folders_are_removed(spark, tmp_path):
    root = f"{tmp_path}/t"
    create_buckets(spark.range(50).selectExpr("id AS k", "'a' AS s", "0.0D AS v"), root, ["k"], 4)
    for v in (1.0, 2.0):
        upsert_buckets(spark.createDataFrame([(1, "b", v)], KINDS), root, ["v"])
    assert remove_unused(spark, root, 2) == 1
    assert read_buckets(spark, root, 2).filter("k = 1").first().v == 1.0
    assert remove_unused(spark, root, 1) == 1 and remove_unused(spark, root, 1) == 0
    assert read_buckets(spark, root).count() == 50 and read_buckets(spark, root).filter("k = 1").first().v == 2.0
