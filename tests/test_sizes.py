"""Queries on tables of their own, as long or as many as the small ones are not."""

import datetime as dt

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_point

KINDS = ("view", "click", "purchase", "signup", "error")


@pytest.fixture
def tables(spark, tmp_path):
    """Writes events and suppliers of given numbers; returns their folder."""

    def write(events, suppliers):
        start = dt.datetime(2024, 1, 1)
        rows = {
            "event_id": range(events), "ts": [start + dt.timedelta(seconds=7 * i) for i in range(events)],
            "user_id": [i % 13 for i in range(events)], "event_type": [KINDS[i % 5] for i in range(events)],
            "value": [float(i * 37 % 160) for i in range(events)], "props": "{}",
        }
        sites = {
            "s_suppkey": range(1, suppliers + 1), "s_name": [f"S{i}" for i in range(suppliers)],
            "s_nationkey": [i % 25 for i in range(suppliers)], "s_acctbal": [float(i % 50 * 100 - 600) for i in range(suppliers)],
        }
        con = duckdb.connect()
        for name, frame in (("events", pd.DataFrame(rows)), ("supplier", pd.DataFrame(sites))):
            con.register("frame", frame.astype({c: "int32" for c in frame if c == "s_nationkey"}))
            columns = "* REPLACE (ts::TIMESTAMP AS ts)" if name == "events" else "*"
            con.execute(f"COPY (SELECT {columns} FROM frame) TO '{tmp_path}/{name}.parquet'")
            con.unregister("frame")
        return str(tmp_path)

    return write


def agrees(spark, name, folder):
    """A query's rows against its SQL on the same tables."""
    found = entry_point.queries()[name](spark, folder)
    con = duckdb.connect()
    for table in ("events", "supplier"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    want = con.execute(f"SELECT {', '.join(found.columns)} FROM ({entry_point.oracle_sql()[name]})").fetchall()
    assert want
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want))


def test_ids_of_a_list_that_is_too_long_for_the_inline_way(spark, tables):
    agrees(spark, "nearest_site_ids", tables(200, 2500))


def test_a_load_takes_as_many_batches_as_its_rows_were_enriched_in(spark, tables, monkeypatch):
    from gaugeworks.plans import registry
    from gaugeworks.streaming import committed_batches

    targets, fresh = [], registry.fresh_path
    monkeypatch.setattr(registry, "fresh_path", lambda s, label: targets.append(fresh(s, label)) or targets[-1])
    agrees(spark, "stream_load", tables(400, 30))
    target = next(p for p in targets if "/clean-" in p)
    assert committed_batches(spark, target).count() == registry._BATCHES


def test_new_keys_are_kept_by_the_state_store(spark, tmp_path):
    """Without a time to live no Python runs per key; with one a key is new again after it."""
    from gaugeworks.streaming.keyed import keyed_settings, new_keys

    settings = keyed_settings()
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        for ttl, want in ((None, [1, 2, 3]), (3_600_000, [1, 2, 3]), (1, [1, 1, 2, 2, 3])):
            at = f"{tmp_path}/{ttl}"
            for part in ((1, 1, 2), (2, 3), (1,)):
                spark.createDataFrame([(n,) for n in part], "k long").write.mode("append").parquet(f"{at}/in")
                stream = spark.readStream.schema("k long").parquet(f"{at}/in")
                writer = new_keys(stream, "k", ttl).writeStream.format("parquet").option("path", f"{at}/out")
                query = writer.option("checkpointLocation", f"{at}/cp").trigger(once=True).start()
                query.awaitTermination()
                name = query.lastProgress["stateOperators"][0]["operatorName"]
                assert ttl or name == "dedupe"
            found = sorted(r.k for r in spark.read.parquet(f"{at}/out").collect())
            assert found == want
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value else spark.conf.unset(name)


def test_differences_of_many_rows_are_dealt_over_more_tasks(spark, monkeypatch):
    from gaugeworks.operators import difference

    monkeypatch.setattr(difference, "ROWS_PER_TASK", 50)
    rows = [(i % 7 if i < 600 else i, i) for i in range(1000)]  # seven keys have most of the rows
    one = spark.createDataFrame(rows, "k long, v long")
    two = one.filter("v % 11 > 0").withColumn("v", one.v + 0)
    found = difference.stage_difference(one, two, ["k"])
    want = {}
    for k, v in rows:
        b, a = want.get(k, (0, 0))
        want[k] = b + 1, a + (v % 11 > 0)
    assert sorted(map(tuple, found.collect())) == sorted(
        (k, "fewer" if a else "lost", b, a) for k, (b, a) in want.items() if a != b
    )
    plan = found._jdf.queryExecution().toString()
    assert "REPARTITION_BY_NUM" in plan


def test_a_stage_is_computed_once(spark):
    from gaugeworks.operators.difference import stage_differences

    seen = spark.sparkContext.accumulator(0)
    rows = spark.sparkContext.parallelize(range(10), 1).map(lambda i: (seen.add(1), (i, i))[1])
    one = spark.createDataFrame(rows, "k long, v long")
    got = stage_differences([("a", one), ("b", spark.range(8).selectExpr("id AS k", "id AS v"))], ["k"])
    assert sorted(r.k for r in got.collect()) == [8, 9] and seen.value == 10


def test_long_answers_are_not_broadcast(spark, monkeypatch):
    from gaugeworks.operators import nearest

    monkeypatch.setattr(nearest, "ANSWER_BYTES", 0)
    sites = spark.range(50).selectExpr("id AS gid", "id * 0.5 AS latitude", "id * 0.25 AS longitude")
    events = spark.range(300).selectExpr("id AS event_id", "id % 25 + 0D AS latitude", "id % 12 + 0D AS longitude")
    found = nearest.nearest_site(events, sites, strategy="packed")
    joins = [x for x in found._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join LeftOuter" in x]
    assert joins and "strategy=broadcast" not in joins[0]
    listed = nearest.nearest_site(events, sites, strategy="inline")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, listed.collect()))


def test_a_keyed_side_above_the_limit_is_not_broadcast_by_its_file_size(spark, tmp_path):
    from gaugeworks.operators.lookup import lookup_join

    spark.range(1000).selectExpr("id AS k", "'x' AS v").write.parquet(f"{tmp_path}/keyed")
    keyed = spark.read.parquet(f"{tmp_path}/keyed")
    found = lookup_join(spark.range(50).selectExpr("id AS k"), keyed, ["k"], max_rows=10)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.filter("v = 'x'").count() == 50


def test_entries_above_the_limit_are_not_broadcast_by_their_file_size(spark, tmp_path):
    from gaugeworks.operators.nearest import _visit

    spark.range(100).selectExpr("id AS node", "id AS gid").write.parquet(f"{tmp_path}/entries")
    entries = spark.read.parquet(f"{tmp_path}/entries")
    found = _visit(spark.range(40).selectExpr("id AS __id", "id AS node"), entries, 100, 10, 4)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 40
