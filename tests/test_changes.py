"""Audits of changed days, differences of stages, cascades."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import quality as Q
from gaugeworks.operators.cascade import ForeignKey, cascade, dangling
from gaugeworks.operators.constraints import ConstraintError
from gaugeworks.operators.difference import (
    bucket_folds,
    differing_buckets,
    stage_difference,
    stage_differences,
)
from gaugeworks.operators.incremental import audit_days, read_days, stored_actions, stored_audit
from gaugeworks.session import remove_path

COLUMNS = (
    "event_id string, observed_at timestamp, collected_at timestamp, source string, temperature_c double,"
    " humidity_pct double, wind_speed_kmh double, precipitation_mm double, sensor_gid int, sensor_ident string,"
    " sensor_type string, zone int, sensor_latitude double, sensor_longitude double, sensor_label string,"
    " comptage_5m int, processed_at timestamp, day int"
)


@pytest.fixture
def site_list(spark):
    rows = [(g, f"P{g}", "T", g % 3, 44.5, -0.5, f"rue {g}") for g in range(5)]
    return spark.createDataFrame(
        rows, "gid int, ident string, type_code string, zone_code int, latitude double, longitude double, libelle string"
    )


def weather(spark, days, seed, n=40):
    """Rows of some days, with every kind of defect."""
    pick, at, rows = random.Random(seed), datetime(2024, 1, 1), []
    for day in days:
        for _ in range(n):
            gid = pick.randrange(6)
            key = pick.choice([f"e{pick.randrange(60)}", None] if pick.random() < 0.1 else [f"d{day}-{pick.randrange(900)}"])
            rows.append(
                (key, at, pick.choice((at, None)), pick.choice(("s", " s ", "", None)), pick.choice((5.0, 90.0, None, float("nan"))),
                 pick.choice((50.0, 101.0)), pick.choice((1.0, -1.0)), pick.choice((0.0, -2.0)), gid, pick.choice((f"P{gid}", "x")),
                 "T", gid % 3, 44.5, pick.choice((-0.5, -200.0)), f"rue {gid}", pick.choice((1, -1)), at, day)
            )
    return spark.createDataFrame(rows, COLUMNS)


def reports(spark, path, root, sites):
    table = spark.read.parquet(path)
    for got, want in (
        (stored_audit(spark, root), Q.audit(table, sites)),
        (stored_actions(spark, root), Q.repair_actions(table, sites)),
    ):
        assert list(map(tuple, got.collect())) == list(map(tuple, want.collect()))
    return table.count()


def test_audit_follows_changed_days(spark, site_list, tmp_path):
    path, root = f"{tmp_path}/t", f"{tmp_path}/a"

    def write(days, seed, mode="append"):
        weather(spark, days, seed).write.mode(mode).partitionBy("day").parquet(path)

    def run(sites=site_list):
        version = audit_days(spark, path, sites, root, "day")
        reports(spark, path, root, sites)
        return version.content["scanned"]

    write([1, 2, 3], 1)
    assert run() == ["day=1", "day=2", "day=3"]
    write([4], 2)
    assert run() == ["day=4"]
    write([2], 3)  # more rows of a known day
    assert run() == ["day=2"]
    number = audit_days(spark, path, site_list, root, "day").number
    assert audit_days(spark, path, site_list, root, "day").number == number  # nothing to do
    remove_path(spark, f"{path}/day=3")  # a day goes, another is replaced
    remove_path(spark, f"{path}/day=1")
    write([1], 4)
    assert run() == ["day=1"]
    remove_path(spark, f"{path}/day=4")
    assert run() == []
    assert run(site_list.filter("gid <> 2")) == ["day=1", "day=2"]  # other sites: every day again
    weather(spark, [None], 5).write.mode("append").partitionBy("day").parquet(path)
    assert run(site_list.filter("gid <> 2")) == ["day=__HIVE_DEFAULT_PARTITION__"]


def test_only_named_days_are_read(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(60).selectExpr("id", "id % 6 AS day").write.partitionBy("day").parquet(path)
    rows = read_days(spark, path, ["day=2", "day=5"], "day")
    assert {n.split("/")[-2] for n in rows.inputFiles()} == {"day=2", "day=5"}
    assert {tuple(r) for r in rows.select("day", "__day").distinct().collect()} == {(2, "day=2"), (5, "day=5")}


# --- differences ----------------------------------------------------------------------


def plain_difference(before, after):
    out = []
    for key in {r[0] for r in before} | {r[0] for r in after}:
        b, a = sorted(map(str, (r for r in before if r[0] == key))), sorted(map(str, (r for r in after if r[0] == key)))
        if a == b:
            continue
        gone, new = set(b) - set(a), set(a) - set(b)
        kind = "lost" if not a else "added" if not b else "changed" if gone and new else None
        kind = kind or ("fewer" if len(a) < len(b) else "more" if len(a) > len(b) else "changed")
        out.append((key, kind, len(b), len(a)))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(4))
def test_difference_matches_a_plain_one(spark, seed):
    pick = random.Random(seed)
    make = lambda: [(pick.choice([None, *range(12)]), pick.choice(("a", "b", None)), pick.choice((1.0, None))) for _ in range(40)]
    before = make()
    after = [r for r in before if pick.random() < 0.8] + make()[:5]
    frames = [spark.createDataFrame(r, "k long, s string, v double").repartition(3) for r in (before, after)]
    got = stage_difference(*frames, ["k"], buckets=5)
    assert sorted(map(tuple, got.collect()), key=str) == plain_difference(before, after)


def test_folds_tell_multisets_apart(spark):
    rows = [(1, "a"), (1, "a"), (1, "b"), (2, None)]
    fold = lambda r: bucket_folds(spark.createDataFrame(r, "k long, s string").repartition(2), ["k"], buckets=1)
    assert differing_buckets(fold(rows), fold(rows[::-1])).isEmpty()
    assert not differing_buckets(fold(rows), fold([(1, "a"), (1, "b"), (1, "b"), (2, None)])).isEmpty()
    assert not differing_buckets(fold(rows), fold(rows[:3] + [(2, "")])).isEmpty()
    assert differing_buckets(fold(rows), fold([])).first().asDict() == {"bucket": 0, "rows_before": 4, "rows_after": 0}


def test_difference_of_stages(spark):
    one = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, s string")
    two = one.filter("k < 3").withColumn("more", F.lit(1))
    three = two.withColumn("s", F.lit("x")).unionByName(two.filter("k = 2").withColumn("s", F.lit("x")))
    got = stage_differences([("in", one), ("mid", two), ("out", three)], ["k"], ["s"])
    assert sorted(map(tuple, got.collect())) == [
        ("in", "mid", 3, "lost", 1, 0), ("mid", "out", 1, "changed", 1, 1), ("mid", "out", 2, "changed", 1, 2),
    ]
    with pytest.raises(ValueError):
        stage_differences([("in", one)], ["k"])


# --- cascades -------------------------------------------------------------------------


def make(spark, **tables):
    return {name: spark.createDataFrame(rows, ddl) for name, (ddl, rows) in tables.items()}


def ids(left, name):
    return sorted(r[0] for r in left[name].collect())


def test_cascade_through_a_cycle_and_nulls(spark):
    tables = make(
        spark,
        a=("id int, b int", [(1, 10), (2, 20), (3, None), (4, 30)]),
        b=("id int, a int", [(10, 2), (20, 1), (30, 3), (40, None)]),
        c=("id int, a int", [(100, 1), (101, 3), (102, None), (103, 4)]),
    )
    keys = {"a": "id", "b": "id", "c": "id"}
    edges = [ForeignKey("a", "b", "b", "id"), ForeignKey("b", "a", "a", "id"), ForeignKey("c", "a", "a", "id")]
    left = cascade(tables, keys, edges, {"a": spark.createDataFrame([(1,), (77,), (None,)], "id int")})
    assert (ids(left, "a"), ids(left, "b"), ids(left, "c")) == ([3, 4], [30, 40], [101, 102, 103])
    same = cascade(tables, keys, edges, {"a": spark.createDataFrame([(77,)], "id int")})
    assert {n: ids(same, n) for n in same} == {n: ids(tables, n) for n in tables}
    gone = dangling(left, keys, edges)
    assert all(df.isEmpty() for df in gone.values())


def test_cascade_along_a_chain_and_by_another_column(spark):
    chain = [(i, i - 1 if i else None, f"n{i}") for i in range(12)]
    tables = make(
        spark,
        t=("id long, parent int, name string", chain),
        u=("id int, of string", [(i, f"n{i}") for i in range(12)] + [(99, None)]),
    )
    edges = [ForeignKey("t", "parent", "t", "id"), ForeignKey("u", "of", "t", "name")]
    left = cascade(tables, {"t": "id", "u": "id"}, edges, {"t": spark.createDataFrame([(4,)], "id int")})
    assert ids(left, "t") == [0, 1, 2, 3] and ids(left, "u") == [0, 1, 2, 3, 99]
    assert left["t"].dtypes == tables["t"].dtypes
    with pytest.raises(RuntimeError, match="longer"):
        cascade(tables, {"t": "id", "u": "id"}, edges, {"t": spark.createDataFrame([(0,)], "id int")}, max_steps=3)


def test_set_null_and_restrict(spark):
    tables = make(spark, p=("id int", [(1,), (2,)]), c=("id int, p int", [(10, 1), (11, 2), (12, None)]))
    keys, removed = {"p": "id", "c": "id"}, {"p": spark.createDataFrame([(1,)], "id int")}
    left = cascade(tables, keys, [ForeignKey("c", "p", "p", "id", "set null")], removed)
    assert sorted(map(tuple, left["c"].collect())) == [(10, None), (11, 2), (12, None)]
    with pytest.raises(ConstraintError, match="c.p"):
        cascade(tables, keys, [ForeignKey("c", "p", "p", "id", "restrict")], removed)
    other = {"c": spark.createDataFrame([(10,)], "id int"), **removed}
    both = cascade(tables, keys, [ForeignKey("c", "p", "p", "id", "restrict")], other)
    assert ids(both, "c") == [11, 12] and ids(both, "p") == [2]
    with pytest.raises(ValueError):
        cascade(tables, keys, [ForeignKey("c", "p", "p", "id", "explode")], removed)


def test_dangling(spark):
    tables = make(spark, p=("id int", [(1,)]), c=("id int, p string", [(10, "1"), (11, "5"), (12, None), (13, "x")]))
    found = dangling(tables, {"p": "id", "c": "id"}, [ForeignKey("c", "p", "p", "id")])
    assert sorted(r[0] for r in found["c"].collect()) == [11]
