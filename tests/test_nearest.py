import math

import numpy as np
import pandas as pd
import pytest

from gaugeworks.operators.nearest import nearest_site, prepare_sites
from gaugeworks.session import scratch, shared_dir

TAKE = {"sensor_gid": "gid", "sensor_ident": "ident"}
WAYS = {
    "inline": {"strategy": "inline"},
    "tree": {"strategy": "tree"},
    "packed": {"strategy": "packed"},
    "shuffled": {"strategy": "packed", "broadcast_nodes": 0, "broadcast_rows": 0},
}


def frame(spark, lat, lon, **more):
    return spark.createDataFrame(pd.DataFrame({"latitude": lat, "longitude": lon, **more}))


@pytest.fixture(scope="module")
def city(spark):
    """Half of the sites and events in one spot of a few metres, half all over the globe."""
    rng = np.random.default_rng(7)
    n, m = 700, 900

    def places(count, spread):
        half = count // 2
        lat = np.concatenate([rng.uniform(-95, 95, half), 44.8 + rng.normal(0, spread, count - half)])
        lon = np.concatenate([rng.uniform(-190, 190, half), -0.57 + rng.normal(0, spread, count - half)])
        return lat, lon

    s_lat, s_lon = places(n, 1e-4)
    e_lat, e_lon = places(m, 2e-4)
    sites = frame(spark, s_lat, s_lon, gid=np.arange(n), ident=[f"P{i}" for i in range(n)])
    events = frame(spark, e_lat, e_lon, event_id=np.arange(m))
    d2 = (e_lat[:, None] - s_lat) ** 2 + (e_lon[:, None] - s_lon) ** 2
    return events, sites, d2


@pytest.mark.parametrize("way", WAYS)
def test_agrees_with_brute_force(city, way):
    events, sites, d2 = city
    found = nearest_site(events, sites, take=TAKE, **WAYS[way]).toPandas().sort_values("event_id")
    assert (found.sensor_gid.to_numpy() == d2.argmin(axis=1)).all()
    assert np.array_equal(found.distance.to_numpy(), np.sqrt(d2.min(axis=1)))
    assert (found.sensor_ident == "P" + found.sensor_gid.astype(str)).all()


@pytest.mark.parametrize("way", WAYS)
def test_hot_position_keeps_every_row(spark, city, way):
    _, sites, _ = city
    events = frame(spark, [44.8] * 500 + [10.0] * 5, [-0.57] * 500 + [20.0] * 5, event_id=range(505))
    found = nearest_site(events, sites, take=TAKE, **WAYS[way])
    assert found.count() == 505
    assert found.select("event_id").distinct().count() == 505
    assert found.filter("latitude = 44.8").select("sensor_gid").distinct().count() == 1


@pytest.mark.parametrize("way", WAYS)
def test_golden_pair(spark, way):
    sites = frame(
        spark, [44.8362039, 44.8361999], [-0.578552, -0.5786028], gid=[2616, 2615], ident=["P52.2", "P52.1"]
    )
    row = nearest_site(frame(spark, [44.8378], [-0.5792]), sites, take=TAKE, **WAYS[way]).first()
    assert row.sensor_gid == 2615
    assert math.isclose(row.distance, 0.0017079133, abs_tol=1e-10)


@pytest.mark.parametrize("way", WAYS)
def test_tie_goes_to_lowest_gid(spark, way):
    sites = frame(spark, [1.0, -1.0, 1.0], [0.0, 0.0, 0.0], gid=[9, 4, 7], ident=["a", "b", "c"])
    row = nearest_site(frame(spark, [0.0], [0.0]), sites, take=TAKE, **WAYS[way]).first()
    assert (row.sensor_gid, row.distance) == (4, 1.0)


@pytest.mark.parametrize("way", WAYS)
def test_unusable_positions(spark, way):
    sites = spark.createDataFrame(
        [(1, "a", None, 0.0), (2, "b", float("nan"), 0.0), (3, "c", 50.0, 50.0)],
        "gid int, ident string, latitude double, longitude double",
    )
    events = spark.createDataFrame(
        [(1, 0.0, 0.0), (2, None, 0.0), (3, 0.0, float("nan")), (4, float("inf"), 0.0)],
        "event_id int, latitude double, longitude double",
    )
    found = nearest_site(events, sites, take=TAKE, **WAYS[way])
    rows = {r.event_id: (r.sensor_gid, r.distance is None) for r in found.collect()}
    assert rows == {1: (3, False), 2: (None, True), 3: (None, True), 4: (None, True)}


@pytest.mark.parametrize("way", WAYS)
def test_negative_zero_is_zero(spark, way):
    sites = frame(spark, [1.0, 0.0], [0.0, -0.0], gid=[1, 2], ident=["a", "b"])
    events = frame(spark, [0.0, -0.0, -0.0], [-0.0, 0.0, -0.0], event_id=[1, 2, 3])
    found = nearest_site(events, sites, take=TAKE, **WAYS[way]).collect()
    assert [(r.sensor_gid, r.distance) for r in found] == [(2, 0.0)] * 3


@pytest.mark.parametrize("way", WAYS)
def test_no_site_at_all(spark, way):
    sites = spark.createDataFrame([], "gid int, ident string, latitude double, longitude double")
    rows = nearest_site(frame(spark, [0.0], [0.0]), sites, take=TAKE, **WAYS[way]).collect()
    assert [(r.sensor_gid, r.sensor_ident, r.distance) for r in rows] == [(None, None, None)]


def test_site_value_replaces_event_value(spark):
    sites = frame(spark, [0.0], [0.0], gid=[5], zone=[3])
    events = frame(spark, [1.0], [1.0], zone=[99])
    assert nearest_site(events, sites, take={"zone": "zone"}).first().zone == 3


def test_plans_stay_free_of_cross_joins(city, plan):
    events, sites, _ = city
    for options in WAYS.values():
        text = plan(nearest_site(events, sites, take=TAKE, **options))
        assert "CartesianProduct" not in text
        assert "NestedLoop" not in text


def test_inline_does_not_shuffle_events(city, plan):
    events, sites, _ = city
    text = plan(nearest_site(events, sites, take=TAKE, strategy="inline"))
    assert "Exchange hashpartitioning" not in text


def test_many_levels(spark, monkeypatch):
    """Ids that span partitions and several levels give the same answers."""
    from gaugeworks.operators import nearest

    monkeypatch.setattr(nearest, "FAN_BITS", 1)
    rng = np.random.default_rng(3)
    lat, lon = rng.uniform(-5, 5, 300), rng.uniform(-5, 5, 300)
    sites = frame(spark, lat, lon, gid=np.arange(300), ident=["x"] * 300)
    events = frame(spark, rng.uniform(-6, 6, 100), rng.uniform(-6, 6, 100), event_id=np.arange(100))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = nearest_site(events, sites, take=TAKE, strategy="packed").toPandas()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    d2 = (found.latitude.to_numpy()[:, None] - lat) ** 2 + (found.longitude.to_numpy()[:, None] - lon) ** 2
    assert (found.sensor_gid.to_numpy() == d2.argmin(axis=1)).all()


def test_long_lists_are_not_collected(city):
    events, sites, d2 = city
    with pytest.raises(ValueError, match="more than 10"):
        nearest_site(events, sites, strategy="inline", inline_sites=10)
    for most in (10, 1000):
        found = nearest_site(events, sites, inline_sites=10, tree_sites=most).toPandas().sort_values("event_id")
        assert (found.sensor_gid.to_numpy() == d2.argmin(axis=1)).all()
    assert (found.sensor_gid.to_numpy() == d2.argmin(axis=1)).all()
    with pytest.raises(ValueError, match="unknown"):
        nearest_site(events, sites, strategy="guess")


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("kind", ["bigint", "decimal(20,0)", "string"])
def test_ids_of_any_type_stay_exact(spark, way, kind):
    """Ids beyond a double's digits, with an unplaced event in the same batch."""
    rows = [(9007199254740992, 10.0, 0.0), (9007199254740993, 1.0, 0.0), (None, 1.0, 0.0)]
    sites = spark.createDataFrame(rows, "gid bigint, latitude double, longitude double")
    sites = sites.withColumn("gid", sites.gid.cast(kind))
    events = spark.createDataFrame(
        [(1, 1.0, 0.0), (2, None, 0.0), (3, 1.0, 0.0), (4, 9.0, 0.0)], "e int, latitude double, longitude double"
    ).coalesce(1)
    found = nearest_site(events, sites, take={"id": "gid"}, **WAYS[way]).collect()
    got = {r.e: None if r.id is None else str(r.id) for r in found}
    assert got == {1: "9007199254740993", 2: None, 3: "9007199254740993", 4: "9007199254740992"}


def test_prepared_sites_serve_many_batches(spark, city):
    events, sites, _ = city
    ready = prepare_sites(sites, take=TAKE, strategy="packed")
    want = nearest_site(events, sites, take=TAKE, strategy="packed").orderBy("event_id").collect()
    assert nearest_site(events, ready).orderBy("event_id").collect() == want
    with pytest.raises(TypeError):
        nearest_site(events, ready, take=TAKE)


def test_scratch_tables_are_removed(spark, city, tmp_path):
    import os

    events, sites, _ = city
    root = shared_dir(spark).removeprefix("file://") + "/gaugeworks"
    ready = prepare_sites(sites, take=TAKE, strategy="packed")
    before = set(os.listdir(root))
    with scratch(spark):
        nearest_site(events, ready).write.parquet(f"{tmp_path}/out")
    assert set(os.listdir(root)) == before


@pytest.mark.parametrize("cells", [64, 1_000_000])
def test_tree_with_crowds_and_far_places(spark, monkeypatch, cells):
    """Many sites at one distance from an event, positions off the globe, and a small frontier."""
    from gaugeworks.operators import nearest

    monkeypatch.setattr(nearest, "BATCH_CELLS", cells)
    angle = np.linspace(0, 2 * np.pi, 500, endpoint=False)
    lat = np.concatenate([np.round(np.cos(angle), 2), np.zeros(300), [1e200, -1e300]])
    lon = np.concatenate([np.round(np.sin(angle), 2), np.arange(300) * 3.0, [0.0, 1e250]])
    gid = np.random.default_rng(5).permutation(len(lat))
    sites = frame(spark, lat, lon, gid=gid, ident=["x"] * len(lat))
    at = np.array([[0.0, 0.0], [0.0, 898.0], [50.0, 1.5], [1e199, 5.0], [-1e299, 1e249], [0.5, 0.5]])
    events = frame(spark, at[:, 0], at[:, 1], event_id=np.arange(len(at)))
    found = nearest_site(events, sites, take=TAKE, strategy="tree").toPandas().sort_values("event_id")
    with np.errstate(over="ignore"):
        d2 = (at[:, :1] - lat) ** 2 + (at[:, 1:] - lon) ** 2
    want = [min(gid[row == row.min()]) for row in d2]
    assert found.sensor_gid.tolist() == want
