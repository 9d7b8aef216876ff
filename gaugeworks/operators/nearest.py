"""Nearest site of every event by planar distance in degrees; ties go to the lowest gid.

Three ways to the same result:

* ``inline``: a site list of proven small size goes to every task. Each event is
  answered in its own row, so the events are neither joined nor shuffled for it.
* ``tree``: so does a list of up to ``TREE_SITES``, packed into a tree of boxes
  that each task walks with array arithmetic.
* ``packed``: sites are sorted along a space-filling curve and packed into runs of
  16, runs of runs and so on. Distinct event positions walk down that tree one
  level per join, keeping only boxes that can still hold the nearest site. A node
  never has more than 16 entries, however unevenly the sites are spread, so
  no group of sites meets a group of events as a whole.

The square of the distance decides. Rounding is monotone, so a box bound computed
in floating point is never wrong about the points inside the box.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.functions.columns import is_finite
from gaugeworks.operators.lookup import (
    BROADCAST_BYTES,
    BROADCAST_ROWS,
    lookup_join,
    measured_size,
)
from gaugeworks.session import materialise

FAN_BITS = 4  # of a packed node
INLINE_SITES = 2048
TREE_SITES = 250_000
BATCH_CELLS = 1_000_000  # distances computed at once by a task
BROADCAST_NODES = 250_000
ANSWER_BYTES = 16 * 1024 * 1024  # of answers by position; a stream sends them anew in each batch
NODE_SALTS = 16
_ROW_BITS = 33  # row part of monotonically_increasing_id

_POSITION = ["__lat", "__lon"]


def _square_distance(lat: Column, lon: Column) -> Column:
    d_lat, d_lon = lat - F.col("lat"), lon - F.col("lon")
    return d_lat * d_lat + d_lon * d_lon


def _square_to_box(lat: Column, lon: Column) -> Column:
    """Squared distance from a position to the box in the columns of ``_boxes``."""
    d_lat = F.greatest(F.col("lat_lo") - lat, lat - F.col("lat_hi"), F.lit(0.0))
    d_lon = F.greatest(F.col("lon_lo") - lon, lon - F.col("lon_hi"), F.lit(0.0))
    return d_lat * d_lat + d_lon * d_lon


def _spread_bits(c: Column) -> Column:
    """Put a zero between the low 31 bits of an integer."""
    for shift, mask in (
        (16, 0x0000FFFF0000FFFF),
        (8, 0x00FF00FF00FF00FF),
        (4, 0x0F0F0F0F0F0F0F0F),
        (2, 0x3333333333333333),
        (1, 0x5555555555555555),
    ):
        c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask))
    return c


def _curve(lat: str, lon: str) -> Column:
    """Z-order key. Only locality depends on it, so positions off the globe are clamped."""

    def scaled(c: str, span: float) -> Column:
        unit = F.least(F.greatest((F.col(c) + span / 2) / span, F.lit(0.0)), F.lit(1.0))
        return (unit * float(2**31 - 1)).cast("bigint")

    return _spread_bits(scaled(lat, 180.0)).bitwiseOR(
        F.shiftleft(_spread_bits(scaled(lon, 360.0)), 1)
    )


def _site_points(sites: DataFrame, gid: str, lat: str, lon: str) -> DataFrame:
    """Lowest gid of every distinct, usable site position."""
    return (
        sites.filter(is_finite(lat) & is_finite(lon) & F.col(gid).isNotNull())
        .groupBy(F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon"))
        .agg(F.min(gid).alias("gid"))
    )


def _boxes(points: DataFrame, shift: int) -> DataFrame:
    """Bounds of each node and the site in the middle of its run."""
    in_run = F.col("rank").bitwiseAND(F.lit((1 << shift) - 1))
    from_middle = in_run.bitwiseXOR(F.lit(1 << (shift - 1)))  # no two sites agree
    return points.groupBy(F.shiftright("rank", shift).alias("id")).agg(
        F.min("lat").alias("lat_lo"),
        F.max("lat").alias("lat_hi"),
        F.min("lon").alias("lon_lo"),
        F.max("lon").alias("lon_hi"),
        F.min_by("lat", from_middle).alias("lat"),
        F.min_by("lon", from_middle).alias("lon"),
    )


class _Listed:
    """A short list, by gid: every distance is computed."""

    def __init__(self, lat: np.ndarray, lon: np.ndarray) -> None:
        self.lat, self.lon = lat, lon

    def find(self, lats: np.ndarray, lons: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the nearest site, squared distance) per position."""
        best, near = np.empty(len(lats), int), np.empty(len(lats))
        step = max(1, BATCH_CELLS // len(self.lat))
        for start in range(0, len(lats), step):
            some = slice(start, start + step)
            d_lat = lats[some, None] - self.lat
            d_lon = lons[some, None] - self.lon
            squares = d_lat * d_lat + d_lon * d_lon
            best[some] = squares.argmin(axis=1)  # the first minimum is the lowest gid
            near[some] = squares.min(axis=1)
        return best, near


class _Tree:
    """Boxes in the order of a curve, packed by ``1 << FAN_BITS`` level by level.

    A box is (lat_lo, lat_hi, lon_lo, lon_hi) with a site of its own in (lat, lon). ``rank``
    settles ties between boxes that are sites.
    """

    def __init__(self, levels: list[list[np.ndarray]], rank: np.ndarray) -> None:
        self.levels, self.rank = levels, rank

    @staticmethod
    def pack(boxes: list[np.ndarray]) -> list[list[np.ndarray]]:
        """The levels of a tree over ``boxes``, from them to the top."""
        fan, levels = 1 << FAN_BITS, [boxes]
        while len(boxes[0]) > fan:
            first = np.arange(0, len(boxes[0]), fan)
            middle = np.minimum(first + fan // 2, len(boxes[0]) - 1)
            folds = (np.minimum, np.maximum, np.minimum, np.maximum)
            boxes = [f.reduceat(x, first) for f, x in zip(folds, boxes)] + [x[middle] for x in boxes[4:]]
            levels.append(boxes)
        return levels

    def walk(self, lats: np.ndarray, lons: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, box) that may hold the nearest site, and the bound of every position."""
        fan, top = 1 << FAN_BITS, len(self.levels[-1][0])
        np.seterr(over="ignore")  # far off the globe every distance may be infinite
        bound = np.full(len(lats), np.inf)
        of, node = np.repeat(np.arange(len(lats)), top), np.tile(np.arange(top), len(lats))
        for depth in range(len(self.levels) - 1, -1, -1):
            lat_lo, lat_hi, lon_lo, lon_hi, lat, lon = (x[node] for x in self.levels[depth])
            at_lat, at_lon = lats[of], lons[of]
            d_lat = np.maximum(np.maximum(lat_lo - at_lat, at_lat - lat_hi), 0.0)
            d_lon = np.maximum(np.maximum(lon_lo - at_lon, at_lon - lon_hi), 0.0)
            near = d_lat * d_lat + d_lon * d_lon
            # The box's own site is a candidate, so its distance is a bound. Every position has boxes left.
            d_lat, d_lon = at_lat - lat, at_lon - lon
            firsts = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            bound = np.minimum(bound, np.minimum.reduceat(d_lat * d_lat + d_lon * d_lon, firsts))
            left = near <= bound[of]
            of, node = of[left], node[left]
            if depth:
                if len(of) * fan > 4 * BATCH_CELLS and len(lats) > 1:  # many boxes at one distance
                    half = len(lats) // 2
                    parts = (self.walk(lats[:half], lons[:half]), self.walk(lats[half:], lons[half:]))
                    parts[1][0][:] += half
                    return tuple(np.concatenate(x) for x in zip(*parts))
                node = (node[:, None] * fan + np.arange(fan)).ravel()
                of = np.repeat(of, fan)
                real = node < len(self.levels[depth - 1][0])
                of, node = of[real], node[real]
        return of, node, bound

    def find(self, lats: np.ndarray, lons: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the nearest site, squared distance) per position, where boxes are sites."""
        best, near = np.empty(len(lats), int), np.empty(len(lats))
        step = max(1, BATCH_CELLS >> (2 * FAN_BITS))
        for start in range(0, len(lats), step):
            some = slice(start, start + step)
            of, node, near[some] = self.walk(lats[some], lons[some])
            order = np.lexsort((self.rank[node], of))
            firsts = np.append(True, of[order][1:] != of[order][:-1])
            best[some] = node[order][firsts]
        return best, near


def _answered(events: DataFrame, ready: PreparedSites, lat: str, lon: str) -> DataFrame:
    """Answer each event in its row from a list that every task holds.

    Arrow batches and array arithmetic; the same as a built-in higher-order function
    takes several times as long, the more the longer the list. Each different position
    of a batch is measured once.
    """
    shared = ready.shared

    @F.pandas_udf(f"d2 double, gid {ready.kind}")
    def nearest(lats: pd.Series, lons: pd.Series) -> pd.DataFrame:
        way, arrays, gids = shared.value
        finder = {"list": _Listed, "tree": _Tree}[way](*arrays) if len(gids) > 1 else None
        lats, lons = lats.to_numpy(float, na_value=np.nan), lons.to_numpy(float, na_value=np.nan)
        best = np.full(len(lats), len(gids) - 1)
        d2 = np.full(len(lats), np.nan)
        usable = np.flatnonzero(np.isfinite(lats) & np.isfinite(lons)) if finder else []
        if len(usable):
            codes, places = pd.factorize(lats[usable] + 1j * lons[usable])
            found, near = finder.find(places.real, places.imag)
            best[usable], d2[usable] = found[codes], near[codes]
        return pd.DataFrame({"d2": d2, "gid": pd.Series(gids[best], dtype=object)})

    place = nearest(F.col(lat).cast("double"), F.col(lon).cast("double"))
    return events.withColumn("__best", place).select(
        *events.columns, F.sqrt("__best.d2").alias("distance"), F.col("__best.gid").alias("__gid")
    )


def _finder(points: DataFrame, most: int, short: int):
    """(way, its arrays, gids by place) for the tasks, or None if there are more than ``most``."""
    rows = points.select(_curve("lat", "lon").alias("z"), "lat", "lon", "gid").limit(most + 1).toArrow()
    if rows.num_rows > most:
        return None
    rows = rows.sort_by("gid")  # places in this order settle ties
    lat, lon = rows.column("lat").to_numpy() + 0.0, rows.column("lon").to_numpy() + 0.0
    # As objects: a float could not hold every 64-bit id. The last one stands for no site.
    gids = np.empty(rows.num_rows + 1, dtype=object)
    gids[:-1] = rows.column("gid").to_pylist()
    if rows.num_rows <= short or not rows.num_rows:
        return "list", (lat, lon), gids
    order = np.lexsort((lon, lat, rows.column("z").to_numpy()))
    gids[:-1] = gids[:-1][order]
    lat, lon = lat[order], lon[order]
    return "tree", (_Tree.pack([lat, lat, lon, lon, lat, lon]), order), gids


def _packed_points(points: DataFrame) -> DataFrame:
    """Sort sites along the curve, number them and keep the numbering as a table.

    The numbering must not change when an executor is lost, hence the table.
    Positions are distinct, so the range split can always divide a dense area.
    """
    ranked = (
        points.withColumn("z", _curve("lat", "lon"))
        .repartitionByRange("z", "lat", "lon")
        .sortWithinPartitions("z", "lat", "lon")
        .select(F.monotonically_increasing_id().alias("rank"), "lat", "lon", "gid")
    )
    return materialise(ranked, "site-points")


def _levels(points: DataFrame) -> list[tuple[int, int]]:
    """(right shift of the rank that names a node, most nodes) per level, leaves first."""
    row_mask = (1 << _ROW_BITS) - 1
    count, top_row, top_part = points.agg(
        F.count("*"),
        F.max(F.col("rank").bitwiseAND(F.lit(row_mask))),
        F.max(F.shiftright("rank", _ROW_BITS)),
    ).first()
    shifts = [FAN_BITS]
    if count:
        while top_row >> shifts[-1]:
            shifts.append(min(shifts[-1] + FAN_BITS, _ROW_BITS))
    if top_part:
        shifts.append(_ROW_BITS + FAN_BITS)
        while top_part >> (shifts[-1] - _ROW_BITS):
            shifts.append(shifts[-1] + FAN_BITS)
    # Full nodes plus one short node per partition.
    return [(shift, (count >> min(shift, 62)) + (top_part or 0) + 1) for shift in shifts]


def _visit(
    frontier: DataFrame, children: DataFrame, rows: int, most: int, salts: int
) -> DataFrame:
    """One row per position and entry of a frontier node."""
    if rows <= most:
        return frontier.join(F.broadcast(children), "node")
    # Many positions may share one node. Their numbers are distinct, so a hash spreads them.
    salt = F.pmod(F.xxhash64("__id"), F.lit(salts)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    # By the size of their files Spark would broadcast all copies of all entries.
    return frontier.withColumn("__salt", salt).join(
        children.withColumn("__salt", copies).hint("merge"), ["node", "__salt"]
    )


def _upper_levels(positions: DataFrame, boxes: DataFrame) -> DataFrame:
    """(position, bound, node) for the boxes of a level that may hold the nearest site.

    ``boxes`` are few enough for every task: the levels above them are walked in one step, in
    the position's own task.
    """
    rows = boxes.orderBy("id").toArrow()
    names = ("lat_lo", "lat_hi", "lon_lo", "lon_hi", "lat", "lon")
    levels = _Tree.pack([rows.column(n).to_numpy() for n in names])
    ids = rows.column("id").to_numpy()
    shared = positions.sparkSession.sparkContext.broadcast((levels, ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, ids = shared.value
        tree, step = _Tree(levels, ids), max(1, BATCH_CELLS >> (2 * FAN_BITS))
        for batch in batches:
            number, lat, lon = (batch.column(i).to_numpy() for i in range(3))
            for start in range(0, len(number) if len(ids) else 0, step):
                some = slice(start, start + step)
                of, node, bound = tree.walk(lat[some], lon[some])
                columns = (number[some][of], lat[some][of], lon[some][of], bound[of], ids[node])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema.names)

    schema = positions.sparkSession.createDataFrame(
        [], "__id long, __lat double, __lon double, __bound double, node long"
    ).schema
    return positions.select("__id", *_POSITION).mapInArrow(run, schema)


def _packed_answers(
    positions: DataFrame, points: DataFrame, broadcast_nodes: int, salts: int
) -> DataFrame:
    """(position) -> (d2, gid) by walking down the packed levels.

    Positions are numbered, in a table for the same reason as the sites. The levels that every
    task can hold are walked in the position's task; below them positions are partitioned by
    number once, windows and aggregates reuse that, and their sort is on one integer.
    """
    at_lat, at_lon = F.col("__lat"), F.col("__lon")
    d2 = _square_distance(at_lat, at_lon)
    levels = _levels(points)
    numbered = positions.select(F.monotonically_increasing_id().alias("__id"), *_POSITION)
    numbered = materialise(numbered, "positions").repartition("__id")
    held = [i for i, (_, count) in enumerate(levels) if count <= broadcast_nodes]
    if held:
        frontier = _upper_levels(numbered, _boxes(points, levels[held[0]][0]))
        levels = levels[: held[0] + 1]
    else:
        frontier = numbered.withColumn("__bound", F.lit(float("inf"))).withColumn(
            "node", F.explode(F.array(F.lit(0).cast("bigint")))
        )
    for (child, count), (parent, _) in reversed(list(zip(levels, levels[1:]))):
        boxes = _boxes(points, child).withColumn("node", F.shiftright("id", parent - child))
        # The middle site of any box is a candidate, so its distance is a bound.
        closest = F.min("__d2").over(Window.partitionBy("__id"))
        frontier = (
            _visit(frontier, boxes, count, broadcast_nodes, salts)
            .select(
                "__id",
                *_POSITION,
                "__bound",
                _square_to_box(at_lat, at_lon).alias("__near"),
                d2.alias("__d2"),
                "id",
            )
            .filter("__near <= __bound")
            .withColumn("__bound", F.least("__bound", closest))
            .filter("__near <= __bound")
            .select("__id", *_POSITION, "__bound", F.col("id").alias("node"))
        )
    leaf, count = levels[0]
    sites = points.select(F.shiftright("rank", leaf).alias("node"), "lat", "lon", "gid")
    return (
        _visit(frontier, sites, count << FAN_BITS, broadcast_nodes, salts)
        .select("__id", *_POSITION, "__bound", d2.alias("d2"), "gid")
        .filter("d2 <= __bound")
        .groupBy("__id")
        .agg(F.min(F.struct("d2", F.col("gid").alias("__gid"), *_POSITION)).alias("__best"))
        .select("__best.*")
    )


@dataclass(frozen=True)
class PreparedSites:
    """A site list made ready once, for any number of event tables or batches.

    ``shared`` holds a list that every task takes whole, else ``points`` is the table of
    the packed tree. ``chosen`` has the columns to take, by gid; ``size`` its rows and bytes.
    """

    take: dict[str, str]
    kind: str
    chosen: DataFrame
    size: tuple[int, int]
    shared: Broadcast | None
    points: DataFrame | None


def prepare_sites(
    sites: DataFrame,
    *,
    gid: str = "gid",
    site_lat: str = "latitude",
    site_lon: str = "longitude",
    take: dict[str, str] | None = None,
    strategy: str = "auto",
    inline_sites: int = INLINE_SITES,
    tree_sites: int = TREE_SITES,
) -> PreparedSites:
    """Read the sites, choose the way by their number, and pack a long list."""
    if strategy not in ("auto", "inline", "tree", "packed"):
        raise ValueError(f"unknown strategy {strategy!r}")
    take = take or {"sensor_gid": gid}
    points = _site_points(sites, gid, site_lat, site_lon)
    kind = points.schema["gid"].dataType.simpleString()
    chosen = sites.select(
        F.col(gid).alias("__gid"),
        *(F.col(src).alias(f"__take_{out}") for out, src in take.items()),
    )
    size = measured_size(chosen)
    if strategy == "packed":
        return PreparedSites(take, kind, chosen, size, None, _packed_points(points))
    # One site more than may be listed tells whether all of them may.
    most = inline_sites if strategy == "inline" else max(tree_sites, inline_sites)
    found = _finder(points, most, 0 if strategy == "tree" else inline_sites)
    if found is None and strategy != "auto":
        raise ValueError(f"more than {most} sites for the {strategy} strategy")
    if found is None:
        return PreparedSites(take, kind, chosen, size, None, _packed_points(points))
    shared = sites.sparkSession.sparkContext.broadcast(found)
    return PreparedSites(take, kind, chosen, size, shared, None)


def nearest_site(
    events: DataFrame,
    sites: DataFrame | PreparedSites,
    *,
    lat: str = "latitude",
    lon: str = "longitude",
    broadcast_nodes: int = BROADCAST_NODES,
    broadcast_rows: int = BROADCAST_ROWS,
    node_salts: int = NODE_SALTS,
    **prepare: object,
) -> DataFrame:
    """Events with ``distance`` and the columns ``take`` (output -> site column).

    Site values replace event columns of the same name. Sites without a usable
    position are never chosen. Events without one keep their row, with NULLs, so
    that the caller can set them aside. ``gid`` must be unique among the sites.
    ``sites`` is a table, made ready with the options of ``prepare_sites``, or the
    result of that function.
    """
    if isinstance(sites, DataFrame):
        sites = prepare_sites(sites, **prepare)
    elif prepare:
        raise TypeError(f"sites are prepared already: {', '.join(prepare)}")
    take = sites.take
    events = events.drop(*(c for c in take if c in events.columns))
    taken = [F.col(f"__take_{out}").alias(out) for out in take]
    rows, size = sites.size
    small = rows <= broadcast_rows and size <= BROADCAST_BYTES

    def with_site(answers: DataFrame, how: str) -> DataFrame:
        if small:
            return answers.join(F.broadcast(sites.chosen), "__gid", how)
        return lookup_join(answers, sites.chosen, ["__gid"], how, max_rows=broadcast_rows)

    if sites.shared is not None:
        answered = _answered(events, sites, lat, lon)
        return with_site(answered, "left").select(*events.columns, "distance", *taken)
    usable = is_finite(lat) & is_finite(lon)
    located = events.withColumns(
        {
            "__lat": F.when(usable, F.col(lat).cast("double")),
            "__lon": F.when(usable, F.col(lon).cast("double")),
        }
    )
    positions = located.select(*_POSITION).dropna().distinct()
    answers = materialise(
        _packed_answers(positions, sites.points, broadcast_nodes, node_salts), "nearest"
    )
    answers = with_site(answers, "inner").select(*_POSITION, F.sqrt("d2").alias("distance"), *taken)
    joined = lookup_join(
        located, answers, _POSITION, "left", max_rows=broadcast_rows, max_bytes=ANSWER_BYTES
    )
    return joined.select(*events.columns, "distance", *take)
