"""Density-based outlier operators on points.

Points are rows with a group key (species), an id and LAT/LON in degrees.
Neighbourhoods are within a geodesic ``eps`` (metres) in the same group.

The plan never forms all pairs of a group.  Points are put into 3-D cubes
(Earth-centred coordinates) whose edge is chosen so that any two points in
one cube are within ``eps``:

* a cube holding ``>= minpts`` points is *dense*: all its points are core,
  none is noise, and no pair is formed for them;
* points of sparse cubes meet in tiles of ``TILE`` cubes a side: a point is
  sent to the tiles that its search radius touches (three on average, at most
  eight), not to each of the 125 cubes that can hold neighbours; groups of few
  such points meet as a whole.  A sparse cube has fewer than ``minpts`` points
  and a tile a fixed number of cubes, so the pairs per point are bounded by
  ``minpts`` whatever the data volume;
* sparse points count the parts of dense cubes that lie wholly within ``eps``;
  one that has ``minpts`` by them is core.  The cube pyramid counts for the
  others, over the points of the parts that they touch.

Points of dense cubes are written once and, if the dense cubes are few enough to
be broadcast, never shuffled by cube or id.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from occuflow.functions.geo import SPHEROID_BAND, chord_for_arc, cube_key, ecef, within_eps
from occuflow.operators import knn
from occuflow.session import broadcast_if_small, cut_lineage, keyed_join, ship_package, spread, stage_scope

# Edge cubes of at most this many points are tested point by point.
EDGE_POINTS = 8
# No further round for this many pairs in all.
EDGE_PAIRS = 200_000
# Cubes along the edge of a tile: sparse points are joined by tile.
TILE = 8
# Sparse points of a group that meet without tiles.
GROUP_POINTS = 256
# Parts along the edge of a dense cube that are counted as a whole.
PARTS = 4


def _check(eps_m, minpts):
    if eps_m is None or not eps_m > 0:
        raise ValueError("eps (metres) must be a positive number")
    if minpts is None or int(minpts) != minpts or minpts < 1:
        raise ValueError("minpts must be a positive integer")


def _offsets(reach: int) -> list[tuple[int, int, int]]:
    r = range(-reach, reach + 1)
    return [(a, b, c) for a in r for b in r for c in r]


def with_cubes(points: DataFrame, side: float, lat: str = "LAT", lon: str = "LON") -> DataFrame:
    x, y, z = ecef(lat, lon)
    return (points.withColumn("_x", x).withColumn("_y", y).withColumn("_z", z)
                  .withColumn("_cx", cube_key(F.col("_x"), side))
                  .withColumn("_cy", cube_key(F.col("_y"), side))
                  .withColumn("_cz", cube_key(F.col("_z"), side)))


def neighbour_cubes(df: DataFrame, side: float, reach: int, search_chord: float) -> DataFrame:
    """Explode each point to the cubes within ``search_chord`` of it.

    Adds ``_ncx, _ncy, _ncz``.  The box-distance test runs on the exploded
    rows in codegen and prunes most of the (2*reach+1)^3 candidates.
    """
    offs = F.array(*[F.struct(F.lit(a).alias("dx"), F.lit(b).alias("dy"), F.lit(c).alias("dz"))
                     for a, b, c in _offsets(reach)])
    ex = df.withColumn("_o", F.explode(offs))

    def gap(coord: str, cube: str, d: str):
        lo = (F.col(cube) + F.col(f"_o.{d}")) * F.lit(side)
        hi = lo + F.lit(side)
        return F.greatest(lo - F.col(coord), F.col(coord) - hi, F.lit(0.0))

    g2 = (F.pow(gap("_x", "_cx", "dx"), 2) + F.pow(gap("_y", "_cy", "dy"), 2)
          + F.pow(gap("_z", "_cz", "dz"), 2))
    return (ex.where(g2 <= F.lit(search_chord * search_chord))
              .withColumn("_ncx", F.col("_cx") + F.col("_o.dx"))
              .withColumn("_ncy", F.col("_cy") + F.col("_o.dy"))
              .withColumn("_ncz", F.col("_cz") + F.col("_o.dz"))
              .drop("_o"))


def _geometry(eps_m: float, geomodel: str):
    chord = chord_for_arc(eps_m)
    if geomodel == "wgs84":
        inner = chord_for_arc(eps_m * (1 - SPHEROID_BAND))
        search = chord_for_arc(eps_m * (1 + SPHEROID_BAND))
    else:
        inner, search = chord, chord * (1 + 1e-9)
    side = inner / math.sqrt(3) * (1 - 1e-9)
    reach = max(1, math.ceil(search / side))
    return side, reach, search


def _cubed(points: DataFrame, side: float, lat: str, lon: str, outlive: bool = False) -> DataFrame:
    """The points with their cube, written once: the plans below read them several times."""
    return cut_lineage(points.withColumns({f"_c{v}": cube_key(c, side) for v, c in zip("xyz", ecef(lat, lon))}), outlive)


def _named(cubed: DataFrame, key: str, pid: str, lat: str, lon: str, weight: str | None) -> DataFrame:
    """Written points with ``_k, _id, _lat, _lon, _w`` and their Earth-centred coordinates, which are not written."""
    w = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    return _located(cubed.withColumns({"_k": F.col(key), "_id": F.col(pid), "_lat": F.col(lat), "_lon": F.col(lon), "_w": w}))


def _cubed_points(points: DataFrame, side: float, key: str, pid: str, lat: str, lon: str,
                  weight: str | None) -> DataFrame:
    return _named(_cubed(points, side, lat, lon), key, pid, lat, lon, weight)


def _located(points: DataFrame) -> DataFrame:
    """The points with their Earth-centred coordinates."""
    return points.withColumns(dict(zip(("_x", "_y", "_z"), ecef("_lat", "_lon"))))


def _partners(probe: DataFrame, target: DataFrame, tag: str, eps_m: float, geomodel: str,
              how: str = "inner") -> DataFrame:
    """Probe rows (with ``_ncx/_ncy/_ncz``) joined to target points of that cube
    within eps; returns ``_k, _id, _<tag>id, _<tag>w`` (or probe rows for semi)."""
    t = target.select(F.col("_k").alias("_tk"), F.col("_id").alias(f"_{tag}id"),
                      F.col("_w").alias(f"_{tag}w"),
                      F.col("_lat").alias("_tlat"), F.col("_lon").alias("_tlon"),
                      F.col("_cx").alias("_tcx"), F.col("_cy").alias("_tcy"),
                      F.col("_cz").alias("_tcz"))
    probe = spread(probe, "_k", "_ncx", "_ncy", "_ncz")
    t = spread(t, "_tk", "_tcx", "_tcy", "_tcz")
    cond = ((probe["_k"] == t["_tk"]) & (probe["_ncx"] == t["_tcx"])
            & (probe["_ncy"] == t["_tcy"]) & (probe["_ncz"] == t["_tcz"])
            & within_eps(probe["_lat"], probe["_lon"], t["_tlat"], t["_tlon"], eps_m, geomodel))
    if how == "left_semi":
        return probe.join(t, cond, "left_semi")
    return probe.join(t, cond).select("_k", "_id", f"_{tag}id", f"_{tag}w")


def _tiles(rows: DataFrame, low, high) -> DataFrame:
    """Each row once per tile ``_tx, _ty, _tz`` from ``low(axis)`` to ``high(axis)``."""
    for v in "xyz":
        rows = rows.withColumn(f"_t{v}", F.explode(F.sequence(low(v), high(v))))
    return rows


def _tile_of(cube) -> F.Column:
    return F.floor(cube / F.lit(float(TILE))).cast("long")


_TILES = ("_tx", "_ty", "_tz")


def _sparse_pairs(sparse: DataFrame, side: float, search: float, eps_m: float, geomodel: str) -> DataFrame:
    """(_k, _id, _w, _sid, _sw): the sparse points within eps of each sparse point, itself included.

    The points of a group of at most ``GROUP_POINTS`` meet as one; those of
    larger groups by tile.  Only coordinates are shuffled.
    """
    def tile(metres) -> F.Column:
        return F.floor(metres / F.lit(side * TILE)).cast("long")

    wide = F.lit(search + knn.SLACK_M)
    rows = sparse.select("_k", "_id", "_w", "_lat", "_lon")
    large = broadcast_if_small(rows.groupBy("_k").agg(F.count(F.lit(1)).alias("_m")).where(F.col("_m") > GROUP_POINTS).select("_k"))

    def met(probe: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
        a = _located(spread(probe, *keys))
        b = _located(spread(target, *keys)).select(
            *keys, F.col("_id").alias("_sid"), F.col("_w").alias("_sw"), F.col("_lat").alias("_tlat"), F.col("_lon").alias("_tlon"),
            *[F.col(f"_{v}").alias(f"_s{v}") for v in "xyz"])
        close = reduce(lambda c, d: c & d, [F.abs(F.col(f"_{v}") - F.col(f"_s{v}")) <= wide for v in "xyz"])
        return (a.join(b.hint("merge"), keys).where(close & within_eps("_lat", "_lon", "_tlat", "_tlon", eps_m, geomodel))
                 .select("_k", "_id", "_w", "_sid", "_sw"))

    few = rows.join(large, "_k", "left_anti")
    many = _located(rows.join(large, "_k", "left_semi"))
    probe = _tiles(many, lambda v: tile(F.col(f"_{v}") - wide), lambda v: tile(F.col(f"_{v}") + wide)).drop("_x", "_y", "_z")
    target = many.select(*rows.columns, *[_tile_of(cube_key(F.col(f"_{v}"), side)).alias(t) for v, t in zip("xyz", _TILES)])
    return met(few, few, ["_k"]).unionByName(met(probe, target, ["_k", *_TILES]))


def _near_each_other(sparse: DataFrame, dense: DataFrame, reach: int) -> DataFrame:
    """Pairs of a sparse point's cube and a dense cube (``_dcx, _dcy, _dcz``) in reach of it."""
    cubes = [f"_c{v}" for v in "xyz"]
    has_dense = broadcast_if_small(dense.select("_k").distinct())
    probe = _tiles(sparse.join(has_dense, "_k", "left_semi").select("_k", *cubes).distinct(),
                   lambda v: _tile_of(F.col(f"_c{v}") - reach), lambda v: _tile_of(F.col(f"_c{v}") + reach))
    target = dense.select("_k", *[F.col(c).alias(f"_d{c[1:]}") for c in cubes],
                          *[_tile_of(F.col(c)).alias(t) for c, t in zip(cubes, _TILES)])
    close = reduce(lambda a, b: a & b, [F.abs(F.col(c) - F.col(f"_d{c[1:]}")) <= reach for c in cubes])
    return cut_lineage(probe.join(target, ["_k", *_TILES]).where(close).select("_k", *cubes, *[f"_d{c[1:]}" for c in cubes]))


def _beside_dense(sparse: DataFrame, dense: DataFrame, dense_cubes: DataFrame, side: float, reach: int, eps_m: float,
                  minpts: int, geomodel: str) -> DataFrame:
    """(_k, _id, _w, _nd): how many (summed ``_w``) points of dense cubes lie within eps of sparse points that have any.

    Dense cubes beside a sparse point are cut into ``PARTS`` parts along an
    edge.  A part wholly within eps counts as a whole; a point with ``minpts``
    in such parts is core and counted no further.  Points that need it are
    counted exactly, in the parts that they touch only.
    """
    inner, outer = _chords(eps_m, geomodel)
    mine, theirs = [f"_c{v}" for v in "xyz"], [f"_dc{v}" for v in "xyz"]
    parts = [f"_p{v}" for v in "xyz"]
    pairs = _near_each_other(sparse, dense_cubes, reach)
    there = broadcast_if_small(pairs.select("_k", *[F.col(t).alias(c) for c, t in zip(mine, theirs)]).distinct())
    beside = dense.join(there, ["_k", *mine], "left_semi").select(
        "_k", "_id", "_w", "_lat", "_lon", "_x", "_y", "_z", *[F.col(c).alias(t) for c, t in zip(mine, theirs)],
        *[cube_key(F.col(f"_{v}"), side / PARTS).alias(p) for v, p in zip("xyz", parts)])
    boxes = cut_lineage(beside.groupBy("_k", *theirs, *parts).agg(
        F.sum("_w").alias("_n"), *[f(a).alias(f"{a}{i}") for a in ("_x", "_y", "_z") for i, f in ((0, F.min), (1, F.max))]))
    gap = F.lit(0.0)
    for v in "xyz":
        low = F.col(f"_dc{v}") * F.lit(side)
        gap = gap + F.pow(F.greatest(low - F.col(f"_{v}"), F.col(f"_{v}") - (low + F.lit(side)), F.lit(0.0)), 2)

    def touched(points: DataFrame) -> DataFrame:
        """The points (with their cube) once per part that their radius touches."""
        near = (_located(points.join(pairs, ["_k", *mine])).where(gap <= F.lit((outer + knn.SLACK_M) ** 2))
                .select("_k", "_id", "_w", "_lat", "_lon", *theirs))
        rows = _located(spread(near, "_k", *theirs)).join(spread(boxes, "_k", *theirs).hint("merge"), ["_k", *theirs])
        return rows.where(knn.box_distance(False) <= outer)

    probe = sparse.select("_k", "_id", "_w", "_lat", "_lon", *mine)
    whole = knn.box_distance(True) <= inner
    found = cut_lineage(touched(probe).groupBy("_k", "_id", "_w").agg(
        F.sum(F.when(whole, F.col("_n")).otherwise(0)).alias("_nd"), F.min(whole).alias("_settled")))
    open_ = ~F.col("_settled") & (F.col("_nd") < minpts)
    counted = found.where(~open_).select("_k", "_id", "_w", "_nd")
    rest = cut_lineage(probe.join(found.where(open_).select("_k", "_id"), ["_k", "_id"], "left_semi"))
    if rest.isEmpty():
        return counted
    cells = broadcast_if_small(touched(rest).select("_k", *theirs, *parts).distinct())
    exact = count_within(_located(rest), beside.join(cells, ["_k", *theirs, *parts], "left_semi"), eps_m, geomodel)
    return counted.unionByName(rest.select("_k", "_id", "_w").join(exact.withColumnRenamed("_nw", "_nd"), ["_k", "_id"]))


def _chords(eps_m: float, geomodel: str) -> tuple[float, float]:
    """Chords within which two points surely, and beyond which they never, lie within ``eps``."""
    band = SPHEROID_BAND if geomodel == "wgs84" else 0.0
    return (chord_for_arc(eps_m * (1 - band)) * (1 - 1e-9) - knn.SLACK_M,
            chord_for_arc(eps_m * (1 + band)) * (1 + 1e-9) + knn.SLACK_M)


def count_within(probe: DataFrame, target: DataFrame, eps_m: float, geomodel: str) -> DataFrame:
    """(_k, _id, _nw): summed ``_w`` of the target points within ``eps`` of each probe point.

    Works on the target's cube pyramid: cubes whose box lies wholly within
    ``eps`` of a point add their sum, cubes wholly outside go, and cubes on
    the edge are split; only the points of the last edge cubes (sum
    ``EDGE_POINTS`` or less) are tested one by one.  The work follows the edge
    of the neighbourhood, not its content.  Points without any are left out.
    """
    inner, outer = _chords(eps_m, geomodel)
    if geomodel == "wgs84":
        ship_package(probe.sparkSession)
    level = max(0, min(int(math.log(knn.top_side() / outer, 2 ** knn.STEP)), knn.LEVELS - 1))
    lv = knn.cube_levels(cut_lineage(target.select("_k", "_id", "_lat", "_lon", "_x", "_y", "_z", "_w")), level)
    boxes = knn.cube_boxes(lv, "_w")
    children = knn.cube_children(boxes)
    query = ["_k", "_id", "_lat", "_lon", "_x", "_y", "_z"]
    frontier = (knn.cubes_in_reach(probe.select(*query, F.lit(level).alias("_lv")), F.lit(outer))
                .select(*query, *knn.NODE[1:]).join(boxes, knn.NODE))
    whole, edge = [], []
    for _ in range(knn.LEVELS):
        touched = frontier.withColumn("_near", knn.box_distance(False)).where(F.col("_near") <= outer)
        state = (F.when(knn.box_distance(True) <= inner, F.lit("in"))
                  .when((F.col("_n") <= EDGE_POINTS) | (F.col("_lv") == knn.LEVELS - 1), F.lit("edge"))
                  .otherwise(F.lit("split")))
        step = cut_lineage(touched.select(*query, *knn.NODE[1:], "_n", state.alias("_state")))
        whole.append(step.where("_state = 'in'").select("_k", "_id", "_n"))
        edge.append(step.where("_state = 'edge'").select("_k", "_id", "_lat", "_lon", *knn.NODE[1:]))
        split = step.where("_state = 'split'")
        pairs = split.agg(F.sum("_n")).first()[0] or 0
        if pairs <= EDGE_PAIRS:  # few in all: test their points at once
            edge.append(split.select("_k", "_id", "_lat", "_lon", *knn.NODE[1:]))
            break
        frontier = knn.into_children(split, children, query)
    members = lv.select(*knn.NODE, F.col("_lat").alias("_tlat"), F.col("_lon").alias("_tlon"), "_w")
    tested = (reduce(DataFrame.unionByName, edge).join(members, knn.NODE)
              .where(within_eps("_lat", "_lon", "_tlat", "_tlon", eps_m, geomodel))
              .select("_k", "_id", F.col("_w").alias("_n")))
    return (reduce(DataFrame.unionByName, [*whole, tested])
            .groupBy("_k", "_id").agg(F.sum("_n").alias("_nw")))


def _core_state(cubed: DataFrame, names, side: float, reach: int, search: float, eps_m: float,
                minpts: int, geomodel: str, outlive: bool = False):
    """(dense cubes, points in them, points of sparse cubes, pairs of these, (_k, _id, _nd, _core) of those that have neighbours).

    Dense cubes (total weight >= minpts) are all core with no pair formed;
    sparse points count their neighbours' weights: other sparse points through
    the tile join, points of dense cubes as far as ``minpts``.
    """
    pts = names(cubed).where(_known())
    cubes = broadcast_if_small(pts.groupBy(*_CUBE).agg(F.sum("_w").alias("_cn")).where(F.col("_cn") >= minpts).select(*_CUBE),
                               outlive=outlive)
    dense = pts.join(cubes, _CUBE, "left_semi")
    sparse = names(cut_lineage(pts.join(cubes, _CUBE, "left_anti").select(*cubed.columns), outlive))
    # read for the counts and again for the rescued points; a point without neighbours is in no pair
    ss = cut_lineage(_sparse_pairs(sparse, side, search, eps_m, geomodel).where(F.col("_id") != F.col("_sid")))
    nd = _beside_dense(sparse, dense, cubes, side, reach, eps_m, minpts, geomodel)
    state = (ss.select("_k", "_id", "_w", F.col("_sw").alias("_n"), F.lit(0).cast("long").alias("_nd"))
               .unionByName(nd.select("_k", "_id", "_w", F.col("_nd").alias("_n"), "_nd"))
               .groupBy("_k", "_id").agg(F.max("_w").alias("_w"), F.sum("_n").alias("_n"), F.sum("_nd").alias("_nd")))
    return cubes, dense, sparse, ss, cut_lineage(state.select(
        "_k", "_id", "_nd", (F.col("_w") + F.col("_n") >= minpts).alias("_core")))


_CUBE = ["_k", "_cx", "_cy", "_cz"]


def _known() -> F.Column:
    """Points with a group, an id and a place; others take no part."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*_CUBE, "_id")])


def dbscan_noise(points: DataFrame, eps_m: float = 1_000_000.0, minpts: int = 3,
                 key: str = "Species", pid: str = "H3", lat: str = "LAT", lon: str = "LON",
                 geomodel: str = "sphere", weight: str | None = None) -> DataFrame:
    """DBSCAN outlier score (D1): 1.0 for noise, 0.0 otherwise.

    Noise = not core (fewer than ``minpts`` points within ``eps``, counting
    itself) and no core point within ``eps``.  No cluster labels are needed.
    ``weight`` (optional) is a multiplicity column, so duplicate records can
    be collapsed to one point first.  Returns ``points`` with an
    ``OutlierScore`` column; (key, pid) must be unique.
    """
    _check(eps_m, minpts)
    side, reach, search = _geometry(eps_m, geomodel)

    def names(df: DataFrame) -> DataFrame:
        # joins by number, not by name
        return _named(df, key, "_number", lat, lon, weight)

    with stage_scope(points.sparkSession):
        number = F.when(F.col(pid).isNotNull(), F.monotonically_increasing_id())
        cubed = _cubed(points.withColumn("_number", number), side, lat, lon, outlive=True)
        cubes, _, sparse, ss, state = _core_state(cubed, names, side, reach, search, eps_m, minpts, geomodel, outlive=True)
        beside_core = ss.join(state.where("_core").select("_k", F.col("_id").alias("_sid")), ["_k", "_sid"], "left_semi")
        safe = cut_lineage(state.where("_core OR _nd > 0").select("_id").unionByName(beside_core.select("_id")).distinct()
                           .withColumn("_safe", F.lit(0.0)), outlive=True)
    # only points of sparse cubes can be noise; the others are not shuffled
    pts, zero = names(cubed), F.lit(0.0).alias("OutlierScore")
    scored = sparse.join(safe, "_id", "left").select(*points.columns, F.coalesce("_safe", F.lit(1.0)).alias("OutlierScore"))
    return (scored.unionByName(pts.where(_known()).join(cubes, _CUBE, "left_semi").select(*points.columns, zero))
                  .unionByName(pts.where(~_known()).select(*points.columns, zero)))


def neighbour_counts(points: DataFrame, eps_m: float, key: str = "Species", pid: str = "H3",
                     lat: str = "LAT", lon: str = "LON", geomodel: str = "sphere",
                     include_self: bool = True) -> DataFrame:
    """Exact number of points within ``eps`` of each point, same group.

    See :func:`count_within`: whole cubes are counted, not their points.
    """
    _check(eps_m, 1)
    x, y, z = ecef("_lat", "_lon")
    pts = cut_lineage(points.select(F.col(key).alias("_k"), F.col(pid).alias("_id"),
                                    F.col(lat).alias("_lat"), F.col(lon).alias("_lon"))
                            .withColumn("_x", x).withColumn("_y", y).withColumn("_z", z)
                            .withColumn("_w", F.lit(1).cast("long")))
    n = (count_within(pts, pts, eps_m, geomodel)
         .select(F.col("_k").alias("_nk"), F.col("_id").alias("_nid"),
                 (F.col("_nw") - F.lit(0 if include_self else 1)).alias("n_neighbours")))
    out = points.join(n, (points[key] == n["_nk"]) & (points[pid] == n["_nid"]), "left")
    return out.drop("_nk", "_nid")


def db_outlier_score(points: DataFrame, d_m: float, key: str = "Species", pid: str = "H3",
                     lat: str = "LAT", lon: str = "LON", geomodel: str = "sphere") -> DataFrame:
    """DB-outlier score (D7, Knorr & Ng): share of the group's other points
    farther than ``d`` — 1 − (neighbours within d, excluding self) / (n − 1).
    """
    counted = neighbour_counts(points, d_m, key, pid, lat, lon, geomodel, include_self=False)
    sizes = points.groupBy(key).agg(F.count(F.lit(1)).alias("_gn"))
    return (counted.join(sizes, key)
                   .withColumn("OutlierScore",
                               F.when(F.col("_gn") > 1,
                                      F.lit(1.0) - F.col("n_neighbours") / (F.col("_gn") - 1))
                                .otherwise(F.lit(0.0)))
                   .drop("_gn", "n_neighbours"))



def _cube_node() -> F.Column:
    return F.concat_ws(":", F.col("_cx").cast("string"), F.col("_cy").cast("string"),
                       F.col("_cz").cast("string"))


def connected_components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """Min-label components of an undirected graph ``(_k, src, dst)``.

    Returns ``(_k, node, label)`` with ``label`` the smallest node of the
    component.  Each round takes the minimum over neighbours, then jumps to
    the label's label (pointer jumping), and is checkpointed; the loop stops
    when no label changes (one flag per round reaches the driver).
    """
    both = edges.unionByName(edges.select("_k", F.col("dst").alias("src"), F.col("src").alias("dst")))
    both = cut_lineage(both.distinct())
    labels = cut_lineage(both.select("_k", F.col("src").alias("node"))
                             .distinct().withColumn("label", F.col("node")))
    for _ in range(max_rounds):
        nb = (keyed_join(both, labels.select("_k", F.col("node").alias("dst"), F.col("label").alias("_nl")), ["_k", "dst"])
                  .groupBy("_k", F.col("src").alias("node")).agg(F.min("_nl").alias("_m")))
        step = (keyed_join(labels, nb, ["_k", "node"], "left")
                      .select("_k", "node", F.col("label").alias("_old"), F.least("label", F.coalesce("_m", "label")).alias("label")))
        jump = cut_lineage(
            keyed_join(step, step.select("_k", F.col("node").alias("label"), F.col("label").alias("_ll")), ["_k", "label"], "left")
            .select("_k", "node", F.least("label", F.coalesce("_ll", "label")).alias("label"), "_old"))
        labels = jump.drop("_old")
        if jump.where("label <> _old").isEmpty():
            return labels
    raise RuntimeError(f"connected components did not converge in {max_rounds} rounds")


def dbscan_labels(points: DataFrame, eps_m: float, minpts: int, key: str = "Species",
                  pid: str = "H3", lat: str = "LAT", lon: str = "LON",
                  geomodel: str = "sphere", weight: str | None = None) -> DataFrame:
    """DBSCAN cluster labels (D2): ``cluster`` (-1 = noise), ``cluster_rep``, ``is_core``.

    All points of one cube are within eps of each other, so every cube with
    a core point is one graph node; two nodes are joined when some core pair
    across them is within eps (a semi-join: existence, no pair list).  The
    components of that cube graph are the clusters.  ``cluster_rep`` is the
    smallest core point id of the cluster (NULL for noise); a border point
    takes the smallest one among its core neighbours' clusters.  ``cluster``
    is a non-negative number derived from it (-1 for noise).
    """
    _check(eps_m, minpts)
    side, reach, search = _geometry(eps_m, geomodel)
    cubed = _cubed(points, side, lat, lon)
    names = lambda df: _named(df, key, pid, lat, lon, weight)
    pts = names(cubed)
    _, dense, sparse, _, state = _core_state(cubed, names, side, reach, search, eps_m, minpts, geomodel)
    held = ["_id", "_w", "_lat", "_lon", "_x", "_y", "_z", *_CUBE]
    core = cut_lineage(
        dense.select(*held).unionByName(sparse.join(state.where("_core").select("_k", "_id"), ["_k", "_id"], "left_semi").select(*held))
             .withColumn("_node", _cube_node()))
    # Cube-graph edges.  The boxes of two cubes' core points decide most pairs:
    # wholly within eps is an edge, wholly outside none.  Only for the others,
    # and only where these edges leave two components, do the core points of
    # one cube look for one of the other's.
    boxes = cut_lineage(core.groupBy("_k", "_node", "_cx", "_cy", "_cz").agg(
        *[f(c).alias(f"{c}{i}") for c in ("_x", "_y", "_z") for i, f in ((0, F.min), (1, F.max))],
        F.array(*[f(F.struct("_lat", "_lon"), F.col(c)) for c in ("_x", "_y", "_z") for f in (F.min_by, F.max_by)]).alias("_ends")))
    near2, far2 = F.lit(0.0), F.lit(0.0)
    for c in ("_x", "_y", "_z"):
        gap = F.greatest(F.col(f"t{c}0") - F.col(f"{c}1"), F.col(f"{c}0") - F.col(f"t{c}1"), F.lit(0.0))
        span = F.greatest(F.col(f"t{c}1") - F.col(f"{c}0"), F.col(f"{c}1") - F.col(f"t{c}0"))
        near2, far2 = near2 + gap * gap, far2 + span * span
    inner = side * math.sqrt(3)
    around = F.array(*[F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy"), F.lit(l).alias("dz"))
                       for i, j, l in _offsets(reach) if (i, j, l) > (0, 0, 0)])
    there = boxes.select("_k", F.col("_node").alias("dst"), F.col("_ends").alias("_dends"), *[F.col(f"_c{v}").alias(f"_nc{v}") for v in "xyz"],
                         *[F.col(f"{c}{i}").alias(f"t{c}{i}") for c in ("_x", "_y", "_z") for i in (0, 1)])
    pairs = cut_lineage(
        boxes.withColumn("_o", F.explode(around))
             .withColumns({f"_nc{v}": F.col(f"_c{v}") + F.col(f"_o.d{v}") for v in "xyz"})
             .join(there, ["_k", "_ncx", "_ncy", "_ncz"])
             .where(near2 <= F.lit(search * search))
             .select("_k", "_node", "dst", "_ncx", "_ncy", "_ncz", "_ends", "_dends", (far2 <= F.lit(inner * inner)).alias("_sure")))
    # the outermost points of two cubes (six each) settle nearly all others
    met = (pairs.where("NOT _sure").select("_k", "_node", "dst", F.explode("_ends").alias("_p"), "_dends")
                .select("_k", "_node", "dst", "_p", F.explode("_dends").alias("_q"))
                .where(within_eps(F.col("_p._lat"), F.col("_p._lon"), F.col("_q._lat"), F.col("_q._lon"), eps_m, geomodel)))
    edges = pairs.where("_sure").select("_k", "_node", "dst").unionByName(met.select("_k", "_node", "dst")).distinct()
    nodes = core.select("_k", F.col("_node").alias("src"), F.col("_node").alias("dst")).distinct()
    comp = connected_components(edges.withColumnRenamed("_node", "src").unionByName(nodes))
    # A pair inside one component adds nothing: only points between two of them are looked at.
    at = lambda c, label: comp.select("_k", F.col("node").alias(c), F.col("label").alias(label))
    apart = cut_lineage(pairs.where("NOT _sure").join(at("_node", "_from"), ["_k", "_node"]).join(at("dst", "_to"), ["_k", "dst"])
                        .where("_from <> _to").select("_k", "_node", "_ncx", "_ncy", "_ncz", "_from", "_to"))
    if not apart.isEmpty():
        probe = (core.join(apart, ["_k", "_node"])
                     .select("_k", "_id", "_from", "_to", "_lat", "_lon", "_ncx", "_ncy", "_ncz"))
        hit = _partners(probe, core, "c", eps_m, geomodel, how="left_semi")
        over = connected_components(hit.select("_k", F.col("_from").alias("src"), F.col("_to").alias("dst")).distinct())
        comp = (comp.join(over.select("_k", F.col("node").alias("label"), F.col("label").alias("_over")), ["_k", "label"], "left")
                    .select("_k", "node", F.coalesce("_over", "label").alias("label")))
    core_lab = (core.join(comp.withColumnRenamed("node", "_node"), ["_k", "_node"])
                    .select("_k", "_id", "label"))
    # Canonical cluster id: the smallest core point id of the component.
    rep = core_lab.groupBy("_k", "label").agg(F.min("_id").alias("_rep"))
    core_lab = (core_lab.join(rep, ["_k", "label"])
                        .select("_k", "_id", F.col("_rep").alias("label")))
    # Border points: non-core points with a core neighbour (fewer than minpts
    # neighbours in total, so few pairs).
    noncore = pts.join(core.select("_k", "_id"), ["_k", "_id"], "left_anti")
    bprobe = neighbour_cubes(noncore, side, reach, search).select(
        "_k", "_id", "_lat", "_lon", "_ncx", "_ncy", "_ncz")
    bpairs = _partners(bprobe, core, "c", eps_m, geomodel)
    border = (bpairs.join(core_lab.select("_k", F.col("_id").alias("_cid"), "label"), ["_k", "_cid"])
                    .groupBy("_k", "_id").agg(F.min("label").alias("label")))
    lab = core_lab.withColumn("is_core", F.lit(True)).unionByName(
        border.withColumn("is_core", F.lit(False)))
    cluster = F.xxhash64(F.col("_k").cast("string"), F.col("label")).bitwiseAND(
        F.lit(0x7FFFFFFFFFFFFFFF))
    out = pts.join(lab, ["_k", "_id"], "left")
    return (out.withColumn("cluster", F.when(F.col("label").isNull(), F.lit(-1)).otherwise(cluster))
               .withColumn("cluster_rep", F.col("label"))
               .withColumn("is_core", F.coalesce("is_core", F.lit(False)))
               .select(*points.columns, "cluster", "cluster_rep", "is_core"))


def remove_by_clustering(df: DataFrame, eps_km: float | None, min_samples: int,
                         method: str = "DBSCAN", lat_col: str = "decimallatitude",
                         lon_col: str = "decimallongitude", by: str | None = None,
                         min_cluster_size: int = 5):
    """Cluster raw records and drop noise (D3): returns (retained, outliers).

    Records are collapsed to distinct coordinates with a multiplicity weight
    (DBSCAN on records counts duplicates), scored, and the noise flag joined
    back.  Distances are haversine on R = 6371.0088 km; ``by`` clusters each
    group separately (the reference runs on one file, i.e. ``by=None``).
    Records without coordinates cannot be clustered and are returned as
    outliers.  ``HDBSCAN`` needs no ``eps_km`` and takes ``min_cluster_size``;
    OPTICS label extraction is not built (README).
    """
    if method not in ("DBSCAN", "HDBSCAN"):
        raise NotImplementedError(f"{method} labels are not built; use DBSCAN or HDBSCAN")
    if method == "DBSCAN" and eps_km is None:
        raise ValueError(f"epsilon_km must be provided for {method}")
    # a NULL group is a group of its own
    grp = F.coalesce(F.concat(F.lit("="), F.col(by).cast("string")), F.lit("")) if by else F.lit("")
    valid = F.col(lat_col).isNotNull() & F.col(lon_col).isNotNull()
    pts = (df.where(valid).groupBy(grp.alias("_g"), F.col(lat_col).alias("_la"),
                                   F.col(lon_col).alias("_lo"))
             .agg(F.count(F.lit(1)).alias("_mult")))
    spots = dict(key="_g", lat="_la", lon="_lo", weight="_mult")
    if method == "DBSCAN":
        noise = dbscan_noise(pts, eps_km * 1000.0, min_samples, pid="_g", **spots).where(F.col("OutlierScore") == 1.0)
    else:
        from occuflow.operators import hierarchy

        pid = F.concat_ws("|", F.col("_la").cast("string"), F.col("_lo").cast("string"))
        noise = hierarchy.hdbscan_labels(pts.withColumn("_pid", pid), min_samples, min_cluster_size, pid="_pid",
                                         **spots).where("cluster = -1")
    noise = noise.select("_g", "_la", "_lo")
    # the same rows on the left of both joins: they are shuffled once
    tagged = df.where(valid).withColumn("_g", grp)
    cond = ((tagged["_g"] == noise["_g"]) & (tagged[lat_col] == noise["_la"])
            & (tagged[lon_col] == noise["_lo"]))
    retained = tagged.join(noise, cond, "left_anti").drop("_g")
    out_noise = tagged.join(noise, cond, "left_semi").drop("_g")
    outliers = out_noise.unionByName(df.where(~valid))
    return retained, outliers
