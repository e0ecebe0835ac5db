"""Exact k-nearest-neighbour join within a group (J11) and the kNN-based
outlier scores built on it (D8-D10, D12, D13, D15, D20).

Conventions (not fixed by the reference): the query point is excluded from
its own neighbours; distances are great-circle metres rounded to whole
millimetres, so equal distances compare equal on every engine; and the
neighbourhood ``N_k(p)`` holds every point within the k-distance of ``p``
(ties included, as in Breunig et al. 2000), so results do not depend on how
ties are broken.

Plan (branch and bound over a cube pyramid, no all-pairs per group):

1. Points lie in a pyramid of 3-D cubes (Earth-centred coordinates) whose
   edge shrinks four-fold a level.  One aggregate per level gives each cube's
   count and the tight box around its points.
2. The finest cube around a point that holds ``k + 1`` points bounds its
   k-distance from above: the farthest corner of that cube's tight box.
3. A frontier of cubes per point starts one level above that cube, with the
   (at most 8) cubes that the bound reaches.  Each round drops cubes whose
   box lies beyond the bound, tightens the bound by the cubes' counts, and
   replaces cubes of many points by their children.  Far queries see a dense
   patch as a few boxes until they reach its near edge.
4. Only the points of the last cubes are ranked, and only rows within the
   k-distance leave the join.

Rounds grow with the logarithm of the largest group, rows per point with the
cubes within its bound, not with the group.
"""

from __future__ import annotations

import functools
import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from occuflow.functions.geo import EARTH_RADIUS_M, SPHEROID_BAND, ecef, haversine_m, vincenty_m, vincenty_np
from occuflow.functions.tails import chi_square_tail, gamma_tail
from occuflow.session import cut_lineage, keyed_join, ship_package, spread

# Cube edges shrink by 2 ** STEP a level: about 2.02 R_earth down to 0.8 m.
STEP, LEVELS = 2, 13
# Absolute slack on chord bounds (m): ranks compare distances in whole
# millimetres, and haversine and chord differ by rounding.
SLACK_M = 0.01
GEOMODELS = ("sphere", "wgs84")


def top_side() -> float:
    return 2.02 * EARTH_RADIUS_M


def _side(level) -> F.Column:
    return F.lit(top_side()) / F.pow(F.lit(2.0 ** STEP), level)


def _dist_mm(lat1, lon1, lat2, lon2, geomodel: str = "sphere"):
    metres = haversine_m if geomodel == "sphere" else vincenty_m
    return F.floor(metres(lat1, lon1, lat2, lon2) * F.lit(1000.0) + F.lit(0.5)).cast("long")


_CUBE = ("_cx", "_cy", "_cz")
_AXES = ("_x", "_y", "_z")
NODE = ["_k", "_lv", *_CUBE]
BOX = [f"{a}{i}" for a in _AXES for i in (0, 1)]


def box_distance(far: bool) -> F.Column:
    """Chord from the point (_x, _y, _z) to the nearest or farthest spot of a box."""
    total = F.lit(0.0)
    for a in _AXES:
        low, high = F.col(f"{a}0") - F.col(a), F.col(a) - F.col(f"{a}1")
        # low > 0: the box lies above the point; high > 0: below it
        d = F.greatest(F.abs(low), F.abs(high)) if far else F.greatest(low, high, F.lit(0.0))
        total = total + d * d
    return F.sqrt(total)


def cube_levels(pts: DataFrame, first: int = 0, last: int = LEVELS - 1) -> DataFrame:
    """The points (with _x, _y, _z) once per pyramid level from ``first`` to ``last``, with their cube."""
    lv = pts.withColumn("_lv", F.explode(F.sequence(F.lit(first), F.lit(last))))
    for c, a in zip(_CUBE, _AXES):
        lv = lv.withColumn(c, F.floor(F.col(a) / _side(F.col("_lv"))).cast("long"))
    return lv


def deepest_level(pts: DataFrame, most: int) -> int:
    """The first level on which no cube holds more than ``most`` points of a group, or the last: none below it is needed."""
    low, high = 0, LEVELS - 1
    while low < high:
        level = (low + high) // 2
        cubes = [F.floor(F.col(a) / _side(F.lit(level))).alias(c) for c, a in zip(_CUBE, _AXES)]
        if pts.groupBy("_k", *cubes).agg(F.count(F.lit(1)).alias("_m")).where(F.col("_m") > most).isEmpty():
            high = level
        else:
            low = level + 1
    return low


def cube_boxes(lv: DataFrame, weight: str | None = None) -> DataFrame:
    """Count (or weight sum) and tight box of every cube that holds points (cut)."""
    return cut_lineage(lv.groupBy(*NODE).agg(
        (F.sum(weight) if weight else F.count(F.lit(1))).alias("_n"),
        *[f(a).alias(f"{a}{i}") for a in _AXES for i, f in ((0, F.min), (1, F.max))]))


def cube_children(boxes: DataFrame) -> DataFrame:
    """Cubes keyed by their parent, their own columns with a trailing ``c``."""
    return boxes.select("_k", F.col("_lv").alias("_clv"), *[F.col(c).alias(f"{c}c") for c in _CUBE],
                        *[F.floor(F.col(c) / 2 ** STEP).cast("long").alias(c) for c in _CUBE],
                        (F.col("_lv") - 1).alias("_lv"), F.col("_n").alias("_cn"),
                        *[F.col(b).alias(f"{b}c") for b in BOX])


def into_children(rows: DataFrame, children: DataFrame, carry: list[str]) -> DataFrame:
    """Replace each (row, cube) by the row with the cube's children."""
    return (keyed_join(rows.select(*carry, "_lv", *_CUBE), children, NODE)
                .select(*carry, F.col("_clv").alias("_lv"), *[F.col(f"{c}c").alias(c) for c in _CUBE],
                        F.col("_cn").alias("_n"), *[F.col(f"{b}c").alias(b) for b in BOX]))


def cubes_in_reach(rows: DataFrame, reach: F.Column) -> DataFrame:
    """Each row once per cube of its ``_lv`` that a ball of ``reach`` around it can touch."""
    for c, a in zip(_CUBE, _AXES):
        side, top = _side(F.col("_lv")), F.lit(EARTH_RADIUS_M)
        rows = rows.withColumn(c, F.explode(F.sequence(
            F.floor(F.greatest(F.col(a) - reach, -top) / side).cast("long"),
            F.floor(F.least(F.col(a) + reach, top) / side).cast("long"))))
    return rows


def knn_candidates(points: DataFrame, k: int, key: str = "Species", pid: str = "H3",
                   lat: str = "LAT", lon: str = "LON", geomodel: str = "sphere") -> DataFrame:
    """Pairs ``(_k, _id, _nid, _dmm)`` that hold every point's k nearest and their ties."""
    if geomodel not in GEOMODELS:
        raise ValueError(f"geomodel must be one of {GEOMODELS}")
    if k is None or int(k) != k or k < 1:
        raise ValueError("k must be a positive integer")
    # the bound holds for spherical distances; the spheroid's differ by the band
    wider = 1.0 if geomodel == "sphere" else (1 + SPHEROID_BAND) / (1 - SPHEROID_BAND)
    if geomodel != "sphere":
        ship_package(points.sparkSession)
    x, y, z = ecef("_lat", "_lon")
    pts = cut_lineage(points.select(F.col(key).alias("_k"), F.col(pid).alias("_id"),
                                    F.col(lat).alias("_lat"), F.col(lon).alias("_lon"))
                            .withColumn("_x", x).withColumn("_y", y).withColumn("_z", z))
    lv = cube_levels(pts, 0, deepest_level(pts, k))
    boxes = cube_boxes(lv)

    # 2. the finest own cube of k + 1 points and the bound it gives.
    own = (keyed_join(lv.select("_id", *NODE, *_AXES), boxes.where(F.col("_n") > k), NODE)
             .groupBy("_k", "_id").agg(F.max(F.struct("_lv", box_distance(True).alias("_far"))).alias("_m")))
    start = (keyed_join(pts, own, ["_k", "_id"], "left")
                .withColumn("_ub", F.coalesce(F.col("_m._far") * wider + F.lit(SLACK_M), F.lit(math.inf)))
                .withColumn("_lv", F.greatest(F.coalesce(F.col("_m._lv"), F.lit(0)) - 1, F.lit(0)))
                .drop("_m"))

    # 3. the cubes around the bound's ball at the level above.
    first = cubes_in_reach(start, F.least(F.col("_ub"), F.lit(top_side())))
    query = ["_k", "_id", "_lat", "_lon", *_AXES, "_ub"]
    frontier = keyed_join(first.select(*query, "_lv", *_CUBE), boxes, NODE)
    parents = cube_children(boxes)
    last = None
    for _ in range(LEVELS + 1):
        inside = F.lit(True)
        for c, a in zip(_CUBE, _AXES):
            inside = inside & (F.col(c) == F.floor(F.col(a) / _side(F.col("_lv"))))
        near = (frontier.withColumn("_near", box_distance(False)).where(F.col("_near") <= F.col("_ub"))
                        .withColumn("_far", box_distance(True)))
        w = Window.partitionBy("_k", "_id")
        held = F.sum(F.col("_n") - F.when(inside, 1).otherwise(0)).over(w.orderBy("_far", "_lv", *_CUBE))
        near = (near.withColumn("_held", held)
                    .withColumn("_ub", F.least("_ub", F.coalesce(
                        F.min(F.when(F.col("_held") >= k, F.col("_far"))).over(w) * wider + F.lit(SLACK_M),
                        F.col("_ub"))))
                    .where(F.col("_near") <= F.col("_ub"))
                    .withColumn("_split", (F.col("_n") > k + 1) & (F.col("_lv") < LEVELS - 1)))
        step = cut_lineage(near.select(*query, "_lv", *_CUBE, "_n", *BOX, "_split"))
        if step.where("_split").isEmpty():
            last = step
            break
        frontier = step.where("NOT _split").drop("_split").unionByName(
            into_children(step.where("_split"), parents, query))

    # 4. the points of the last cubes.
    ends = last.select("_k", "_id", "_lat", "_lon", "_lv", *_CUBE)
    members = lv.select(*NODE, F.col("_id").alias("_nid"), F.col("_lat").alias("_nlat"), F.col("_lon").alias("_nlon"))
    return (keyed_join(ends, members, NODE).where(F.col("_id") != F.col("_nid"))
                .select("_k", "_id", "_nid", _dist_mm("_lat", "_lon", "_nlat", "_nlon", geomodel).alias("_dmm")))


def knn(points: DataFrame, k: int, key: str = "Species", pid: str = "H3",
        lat: str = "LAT", lon: str = "LON", geomodel: str = "sphere") -> DataFrame:
    """Neighbour rows ``(key, pid, nid, dist_m, rank)`` for every point.

    Holds every neighbour within the k-distance (ties included), ranked by
    (distance, neighbour id); ``rank`` <= k for the k nearest.  Points that
    are alone in their group get no rows.
    """
    cand = knn_candidates(points, k, key, pid, lat, lon, geomodel)
    w = Window.partitionBy("_k", "_id").orderBy("_dmm", "_nid")
    kth = F.max(F.when(F.col("_rank") == k, F.col("_dmm"))).over(Window.partitionBy("_k", "_id"))
    ranked = cand.withColumn("_rank", F.row_number().over(w)).withColumn("_kdmm", kth)
    return (ranked.where(F.col("_kdmm").isNull() | (F.col("_dmm") <= F.col("_kdmm")))
                  .select(F.col("_k").alias(key), F.col("_id").alias(pid), F.col("_nid").alias("nid"),
                          (F.col("_dmm") / F.lit(1000.0)).alias("dist_m"), F.col("_rank").alias("rank")))


def _ratio(a, b) -> F.Column:
    """a / b in the limit of coincident points: equal zeros or infinities give 1,
    anything else over zero infinity, anything finite over infinity 0."""
    a, b = (F.col(v) if isinstance(v, str) else v for v in (a, b))
    a, b = a.cast("double"), b.cast("double")
    inf = F.lit(math.inf)
    return (F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
             .when(((a == 0) & (b == 0)) | ((a == inf) & (b == inf)), F.lit(1.0))
             .when(b == 0, inf).otherwise(F.try_divide(a, b)))


def _points_once(score):
    """Write the points before the score reads them: each further read would count the records again."""
    @functools.wraps(score)
    def run(points: DataFrame, *args, **kwargs) -> DataFrame:
        return score(cut_lineage(points), *args, **kwargs)
    return run


def _attach(points: DataFrame, scores: DataFrame, key: str, pid: str) -> DataFrame:
    return keyed_join(points, scores, [key, pid], "left")


def _kstats(nb: DataFrame, k: int, key: str, pid: str) -> DataFrame:
    """Per point: k-distance, sum/mean of the k nearest distances, |N_k|."""
    return nb.groupBy(key, pid).agg(
        F.max(F.when(F.col("rank") <= k, F.col("dist_m"))).alias("kdist"),
        F.sum(F.when(F.col("rank") <= k, F.col("dist_m"))).alias("ksum"),
        F.count(F.lit(1)).alias("nk"),
        F.sum("dist_m").alias("nsum"))


@_points_once
def knn_outlier(points: DataFrame, k: int, key="Species", pid="H3", lat="LAT", lon="LON",
    geomodel: str = "sphere"):
    """KNNOutlier (D8): distance to the k-th nearest neighbour."""
    st = _kstats(knn(points, k, key, pid, lat, lon, geomodel), k, key, pid)
    return _attach(points, st.select(key, pid, F.col("kdist").alias("OutlierScore")), key, pid)


@_points_once
def knn_weight(points: DataFrame, k: int, key="Species", pid="H3", lat="LAT", lon="LON",
    geomodel: str = "sphere"):
    """KNNWeightOutlier (D9): sum of the distances to the k nearest."""
    st = _kstats(knn(points, k, key, pid, lat, lon, geomodel), k, key, pid)
    return _attach(points, st.select(key, pid, F.col("ksum").alias("OutlierScore")), key, pid)


@_points_once
def odin(points: DataFrame, k: int, key="Species", pid="H3", lat="LAT", lon="LON",
    geomodel: str = "sphere"):
    """ODIN (D10): in-degree in the kNN graph divided by k (low = outlier)."""
    nb = knn(points, k, key, pid, lat, lon, geomodel)
    indeg = nb.groupBy(key, F.col("nid").alias(pid)).agg(F.count(F.lit(1)).alias("_in"))
    out = _attach(points, indeg, key, pid)
    return out.withColumn("OutlierScore", F.coalesce("_in", F.lit(0)) / F.lit(float(k))).drop("_in")


@_points_once
def local_isolation(points: DataFrame, k: int, key="Species", pid="H3", lat="LAT", lon="LON",
    geomodel: str = "sphere"):
    """Local isolation coefficient (D20): k-distance plus mean kNN distance."""
    st = _kstats(knn(points, k, key, pid, lat, lon, geomodel), k, key, pid)
    sc = st.select(key, pid, (F.col("kdist") + F.col("ksum") / F.lit(float(k))).alias("OutlierScore"))
    return _attach(points, sc, key, pid)


@_points_once
def lof(points: DataFrame, k: int, key="Species", pid="H3", lat="LAT", lon="LON",
        simplified: bool = False, geomodel: str = "sphere"):
    """LOF (D12), or SimplifiedLOF (D13) without the reachability distance.

    reach(p, o) = max(k-distance(o), d(p, o)); lrd(p) = 1 / mean over
    N_k(p) of reach(p, o); LOF(p) = mean over N_k(p) of lrd(o) / lrd(p).
    Simplified: density(p) = 1 / mean over N_k(p) of d(p, o).
    """
    nb = cut_lineage(knn(points, k, key, pid, lat, lon, geomodel))
    st = _kstats(nb, k, key, pid)
    if simplified:
        dens = st.select(key, pid, _ratio("nk", "nsum").alias("_lrd"))
    else:
        kd = st.select(key, F.col(pid).alias("nid"), F.col("kdist").alias("_okd"))
        reach = (nb.join(kd, [key, "nid"])
                   .withColumn("_r", F.greatest("_okd", "dist_m")))
        dens = (reach.groupBy(key, pid)
                     .agg(_ratio(F.count(F.lit(1)), F.sum("_r")).alias("_lrd")))
    nd = dens.select(key, F.col(pid).alias("nid"), F.col("_lrd").alias("_nlrd"))
    ratio = (nb.join(nd, [key, "nid"]).groupBy(key, pid).agg(F.avg("_nlrd").alias("_m"))
               .join(dens, [key, pid])
               .select(key, pid, _ratio("_m", "_lrd").alias("OutlierScore")))
    return _attach(points, ratio, key, pid)


@_points_once
def ldof(points: DataFrame, k: int, key="Species", pid="H3", lat="LAT", lon="LON",
    geomodel: str = "sphere"):
    """LDOF (D15): mean distance to the k nearest over their mean pairwise distance.

    Pairs among each point's k nearest: k(k-1) per point, bounded by k.
    """
    nb = cut_lineage(knn(points, k, key, pid, lat, lon, geomodel).where(F.col("rank") <= k))
    coords = points.select(F.col(key).alias(key), F.col(pid).alias("nid"),
                           F.col(lat).alias("_nlat"), F.col(lon).alias("_nlon"))
    nbc = nb.join(coords, [key, "nid"])
    a = nbc.select(key, pid, F.col("nid").alias("_a"), F.col("_nlat").alias("_alat"),
                   F.col("_nlon").alias("_alon"))
    b = nbc.select(key, pid, F.col("nid").alias("_b"), F.col("_nlat").alias("_blat"),
                   F.col("_nlon").alias("_blon"))
    inner = (a.join(b, [key, pid]).where(F.col("_a") != F.col("_b"))
              .select(key, pid, (_dist_mm("_alat", "_alon", "_blat", "_blon", geomodel) / F.lit(1000.0))
                      .alias("_d"))
              .groupBy(key, pid).agg(F.avg("_d").alias("_inner")))
    outer = nb.groupBy(key, pid).agg(F.avg("dist_m").alias("_outer"))
    sc = (outer.join(inner, [key, pid], "left")
               .select(key, pid, F.try_divide(F.col("_outer"), F.col("_inner")).alias("OutlierScore")))
    return _attach(points, sc, key, pid)


def trivial_average(points: DataFrame, lat: str = "LAT", lon: str = "LON") -> DataFrame:
    """TrivialAverageCoordinate (D28): the mean of the two coordinates."""
    return points.withColumn("OutlierScore", (F.col(lat) + F.col(lon)) / F.lit(2.0))


@_points_once
def density_sweep(points: DataFrame, minpts: int, eps_list=(), key="Species", pid="H3",
                  lat="LAT", lon="LON", geomodel: str = "sphere") -> DataFrame:
    """Multi-eps DBSCAN sweep (D6, re-aimed from OPTICS) from one kNN join.

    ``core_dist`` = distance to the (minpts - 1)-th neighbour (the point
    counts itself); ``reach_dist`` = the smallest eps at which the point is
    not noise: min(core_dist(p), min over q in N(p) of max(d(p, q),
    core_dist(q))).  Only q closer than core_dist(p) can lower it, and those
    are p's kNN.  For each eps in ``eps_list`` a column ``noise_<eps>``
    (1.0/0.0) is added.  Distances are in whole millimetres.
    """
    if minpts is None or int(minpts) != minpts or minpts < 1:
        raise ValueError("minpts must be a positive integer")
    if minpts == 1:
        out = points.withColumn("core_dist", F.lit(0.0)).withColumn("reach_dist", F.lit(0.0))
    else:
        k = minpts - 1
        nb = cut_lineage(knn(points, k, key, pid, lat, lon, geomodel))
        # A group with fewer than minpts points has no core point.
        core = (nb.groupBy(key, pid)
                  .agg(F.max(F.when(F.col("rank") <= k, F.col("dist_m"))).alias("_kd"),
                       F.count_if(F.col("rank") <= k).alias("_kc"))
                  .select(key, pid, F.when(F.col("_kc") >= k, F.col("_kd")).alias("core_dist")))
        qc = core.select(key, F.col(pid).alias("nid"), F.col("core_dist").alias("_qcore"))
        via = (nb.join(qc.where(F.col("_qcore").isNotNull()), [key, "nid"])
                 .groupBy(key, pid).agg(F.min(F.greatest("dist_m", "_qcore")).alias("_via")))
        sc = (core.join(via, [key, pid], "left")
                  .select(key, pid, "core_dist",
                          F.least(F.coalesce("core_dist", F.lit(float("inf"))),
                                  F.coalesce("_via", F.lit(float("inf")))).alias("reach_dist")))
        out = _attach(points, sc, key, pid).withColumn(
            "core_dist", F.coalesce("core_dist", F.lit(float("inf")))).withColumn(
            "reach_dist", F.coalesce("reach_dist", F.lit(float("inf"))))
    for eps in eps_list:
        name = f"noise_{int(eps) if float(eps).is_integer() else eps}"
        out = out.withColumn(name, F.when(F.col("reach_dist") > F.lit(float(eps)), F.lit(1.0))
                                    .otherwise(F.lit(0.0)))
    return out


def _knn_rows(points, k, key, pid, lat, lon, geomodel="sphere"):
    """Cut neighbour rows limited to the k nearest (rank <= k)."""
    return cut_lineage(knn(points, k, key, pid, lat, lon, geomodel))


@_points_once
def knndd(points: DataFrame, k: int, key="Species", pid="H3", lat="LAT", lon="LON",
    geomodel: str = "sphere"):
    """KNNDD (D11): k-distance over the mean k-distance of the k nearest."""
    nb = _knn_rows(points, k, key, pid, lat, lon, geomodel)
    kd = _kstats(nb, k, key, pid).select(key, pid, "kdist")
    nkd = kd.select(key, F.col(pid).alias("nid"), F.col("kdist").alias("_nkd"))
    m = (nb.where(F.col("rank") <= k).join(nkd, [key, "nid"])
           .groupBy(key, pid).agg(F.avg("_nkd").alias("_m")))
    sc = kd.join(m, [key, pid]).select(key, pid, _ratio("kdist", "_m").alias("OutlierScore"))
    return _attach(points, sc, key, pid)


@_points_once
def inflo(points: DataFrame, k: int, key="Species", pid="H3", lat="LAT", lon="LON",
    geomodel: str = "sphere"):
    """INFLO (D16): influence space = kNN ∪ reverse kNN; density 1 / k-distance;
    score = mean density over the influence space / own density."""
    nb = _knn_rows(points, k, key, pid, lat, lon, geomodel)
    den = (_kstats(nb, k, key, pid)
           .select(key, pid, _ratio(F.lit(1.0), F.col("kdist")).alias("_den")))
    fwd = nb.where(F.col("rank") <= k).select(key, pid, "nid")
    rev = fwd.select(key, F.col("nid").alias(pid), F.col(pid).alias("nid"))
    space = fwd.unionByName(rev).distinct()
    nden = den.select(key, F.col(pid).alias("nid"), F.col("_den").alias("_nden"))
    m = space.join(nden, [key, "nid"]).groupBy(key, pid).agg(F.avg("_nden").alias("_m"))
    sc = den.join(m, [key, pid]).select(key, pid, _ratio("_m", "_den").alias("OutlierScore"))
    return _attach(points, sc, key, pid)


def erf(x) -> F.Column:
    """Error function as a Column (Abramowitz & Stegun 7.1.26, |error| < 1.5e-7)."""
    x = F.col(x) if isinstance(x, str) else x
    # The published coefficients of the approximation.
    p, a1, a2, a3, a4, a5 = 0.3275911, 0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429
    ax = F.abs(x)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(p) * ax)
    poly = ((((F.lit(a5) * t + F.lit(a4)) * t + F.lit(a3)) * t + F.lit(a2)) * t + F.lit(a1)) * t
    y = F.lit(1.0) - poly * F.exp(-ax * ax)
    return F.signum(x) * y


@_points_once
def loop(points: DataFrame, k: int, lam: float = 2.0, key="Species", pid="H3", lat="LAT",
         lon="LON", geomodel: str = "sphere"):
    """LoOP (D17, Kriegel et al. 2009) with the k nearest as context set.

    pdist(o) = lam * sqrt(mean d(o, s)^2); PLOF(o) = pdist(o) / mean pdist(s)
    - 1; nPLOF = lam * sqrt(mean PLOF^2) per group; LoOP = max(0, erf(PLOF /
    (nPLOF * sqrt 2))).
    """
    nb = _knn_rows(points, k, key, pid, lat, lon, geomodel).where(F.col("rank") <= k)
    pd_ = (nb.groupBy(key, pid)
             .agg((F.lit(lam) * F.sqrt(F.avg(F.col("dist_m") * F.col("dist_m")))).alias("_pd")))
    npd = pd_.select(key, F.col(pid).alias("nid"), F.col("_pd").alias("_npd"))
    plof = (nb.join(npd, [key, "nid"]).groupBy(key, pid).agg(F.avg("_npd").alias("_m"))
              .join(pd_, [key, pid])
              .select(key, pid, (_ratio("_pd", "_m") - F.lit(1.0)).alias("_plof")))
    # a point whose neighbours all coincide with theirs has an infinite PLOF: LoOP 1
    finite = F.when(F.col("_plof") < math.inf, F.col("_plof"))
    norm = plof.groupBy(key).agg((F.lit(lam) * F.sqrt(F.avg(finite * finite))).alias("_n"))
    sc = (plof.join(norm, key)
              .select(key, pid, F.when(F.col("_plof") == math.inf, F.lit(1.0)).otherwise(
                  F.greatest(F.lit(0.0), erf(F.try_divide(F.col("_plof"), F.col("_n") * F.lit(math.sqrt(2.0))))))
                  .alias("OutlierScore")))
    return _attach(points, sc, key, pid)


@_points_once
def variance_of_volume(points: DataFrame, k: int, key="Species", pid="H3", lat="LAT", lon="LON",
                       unit_m: float = 1_000_000.0, geomodel: str = "sphere"):
    """VOV (D19, Hu & Sung 2003): sample variance of the k-distance disc areas
    (pi * (kdist / unit)^2) over the point and its k nearest; ``unit_m``
    scales distances (default 1000 km) to keep the variance well-conditioned."""
    nb = _knn_rows(points, k, key, pid, lat, lon, geomodel)
    r = F.col("kdist") / F.lit(float(unit_m))
    vol = _kstats(nb, k, key, pid).select(key, pid, (F.lit(math.pi) * r * r).alias("_v"))
    nvol = vol.select(key, F.col(pid).alias("nid"), F.col("_v").alias("_nv"))
    members = (nb.where(F.col("rank") <= k).join(nvol, [key, "nid"]).select(key, pid, "_nv")
                 .unionByName(vol.select(key, pid, F.col("_v").alias("_nv"))))
    sc = members.groupBy(key, pid).agg(F.var_samp("_nv").alias("OutlierScore"))
    return _attach(points, sc, key, pid)


@_points_once
def cof(points: DataFrame, k: int, key="Species", pid="H3", lat="LAT", lon="LON",
    geomodel: str = "sphere"):
    """COF (D18, Tang et al. 2002): connectivity-based outlier factor.

    For each point the set-based-nearest trail over itself and its k nearest
    is built greedily (always extend by the closest remaining point); the
    average chaining distance weighs the i-th trail edge by 2(k+1-i)/(k(k+1)).
    COF = own chaining distance / mean of the neighbours'.  The trail is a
    small per-row computation (k+1 points) in an Arrow UDF over arrays.
    """
    ship_package(points.sparkSession)
    nb = _knn_rows(points, k, key, pid, lat, lon, geomodel).where(F.col("rank") <= k)
    coords = points.select(F.col(key).alias(key), F.col(pid).alias("nid"),
                           F.col(lat).alias("_nlat"), F.col(lon).alias("_nlon"))
    own = points.select(F.col(key).alias(key), F.col(pid).alias(pid),
                        F.col(lat).alias("_plat"), F.col(lon).alias("_plon"))
    grouped = (nb.join(coords, [key, "nid"])
                 .groupBy(key, pid)
                 .agg(F.sort_array(F.collect_list(F.struct("rank", "_nlat", "_nlon"))).alias("_nbrs"))
                 .join(own, [key, pid])
                 .withColumn("_las", F.transform("_nbrs", lambda r: r["_nlat"]))
                 .withColumn("_los", F.transform("_nbrs", lambda r: r["_nlon"])))

    @F.pandas_udf(DoubleType())
    def chaining(plat: pd.Series, plon: pd.Series, las: pd.Series, los: pd.Series) -> pd.Series:
        out = []
        for a, b, nla, nlo in zip(plat, plon, las, los):
            la = np.radians(np.concatenate([[a], np.asarray(nla, dtype=float)]))
            lo = np.radians(np.concatenate([[b], np.asarray(nlo, dtype=float)]))
            if geomodel == "sphere":
                h = (np.sin((la[:, None] - la[None, :]) / 2) ** 2
                     + np.cos(la[:, None]) * np.cos(la[None, :]) * np.sin((lo[:, None] - lo[None, :]) / 2) ** 2)
                d = 2 * EARTH_RADIUS_M * np.arcsin(np.sqrt(np.minimum(1.0, h)))
            else:
                i, j = np.indices((len(la), len(la))).reshape(2, -1)
                d = vincenty_np(*np.degrees((la[i], lo[i], la[j], lo[j]))).reshape(len(la), -1)
            d = np.floor(d * 1000 + 0.5) / 1000
            n = len(la) - 1
            if n == 0:
                out.append(None)
                continue
            in_set = np.zeros(n + 1, bool)
            in_set[0] = True
            total = 0.0
            for i in range(1, n + 1):
                sub = d[np.ix_(in_set, ~in_set)]
                j = np.unravel_index(np.argmin(sub), sub.shape)
                cand = np.where(~in_set)[0][j[1]]
                total += 2.0 * (n + 1 - i) / (n * (n + 1)) * sub[j]
                in_set[cand] = True
            out.append(total)
        return pd.Series(out, dtype="float64")

    ac = grouped.select(key, pid, chaining("_plat", "_plon", "_las", "_los").alias("_ac"))
    ac = cut_lineage(ac)
    nac = ac.select(key, F.col(pid).alias("nid"), F.col("_ac").alias("_nac"))
    m = nb.join(nac, [key, "nid"]).groupBy(key, pid).agg(F.avg("_nac").alias("_m"))
    sc = ac.join(m, [key, pid]).select(key, pid, F.try_divide(F.col("_ac"), F.col("_m"))
                                      .alias("OutlierScore"))
    return _attach(points, sc, key, pid)


@_points_once
def kernel_density_lof(points: DataFrame, k: int, key="Species", pid="H3", lat="LAT", lon="LON",
    geomodel: str = "sphere"):
    """Simple kernel-density LOF.

    density(p) = mean over N_k(p) of a 2-D Gaussian kernel of the
    reachability distance max(d(p, o), k-distance(o)) scaled by the
    bandwidth k-distance(p); score = mean neighbour density / own density.
    """
    nb = _knn_rows(points, k, key, pid, lat, lon, geomodel)
    st = _kstats(nb, k, key, pid).select(key, pid, "kdist")
    okd = st.select(key, F.col(pid).alias("nid"), F.col("kdist").alias("_okd"))
    own = st.select(key, pid, F.col("kdist").alias("_h"))
    # a point with k coincident neighbours has bandwidth 0: infinite density
    u = F.try_divide(F.greatest("dist_m", "_okd"), F.col("_h"))
    kern = F.when(F.col("_h") > 0, F.try_divide(F.exp(-u * u / F.lit(2.0)),
                                                F.lit(2.0 * math.pi) * F.col("_h") * F.col("_h"))
                  ).otherwise(F.lit(math.inf))
    dens = (nb.join(okd, [key, "nid"]).join(own, [key, pid])
              .groupBy(key, pid).agg(F.avg(kern).alias("_dens")))
    nd = dens.select(key, F.col(pid).alias("nid"), F.col("_dens").alias("_nd"))
    sc = (nb.join(nd, [key, "nid"]).groupBy(key, pid).agg(F.avg("_nd").alias("_m"))
            .join(dens, [key, pid])
            .select(key, pid, _ratio("_m", "_dens").alias("OutlierScore")))
    return _attach(points, sc, key, pid)


def _binding_probabilities(d: np.ndarray, perplexity: float, iters: int = 60) -> np.ndarray:
    """Row-wise affinities exp(-beta d^2) normalised, with beta set by bisection
    so that the entropy equals log(perplexity) (Janssens et al. 2012)."""
    scale = np.where(d.mean(axis=1, keepdims=True) > 0, d.mean(axis=1, keepdims=True), 1.0)
    d2 = (d / scale) ** 2
    target = math.log(perplexity)
    lo = np.full(len(d), -40.0)
    hi = np.full(len(d), 40.0)
    for _ in range(iters):
        mid = (lo + hi) / 2
        beta = np.exp(mid)[:, None]
        a = np.exp(-(d2 - d2.min(axis=1, keepdims=True)) * beta)
        p = a / a.sum(axis=1, keepdims=True)
        ent = -(p * np.log(np.maximum(p, 1e-300))).sum(axis=1)
        too_flat = ent > target  # entropy too high: beta must grow
        lo = np.where(too_flat, mid, lo)
        hi = np.where(too_flat, hi, mid)
    beta = np.exp((lo + hi) / 2)[:, None]
    a = np.exp(-(d2 - d2.min(axis=1, keepdims=True)) * beta)
    return a / a.sum(axis=1, keepdims=True)


@_points_once
def knn_sos(points: DataFrame, k: int, perplexity: float | None = None, key="Species", pid="H3",
            lat="LAT", lon="LON",
    geomodel: str = "sphere"):
    """KNNSOS (D21): stochastic outlier selection restricted to the k nearest.

    Each point binds to its k nearest with Gaussian affinities whose
    bandwidth gives the requested perplexity (default k / 3); the outlier
    probability of x is the product over the points that bind to x of
    (1 - binding probability).  Rows are ranked neighbours (exactly k per
    point), so the per-row bandwidth search is a small numpy computation.
    """
    h = float(perplexity) if perplexity else k / 3.0
    if not 1.0 <= h < k:
        raise ValueError("perplexity must be in [1, k)")
    ship_package(points.sparkSession)
    nb = _knn_rows(points, k, key, pid, lat, lon, geomodel).where(F.col("rank") <= k)
    rows = (nb.groupBy(key, pid)
              .agg(F.sort_array(F.collect_list(F.struct("rank", "dist_m", "nid"))).alias("_l"))
              .withColumn("_d", F.transform("_l", lambda r: r["dist_m"]))
              .withColumn("_n", F.transform("_l", lambda r: r["nid"])))

    @F.pandas_udf("array<double>")
    def binding(ds: pd.Series) -> pd.Series:
        out = [None] * len(ds)
        by_len: dict[int, list[int]] = {}
        for i, v in enumerate(ds):
            by_len.setdefault(len(v), []).append(i)
        for n, idx in by_len.items():
            if n == 0:
                for i in idx:
                    out[i] = []
                continue
            mat = np.vstack([np.asarray(ds.iloc[i], dtype=float) for i in idx])
            probs = _binding_probabilities(mat, min(h, max(n - 1e-9, 1.0)))
            for row, i in enumerate(idx):
                out[i] = probs[row].tolist()
        return pd.Series(out)

    bound = (rows.withColumn("_b", binding("_d"))
                 .select(key, F.explode(F.arrays_zip(F.col("_n").alias("nid"),
                                                     F.col("_b").alias("b"))).alias("_z"))
                 .select(key, F.col("_z.nid").alias(pid), F.col("_z.b").alias("b")))
    sc = (bound.groupBy(key, pid)
               .agg(F.exp(F.sum(F.log1p(-F.least(F.col("b"), F.lit(1.0 - 1e-16))))).alias("OutlierScore")))
    out = _attach(points, sc, key, pid)
    return out.withColumn("OutlierScore", F.coalesce("OutlierScore", F.lit(1.0)))


@_points_once
def scatterplot_outlier(points: DataFrame, k: int, attr: str, key="Species", pid="H3",
                        lat="LAT", lon="LON",
    geomodel: str = "sphere"):
    """Scatterplot spatial outlier (D24, Shekhar, Lu & Zhang 2003).

    The neighbourhood mean of ``attr`` over the k nearest is regressed on
    ``attr`` per group (``regr_slope``/``regr_intercept`` aggregates); the
    score is the standardised absolute residual |e - mean(e)| / sd(e).
    """
    nb = _knn_rows(points, k, key, pid, lat, lon, geomodel).where(F.col("rank") <= k)
    na = points.select(F.col(key).alias(key), F.col(pid).alias("nid"),
                       F.col(attr).cast("double").alias("_na"))
    own = points.select(F.col(key).alias(key), F.col(pid).alias(pid),
                        F.col(attr).cast("double").alias("_a"))
    avg = (nb.join(na, [key, "nid"]).groupBy(key, pid).agg(F.avg("_na").alias("_m"))
             .join(own, [key, pid]))
    fit = avg.groupBy(key).agg(F.regr_slope("_a", "_m").alias("_b"),
                               F.regr_intercept("_a", "_m").alias("_c"))
    res = (avg.join(fit, key)
              .withColumn("_e", F.col("_a") - (F.col("_c") + F.col("_b") * F.col("_m"))))
    mom = res.groupBy(key).agg(F.avg("_e").alias("_em"), F.stddev_samp("_e").alias("_es"))
    sc = (res.join(mom, key)
             .select(key, pid, F.try_divide(F.abs(F.col("_e") - F.col("_em")), F.col("_es"))
                     .alias("OutlierScore")))
    return _attach(points, sc, key, pid)


@_points_once
def simple_cop(points: DataFrame, k: int, explained: float = 0.85, key="Species", pid="H3",
               lat="LAT", lon="LON",
    geomodel: str = "sphere"):
    """Simple correlation outlier score (D22, after Kriegel et al. 2012).

    Local PCA of the k nearest (planar lat, lon; population covariance)
    with the 2 x 2 eigen decomposition in closed form.  When the strongest
    direction explains at least ``explained`` of the variance, the other one
    is the weak direction and the score is the absolute deviation of the
    point from the neighbourhood mean along it; otherwise no weak subspace
    exists and the score is 0.
    """
    nb = _knn_rows(points, k, key, pid, lat, lon, geomodel).where(F.col("rank") <= k)
    coords = points.select(F.col(key).alias(key), F.col(pid).alias("nid"),
                           F.col(lat).cast("double").alias("_nx"), F.col(lon).cast("double").alias("_ny"))
    mom = (nb.join(coords, [key, "nid"]).groupBy(key, pid)
             .agg(F.avg("_nx").alias("_mx"), F.avg("_ny").alias("_my"),
                  F.var_pop("_nx").alias("_a"), F.covar_pop("_nx", "_ny").alias("_b"),
                  F.var_pop("_ny").alias("_c")))
    half = (F.col("_a") + F.col("_c")) / F.lit(2.0)
    rad = F.sqrt(F.pow((F.col("_a") - F.col("_c")) / F.lit(2.0), 2) + F.col("_b") * F.col("_b"))
    l1, l2 = half + rad, half - rad
    # Eigenvector of the smaller eigenvalue: (l2 - c, b) and (b, l2 - a) are
    # both solutions; the one with the larger norm is the numerically stable
    # choice (the other vanishes when b is near 0).
    u1x, u1y = l2 - F.col("_c"), F.col("_b")
    u2x, u2y = F.col("_b"), l2 - F.col("_a")
    first = (u1x * u1x + u1y * u1y) >= (u2x * u2x + u2y * u2y)
    ex = F.when(first, u1x).otherwise(u2x)
    ey = F.when(first, u1y).otherwise(u2y)
    norm = F.sqrt(ex * ex + ey * ey)
    own = points.select(F.col(key).alias(key), F.col(pid).alias(pid),
                        F.col(lat).cast("double").alias("_px"), F.col(lon).cast("double").alias("_py"))
    dev = F.abs((F.col("_px") - F.col("_mx")) * ex + (F.col("_py") - F.col("_my")) * ey) / norm
    strong = F.try_divide(l1, l1 + l2) >= F.lit(explained)
    sc = (mom.join(own, [key, pid])
             .select(key, pid, F.when(strong & (norm > 0), dev).otherwise(F.lit(0.0)).alias("OutlierScore")))
    return _attach(points, sc, key, pid)


# Subsets of a neighbourhood that are tried for its covariance.
COP_SUBSETS = 2_000
# Share of a neighbourhood that its covariance leaves out, and share of the largest
# deviations that the fitted distribution leaves out.
COP_TRIM = 0.15
# Relative floor of the variances, so that points in a line have a deviation at all.
_COP_FLOOR = 1e-6
# Deviations that are as good as equal have no gamma distribution of their own.
_COP_SPREAD = 0.005


def cop_trims(k: int) -> list[list[int]]:
    """Neighbours (by rank from 0) left out together; farther ones first."""
    t = max(1, math.floor(COP_TRIM * k))
    if math.comb(k, t) > COP_SUBSETS:
        raise ValueError(f"{math.comb(k, t)} subsets of {k} neighbours are too many")
    return [list(c) for c in itertools.combinations(range(k - 1, -1, -1), t)]


@_points_once
def cop(points: DataFrame, k: int, expect: float = 0.001, key="Species", pid="H3", lat="LAT", lon="LON",
        geomodel: str = "sphere", distribution: str = "gamma"):
    """Correlation outlier probability (D22, Kriegel et al. 2012).

    The k nearest neighbours (planar offsets in degrees, the short way round)
    give a robust mean and covariance: of all subsets without 15 % of them (one
    at least) that of the least determinant (to nine digits; ties: the farthest
    left out).  The point's squared deviations, weakest direction first and both
    together, divided by the variances, are compared with those of the
    neighbours: a gamma distribution fitted to the lower 85 % (Choi and Wette's
    closed form) or, where these hardly differ and for ``distribution =
    "chisquared"``, a chi-square distribution.  With q the least tail
    probability the score is expect * (1 - q) / (expect + q).  Points with fewer
    than k neighbours use all of them; fewer than three give 0.
    """
    if distribution not in ("gamma", "chisquared"):
        raise ValueError("distribution must be 'gamma' or 'chisquared'")
    if not 0 < expect < 1:
        raise ValueError("expect must lie between 0 and 1")
    if k is None or isinstance(k, bool) or int(k) != k or k < 3:
        raise ValueError("three neighbours or more are needed")
    trims = cop_trims(k)
    nb = _knn_rows(points, k, key, pid, lat, lon, geomodel).where(F.col("rank") <= k)
    other = points.select(F.col(key).alias(key), F.col(pid).alias("nid"),
                          F.col(lat).cast("double").alias("_nx"), F.col(lon).cast("double").alias("_ny"))
    own = points.select(F.col(key).alias(key), F.col(pid).alias(pid),
                        F.col(lat).cast("double").alias("_px"), F.col(lon).cast("double").alias("_py"))
    across = F.col("_ny") - F.col("_py")
    offset = F.struct("rank", (F.col("_nx") - F.col("_px")).alias("x"),
                      (across - F.lit(360.0) * F.floor((across + 180.0) / 360.0)).alias("y"))
    hood = (keyed_join(keyed_join(nb, other, [key, "nid"]), own, [key, pid]).groupBy(key, pid)
              .agg(F.sort_array(F.collect_list(offset)).alias("_hood")))
    # few bytes but long work a row: an explicit count keeps them from being merged into few tasks
    hood = spread(cut_lineage(hood), key, pid)

    # moments of the subset of least determinant, around the point
    terms = lambda v: [v["x"], v["y"], v["x"] * v["x"], v["x"] * v["y"], v["y"] * v["y"]]
    names = ("sx", "sy", "sxx", "sxy", "syy")
    zero = F.struct(*[F.lit(0.0).alias(n) for n in names])
    plus = lambda s, v: F.struct(*[(s[n] + t).alias(n) for n, t in zip(names, terms(v))])
    whole = F.aggregate("_hood", zero, plus)
    drops = F.when(F.size("_hood") == k, F.array(*[F.array(*map(F.lit, t)) for t in trims])).otherwise(
        F.array(F.array().cast("array<int>")))

    def subset(drop, at):
        gone = F.aggregate(drop, zero, lambda s, i: plus(s, F.get("_hood", i)))
        h = F.size("_hood") - F.size(drop)
        x, y = (F.col("_all.sx") - gone["sx"]) / h, (F.col("_all.sy") - gone["sy"]) / h
        a = (F.col("_all.sxx") - gone["sxx"]) / h - x * x
        b = (F.col("_all.sxy") - gone["sxy"]) / h - x * y
        c = (F.col("_all.syy") - gone["syy"]) / h - y * y
        return F.struct(F.round(a * c - b * b, 9).alias("det"), at.alias("at"), x.alias("mx"), y.alias("my"),
                        a.alias("a"), b.alias("b"), c.alias("c"))

    picked = (hood.where(F.size("_hood") >= 3).withColumn("_all", whole)
              .select(key, pid, "_hood", F.inline(F.array(F.array_min(F.transform(drops, subset))))))
    half, rad = (F.col("a") + F.col("c")) / 2.0, F.sqrt(F.pow((F.col("a") - F.col("c")) / 2.0, 2) + F.col("b") * F.col("b"))
    floor = F.col("a") + F.col("c")
    axes = picked.withColumn("l2", half - rad).withColumn("l1", half + rad).withColumn("_floor", floor * _COP_FLOOR + 1e-12)
    one, two = (F.col("l2") - F.col("c"), F.col("b")), (F.col("b"), F.col("l2") - F.col("a"))
    first = one[0] * one[0] + one[1] * one[1] >= two[0] * two[0] + two[1] * two[1]
    axes = (axes.withColumn("ex", F.when(first, one[0]).otherwise(two[0])).withColumn("ey", F.when(first, one[1]).otherwise(two[1]))
                .withColumn("_len", F.sqrt(F.col("ex") * F.col("ex") + F.col("ey") * F.col("ey")))
                .withColumn("ex", F.when(F.col("_len") > 0, F.col("ex") / F.col("_len")).otherwise(1.0))
                .withColumn("ey", F.when(F.col("_len") > 0, F.col("ey") / F.col("_len")).otherwise(0.0)))

    def deviation(x, y, both: bool):
        dx, dy = x - F.col("mx"), y - F.col("my")
        weak = F.pow(dx * F.col("ex") + dy * F.col("ey"), 2) / (F.greatest("l2", F.lit(0.0)) + F.col("_floor"))
        strong = F.pow(dy * F.col("ex") - dx * F.col("ey"), 2) / (F.col("l1") + F.col("_floor"))
        return weak + strong if both else weak

    tails = []
    for both in (False, True):
        n = f"_{int(both)}"
        kept = F.slice(F.array_sort(F.transform("_hood", lambda v: deviation(v["x"], v["y"], both))), 1,
                       F.greatest(F.floor(F.size("_hood") * (1 - COP_TRIM)), F.lit(1)).cast("int"))
        axes = (axes.withColumn(f"x{n}", deviation(F.lit(0.0), F.lit(0.0), both))
                    .withColumn(f"d{n}", F.filter(kept, lambda v: v > 0)))
        total = F.aggregate(f"d{n}", F.lit(0.0), lambda s, v: s + v)
        logs = F.aggregate(f"d{n}", F.lit(0.0), lambda s, v: s + F.log(v))
        axes = (axes.withColumn(f"m{n}", total / F.nullif(F.size(f"d{n}"), F.lit(0)))
                    .withColumn(f"s{n}", F.log(f"m{n}") - logs / F.nullif(F.size(f"d{n}"), F.lit(0))))
        excess = F.col(f"s{n}")
        shape = (3.0 - excess + F.sqrt(F.pow(excess - 3.0, 2) + 24.0 * excess)) / (12.0 * excess)
        fits = (F.size(f"d{n}") >= 2) & (excess >= _COP_SPREAD) if distribution == "gamma" else F.lit(False)
        axes = axes.withColumn(f"k{n}", F.when(fits, shape))
        # plain columns for the tails, whose steps use them many times
        tails.append(F.when(F.col(f"k{n}").isNull(), chi_square_tail(1 + both, F.col(f"x{n}")))
                     .otherwise(gamma_tail(F.col(f"k{n}"), F.col(f"x{n}") * F.col(f"k{n}") / F.col(f"m{n}"))))
    plain = axes.select(key, pid, F.inline(F.array(F.struct("x_0", "x_1", "m_0", "m_1", "k_0", "k_1"))))
    q = plain.select(key, pid, F.least(*tails).alias("_q"))
    sc = q.select(key, pid, (F.lit(expect) * (1.0 - F.col("_q")) / (F.lit(expect) + F.col("_q"))).alias("OutlierScore"))
    return _attach(points, sc, key, pid).withColumn("OutlierScore", F.coalesce("OutlierScore", F.lit(0.0)))


def _attr_diffs(points, k, attr, key, pid, lat, lon, geomodel="sphere"):
    """Neighbour rows with |attr(p) - attr(o)| over N_k(p) (ties included), cut: they are read several times."""
    nb = _knn_rows(points, k, key, pid, lat, lon, geomodel)
    na = points.select(F.col(key).alias(key), F.col(pid).alias("nid"),
                       F.col(attr).cast("double").alias("_na"))
    own = points.select(F.col(key).alias(key), F.col(pid).alias(pid),
                        F.col(attr).cast("double").alias("_a"))
    return cut_lineage(keyed_join(keyed_join(nb, na, [key, "nid"]), own, [key, pid])
                       .select(key, pid, "nid", F.abs(F.col("_a") - F.col("_na")).alias("_ad")))


@_points_once
def sof(points: DataFrame, k: int, attr: str, key="Species", pid="H3", lat="LAT", lon="LON",
    geomodel: str = "sphere"):
    """Spatial outlier factor (D24): LOF with spatial kNN neighbourhoods and
    attribute differences as distances.  lrd = 1 / mean |attr difference|
    (NULL when all neighbours share the attribute); SOF = mean neighbour lrd
    / own lrd."""
    d = _attr_diffs(points, k, attr, key, pid, lat, lon, geomodel)
    lrd = d.groupBy(key, pid).agg(F.try_divide(F.lit(1.0), F.avg("_ad")).alias("_lrd"))
    nl = lrd.select(key, F.col(pid).alias("nid"), F.col("_lrd").alias("_nl"))
    sc = (d.select(key, pid, "nid").join(nl, [key, "nid"]).groupBy(key, pid)
           .agg(F.avg("_nl").alias("_m")).join(lrd, [key, pid])
           .select(key, pid, F.try_divide(F.col("_m"), F.col("_lrd")).alias("OutlierScore")))
    return _attach(points, sc, key, pid)


@_points_once
def slom(points: DataFrame, k: int, attr: str, key="Species", pid="H3", lat="LAT", lon="LON",
    geomodel: str = "sphere"):
    """Spatial local outlier measure (D24, Chawla & Sun 2006).

    d~(p) = mean |attr difference| over N_k(p) without its largest value;
    over N = N_k(p) and p: avg = mean d~, n+ / n- = members with d~ above /
    below avg (equal within 1e-9 relative counts as neither), beta =
    (max(n+, n-) - min(n+, n-)) / (|N| - 2) (0 when |N| <= 2); SLOM = d~(p)
    * beta / (1 + avg).
    """
    d = _attr_diffs(points, k, attr, key, pid, lat, lon, geomodel)
    dt = cut_lineage(d.groupBy(key, pid)
           .agg(F.when(F.count(F.lit(1)) > 1,
                       (F.sum("_ad") - F.max("_ad")) / (F.count(F.lit(1)) - F.lit(1)))
                 .otherwise(F.max("_ad")).alias("_dt")))
    members = cut_lineage(keyed_join(
        d.select(key, pid, "nid").unionByName(dt.select(key, pid, F.col(pid).alias("nid"))),
        dt.select(key, F.col(pid).alias("nid"), F.col("_dt").alias("_ndt")), [key, "nid"]))
    avg = members.groupBy(key, pid).agg(F.avg("_ndt").alias("_avg"), F.count(F.lit(1)).alias("_n"))
    # Members equal to the mean count as neither above nor below it; the
    # tolerance absorbs summation-order rounding of the mean.
    tol = F.lit(1e-9) * (F.lit(1.0) + F.abs(F.col("_avg")))
    osc = (members.join(avg, [key, pid]).groupBy(key, pid, "_avg", "_n")
                  .agg(F.count_if(F.col("_ndt") - F.col("_avg") > tol).alias("_up"),
                       F.count_if(F.col("_avg") - F.col("_ndt") > tol).alias("_dn")))
    beta = F.when(F.col("_n") > 2, (F.greatest("_up", "_dn") - F.least("_up", "_dn"))
                  / (F.col("_n") - F.lit(2))).otherwise(F.lit(0.0))
    sc = (osc.join(dt, [key, pid])
             .select(key, pid, (F.col("_dt") * beta / (F.lit(1.0) + F.col("_avg"))).alias("OutlierScore")))
    return _attach(points, sc, key, pid)
