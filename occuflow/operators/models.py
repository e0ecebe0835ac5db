"""Grid and model-based outlier scores (D25-D30 subset)."""

from __future__ import annotations

import hashlib
import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from occuflow.session import broadcast_if_small, cut_lineage, ship_package


def hysortod(points: DataFrame, bins: int = 5, min_split: int = 100, key: str = "Species",
             pid: str = "H3", lat: str = "LAT", lon: str = "LON") -> DataFrame:
    """HySortOD (D30, Cabral & Cordeiro 2020) on (lat, lon) per group.

    Coordinates are min-max scaled per group and cut into ``bins`` bins per
    dimension (hypercubes).  The density of a hypercube is the number of
    points in the hypercubes within one bin in every dimension (its own
    included); score = 1 - density / max density in the group.  The paper's
    sorted-index search only speeds up this neighbour count; ``min_split``
    tunes that index and does not change scores, so it is accepted and
    ignored.  Planar coordinates, no geodesic (as the reference).
    """
    if bins < 1:
        raise ValueError("bins must be positive")
    ext = points.groupBy(key).agg(F.min(lat).alias("_la0"), F.max(lat).alias("_la1"),
                                  F.min(lon).alias("_lo0"), F.max(lon).alias("_lo1"))

    def cell(c, lo, hi):
        span = F.col(hi) - F.col(lo)
        scaled = F.when(span > 0, (F.col(c) - F.col(lo)) / span).otherwise(F.lit(0.0))
        return F.least(F.floor(scaled * F.lit(bins)), F.lit(bins - 1)).cast("int")

    binned = (points.join(ext, key)
                    .withColumn("_bi", cell(lat, "_la0", "_la1"))
                    .withColumn("_bj", cell(lon, "_lo0", "_lo1")))
    cube = binned.groupBy(key, "_bi", "_bj").agg(F.count(F.lit(1)).alias("_n"))
    offs = F.array(*[F.struct(F.lit(a).alias("di"), F.lit(b).alias("dj"))
                     for a in (-1, 0, 1) for b in (-1, 0, 1)])
    spread = (cube.select(key, "_bi", "_bj", "_n", F.explode(offs).alias("_o"))
                  .select(key, (F.col("_bi") + F.col("_o.di")).alias("_bi"),
                          (F.col("_bj") + F.col("_o.dj")).alias("_bj"), "_n"))
    dens = (spread.join(cube.select(key, "_bi", "_bj"), [key, "_bi", "_bj"])
                  .groupBy(key, "_bi", "_bj").agg(F.sum("_n").alias("_d")))
    mx = dens.groupBy(key).agg(F.max("_d").alias("_mx"))
    score = dens.join(mx, key).select(key, "_bi", "_bj",
                                      (F.lit(1.0) - F.col("_d") / F.col("_mx")).alias("OutlierScore"))
    return (binned.join(score, [key, "_bi", "_bj"])
                  .drop("_bi", "_bj", "_la0", "_la1", "_lo0", "_lo1"))


# ---------------------------------------------------------------------------
# Isolation forest (D29, Liu et al. 2008)

_NODE_SCHEMA = ("_k string, _t int, node int, feat int, split double, left int, right int, "
                "size long, depth int, psi int")
EULER_GAMMA = 0.5772156649015329


def _c_factor(n):
    """Average path length of an unsuccessful BST search over n points."""
    n = np.asarray(n, dtype=float)
    out = np.where(n > 2, 2.0 * (np.log(np.maximum(n - 1, 1)) + EULER_GAMMA) - 2.0 * (n - 1) / np.maximum(n, 1),
                   np.where(n == 2, 1.0, 0.0))
    return out


def _digits(*parts) -> tuple[float, float]:
    """Two uniforms in [0, 1) from an MD5 of the parts (the same on every engine)."""
    h = hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()
    return int(h[:8], 16) / 2.0 ** 32, int(h[8:16], 16) / 2.0 ** 32


def _build_tree(pdf: pd.DataFrame, sample_size: int, seed: int) -> pd.DataFrame:
    """One isolation tree; a node's split is drawn by a hash of its path of L and R."""
    pdf = pdf.sort_values(["_u", "_id"]).head(sample_size)
    k, t = pdf["_k"].iloc[0], int(pdf["_t"].iloc[0])
    x = pdf[["_lat", "_lon"]].to_numpy(float)
    limit = int(math.ceil(math.log2(max(len(x), 2))))
    nodes = []

    def grow(idx, path):
        me = len(nodes)
        nodes.append([me, -1, 0.0, -1, -1, len(idx), len(path)])
        if len(path) >= limit or len(idx) <= 1:
            return me
        lo, hi = x[idx].min(axis=0), x[idx].max(axis=0)
        feats = np.where(hi > lo)[0]
        if len(feats) == 0:
            return me
        which, where = _digits(seed, t, k, path)
        f = int(feats[int(which * len(feats))])
        s = float(lo[f] + where * (hi[f] - lo[f]))
        left = idx[x[idx, f] < s]
        right = idx[x[idx, f] >= s]
        nodes[me][1], nodes[me][2] = f, s
        nodes[me][3] = grow(left, path + "L")
        nodes[me][4] = grow(right, path + "R")
        return me

    grow(np.arange(len(x)), "")
    out = pd.DataFrame(nodes, columns=["node", "feat", "split", "left", "right", "size", "depth"])
    out.insert(0, "_t", t)
    out.insert(0, "_k", k)
    out["psi"] = len(x)
    return out


def _score_bucket(pts: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
    if pts.empty:
        return pd.DataFrame({"_k": [], "_id": [], "OutlierScore": []})
    x = pts[["_lat", "_lon"]].to_numpy(float)
    total = np.zeros(len(x))
    n_trees = 0
    psi = int(trees["psi"].max()) if len(trees) else 1
    for _, tr in trees.groupby("_t"):
        tr = tr.sort_values("node")
        feat, split = tr["feat"].to_numpy(), tr["split"].to_numpy()
        left, right = tr["left"].to_numpy(), tr["right"].to_numpy()
        size, depth = tr["size"].to_numpy(), tr["depth"].to_numpy()
        cur = np.zeros(len(x), dtype=int)
        while True:
            f = feat[cur]
            inner = f >= 0
            if not inner.any():
                break
            go_left = x[np.arange(len(x)), np.where(inner, f, 0)] < split[cur]
            nxt = np.where(go_left, left[cur], right[cur])
            cur = np.where(inner, nxt, cur)
        total += depth[cur] + _c_factor(size[cur])
        n_trees += 1
    mean_h = total / max(n_trees, 1)
    cn = float(_c_factor(psi)) or 1.0
    return pd.DataFrame({"_k": pts["_k"].to_numpy(), "_id": pts["_id"].to_numpy(),
                         "OutlierScore": np.power(2.0, -mean_h / cn)})


def isolation_forest(points: DataFrame, n_trees: int = 100, sample_size: int = 256,
                     seed: int = 42, key: str = "Species", pid: str = "H3", lat: str = "LAT",
                     lon: str = "LON", bucket_rows: int = 50_000) -> DataFrame:
    """Isolation-forest score per group on planar (lat, lon).

    * Sampling: each point joins tree ``t`` when a seeded hash of (t, group,
      id) falls under a per-group rate giving ~4x ``sample_size``
      candidates; the ``sample_size`` lowest hashes per (group, tree) build
      the tree.  Only candidates travel, a bounded number per tree.
    * Building: one small ``applyInPandas`` group per (group, tree).
    * Scoring: points are salted into buckets of at most ``bucket_rows``
      rows; the group's model (n_trees x at most 2 * sample_size nodes) is
      replicated per bucket and a cogrouped numpy traversal scores them, so
      a group with a third of all points still spreads over many tasks.

    Score = 2^(-E[h(x)] / c(psi)).  A seeded random model: scores match
    other implementations in distribution, not value by value.  All draws are
    MD5 digits of the seed, tree, group and point or path, so any engine can
    repeat them.
    """
    ship_package(points.sparkSession)
    pts = cut_lineage(points.select(F.col(key).cast("string").alias("_k"),
                                    F.col(pid).cast("string").alias("_id"),
                                    F.col(lat).cast("double").alias("_lat"),
                                    F.col(lon).cast("double").alias("_lon")))
    sizes = pts.groupBy("_k").agg(F.count(F.lit(1)).alias("_n"))
    rate = F.least(F.lit(1.0), F.lit(4.0 * sample_size) / F.col("_n"))

    # One MD5 serves four trees: a uniform from each of its 32-bit words.
    def draw(t):
        word = F.substring(F.element_at("_hs", F.floor(t / 4).cast("int") + 1), (t % 4) * 8 + 1, F.lit(8))
        return F.struct(t.alias("t"), (F.conv(word, 16, 10).cast("double") / F.lit(2.0 ** 32)).alias("u"))

    hashes = F.array(*[F.md5(F.concat_ws("|", F.lit(seed), F.lit(i), "_k", "_id")) for i in range(-(-n_trees // 4))])
    cand = (pts.join(sizes, "_k").withColumn("_hs", hashes)
               .withColumn("_d", F.explode(F.filter(F.transform(F.sequence(F.lit(0), F.lit(n_trees - 1)), draw),
                                                    lambda d: d["u"] < rate)))
               .select("_k", "_id", "_lat", "_lon", F.col("_d.t").alias("_t"), F.col("_d.u").alias("_u")))
    trees = cut_lineage(cand.groupBy("_k", "_t").applyInPandas(
        lambda pdf: _build_tree(pdf, sample_size, seed), _NODE_SCHEMA))

    buckets = sizes.withColumn("_nb", F.greatest(F.lit(1), F.ceil(F.col("_n") / F.lit(bucket_rows)))
                               .cast("int"))
    salted = (pts.join(buckets.select("_k", "_nb"), "_k")
                 .withColumn("_b", F.pmod(F.xxhash64(F.col("_id")), F.col("_nb")).cast("int"))
                 .drop("_nb"))
    model = (trees.join(buckets.select("_k", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1))
                                       .alias("_b")), "_k"))
    scored = (salted.groupBy("_k", "_b").cogroup(model.groupBy("_k", "_b"))
                    .applyInPandas(_score_bucket, "_k string, _id string, OutlierScore double"))
    out = points.withColumn("_k", F.col(key).cast("string")).withColumn("_id", F.col(pid).cast("string"))
    return out.join(scored, ["_k", "_id"], "left").drop("_k", "_id")


# ---------------------------------------------------------------------------
# Exact top-n per group without putting a group in one task.


def top_n_per_group(df: DataFrame, group: str, order: list, n: int, uid: str,
                    bucket_rows: int = 50_000, sizes: DataFrame | None = None) -> DataFrame:
    """Rows ranked 1..n per ``group`` by ``order`` (Columns, ties broken by ``uid``).

    Two levels: rows are salted into buckets of about ``bucket_rows`` per
    group and the top n of each bucket kept (windows over bounded buckets);
    the top n of a group is among those candidates (at most buckets x n
    rows), ranked by a second window.  Exact.  ``sizes`` (``group``, ``_gn``) spares
    counting the groups again.
    """
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("_gn")) if sizes is None else sizes
    salted = (df.join(sizes, group)
                .withColumn("_salt", F.pmod(F.xxhash64(F.col(uid)),
                                            F.greatest(F.lit(1), F.ceil(F.col("_gn") / F.lit(bucket_rows))))))
    w1 = Window.partitionBy(group, "_salt").orderBy(*order, F.col(uid))
    cand = salted.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= n)
    w2 = Window.partitionBy(group).orderBy(*order, F.col(uid))
    return (cand.withColumn("_rank", F.row_number().over(w2)).where(F.col("_rank") <= n)
                .drop("_salt", "_r1", "_gn"))


# Centres that are sent to all tasks; of more, groups meet their centres by a shuffle.
CENTRES_MAX = 1_000_000


def kmeans_minus_minus(points: DataFrame, k: int, l: int, max_iter: int = 200, seed: int = 42,
                       key: str = "Species", pid: str = "H3", lat: str = "LAT",
                       lon: str = "LON") -> DataFrame:
    """k-means-- (D27, Chawla & Gionis 2013) per group on planar (lat, lon).

    Each round: distance of every point to its nearest centre; the ``l``
    farthest points of the group are set aside; centres are recomputed from
    the rest.  A group leaves the rounds once none of its centres moves (one
    count per round reaches the driver).  Initial centres: the k points with
    the smallest seeded hash.  Output: ``cluster`` (index of the nearest
    centre), ``OutlierScore`` (distance to it), ``is_outlier`` (among the
    l set aside in the last round) and ``converged``: false for a group whose
    centres still moved after ``max_iter`` rounds.

    The centres of a group travel as one small array (k entries) and the
    nearest one is chosen with higher-order functions inside the scan, so
    points are never shuffled to meet their centres.
    """
    if k < 1 or l < 0:
        raise ValueError("k must be >= 1 and l >= 0")
    pts = cut_lineage(points.select(F.col(key).alias("_k"), F.col(pid).cast("string").alias("_id"),
                                    F.col(lat).cast("double").alias("_x"),
                                    F.col(lon).cast("double").alias("_y")))
    sizes = cut_lineage(pts.groupBy("_k").agg(F.count(F.lit(1)).alias("_gn")))
    # groups only become fewer, so their number is checked once
    few = sizes.count() * k <= CENTRES_MAX
    init = top_n_per_group(pts.withColumn("_h", F.md5(F.concat_ws("|", F.lit(seed), "_k", "_id"))),
                           "_k", [F.col("_h")], k, "_id", sizes=sizes)
    centres = cut_lineage(init.select("_k", (F.col("_rank") - 1).alias("c"), "_x", "_y"))

    def as_arrays(c: DataFrame) -> DataFrame:
        arr = c.groupBy("_k").agg(F.sort_array(F.collect_list(F.struct("c", "_x", "_y"))).alias("_cs"))
        return F.broadcast(arr) if few else arr

    def nearest(arr: DataFrame) -> DataFrame:
        d2 = lambda s: F.pow(s["_x"] - F.col("_x"), 2) + F.pow(s["_y"] - F.col("_y"), 2)
        best = F.aggregate(
            F.col("_cs"), F.struct(F.lit(-1).alias("c"), F.lit(float("inf")).alias("d2")),
            lambda acc, s: F.when(d2(s) < acc["d2"], F.struct(s["c"].alias("c"), d2(s).alias("d2")))
                            .otherwise(acc))
        return (pts.join(arr, "_k").withColumn("_best", best)
                   .select("_k", "_id", "_x", "_y", F.col("_best.c").alias("cluster"),
                           F.sqrt(F.col("_best.d2")).alias("_d")))

    arr, done, moving = as_arrays(centres), [], centres
    for _ in range(max_iter):
        assigned = cut_lineage(nearest(arr))
        far = top_n_per_group(assigned, "_k", [F.col("_d").desc()], l, "_id", sizes=sizes) if l else None
        kept = assigned.join(far.select("_k", "_id"), ["_k", "_id"], "left_anti") if l else assigned
        new = kept.groupBy("_k", F.col("cluster").alias("c")).agg(F.avg("_x").alias("_x"),
                                                                   F.avg("_y").alias("_y"))
        # centres that lost all points stay where they were
        old = moving.select("_k", "c", F.col("_x").alias("_ox"), F.col("_y").alias("_oy"))
        merged = (old.join(new, ["_k", "c"], "left")
                     .select("_k", "c", F.coalesce("_x", "_ox").alias("_x"),
                             F.coalesce("_y", "_oy").alias("_y"),
                             ((F.abs(F.coalesce("_x", "_ox") - F.col("_ox")) > F.lit(1e-9))
                              | (F.abs(F.coalesce("_y", "_oy") - F.col("_oy")) > F.lit(1e-9)))
                             .alias("_moved")))
        merged = cut_lineage(merged)
        still = merged.where("_moved").select("_k").distinct()
        done.append(merged.join(still, "_k", "left_anti").drop("_moved").withColumn("converged", F.lit(True)))
        moving = merged.join(still, "_k", "left_semi").drop("_moved")
        arr = as_arrays(moving)
        if moving.isEmpty():
            break
    settled = reduce(DataFrame.unionByName, [*done, moving.withColumn("converged", F.lit(False))])
    arr = as_arrays(settled.drop("converged"))
    converged = settled.select("_k", "converged").distinct()
    final = cut_lineage(nearest(arr))
    far = (top_n_per_group(final, "_k", [F.col("_d").desc()], l, "_id", sizes=sizes)
           .select("_k", "_id", F.lit(True).alias("is_outlier")) if l else None)
    res = final.select("_k", "_id", "cluster", F.col("_d").alias("OutlierScore"))
    if far is not None:
        res = res.join(far, ["_k", "_id"], "left")
    else:
        res = res.withColumn("is_outlier", F.lit(None).cast("boolean"))
    res = res.withColumn("is_outlier", F.coalesce("is_outlier", F.lit(False))).join(converged, "_k")
    out = points.withColumn("_k", F.col(key)).withColumn("_id", F.col(pid).cast("string"))
    return out.join(res, ["_k", "_id"], "left").drop("_k", "_id")


def em_outlier(points: DataFrame, k: int = 3, max_iter: int = 100, tol: float = 1e-3,
               seed: int = 42, key: str = "Species", pid: str = "H3", lat: str = "LAT",
               lon: str = "LON") -> DataFrame:
    """EM outlier score (D26): a k-component 2-D Gaussian mixture per group
    on planar (lat, lon); score = -log of the largest weighted component
    density at the point (higher = more outlying).

    E-step: each point meets its group's component array (k entries,
    broadcast when small) and computes responsibilities with higher-order
    functions in the scan.  M-step: responsibility-weighted sums per (group,
    component), partially aggregated map-side.  A group leaves the rounds when
    its per-point mean log-likelihood changes by at most ``tol`` (1e-3, the
    usual convention of mixture-model fitting; one count per round reaches
    the driver); ``converged`` is false for a group that had not settled after
    ``max_iter`` rounds.  Densities stay logarithms throughout, so points far
    from every component keep their mass and their order.  Initial means:
    the k points with the smallest seeded hash; initial covariance: the
    group's covariance; a 1e-6 ridge keeps covariances invertible.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    ridge = 1e-6
    pts = cut_lineage(points.select(F.col(key).alias("_k"), F.col(pid).cast("string").alias("_id"),
                                    F.col(lat).cast("double").alias("_x"),
                                    F.col(lon).cast("double").alias("_y")))
    cov = pts.groupBy("_k").agg(F.var_pop("_x").alias("_vx"), F.var_pop("_y").alias("_vy"),
                                F.covar_pop("_x", "_y").alias("_cxy"))
    init = top_n_per_group(pts.withColumn("_h", F.md5(F.concat_ws("|", F.lit(seed), "_k", "_id"))),
                           "_k", [F.col("_h")], k, "_id")
    comps = (init.join(cov, "_k")
                 .select("_k", (F.col("_rank") - 1).alias("c"), F.lit(1.0 / k).alias("w"),
                         F.col("_x").alias("mx"), F.col("_y").alias("my"),
                         (F.col("_vx") + ridge).alias("sxx"), F.col("_cxy").alias("sxy"),
                         (F.col("_vy") + ridge).alias("syy")))

    def as_arrays(c: DataFrame) -> DataFrame:
        arr = c.groupBy("_k").agg(F.sort_array(F.collect_list(
            F.struct("c", "w", "mx", "my", "sxx", "sxy", "syy"))).alias("_cs"))
        return broadcast_if_small(arr, max_rows=1_000_000)

    def log_density(s):
        det = s["sxx"] * s["syy"] - s["sxy"] * s["sxy"]
        dx, dy = F.col("_x") - s["mx"], F.col("_y") - s["my"]
        q = (s["syy"] * dx * dx - F.lit(2.0) * s["sxy"] * dx * dy + s["sxx"] * dy * dy) / det
        return F.log(s["w"]) - q / F.lit(2.0) - F.lit(math.log(2.0 * math.pi)) - F.log(det) / F.lit(2.0)

    def e_step(arr: DataFrame) -> DataFrame:
        return (pts.join(arr, "_k").withColumn("_ld", F.transform(F.col("_cs"), log_density))
                   .withColumn("_best", F.array_max("_ld"))
                   .withColumn("_lt", F.col("_best") + F.log(F.aggregate(
                       "_ld", F.lit(0.0), lambda a, v: a + F.exp(v - F.col("_best"))))))

    arr = as_arrays(comps)
    prev, done, moving = None, [], comps
    for _ in range(max_iter):
        e = e_step(arr)
        resp = e.select("_k", "_x", "_y", "_lt",
                        F.posexplode(F.transform("_ld", lambda v: F.exp(v - F.col("_lt")))).alias("c", "_r"))
        # One pass per round: the component sums and, on component 0 only
        # (one row per point), the log-likelihood terms.
        m = cut_lineage(resp.groupBy("_k", "c")
                 .agg(F.sum(F.when(F.col("c") == 0, F.col("_lt"))).alias("_ll0"),
                      F.sum(F.when(F.col("c") == 0, F.lit(1))).alias("_np"),
                      F.sum("_r").alias("_n"), F.sum(F.col("_r") * F.col("_x")).alias("_sx"),
                      F.sum(F.col("_r") * F.col("_y")).alias("_sy"),
                      F.sum(F.col("_r") * F.col("_x") * F.col("_x")).alias("_sxx"),
                      F.sum(F.col("_r") * F.col("_x") * F.col("_y")).alias("_sxy"),
                      F.sum(F.col("_r") * F.col("_y") * F.col("_y")).alias("_syy")))
        tot = m.groupBy("_k").agg(F.sum("_n").alias("_ntot"))
        mx, my = F.col("_sx") / F.col("_n"), F.col("_sy") / F.col("_n")
        new = (m.join(tot, "_k").where(F.col("_n") > 0)
                .select("_k", "c", (F.col("_n") / F.col("_ntot")).alias("w"), mx.alias("mx"), my.alias("my"),
                        (F.col("_sxx") / F.col("_n") - mx * mx + F.lit(ridge)).alias("sxx"),
                        (F.col("_sxy") / F.col("_n") - mx * my).alias("sxy"),
                        (F.col("_syy") / F.col("_n") - my * my + F.lit(ridge)).alias("syy")))
        new = cut_lineage(new)
        ll = m.where(F.col("c") == 0).select("_k", (F.col("_ll0") / F.col("_np")).alias("_ll"))
        still = ll.select("_k")
        if prev is not None:
            still = (ll.join(prev.withColumnRenamed("_ll", "_pl"), "_k")
                       .where(F.abs(F.col("_ll") - F.col("_pl")) > F.lit(tol)).select("_k"))
            done.append(new.join(still, "_k", "left_anti").withColumn("converged", F.lit(True)))
        moving = new.join(still, "_k", "left_semi")
        arr = as_arrays(moving)
        if arr.isEmpty():
            break
        prev = ll
    settled = reduce(DataFrame.unionByName, [*done, moving.withColumn("converged", F.lit(False))])
    converged = settled.select("_k", "converged").distinct()
    final = (e_step(as_arrays(settled.drop("converged")))
             .select("_k", "_id", (-F.col("_best")).alias("OutlierScore")).join(converged, "_k"))
    out = points.withColumn("_k", F.col(key)).withColumn("_id", F.col(pid).cast("string"))
    return out.join(final, ["_k", "_id"], "left").drop("_k", "_id")


# aLOCI: sampling levels of a pass; finest level whose boxes doubles in [0, 1] still tell apart.
_ALOCI_LEVELS, _ALOCI_DEEPEST = 7, 52


# Steps of the grid shifts, which spread evenly over the unit square.
_SHIFT_U, _SHIFT_V = 0.7548776662466927, 0.5698402909980532


def grid_shifts(grids: int) -> list[tuple[float, float]]:
    """Shift of every box hierarchy; the first is not shifted."""
    return [(i * _SHIFT_U % 1.0, i * _SHIFT_V % 1.0) for i in range(grids)]


def aloci(points: DataFrame, nmin: int = 20, alpha: int = 4, depth: int | None = None, grids: int = 1,
          key: str = "Species", pid: str = "H3", lat: str = "LAT", lon: str = "LON") -> DataFrame:
    """Approximate LOCI (D25, Papadimitriou et al. 2003) on planar (lat, lon).

    Coordinates are min-max scaled per group into the unit square and
    counted in ``grids`` quad-trees of boxes, each shifted by its own vector
    (level l: boxes of side 2^-l; one aggregate over the levels of a pass).
    For each sampling level l a point's counting box is, of its level-(l +
    alpha) boxes in all grids, the one whose centre is nearest to it; its
    sampling box is, of the level-l boxes that hold this centre, the one whose
    centre is nearest to it (ties: the first grid).  With n the counting box's
    count and c the sub-boxes of the sampling box at level l + alpha: n_hat =
    sum c^2 / sum c, sigma = sqrt(sum c^3 / sum c - n_hat^2); MDEF = 1 - n /
    n_hat, score = max over levels with sum c >= nmin of MDEF / (sigma / n_hat).

    Levels end with the points: a pass takes on only points in or beside a box
    of nmin points that are not all in one place, as no other box is ever
    scored.  ``depth`` (the finest counting level) cuts this short.
    """
    deepest = _ALOCI_DEEPEST if depth is None else depth
    if not 1 <= alpha < deepest <= _ALOCI_DEEPEST:
        raise ValueError(f"need 1 <= alpha < depth <= {_ALOCI_DEEPEST}")
    if isinstance(grids, bool) or int(grids) != grids or grids < 1:
        raise ValueError("grids must be a positive integer")
    shifts = grid_shifts(grids)
    ext = points.groupBy(key).agg(F.min(lat).alias("_la0"), F.max(lat).alias("_la1"),
                                  F.min(lon).alias("_lo0"), F.max(lon).alias("_lo1"))

    def unit(c, lo, hi):
        span = F.col(hi) - F.col(lo)
        return F.when(span > 0, (F.col(c) - F.col(lo)) / span).otherwise(F.lit(0.0))

    base = cut_lineage(points.join(ext, key)
                             .select(F.col(key).alias("_k"), F.col(pid).alias("_id"),
                                     unit(lat, "_la0", "_la1").alias("_u"),
                                     unit(lon, "_lo0", "_lo1").alias("_v")))

    def box(c: F.Column, level, shift: float) -> F.Column:
        # the far edge of the unit square belongs to the last box of the unshifted grid
        n = F.pow(F.lit(2.0), level)
        return (F.least(F.floor(c * n), n - 1) if shift == 0 else F.floor((c + F.lit(shift)) * n)).cast("long")

    def in_grid(i: int, u, v, level) -> tuple[F.Column, F.Column]:
        return box(u, level, shifts[i][0]), box(v, level, shifts[i][1])

    def centred(u, v, level) -> F.Column:
        """The (distance, grid, box, box's centre) around a place that is best centred on it."""
        side = F.pow(F.lit(2.0), -level)
        out = []
        for i, (su, sv) in enumerate(shifts):
            bi, bj = in_grid(i, u, v, level)
            cu, cv = (bi + 0.5) * side - su, (bj + 0.5) * side - sv
            # rounded: equal distances must not be told apart by their last digit
            d = F.round(F.pow((cu - u) / side, 2) + F.pow((cv - v) / side, 2), 9)
            out.append(F.struct(d.alias("d"), F.lit(i).alias("g"), bi.alias("i"), bj.alias("j"), cu.alias("u"), cv.alias("v")))
        return F.array_min(F.array(*out)) if len(out) > 1 else out[0]

    active, first, scored = base, 0, []
    while True:
        until = min(first + _ALOCI_LEVELS, deepest - alpha + 1)  # sampling levels first .. until - 1
        at = F.col("_l").cast("double")
        lv = active.select("_k", "_id", "_u", "_v", F.explode(F.sequence(F.lit(first), F.lit(until - 1 + alpha))).alias("_l"))
        every = F.array(*[F.struct(F.lit(i).alias("g"), *[c.alias(n) for c, n in zip(
            in_grid(i, F.col("_u"), F.col("_v"), at), ("i", "j"))]) for i in range(grids)])
        counts = cut_lineage(lv.select("_k", "_l", F.explode(every).alias("_b"))
                               .select("_k", "_l", F.col("_b.g").alias("_g"), F.col("_b.i").alias("_bi"), F.col("_b.j").alias("_bj"))
                               .groupBy("_k", "_l", "_g", "_bi", "_bj").agg(F.count(F.lit(1)).alias("_c")))
        # Sub-box moments of each sampling box: level l + alpha boxes grouped by parent.
        sub = (counts.where(F.col("_l") >= first + alpha)
                     .select("_k", "_g", (F.col("_l") - alpha).alias("_l"),
                             F.shiftright("_bi", alpha).alias("_bi"), F.shiftright("_bj", alpha).alias("_bj"),
                             "_c")
                     .groupBy("_k", "_l", "_g", "_bi", "_bj")
                     .agg(F.sum("_c").alias("_s1"), F.sum(F.col("_c") * F.col("_c")).alias("_s2"),
                          F.sum(F.pow("_c", 3)).alias("_s3")))
        fine = counts.select("_k", F.col("_l").alias("_cl"), F.col("_g").alias("_cg"), F.col("_bi").alias("_ci"),
                             F.col("_bj").alias("_cj"), F.col("_c").alias("_n"))
        counting = centred(F.col("_u"), F.col("_v"), F.col("_cl").cast("double"))
        # inline makes plain columns of the chosen box, computed once
        mine = (lv.where(F.col("_l") < until).withColumn("_cl", F.col("_l") + alpha)
                  .select("_k", "_id", "_l", "_cl", F.inline(F.array(counting)))
                  .withColumnsRenamed({"g": "_cg", "i": "_ci", "j": "_cj", "u": "_cu", "v": "_cv"}).drop("d")
                  .join(fine, ["_k", "_cl", "_cg", "_ci", "_cj"]))
        sampling = centred(F.col("_cu"), F.col("_cv"), at) if grids > 1 else F.struct(
            F.lit(0).alias("g"), F.shiftright("_ci", alpha).alias("i"), F.shiftright("_cj", alpha).alias("j"))
        scored.append(mine.select("_k", "_id", "_l", "_n", F.inline(F.array(sampling)))
                          .withColumnsRenamed({"g": "_g", "i": "_bi", "j": "_bj"})
                          .join(sub.where(F.col("_s1") >= nmin), ["_k", "_l", "_g", "_bi", "_bj"])
                          .withColumn("_nh", F.col("_s2") / F.col("_s1"))
                          .withColumn("_sd", F.sqrt(F.greatest(F.lit(0.0),
                                                              F.col("_s3") / F.col("_s1") - F.col("_nh") * F.col("_nh"))))
                          .where(F.col("_sd") > 0)
                          .select("_k", "_id",
                                  ((F.lit(1.0) - F.col("_n") / F.col("_nh")) / (F.col("_sd") / F.col("_nh"))).alias("_r")))
        if until > deepest - alpha:
            break
        # Full boxes of the next level; a counting box's centre is less than its side away
        # from the point, so a point's sampling box holds one of the places around it.
        level, off = F.lit(float(until)), 2.0 ** -(until + alpha)
        places = [(F.col("_u"), F.col("_v"))] if grids == 1 else [
            (F.col("_u") + a, F.col("_v") + b) for a in (-off, off) for b in (-off, off)]

        def boxes(around) -> F.Column:
            return F.array_distinct(F.array(*[F.struct(F.lit(i).alias("g"), *[c.alias(n) for c, n in zip(
                in_grid(i, u, v, level), ("i", "j"))]) for i in range(grids) for u, v in around]))

        held = active.select("*", F.explode(boxes([(F.col("_u"), F.col("_v"))])).alias("_b"))
        full = (held.groupBy("_k", "_b").agg(
                    F.count(F.lit(1)).alias("_c"), (F.max("_u") - F.min("_u")).alias("_du"),
                    (F.max("_v") - F.min("_v")).alias("_dv"))
                  .where((F.col("_c") >= nmin) & ((F.col("_du") > 0) | (F.col("_dv") > 0))).select("_k", "_b"))
        near = active.select("*", F.explode(boxes(places)).alias("_b")).join(full, ["_k", "_b"], "left_semi")
        active = cut_lineage(near.select("_k", "_id", "_u", "_v").distinct())
        if active.isEmpty():
            break
        first = until
    per_level = reduce(DataFrame.unionByName, scored)
    sc = per_level.groupBy("_k", "_id").agg(F.max("_r").alias("OutlierScore"))
    out = points.withColumn("_k", F.col(key)).withColumn("_id", F.col(pid))
    return (out.join(sc, ["_k", "_id"], "left")
               .withColumn("OutlierScore", F.coalesce("OutlierScore", F.lit(0.0)))
               .drop("_k", "_id"))
