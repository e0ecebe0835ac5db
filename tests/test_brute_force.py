"""Density and kNN operators against numpy brute force on small point sets.

The sets include a tight hot cluster (a third of the points), isolated
points, poles and the antimeridian.
"""

from collections import Counter, defaultdict

import numpy as np
import pytest

from conftest import SF_SMALL
from occuflow.functions.geo import EARTH_RADIUS_M
from occuflow.operators import density, knn, models

R = EARTH_RADIUS_M


def make_points(seed=7, n=240):
    rng = np.random.default_rng(seed)
    rows = []
    for g in ("A", "B"):
        hot = n // 3
        lat = np.concatenate([rng.normal(45, 0.3, hot), rng.uniform(-89.9, 89.9, n - hot - 4),
                              [89.95, -89.95, 10.0, 10.0]])
        lon = np.concatenate([rng.normal(7, 0.3, hot), rng.uniform(-180, 180, n - hot - 4),
                              [0.0, 120.0, 179.999, -179.999]])
        for i, (a, b) in enumerate(zip(lat, lon)):
            rows.append((g, f"{g}{i:04d}", float(a), float(b)))
    return rows


def hav(lat1, lon1, lat2, lon2):
    p1, p2 = np.radians(lat1), np.radians(lat2)
    h = (np.sin(np.radians(lat2 - lat1) / 2) ** 2
         + np.cos(p1) * np.cos(p2) * np.sin(np.radians(lon2 - lon1) / 2) ** 2)
    return 2 * R * np.arcsin(np.sqrt(np.minimum(1.0, h)))


def brute(rows):
    out = {}
    for g in sorted({r[0] for r in rows}):
        pts = [r for r in rows if r[0] == g]
        lat = np.array([r[2] for r in pts])
        lon = np.array([r[3] for r in pts])
        d = hav(lat[:, None], lon[:, None], lat[None, :], lon[None, :])
        out[g] = ([r[1] for r in pts], d)
    return out


@pytest.fixture(scope="module")
def points(spark):
    rows = make_points()
    return rows, spark.createDataFrame(rows, "Species string, H3 string, LAT double, LON double")


@pytest.mark.parametrize("eps,minpts", [(1_000_000.0, 3), (300_000.0, 4), (50_000.0, 2)])
def test_dbscan_noise_matches_brute_force(spark, points, eps, minpts):
    rows, df = points
    got = {(r.Species, r.H3): r.OutlierScore
           for r in density.dbscan_noise(df, eps, minpts).collect()}
    for g, (ids, d) in brute(rows).items():
        within = d <= eps
        core = within.sum(axis=1) >= minpts
        noise = ~core & ~(within & core[None, :]).any(axis=1)
        for i, pid in enumerate(ids):
            assert got[(g, pid)] == (1.0 if noise[i] else 0.0), (g, pid)


def test_dbscan_noise_independent_of_partitioning(spark, points):
    _, df = points
    a = sorted(density.dbscan_noise(df, 300_000.0, 4).collect())
    b = sorted(density.dbscan_noise(df.repartition(7), 300_000.0, 4).collect())
    assert a == b


def test_neighbour_counts_match_brute_force(spark, points):
    rows, df = points
    got = {(r.Species, r.H3): r.n_neighbours
           for r in density.neighbour_counts(df, 400_000.0).collect()}
    for g, (ids, d) in brute(rows).items():
        n = (d <= 400_000.0).sum(axis=1)
        for i, pid in enumerate(ids):
            assert got[(g, pid)] == n[i]


@pytest.mark.parametrize("k", [1, 5, 12])
def test_knn_matches_brute_force(spark, points, k):
    rows, df = points
    nb = knn.knn(df, k).collect()
    by_point = {}
    for r in nb:
        by_point.setdefault((r.Species, r.H3), []).append(r)
    for g, (ids, d) in brute(rows).items():
        dmm = np.floor(d * 1000 + 0.5)
        for i, pid in enumerate(ids):
            others = np.delete(dmm[i], i)
            kth = np.sort(others)[k - 1]
            expected = {ids[j] for j in range(len(ids)) if j != i and dmm[i, j] <= kth}
            got = by_point[(g, pid)]
            assert {r.nid for r in got} == expected, (g, pid)
            assert max(r.dist_m for r in got if r.rank <= k) == pytest.approx(kth / 1000.0)


def test_lof_matches_brute_force(spark, points):
    rows, df = points
    k = 6
    got = {(r.Species, r.H3): r.OutlierScore for r in knn.lof(df, k).collect()}
    for g, (ids, d) in brute(rows).items():
        dmm = np.floor(d * 1000 + 0.5) / 1000.0
        np.fill_diagonal(dmm, np.inf)
        kd = np.sort(dmm, axis=1)[:, k - 1]
        nbrs = [np.where(dmm[i] <= kd[i])[0] for i in range(len(ids))]
        lrd = np.array([len(nb) / np.maximum(kd[nb], dmm[i, nb]).sum()
                        for i, nb in enumerate(nbrs)])
        for i, pid in enumerate(ids):
            assert got[(g, pid)] == pytest.approx(lrd[nbrs[i]].mean() / lrd[i], rel=1e-9)


def brute_dbscan(d, eps, minpts, w=None):
    n = len(d)
    w = np.ones(n) if w is None else np.asarray(w, float)
    within = d <= eps
    core = (within * w[None, :]).sum(axis=1) >= minpts
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i
    for i in range(n):
        if core[i]:
            for j in np.where(within[i] & core)[0]:
                parent[find(i)] = find(j)
    comp = {i: find(i) for i in range(n) if core[i]}
    return within, core, comp


@pytest.mark.parametrize("eps,minpts", [(300_000.0, 4), (1_500_000.0, 3)])
def test_dbscan_labels_match_brute_force(spark, points, eps, minpts):
    rows, df = points
    got = {(r.Species, r.H3): (r.cluster, r.is_core)
           for r in density.dbscan_labels(df, eps, minpts).collect()}
    for g, (ids, d) in brute(rows).items():
        within, core, comp = brute_dbscan(d, eps, minpts)
        # same partition of core points
        mapping = {}
        for i, pid in enumerate(ids):
            lab, is_core = got[(g, pid)]
            assert is_core == bool(core[i])
            if core[i]:
                assert mapping.setdefault(comp[i], lab) == lab
        assert len(set(mapping.values())) == len(mapping)
        # border points join a neighbouring cluster; noise is -1
        for i, pid in enumerate(ids):
            if core[i]:
                continue
            lab = got[(g, pid)][0]
            nbr = {mapping[comp[j]] for j in np.where(within[i] & core)[0]}
            assert (lab == -1) if not nbr else (lab in nbr)


def test_density_sweep_agrees_with_dbscan_noise(spark, points):
    _, df = points
    sweep = knn.density_sweep(df, 3, [300_000.0, 1_000_000.0]).collect()
    for eps in (300_000.0, 1_000_000.0):
        ref = {(r.Species, r.H3): r.OutlierScore for r in density.dbscan_noise(df, eps, 3).collect()}
        col = f"noise_{int(eps)}"
        assert {(r.Species, r.H3): r[col] for r in sweep} == ref


def test_remove_by_clustering_counts_duplicates(spark):
    rows = [(float(i % 3) * 0.01, 0.0) for i in range(6)] + [(50.0, 50.0), (50.0, 50.0),
                                                            (-40.0, 100.0), (None, None)]
    df = spark.createDataFrame(rows, "decimallatitude double, decimallongitude double")
    kept, out = density.remove_by_clustering(df, 100.0, 3)
    assert kept.count() + out.count() == df.count()
    # the duplicated pair has weight 2 < 3 and no core neighbour: noise
    assert sorted((r[0], r[1]) for r in out.collect() if r[0] is not None) == [
        (-40.0, 100.0), (50.0, 50.0), (50.0, 50.0)]
    kept, out = density.remove_by_clustering(df, 100.0, 2)
    assert sorted(r[0] for r in out.collect() if r[0] is not None) == [-40.0]


def _knn_sets(d, k):
    dmm = np.floor(d * 1000 + 0.5) / 1000.0
    np.fill_diagonal(dmm, np.inf)
    order = np.lexsort((np.arange(len(d))[None, :].repeat(len(d), 0), dmm), axis=1)
    return dmm, order[:, :k]


def test_cof_matches_brute_force(spark, points):
    rows, df = points
    k = 4
    got = {(r.Species, r.H3): r.OutlierScore for r in knn.cof(df, k).collect()}
    for g, (ids, d) in brute(rows).items():
        dmm, nn = _knn_sets(d, k)
        np.fill_diagonal(dmm, 0.0)
        ac = []
        for i in range(len(ids)):
            members = [i] + list(nn[i])
            in_set = [members[0]]
            rest = members[1:]
            total = 0.0
            for step in range(1, k + 1):
                dist, pick = min((dmm[a, b], b) for a in in_set for b in rest)
                total += 2.0 * (k + 1 - step) / (k * (k + 1)) * dist
                in_set.append(pick)
                rest.remove(pick)
            ac.append(total)
        ac = np.array(ac)
        for i, pid in enumerate(ids):
            assert got[(g, pid)] == pytest.approx(ac[i] / ac[nn[i]].mean(), rel=1e-9)


def test_loop_matches_brute_force(spark, points):
    import math
    rows, df = points
    k = 5
    got = {(r.Species, r.H3): r.OutlierScore for r in knn.loop(df, k).collect()}
    for g, (ids, d) in brute(rows).items():
        dmm, nn = _knn_sets(d, k)
        pdist = np.array([2.0 * np.sqrt(np.mean(dmm[i, nn[i]] ** 2)) for i in range(len(ids))])
        plof = np.array([pdist[i] / pdist[nn[i]].mean() - 1 for i in range(len(ids))])
        nplof = 2.0 * np.sqrt(np.mean(plof ** 2))
        for i, pid in enumerate(ids):
            exp = max(0.0, math.erf(plof[i] / (nplof * math.sqrt(2))))
            assert got[(g, pid)] == pytest.approx(exp, abs=2e-7)


def test_isolation_forest_separates_and_is_deterministic(spark):
    from occuflow.operators import models
    rng = np.random.default_rng(3)
    rows = [("A", f"a{i}", float(a), float(b)) for i, (a, b) in enumerate(rng.normal(0, 1, (1500, 2)))]
    rows += [("A", "far", 9.0, -9.0), ("B", "b0", 0.0, 0.0)]
    df = spark.createDataFrame(rows, "Species string, H3 string, LAT double, LON double")
    one = {r.H3: r.OutlierScore for r in models.isolation_forest(df, bucket_rows=400).collect()}
    two = {r.H3: r.OutlierScore
           for r in models.isolation_forest(df.repartition(3), bucket_rows=100).collect()}
    assert one == two
    normal = np.array([v for k, v in one.items() if k.startswith("a")])
    assert one["far"] > np.quantile(normal, 0.99) and 0 < normal.min() and normal.max() <= 1


def test_wgs84_band_predicate_matches_vincenty(spark):
    from pyspark.sql import functions as F
    from occuflow.functions.geo import vincenty_np, within_eps
    rng = np.random.default_rng(5)
    a = rng.uniform(-80, 80, (400, 2))
    b = a + rng.normal(0, 6, (400, 2))
    rows = [tuple(map(float, (p[0], p[1], q[0], q[1]))) for p, q in zip(a, b)]
    df = spark.createDataFrame(rows, "la1 double, lo1 double, la2 double, lo2 double")
    eps = 600_000.0
    got = [r[0] for r in df.select(within_eps("la1", "lo1", "la2", "lo2", eps, "wgs84")).collect()]
    exp = vincenty_np(a[:, 0], a[:, 1], b[:, 0], b[:, 1]) <= eps
    assert got == list(exp)


def test_knn_sos_matches_brute_force(spark, points):
    from occuflow.operators.knn import _binding_probabilities
    rows, df = points
    k, h = 9, 3.0
    got = {(r.Species, r.H3): r.OutlierScore for r in knn.knn_sos(df, k, h).collect()}
    for g, (ids, d) in brute(rows).items():
        dmm, nn = _knn_sets(d, k)
        dist = np.take_along_axis(dmm, nn, axis=1)
        b = _binding_probabilities(dist, h)
        ent = -(b * np.log(b)).sum(axis=1)
        assert np.allclose(ent, np.log(h), atol=1e-6)
        prob = np.ones(len(ids))
        for i in range(len(ids)):
            for j, bij in zip(nn[i], b[i]):
                prob[j] *= 1 - bij
        for i, pid in enumerate(ids):
            assert got[(g, pid)] == pytest.approx(prob[i], rel=1e-6, abs=1e-12)


def test_top_n_per_group_is_exact(spark):
    from occuflow.operators.models import top_n_per_group
    rng = np.random.default_rng(11)
    rows = [("A" if i < 900 else "B", f"p{i}", float(v)) for i, v in enumerate(rng.integers(0, 50, 1000))]
    df = spark.createDataFrame(rows, "g string, id string, v double")
    from pyspark.sql import functions as F
    got = top_n_per_group(df, "g", [F.col("v").desc()], 7, "id", bucket_rows=60).collect()
    for g in ("A", "B"):
        exp = sorted([r for r in rows if r[0] == g], key=lambda r: (-r[2], r[1]))[:7]
        assert sorted((r.id, r._rank) for r in got if r.g == g) == sorted(
            (r[1], i + 1) for i, r in enumerate(exp))


def test_kmeans_minus_minus_fixed_point(spark):
    from occuflow.operators.models import kmeans_minus_minus
    rng = np.random.default_rng(2)
    centres = np.array([[0, 0], [20, 20], [-20, 30]])
    pts = np.vstack([c + rng.normal(0, 1, (150, 2)) for c in centres] + [[[60, -60], [-60, 80]]])
    rows = [("S", f"p{i:03d}", float(a), float(b)) for i, (a, b) in enumerate(pts)]
    df = spark.createDataFrame(rows, "Species string, H3 string, LAT double, LON double")
    res = kmeans_minus_minus(df, k=3, l=2).collect()
    out = {r.H3 for r in res if r.is_outlier}
    assert out == {"p450", "p451"}
    # the outliers are the two farthest from their centre
    far = sorted(res, key=lambda r: (-r.OutlierScore, r.H3))[:2]
    assert {r.H3 for r in far} == out
    # centres are the means of the kept points of each cluster: every kept
    # point's distance to its cluster mean equals its score
    by_c = {}
    for r in res:
        if not r.is_outlier:
            by_c.setdefault(r.cluster, []).append((r.LAT, r.LON))
    assert len(by_c) == 3
    means = {c: np.mean(v, axis=0) for c, v in by_c.items()}
    for r in res:
        d = min(np.hypot(r.LAT - m[0], r.LON - m[1]) for m in means.values())
        assert r.OutlierScore == pytest.approx(d, abs=1e-6)


def test_em_outlier_ranks_planted_outliers_highest(spark):
    from occuflow.operators.models import em_outlier
    rng = np.random.default_rng(4)
    pts = np.vstack([rng.normal([0, 0], [1, 2], (200, 2)), rng.normal([15, -10], [2, 1], (200, 2)),
                     [[40, 40], [-30, 25]]])
    rows = [("S", f"p{i:03d}", float(a), float(b)) for i, (a, b) in enumerate(pts)]
    rows += [("T", f"t{i}", float(i), float(-i)) for i in range(5)]
    df = spark.createDataFrame(rows, "Species string, H3 string, LAT double, LON double")
    res = {r.H3: r.OutlierScore for r in em_outlier(df, k=2).collect()}
    s = sorted((v, k) for k, v in res.items() if k.startswith("p"))
    assert {s[-1][1], s[-2][1]} == {"p400", "p401"}
    assert all(np.isfinite(v) for v in res.values())


def _aloci_scores(lat, lon, depth, nmin=20, alpha=4):
    unit = [(v - v.min()) / (v.max() - v.min()) if v.max() > v.min() else np.zeros(len(v)) for v in (lat, lon)]

    def boxes(level):
        return list(zip(*(np.minimum(np.floor(u * 2.0 ** level), 2.0 ** level - 1).astype(np.int64).tolist() for u in unit)))

    best = np.full(len(lat), -np.inf)
    for level in range(depth - alpha + 1):
        fine = boxes(level + alpha)
        count, inside = Counter(fine), defaultdict(list)
        for (i, j), c in count.items():
            inside[i >> alpha, j >> alpha].append(c)
        for p, b in enumerate(boxes(level)):
            c = np.array(inside[b], float)
            nh = (c ** 2).sum() / c.sum()
            sd = np.sqrt(max(0.0, (c ** 3).sum() / c.sum() - nh * nh))
            if c.sum() >= nmin and sd > 0:
                best[p] = max(best[p], (1 - count[fine[p]] / nh) / (sd / nh))
    return np.where(np.isinf(best), 0.0, best)


def test_aloci_splits_as_far_as_the_points_go(spark):
    rng = np.random.default_rng(5)
    wide = rng.uniform(-60, 60, (80, 2))
    dense = np.array([10.0, 20.0]) + rng.normal(0, 2e-5, (150, 2))
    near = np.array([[10.0, 20.0004], [10.0003, 20.0]])
    groups = {"s": np.concatenate([wide, dense, near]), "same": np.tile([[1.0, 2.0]], (30, 1)),
              "two places": np.concatenate([np.tile([[1.0, 2.0]], (30, 1)), [[5.0, 5.0]]])}
    rows = [(s, str(i), float(x), float(y)) for s, p in groups.items() for i, (x, y) in enumerate(p)]
    points = spark.createDataFrame(rows, "Species string, H3 string, LAT double, LON double")
    got = {(r["Species"], int(r["H3"])): r["OutlierScore"] for r in models.aloci(points).collect()}
    assert len(got) == len(rows)
    for s, p in groups.items():
        want = _aloci_scores(p[:, 0], p[:, 1], 52)
        assert np.allclose([got[s, i] for i in range(len(p))], want, rtol=1e-9, atol=1e-9), s
    # The old default ended at level 10.
    s = groups["s"]
    assert (np.abs(_aloci_scores(s[:, 0], s[:, 1], 10) - [got["s", i] for i in range(len(s))]) > 0.1).any()


def test_aloci_query_depth_reaches_the_cells(spark):
    from occuflow.plans import queries

    cells = queries._cells(queries._fx(spark, SF_SMALL)).drop("cell")
    whole = {(r["Species"], r["H3"]): r["OutlierScore"] for r in models.aloci(cells).collect()}
    cut = {(r["Species"], r["H3"]): r["OutlierScore"] for r in
           models.aloci(cells, queries.ALOCI_NMIN, queries.ALOCI_ALPHA, queries.ALOCI_DEPTH).collect()}
    assert whole == cut and any(v > 0 for v in whole.values())
