"""Tail probabilities, correlation outliers, shifted grids and nearly antipodal distances."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from occuflow.functions.geo import vincenty_np
from occuflow.functions.tails import chi_square_tail, gamma_tail
from occuflow.operators import knn, models, scores


def test_gamma_tails(spark):
    xs = [0.0, 1e-9, 0.01, 0.4, 0.5, 1.0, 1.5, 2.0, 3.7, 6.0, 20.0, 90.0, 120.0, 600.0]
    rows = spark.createDataFrame([(x,) for x in xs], "x double").select(
        "x", gamma_tail(F.lit(0.5), F.col("x")).alias("half"), gamma_tail(F.lit(1.0), F.col("x")).alias("one"),
        gamma_tail(F.lit(3.0), F.col("x")).alias("three"), gamma_tail(F.lit(100.0), F.col("x")).alias("hundred"),
        chi_square_tail(1, F.col("x")).alias("c1"), chi_square_tail(2, F.col("x")).alias("c2")).collect()
    for r in rows:
        x = r["x"]
        poisson = lambda n: sum(math.exp(-x + i * math.log(x) - math.lgamma(i + 1)) for i in range(n)) if x else 1.0
        for got, want in ((r["half"], math.erfc(math.sqrt(x))), (r["one"], math.exp(-x)), (r["three"], poisson(3)),
                          (r["hundred"], poisson(100)), (r["c1"], math.erfc(math.sqrt(x / 2))), (r["c2"], math.exp(-x / 2))):
            assert math.isclose(got, want, rel_tol=1e-9, abs_tol=1e-12), (x, got, want)


def test_cop_finds_the_point_beside_the_line(spark):
    rng = np.random.default_rng(8)
    line = [("a", f"l{i:02d}", float(t), float(t + e)) for i, (t, e) in enumerate(zip(rng.uniform(0, 6, 80), rng.normal(0, 0.03, 80)))]
    rows = line + [("a", "off", 3.0, 2.2), ("b", "b0", 1.0, 1.0), ("b", "b1", 2.0, 1.0), ("b", "b2", 3.0, 1.0)]
    points = spark.createDataFrame(rows, "Species string, H3 string, LAT double, LON double").repartition(2)
    for distribution in ("gamma", "chisquared"):
        got = {r["H3"]: r["OutlierScore"] for r in knn.cop(points, 12, distribution=distribution).collect()}
        assert len(got) == len(rows) and all(0.0 <= s <= 1.0 for s in got.values())
        others = [got[r[1]] for r in line]
        assert got["off"] > 0.9 and got["off"] >= np.quantile(others, 0.9) and np.median(others) < 0.2
        assert got["b0"] == got["b1"] == got["b2"] == 0.0
    # the short way across the antimeridian
    turned = points.withColumn("LON", F.expr("LON + 179 - CASE WHEN LON + 179 >= 180 THEN 360 ELSE 0 END"))
    there = {r["H3"]: r["OutlierScore"] for r in knn.cop(turned, 12).collect()}
    here = {r["H3"]: r["OutlierScore"] for r in knn.cop(points, 12).collect()}
    assert all(math.isclose(there[h], here[h], rel_tol=1e-6, abs_tol=1e-9) for h in here)


def test_cop_parameters(spark):
    points = spark.createDataFrame([], "Species string, H3 string, LAT double, LON double")
    for kwargs in ({"k": 2}, {"k": 5, "expect": 0.0}, {"k": 5, "distribution": "normal"}, {"k": 60}):
        with pytest.raises(ValueError):
            knn.cop(points, **kwargs)
    assert "COP" not in scores.NOT_BUILT and {"COP", "DWOF", "GLOSH"} <= set(scores.METHODS)


def test_aloci_with_several_grids(spark):
    """Equal to choosing boxes by hand; one grid is the plain form."""
    rng = np.random.default_rng(4)
    xy = np.vstack([rng.normal(0, 1, (150, 2)), rng.normal(6, 0.3, (60, 2)), [[3.0, 3.0]]])
    points = spark.createDataFrame([("s", f"p{i}", float(a), float(b)) for i, (a, b) in enumerate(xy)],
                                   "Species string, H3 string, LAT double, LON double")
    u = (xy - xy.min(0)) / (xy.max(0) - xy.min(0))
    for grids, alpha, depth in ((1, 2, 5), (3, 2, 6)):
        shifts = models.grid_shifts(grids)

        def box(p, level, g):
            n = 2.0 ** level
            cells = [math.floor((c + s) * n) for c, s in zip(p, shifts[g])]
            return tuple(min(c, int(n) - 1) if shifts[g][i] == 0 else c for i, c in enumerate(cells))

        def best(p, level):
            side = 2.0 ** -level
            out = []
            for g in range(grids):
                b = box(p, level, g)
                centre = tuple((c + 0.5) * side - s for c, s in zip(b, shifts[g]))
                out.append((round(sum(((x - y) / side) ** 2 for x, y in zip(centre, p)), 9), g, b, centre))
            return min(out, key=lambda o: o[:2])

        count = {}
        for level in range(depth + 1):
            for g in range(grids):
                for p in u:
                    at = (level, g, box(p, level, g))
                    count[at] = count.get(at, 0) + 1
        want = []
        for p in u:
            found = []
            for level in range(depth - alpha + 1):
                _, g, b, centre = best(p, level + alpha)
                n = count[level + alpha, g, b]
                _, h, big, _ = best(centre, level) if grids > 1 else (0, 0, tuple(c >> alpha for c in b), None)
                c = [v for (lv, gg, bb), v in count.items()
                     if lv == level + alpha and gg == h and tuple(x >> alpha for x in bb) == big]
                if sum(c) >= 20:
                    mean = sum(x * x for x in c) / sum(c)
                    sd = math.sqrt(max(0.0, sum(x ** 3 for x in c) / sum(c) - mean * mean))
                    if sd > 0:
                        found.append((1 - n / mean) / (sd / mean))
            want.append(max(found, default=0.0))
        got = {r["H3"]: r["OutlierScore"] for r in models.aloci(points, 20, alpha, depth, grids).collect()}
        assert all(math.isclose(got[f"p{i}"], w, rel_tol=1e-9, abs_tol=1e-9) for i, w in enumerate(want))
    with pytest.raises(ValueError):
        models.aloci(points, grids=0)


def test_nearly_antipodal_distances():
    """Published geodesic lengths, and the meridian between opposite points."""
    half = 20003931.4586
    cases = [((0, 0, 0.5, 179.5), 19936288.579), ((0, 0, 0.5, 179.7), 19944127.421), ((0, 0, 0, 180), half),
             ((30, 0, -30, 180), half), ((0, 0, 0, 179.5), 19980861.9089), ((90, 0, -90, 0), half)]
    at = np.array([c for c, _ in cases], dtype=float)
    got = vincenty_np(*at.T)
    assert np.allclose(got, [m for _, m in cases], atol=2e-3)
    # continuous where the two solutions meet, and not all alike
    lon = np.linspace(178.5, 180.0, 301)
    d = vincenty_np(np.zeros(301), np.zeros(301), np.full(301, 0.2), lon)
    assert (np.diff(d) > -1e-3).all() and np.abs(np.diff(d, 2)).max() < 100 and len(set(d.round(3))) > 250
