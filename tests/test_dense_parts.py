"""Sparse points beside dense cubes, and groups of few points (F1 of round 4)."""

from __future__ import annotations

import numpy as np
import pytest

from occuflow.operators import density

EPS, MINPTS = 20_000.0, 4


def _noise(xy: np.ndarray) -> np.ndarray:
    la, lo = np.radians(xy[:, 0]), np.radians(xy[:, 1])
    h = np.sin((la[:, None] - la) / 2) ** 2 + np.cos(la)[:, None] * np.cos(la) * np.sin((lo[:, None] - lo) / 2) ** 2
    close = 2 * density.knn.EARTH_RADIUS_M * np.arcsin(np.sqrt(np.minimum(h, 1))) <= EPS
    core = close.sum(1) >= MINPTS
    return ~core & ~(close & core).any(1)


@pytest.fixture(scope="module")
def patch():
    """A dense patch, points around its edge of which some only graze it, and scattered ones."""
    rng = np.random.default_rng(11)
    ring = np.linspace(0, 0.5, 9)
    far = 0.15 + rng.random(9) * 0.03
    return np.concatenate([rng.random((4000, 2)) * 0.5, np.column_stack([ring, 0.5 + far]), np.column_stack([-far, ring]),
                           np.column_stack([ring, -far - 0.01]), rng.random((40, 2)) * 8 - 4])


def _frame(spark, groups: dict[str, np.ndarray]):
    rows = [(g, f"p{i:05d}", float(a), float(b)) for g, xy in groups.items() for i, (a, b) in enumerate(xy)]
    return spark.createDataFrame(rows, "Species string, H3 string, LAT double, LON double").repartition(4)


def test_few_points_of_dense_cubes_are_counted_one_by_one(spark, patch, monkeypatch):
    counted, plain = [], density.count_within

    def watched(probe, target, eps_m, geomodel):
        counted.append((probe.count(), target.count()))
        return plain(probe, target, eps_m, geomodel)

    monkeypatch.setattr(density, "count_within", watched)
    got = {r["H3"]: r["OutlierScore"] for r in density.dbscan_noise(_frame(spark, {"a": patch}), EPS, MINPTS).collect()}
    assert got == {f"p{i:05d}": float(v) for i, v in enumerate(_noise(patch))}
    (probes, targets), = counted
    assert 0 < probes < 27 and 0 < targets < 300


def test_groups_of_few_points_are_not_copied_to_tiles(spark, monkeypatch):
    rng = np.random.default_rng(12)
    groups = {f"s{g}": rng.random((12, 2)) * 1.5 + 10 for g in range(30)}
    copied, plain = [], density._tiles

    def watched(rows, low, high):
        if "_id" in rows.columns:
            copied.append(rows.count())
        return plain(rows, low, high)

    monkeypatch.setattr(density, "_tiles", watched)
    frame = _frame(spark, groups)
    want = {(g, f"p{i:05d}"): float(v) for g, xy in groups.items() for i, v in enumerate(_noise(xy))}
    assert len(set(want.values())) == 2
    for size in (density.GROUP_POINTS, 3):
        monkeypatch.setattr(density, "GROUP_POINTS", size)
        copied.clear()
        got = {(r["Species"], r["H3"]): r["OutlierScore"] for r in density.dbscan_noise(frame, EPS, MINPTS).collect()}
        assert got == want
        assert sum(copied) == 0 if size > 12 else sum(copied) > 300


def test_points_without_group_id_or_place_are_no_noise(spark):
    rows = [("a", "p1", 1.0, 1.0), (None, "p2", 1.0, 1.0), ("a", None, 50.0, 1.0), ("a", "p3", None, 1.0), ("a", "p4", -50.0, 1.0)]
    frame = spark.createDataFrame(rows, "Species string, H3 string, LAT double, LON double")
    got = {(r["Species"], r["H3"]): r["OutlierScore"] for r in density.dbscan_noise(frame, EPS, 2).collect()}
    assert got == {("a", "p1"): 1.0, ("a", "p4"): 1.0, (None, "p2"): 0.0, ("a", None): 0.0, ("a", "p3"): 0.0}
