"""What a round of the spanning tree costs, and what the removal by HDBSCAN reads (F2 of round 4)."""

from __future__ import annotations

import numpy as np

from conftest import SF_SMALL
from occuflow.operators import density, hierarchy, knn
from occuflow.plans import queries
from occuflow.session import cut_lineage


def test_the_removal_does_not_read_the_records_again(spark, monkeypatch):
    """Its four reads are of the written cells, not of the records counted into cells anew."""
    read = []

    def watched(df, *args, **kwargs):
        read.extend(df.inputFiles())
        empty = df.limit(0)
        return empty, empty

    monkeypatch.setattr(density, "remove_by_clustering", watched)
    queries.QUERIES["record_hdbscan"][0](spark, SF_SMALL)
    assert read and not [f for f in read if "lineitem" in f or "part.parquet" in f]


def test_components_that_choose_each_other_in_rings(spark):
    """Chains into pairs, rings of three and four, and a group of its own with the same numbers."""
    chosen = {("a", c): c - 1 for c in range(1, 40)} | {("a", 0): 1, ("a", 50): 51, ("a", 51): 52, ("a", 52): 50, ("a", 53): 52,
              ("a", 60): 61, ("a", 61): 62, ("a", 62): 63, ("a", 63): 60, ("a", 64): 63, ("b", 1): 2, ("b", 2): 1}
    frame = cut_lineage(spark.createDataFrame([(k, c, o) for (k, c), o in chosen.items()], "_k string, _c long, _o long"))
    got = {(r["_k"], r["_c"]): r["_root"] for r in hierarchy._joined_components(frame).collect()}
    want = {(k, c): 1 if k == "b" else 0 if c < 40 else 50 if c < 60 else 60 for k, c in chosen}
    assert got == want


def test_levels_below_the_crowded_ones_are_left_out(spark):
    rng = np.random.default_rng(4)
    frame = cut_lineage(spark.createDataFrame(
        [("a", i, float(a), float(b)) for i, (a, b) in enumerate(rng.random((300, 2)) * 40)],
        "_k string, _id long, _lat double, _lon double"))
    pts = cut_lineage(density._located(frame))
    for most in (1, 8):
        level = knn.deepest_level(pts, most)
        counts = {r["_lv"]: r["m"] for r in knn.cube_levels(pts).groupBy(*knn.NODE).count().groupBy("_lv")
                  .agg({"count": "max"}).withColumnRenamed("max(count)", "m").collect()}
        assert counts[level] <= most < counts[level - 1] and level < knn.LEVELS - 1
    twice = cut_lineage(pts.unionByName(pts))
    assert knn.deepest_level(twice, 1) == knn.LEVELS - 1
    assert knn.deepest_level(pts.limit(0), 1) == 0


def test_few_points_search_for_their_components_edge(spark, monkeypatch):
    """Known neighbours answer for most points of the first rounds."""
    rng = np.random.default_rng(7)
    frame = spark.createDataFrame([("a", f"p{i}", float(a), float(b)) for i, (a, b) in enumerate(rng.random((400, 2)) * 10)],
                                  "Species string, H3 string, LAT double, LON double")
    searched, plain = [], hierarchy._search

    def watched(need, *args):
        searched.append(need.count())
        return plain(need, *args)

    monkeypatch.setattr(hierarchy, "_search", watched)
    _, sites, tree = hierarchy._hierarchy(frame, 3, "Species", "LAT", "LON", "sphere", None)
    assert tree.count() >= 399 and sum(searched) < 200
