"""Cases outside the fixtures: coincident points, dense patches, missing trees, odd names."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from occuflow.operators import density, knn, models
from occuflow.operators.outliers import flag_outliers
from occuflow.operators.predicates import select_extinct
from occuflow.operators.trees import tree_stats
from occuflow.session import cut_lineage, ensure_checkpoint_dir, stage_scope
from occuflow.sources.readers import read_species_list, read_tree_tips


def points(spark, rows):
    return spark.createDataFrame([("s", f"p{i:05d}", float(a), float(b)) for i, (a, b) in enumerate(rows)],
                                 "Species string, H3 string, LAT double, LON double")


def test_candidates_follow_the_result_not_the_group(spark):
    """A dense patch and isolated points: nobody reads the whole patch."""
    rng = np.random.default_rng(1)
    patch = rng.random((10_000, 2)) * 2
    lonely = np.column_stack([rng.random(40) * 100 - 60, 60 + rng.random(40) * 200 - 20])
    pts = points(spark, np.concatenate([patch, lonely]))
    k = 5
    cand = cut_lineage(knn.knn_candidates(pts, k))
    rows = knn.knn(pts, k).count()
    assert cand.count() <= 20 * rows
    assert cand.groupBy("_id").count().agg({"count": "max"}).first()[0] < 2_500


def test_knn_of_lonely_points_is_exact(spark):
    rng = np.random.default_rng(2)
    xy = np.concatenate([rng.random((300, 2)) * 0.1, rng.random((12, 2)) * [170, 350] - [85, 175], [[0.05, 179.99], [0.05, -179.99]]])
    got = {}
    for r in knn.knn(points(spark, xy), 4).where("rank <= 4").collect():
        got.setdefault(r["H3"], []).append(r["dist_m"])
    la, lo = np.radians(xy[:, 0]), np.radians(xy[:, 1])
    h = (np.sin((la[:, None] - la) / 2) ** 2
         + np.cos(la)[:, None] * np.cos(la) * np.sin((lo[:, None] - lo) / 2) ** 2)
    d = 2 * 6371008.8 * np.arcsin(np.sqrt(np.minimum(1, h)))
    np.fill_diagonal(d, np.inf)
    for i in range(len(xy)):
        assert np.allclose(sorted(got[f"p{i:05d}"]), np.sort(d[i])[:4], atol=2e-3)


@pytest.mark.parametrize("score", ["lof", "knndd", "inflo", "loop", "kernel_density_lof", "simplified"])
def test_coincident_points_are_inliers_and_the_far_one_is_not(spark, score):
    pts = points(spark, [(10.0, 10.0)] * 6 + [(10.0, 10.0 + i / 100) for i in range(1, 5)] + [(40.0, 60.0)])
    fn = (lambda p, k: knn.lof(p, k, simplified=True)) if score == "simplified" else getattr(knn, score)
    got = {r["H3"]: r["OutlierScore"] for r in fn(pts, 3).collect()}
    assert all(v is not None and not math.isnan(v) for v in got.values())
    if score in ("lof", "simplified", "knndd", "inflo", "kernel_density_lof"):
        assert all(got[f"p{i:05d}"] == 1.0 for i in range(6))
    assert got["p00010"] >= max(got[f"p{i:05d}"] for i in range(6))


def test_far_point_keeps_its_rank_in_the_mixture(spark):
    rng = np.random.default_rng(3)
    xy = np.concatenate([rng.normal(0, 0.01, (200, 2)), [[60.0, 100.0], [60.0, 140.0]]])
    got = models.em_outlier(points(spark, xy), k=1).collect()
    score = {r["H3"]: r["OutlierScore"] for r in got}
    assert score["p00201"] > score["p00200"] > max(v for p, v in score.items() if p < "p00200")
    assert all(r["converged"] for r in got)


def test_unsettled_groups_say_so(spark):
    rng = np.random.default_rng(4)
    pts = points(spark, rng.random((300, 2)) * 50)
    few = models.kmeans_minus_minus(pts, 6, 3, max_iter=1).collect()
    many = models.kmeans_minus_minus(pts, 6, 3).collect()
    assert not any(r["converged"] for r in few) and all(r["converged"] for r in many)
    assert len(few) == len(many) == 300 and sum(r["is_outlier"] for r in many) == 3


def test_tree_without_source_is_reported(spark):
    counts = spark.createDataFrame([("A b", 5, 2)], "species string, NumRecords long, NumUniqCoordsRounded2dp long")
    tips = spark.createDataFrame([("T1", "source", "A_b"), ("T1", "processed", "A_b"), ("T2", "processed", "A_b")],
                                 "tree string, stage string, tip_label string")
    got = {r["Tree"]: r for r in tree_stats(counts, tips).collect()}
    assert got["T2"]["SpeciesInGBIF"] == 1 and got["T2"]["SpeciesInSourceTree"] is None
    assert got["T2"]["Pct_NameMatchedSpecies"] is None and got["T1"]["SpeciesInSourceTree"] == 1


def test_noise_of_the_null_group_is_dropped(spark):
    rows = [(g, 10.0 + i * 0.001, 10.0) for g in (None, "a") for i in range(5)] + [(None, 50.0, 50.0), ("a", 60.0, 60.0)]
    df = spark.createDataFrame(rows, "g string, decimallatitude double, decimallongitude double")
    kept, out = density.remove_by_clustering(df, 5.0, 3, by="g")
    assert kept.count() == 10 and {r["decimallatitude"] for r in out.collect()} == {50.0, 60.0}


def test_quoted_tips_and_padded_names(spark, tmp_path):
    (tmp_path / "t.nwk").write_text("(('O''Brien_x':1,b_c):2,'d (e)':1);")
    assert {r["tip_label"] for r in read_tree_tips(spark, str(tmp_path / "t.nwk"), "T").collect()} == {"O'Brien_x", "b_c", "d (e)"}
    (tmp_path / "n.txt").write_text("  Aus bus \n\n   \nCus dus\n")
    assert sorted(r["species"] for r in read_species_list(spark, str(tmp_path / "n.txt")).collect()) == ["Aus bus", "Cus dus"]


def test_dataset_key_needs_its_column(spark):
    tax = spark.createDataFrame([(1, 2, "SPECIES", "ACCEPTED", True)],
                                "taxonkey long, highertaxonkey long, taxonrank string, status string, isextinct boolean")
    with pytest.raises(ValueError):
        select_extinct(tax, [2], dataset_key="x")


def test_global_flags_build_no_job_and_agree(spark):
    scores = spark.createDataFrame([(str(i), "s", float(i % 7)) for i in range(50)] + [("x", "s", 90.0)],
                                   "H3Index string, Species string, OutlierScore double")
    got = flag_outliers(scores, "medium", by=None).collect()
    assert [r["H3Index"] for r in got if r["Outlier"] == 1] == ["x"] and len(got) == 51


def test_stage_tables_go_with_their_scope(spark):
    jvm = spark._jvm
    base = jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark))
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    before = len(fs.listStatus(base))
    with stage_scope(spark):
        assert cut_lineage(spark.range(5)).count() == 5
        assert len(fs.listStatus(base)) == before + 1
    assert len(fs.listStatus(base)) == before


def test_neighbourhood_counts_follow_the_edge_not_the_content(spark, monkeypatch):
    """Four times the points in the same patch, 16 times the neighbours: about as many edge rows a point."""
    rng = np.random.default_rng(5)
    cuts = []
    plain = density.cut_lineage
    monkeypatch.setattr(density, "cut_lineage", lambda df: cuts.append(plain(df)) or cuts[-1])
    rows, tested = {}, {}
    for n in (2_000, 8_000):
        cuts.clear()
        xy = rng.random((n, 2)) * 2
        pts = points(spark, xy)
        got = density.neighbour_counts(pts, 50_000.0).agg({"n_neighbours": "sum"}).first()[0]
        la, lo = np.radians(xy[:, 0]), np.radians(xy[:, 1])
        total = 0
        for i in range(0, n, 500):
            h = (np.sin((la[i:i + 500, None] - la) / 2) ** 2
                 + np.cos(la[i:i + 500, None]) * np.cos(la) * np.sin((lo[i:i + 500, None] - lo) / 2) ** 2)
            total += int((2 * 6371008.8 * np.arcsin(np.sqrt(h)) <= 50_000).sum())
        assert got == total
        rows[n] = total
        tested[n] = sum(c.where("_state = 'edge'").count() for c in cuts if "_state" in c.columns)
    assert rows[8_000] > 10 * rows[2_000] and tested[8_000] < 10 * tested[2_000]


def test_one_hot_cube_forms_no_pairs_with_its_points(spark):
    rng = np.random.default_rng(6)
    hot = rng.random((50_000, 2)) * 0.5
    around = np.column_stack([rng.random(30) * 4 - 2, 2 + rng.random(30) * 3])
    pts = points(spark, np.concatenate([hot, around, [[50.0, 50.0], [50.0, 50.1]]]))
    got = {r["H3"] for r in density.dbscan_noise(pts, 300_000.0, 5).where("OutlierScore = 1").collect()}
    assert got == {"p50030", "p50031"}


def test_dispatcher_checks_and_spheroid(spark):
    from occuflow.operators.scores import METHODS, outlier_scores

    rng = np.random.default_rng(7)
    pts = points(spark, rng.random((60, 2)) * [120, 300] - [60, 150])
    for bad in ({"method": "Nope"}, {"method": "LOF"}, {"method": "LOF", "k": 0}, {"method": "DBOutlierScore", "k": 3},
                {"method": "DBOutlierScore", "d": -1.0}, {"method": "LOF", "k": 3, "geomodel": "flat"}, {"method": "SLOM", "k": 3}):
        with pytest.raises(ValueError):
            outlier_scores(pts, **bad)
    with pytest.raises(NotImplementedError):
        outlier_scores(pts, "SOS")
    from occuflow.functions.geo import vincenty_np

    got = {r["H3Index"]: r["OutlierScore"] for r in outlier_scores(pts, "KNNOutlier", k=3).collect()}
    xy = np.array([(r["LAT"], r["LON"]) for r in pts.orderBy("H3").collect()])
    for i in range(60):
        d = np.sort(vincenty_np(np.full(60, xy[i, 0]), np.full(60, xy[i, 1]), xy[:, 0], xy[:, 1]))
        assert abs(got[f"p{i:05d}"] - d[3]) < 2e-3
    assert len(METHODS) >= 25


def test_known_geodesic_distances():
    """Published WGS84 values (degrees, metres)."""
    from occuflow.functions.geo import vincenty_np

    one = lambda *a: float(vincenty_np(*[np.array([v], dtype=float) for v in a])[0])
    assert abs(one(0, 0, 0, 1) - 111319.4908) < 1e-3  # a degree of the equator
    assert abs(one(0, 0, 90, 0) - 10001965.7293) < 1e-2  # a quarter meridian
    assert abs(one(0, 0, 1, 0) - 110574.3886) < 1e-3  # the first degree of latitude
    assert 19_900_000 < one(0, 0, 0.5, 179.7) < 20_010_000


def test_dbscan_on_the_spheroid(spark):
    """At 45 N, 1 degree of latitude is 111.13 km on the spheroid and 111.19 km on the sphere."""
    pts = points(spark, [(45, 10), (46, 10)])
    noise = lambda m: density.dbscan_noise(pts, 111_160.0, 2, geomodel=m).where("OutlierScore = 1").count()
    assert noise("wgs84") == 0 and noise("sphere") == 2


def test_hexagons_tile_the_globe():
    from occuflow.functions import hexgrid

    rng = np.random.default_rng(8)
    n = 300_000
    lat, lon = np.degrees(np.arcsin(rng.uniform(-1, 1, n))), rng.uniform(-180, 180, n)
    for r in range(3):
        cells = hexgrid.encode(lat, lon, r)
        have = np.unique(cells)
        assert len(have) == 2 + 120 * 7 ** r
        la, lo = hexgrid.decode(have)
        assert (hexgrid.encode(la, lo, r) == have).all()
    la, lo = hexgrid.decode(hexgrid.encode(lat, lon, 6))
    h = (np.sin(np.radians(la - lat) / 2) ** 2
         + np.cos(np.radians(la)) * np.cos(np.radians(lat)) * np.sin(np.radians(lo - lon) / 2) ** 2)
    assert 2 * 6371.0088 * np.arcsin(np.sqrt(h)).max() < 4.5


def test_hexagons_at_the_poles_and_the_date_line(spark):
    from occuflow.functions.cells import HexCells, make_indexer

    hexes = make_indexer("hex", 6)
    assert isinstance(hexes, HexCells)
    df = spark.createDataFrame([(90.0, 0.0), (90.0, 123.0), (10.0, 180.0), (10.0, -180.0), (None, 1.0), (1.0, None)],
                               "decimallatitude double, decimallongitude double")
    from occuflow.functions.cells import with_cells

    got = [r["cell"] for r in with_cells(df, hexes).collect()]
    assert got[0] == got[1] and got[2] == got[3] and got[4] is None and got[5] is None


def test_cluster_labels_of_touching_and_separate_patches(spark):
    """Labels against plain DBSCAN on patches that touch, nearly touch and stand apart."""
    rng = np.random.default_rng(9)
    xy = np.concatenate([rng.random((150, 2)) * [4, 4], rng.random((150, 2)) * [4, 4] + [0, 4.5],
                         rng.random((60, 2)) * [1, 1] + [20, 20], rng.random((25, 2)) * [30, 30] + [-40, 60]])
    eps, minpts = 80_000.0, 4
    la, lo = np.radians(xy[:, 0]), np.radians(xy[:, 1])
    h = (np.sin((la[:, None] - la) / 2) ** 2
         + np.cos(la)[:, None] * np.cos(la) * np.sin((lo[:, None] - lo) / 2) ** 2)
    close = 2 * 6371008.8 * np.arcsin(np.sqrt(np.minimum(1, h))) <= eps
    core = close.sum(1) >= minpts
    label = np.where(core, np.arange(len(xy)), -1)
    for _ in range(len(xy)):
        new = np.array([min([label[i], *label[close[i] & core]]) if core[i] else -1 for i in range(len(xy))])
        if (new == label).all():
            break
        label = new
    want = {i: (min(label[close[i] & core]) if (close[i] & core).any() else None) for i in range(len(xy))}
    got = {int(r["H3"][1:]): r["cluster_rep"] for r in density.dbscan_labels(points(spark, xy), eps, minpts).collect()}
    assert {i: None if v is None else int(v[1:]) for i, v in got.items()} == want
    assert len({v for v in want.values() if v is not None}) >= 2


def test_sparse_points_meet_by_tile(spark):
    """A scattered point is sent to a few tiles, not to every cube around it; no pair is lost on tile edges."""
    rng = np.random.default_rng(5)
    xy = np.concatenate([rng.random((400, 2)) * 4 - 2, [[0.0, 179.999], [0.0, -179.999], [89.99, 10.0], [89.99, -170.0]]])
    eps = 20_000.0
    side, reach, search = density._geometry(eps, "sphere")
    sparse = cut_lineage(density._cubed_points(points(spark, xy), side, "Species", "H3", "LAT", "LON", None))
    got = {(r["_id"], r["_sid"]) for r in density._sparse_pairs(sparse, side, search, eps, "sphere").collect()}
    la, lo = np.radians(xy[:, 0]), np.radians(xy[:, 1])
    h = np.sin((la[:, None] - la) / 2) ** 2 + np.cos(la)[:, None] * np.cos(la) * np.sin((lo[:, None] - lo) / 2) ** 2
    close = 2 * density.knn.EARTH_RADIUS_M * np.arcsin(np.sqrt(np.minimum(h, 1))) <= eps
    assert got == {(f"p{i:05d}", f"p{j:05d}") for i, j in zip(*np.nonzero(close))}
    cubes = density.neighbour_cubes(sparse, side, reach, search).count()
    tile = lambda sign: lambda v: F.floor((F.col(f"_{v}") + sign * search) / (side * density.TILE)).cast("long")
    assert 5 * density._tiles(sparse, tile(-1), tile(1)).count() < cubes


def test_pairs_inside_a_component_are_not_probed(spark, monkeypatch):
    """Cubes that sure edges join already send no points to each other; a component that needs a probe is found."""
    rng = np.random.default_rng(6)
    strip = np.column_stack([rng.random(400), np.linspace(0, 60, 400)])
    near = np.column_stack([8.0 + rng.random(40) * 0.2, 20 + rng.random(40) * 0.2])  # within eps of the strip in its corner only
    far = np.column_stack([60 + rng.random(40), 20 + rng.random(40)])
    probed = []
    plain = density._partners

    def counted(probe, target, tag, eps_m, geomodel, how="inner"):
        if how == "left_semi":
            probed.append(probe.count())
        return plain(probe, target, tag, eps_m, geomodel, how)

    monkeypatch.setattr(density, "_partners", counted)
    pts = points(spark, np.concatenate([strip, near, far]))
    reps = [r["cluster_rep"] for r in density.dbscan_labels(pts, 1_000_000.0, 3).orderBy("H3").collect()]
    assert reps == ["p00000"] * 440 + ["p00440"] * 40
    assert sum(probed) < 400
