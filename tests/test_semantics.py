"""Quirks of the reference reproduced on small hand-made frames."""

import math

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from occuflow.functions.cells import Graticule, check_resolution
from occuflow.functions.text import coordinate_key, normalize_name, rounded_text, tip_to_species
from occuflow.operators import binning, counts, outliers, pool, predicates, trees
from occuflow.sources.sinks import check_zstd_level

OCC_SCHEMA = ("gbifid long, datasetkey string, specieskey long, kingdom string, phylum string, "
              "class string, `order` string, family string, genus string, species string, "
              "decimallatitude double, decimallongitude double, basisofrecord string, year int")


def occ_rows(spark, rows):
    full = []
    for i, r in enumerate(rows):
        base = dict(gbifid=i, datasetkey="ds-1", specieskey=1, kingdom="K", phylum="P",
                    **{"class": "C"}, order="O", family="F", genus="G", species="G a",
                    decimallatitude=1.0, decimallongitude=1.0, basisofrecord="OBSERVATION",
                    year=2000)
        base.update(r)
        full.append(tuple(base[c] for c in ("gbifid", "datasetkey", "specieskey", "kingdom",
                                              "phylum", "class", "order", "family", "genus",
                                              "species", "decimallatitude", "decimallongitude",
                                              "basisofrecord", "year")))
    return spark.createDataFrame(full, OCC_SCHEMA)


def test_coordinate_key_collides_without_separator(spark):
    df = spark.createDataFrame([(1.1, 10.1), (1.11, 0.1)], "a double, b double")
    keys = [r[0] for r in df.select(coordinate_key("a", "b")).collect()]
    assert keys == ["1.110.1", "1.110.1"]
    pair = [r[0] for r in df.select(coordinate_key("a", "b", "pair")).collect()]
    assert pair[0] != pair[1]


def test_rounding_matches_binary_half_away_and_negative_zero(spark):
    df = spark.createDataFrame([(1.005,), (-0.001,), (-0.0,), (2.5,), (0.004,)], "x double")
    got = [r[0] for r in df.select(rounded_text("x")).collect()]
    # 1.005 is 1.00499.. in binary: rounds down; tiny negatives keep the sign.
    assert got == ["1.0", "-0.0", "-0.0", "2.5", "0.0"]


def test_counts_drop_null_key_and_missing_coordinates(spark):
    occ = occ_rows(spark, [
        dict(specieskey=None),
        dict(decimallatitude=None),
        dict(decimallatitude=1.001, decimallongitude=2.0),
        dict(decimallatitude=1.002, decimallongitude=2.0),
        dict(decimallatitude=5.0, decimallongitude=2.0, species="G b"),
    ])
    rows = counts.species_counts(occ).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.NumRecords == 3 and r.NumUniqCoordsRounded2dp == 2
    assert r.species == "G b"  # MAX over the names of one key


def test_basis_filter_validates_and_drops_null(spark):
    with pytest.raises(ValueError):
        predicates.parse_basis("PRESERVED_SPECIMEN,NOT_A_BASIS")
    occ = occ_rows(spark, [dict(basisofrecord=None), dict(basisofrecord="PRESERVED_SPECIMEN")])
    assert counts.species_counts(occ, "PRESERVED_SPECIMEN").first().NumRecords == 1


def test_tip_label_first_underscore_only(spark):
    df = spark.createDataFrame([("Genus_species_sub",), ("Plain",)], "t string")
    assert [r[0] for r in df.select(tip_to_species("t")).collect()] == ["Genus species_sub", "Plain"]


def test_normalize_name(spark):
    df = spark.createDataFrame([("Genus sp. 'x', y",)], "n string")
    assert df.select(normalize_name("n")).first()[0] == "Genus_sp_x_y"
    assert df.select(normalize_name("n", collapse=False)).first()[0] == "Genus_sp___x___y"


def test_tree_stats_count_duplicate_tips_and_two_keys_per_name(spark):
    cnt = spark.createDataFrame(
        [(1, "A a", 10, 5), (2, "A a", 1, 1), (3, "B b", 4, 4)],
        "specieskey long, species string, NumRecords long, NumUniqCoordsRounded2dp long")
    tips = spark.createDataFrame(
        [("T", "processed", "A_a"), ("T", "processed", "A_a"), ("T", "processed", "C_c"),
         ("T", "source", "x"), ("T", "source", "y"), ("T", "source", "z"), ("T", "source", "w")],
        "tree string, stage string, tip_label string")
    r = trees.tree_stats(cnt, tips).first()
    assert r.SpeciesInTree == 3 and r.SpeciesInGBIF == 2 and r.SpeciesNotInGBIF == 1
    assert r.NumUniqueOccurrences == 11 and r.NumNonRedundantOccurrences == 6
    assert r.SpeciesInSourceTree == 4 and r.OverallTreeTipsNotInGBIF == 2
    assert r.Pct_SpeciesInGBIF == 66.67 and r.Pct_NameMatchedSpecies == 75.0


def test_name_under_two_keys_lands_in_both_lists(spark):
    cnt = spark.createDataFrame(
        [(1, "A a", 500, 500), (2, "A a", 1, 1), (3, "X'y, z", 3, 3)],
        "specieskey long, species string, NumRecords long, NumUniqCoordsRounded2dp long")
    tips = spark.createDataFrame([("T", "processed", "A_a"), ("T", "processed", "X'y,_z")],
                                 "tree string, stage string, tip_label string")
    pooled = pool.pool_species(trees.split_species(cnt, tips, 100)).collect()
    assert [(r.occ_group, r.species) for r in pooled] == [
        ("Large", "A a"), ("Small", "A a"), ("Small", "X'y, z")]
    ext = spark.createDataFrame([("A a",)], "species string")
    pooled = pool.pool_species(trees.split_species(cnt, tips, 100), ext).collect()
    assert [r.species for r in pooled] == ["X'y, z"]


def test_binning_keeps_null_year_and_null_dataset_key(spark):
    occ = occ_rows(spark, [dict(year=None), dict(year=None, datasetkey=None),
                           dict(datasetkey="ds-2"), dict(decimallatitude=None)])
    rows = {r.year: r for r in binning.bin_counts(occ, Graticule(1)).collect()}
    assert rows[None].record_count == 2 and rows[None].dataset_keys == [None, "ds-1"]
    assert rows[2000].record_count == 1 and rows[2000].dataset_keys == ["ds-2"]


def test_removal_keeps_half_score_out_of_summary_count(spark):
    scores = spark.createDataFrame([("c1", "S", 0.5), ("c2", "S", 0.0), ("c3", "S", None),
                                    ("c4", "T", 1.0)],
                                   "H3Index string, Species string, OutlierScore double")
    flagged = {(r.species, r.h3_index) for r in outliers.flagged_cells(scores).collect()}
    assert flagged == {("S", "c1"), ("T", "c4")}  # 0.5 is removed
    summary = dict(outliers.outlier_summary(scores).collect())
    assert summary["Total_outliers"] == "1"  # 0.5 is not counted (score > 0.5)
    assert summary["Unique_species"] == "2" and summary["Total_records"] == "4"
    assert summary["Median_outlier_score"] == "0.5"


def test_removal_is_per_species(spark):
    occ = occ_rows(spark, [dict(species="S"), dict(species="T"), dict(species="S",
                                                                       decimallatitude=None)])
    g = Graticule(4)
    cell = spark.range(1).select(g.cell_string(g.cell_id(F.lit(1.0), F.lit(1.0)))).first()[0]
    scores = spark.createDataFrame([(cell, "S", 1.0), (cell, "T", 0.0)],
                                   "H3Index string, Species string, OutlierScore double")
    kept = outliers.remove_outliers(occ, scores, g).collect()
    # S's record in the flagged cell goes; T keeps the same cell; NULL coords stay.
    assert sorted((r.species, r.decimallatitude) for r in kept) == [("S", None), ("T", 1.0)]
    assert "h3_index" in kept[0].asDict()


def test_graticule_edges(spark):
    g = Graticule(4)
    df = spark.createDataFrame([(90.0, 180.0), (-90.0, -180.0), (0.0, 179.99), (None, 1.0),
                                (float("nan"), 1.0)], "lat double, lon double")
    ids = [r[0] for r in df.select(g.cell_id("lat", "lon")).collect()]
    assert ids[0] == 719 * 1440 and ids[1] == 0 and ids[2] == 360 * 1440 + 1439
    assert ids[3] is None and ids[4] is None
    lat, lon = g.centroid(F.lit(ids[0]))
    c = spark.range(1).select(lat, lon).first()
    assert c[0] == 89.875 and c[1] == -179.875


def test_parameter_checks():
    with pytest.raises(ValueError):
        check_resolution(16)
    with pytest.raises(ValueError):
        check_zstd_level(23)
    assert check_resolution(0) == 0 and check_zstd_level(22) == 22


def test_quality_predicate_keeps_nulls_in_not_in(spark):
    df = spark.createDataFrame(
        [Row(occurrencestatus="PRESENT", year=2000, hasgeospatialissues=False,
             degreeofestablishment=None, basisofrecord=None, coordinateuncertaintyinmeters=None,
             kingdomkey=None, genuskey=None, specieskey=None, issue=None,
             decimallatitude=1.0, decimallongitude=2.0),
         Row(occurrencestatus="PRESENT", year=2000, hasgeospatialissues=False,
             degreeofestablishment="MANAGED", basisofrecord=None,
             coordinateuncertaintyinmeters=None, kingdomkey=None, genuskey=None,
             specieskey=None, issue=None, decimallatitude=1.0, decimallongitude=2.0)],
        "occurrencestatus string, year int, hasgeospatialissues boolean, "
        "degreeofestablishment string, basisofrecord string, "
        "coordinateuncertaintyinmeters double, kingdomkey int, genuskey int, specieskey int, "
        "issue array<string>, decimallatitude double, decimallongitude double")
    assert predicates.quality_filter(df).count() == 1
    with pytest.raises(ValueError):
        predicates.term_column("NOT_A_TERM")


def test_flags_and_thresholds(spark):
    df = spark.createDataFrame([("S", float(v)) for v in (1, 2, 3, 4, 100)] + [("S", None)],
                               "Species string, OutlierScore double")
    th = outliers.quantile_thresholds(df).first()
    assert th.q1 == 2.0 and th.q3 == 4.0 and th.threshold_medium == 7.0
    fl = outliers.flag_outliers(df, "medium")
    got = sorted((r.OutlierScore, r.Outlier) for r in fl.collect() if r.OutlierScore is not None)
    assert got[-1] == (100.0, 1) and got[0] == (1.0, 0)
    assert [r.Outlier for r in fl.collect() if r.OutlierScore is None] == [None]
    inf = spark.createDataFrame([("S", math.inf)], "Species string, OutlierScore double")
    r = outliers.flag_outliers(inf, "threshold", threshold=2.0).first()
    assert r.Outlier == 1 and r.DisplayScore == 4.0
