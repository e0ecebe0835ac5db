"""Whole-run invariants on the smallest fixture."""

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from occuflow.functions.cells import Graticule
from occuflow.operators import binning, density, outliers
from occuflow.plans.outputs import output_paths, write_outputs
from occuflow.plans.pipeline import Params, run
from occuflow.sources.fixtures import load_fixture


# Cells and distances that plain SQL can repeat.
PLAIN = {"basis": None, "outlier_cells": Graticule(4), "final_cells": Graticule(1), "geomodel": "sphere"}


@pytest.fixture(scope="module")
def fx(spark):
    return load_fixture(spark, SF_SMALL)


@pytest.fixture(scope="module")
def results(spark, fx):
    return run(fx["occurrences"], fx["tree_tips"], fx["extinct_taxa"], Params(**PLAIN))


def test_binned_counts_cover_every_located_record(spark, fx):
    occ = fx["occurrences"]
    binned = binning.bin_counts(occ, Graticule(1))
    total = binned.agg(F.sum("record_count")).first()[0]
    located = occ.where("species IS NOT NULL AND decimallatitude IS NOT NULL "
                        "AND decimallongitude IS NOT NULL").count()
    assert total == located


def test_removal_partitions_the_records(spark, fx, results):
    occ = fx["occurrences"]
    large = results["pooled"].where("occ_group = 'Large'").select("species")
    scores = results["scores"]
    kept = outliers.remove_outliers(occ, scores, Graticule(4), large)
    g = Graticule(4)
    tagged = (occ.join(large, "species", "left_semi")
                 .withColumn("h3_index", g.cell_string(g.cell_id("decimallatitude", "decimallongitude"))))
    flagged = outliers.flagged_cells(scores)
    removed = tagged.join(flagged, ["species", "h3_index"], "left_semi")
    assert kept.count() + removed.count() == tagged.count()
    assert removed.count() > 0


def test_no_dbscan_run_bins_more_records_than_cleaned_run(spark, fx, results):
    raw = run(fx["occurrences"], fx["tree_tips"], fx["extinct_taxa"],
              Params(**PLAIN, nodbscan=True))["binned"]
    n_clean = results["binned"].agg(F.sum("record_count")).first()[0]
    n_raw = raw.agg(F.sum("record_count")).first()[0]
    assert n_raw > n_clean


def test_overlap_large_bins_each_name_once(spark, fx):
    res = run(fx["occurrences"], fx["tree_tips"], fx["extinct_taxa"],
              Params(**PLAIN, overlap="large"))
    b = res["binned"]
    assert b.count() == b.select("H3", "species", "year").distinct().count()


def test_scores_match_standalone_dbscan(spark, results):
    cells = results["cells"]
    alone = density.dbscan_noise(cells, 1_000_000.0, 3).select(
        F.col("H3").alias("H3Index"), "Species", "OutlierScore")
    assert sorted(alone.collect()) == sorted(results["scores"].collect())


def test_write_outputs_layout(spark, results, tmp_path):
    paths = write_outputs(results, str(tmp_path), userid="u1", rows_per_file=5000)
    assert paths == output_paths(str(tmp_path), "u1")
    files = glob.glob(os.path.join(paths["filtered"], "*.parquet"))
    assert sum(pq.ParquetFile(f).metadata.num_rows for f in files) == results["binned"].count()
    assert glob.glob(os.path.join(paths["outliers"], "outlier_scores_summary", "*.csv"))
    assert glob.glob(os.path.join(paths["tree_stats"], "trees", "lists", "tree=*", "OccGroup=*"))
    names = spark.read.text(os.path.join(paths["tree_stats"], "pooled_large")).count()
    assert names == results["pooled"].where("occ_group = 'Large'").count()


def test_default_run_uses_hexagons_and_the_spheroid(spark, fx, tmp_path):
    from occuflow.functions import hexgrid
    from occuflow.plans.outputs import run_and_write

    paths = run_and_write(fx["occurrences"], fx["tree_tips"], str(tmp_path), fx["extinct_taxa"], Params(basis=None))
    binned = spark.read.parquet(paths["filtered"]).collect()
    cells = {int(r["H3"], 16) for r in binned}
    assert {c >> 59 for c in cells} == {4}
    lat, lon = hexgrid.decode(list(cells))
    assert (hexgrid.encode(lat, lon, 4) == list(cells)).all()
    located = fx["occurrences"].where("decimallatitude IS NOT NULL AND species IS NOT NULL").count()
    assert 0 < sum(r["record_count"] for r in binned) <= 2 * located
