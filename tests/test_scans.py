"""What scores and bins read: points once, records in a loop that the JVM compiles."""

from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from occuflow.functions.cells import Graticule, valid_coordinates
from occuflow.operators import binning, knn
from occuflow.operators.predicates import DEFAULT_BASIS, apply_basis
from occuflow.sources.fixtures import VIEWS


def _points(spark, path):
    rng = random.Random(3)
    rows = [(s, f"p{i}", rng.uniform(-50, 50), rng.uniform(-50, 50), i % 7) for s in "ab" for i in range(40)]
    spark.createDataFrame(rows, "Species string, H3 string, LAT double, LON double, n long").write.parquet(path)
    return spark.read.parquet(path)


def test_scores_do_not_read_the_points_again(spark, tmp_path):
    """Whatever counts the records into points runs once, not for each join."""
    points = _points(spark, str(tmp_path / "points"))
    for out in (knn.slom(points, 3, "n"), knn.cop(points, 5), knn.knn_outlier(points, 3)):
        assert not [f for f in out.inputFiles() if str(tmp_path) in f]
        assert out.count() == 80


def test_neighbourhoods_are_dealt_to_many_tasks(spark, tmp_path):
    """The long work on few bytes must not be merged into one task."""
    out = knn.cop(_points(spark, str(tmp_path / "points")), 5)
    assert "RepartitionByExpression" in out._jdf.queryExecution().optimizedPlan().toString()


def test_valid_coordinates(spark):
    nan, inf = math.nan, math.inf
    rows = [(0, 1.0, 2.0), (1, None, 2.0), (2, 1.0, None), (3, nan, 2.0), (4, 1.0, nan), (5, None, None), (6, inf, -inf), (7, -0.0, 180.0)]
    frame = spark.createDataFrame(rows, "i int, decimallatitude double, decimallongitude double")
    assert {r["i"] for r in frame.where(valid_coordinates()).collect()} == {0, 6, 7}
    assert {r["i"] for r in frame.where(~valid_coordinates()).collect()} == {1, 2, 3, 4, 5}


def test_bins_hold_each_derived_coordinate_twice_at_most(spark):
    """Once in the filter, once as a column: more copies left the loop above the 8,000 bytes that HotSpot compiles."""
    spark.createDataFrame([(i, i % 4, i % 5, i % 6, "A", "F", "1995-01-01") for i in range(20)],
                          "l_orderkey long, l_linenumber long, l_suppkey long, l_partkey long, l_returnflag string, l_linestatus string, "
                          "l_shipdate string").withColumn("l_shipdate", F.to_date("l_shipdate")).createOrReplaceTempView("lineitem")
    spark.createDataFrame([(i, "t", "b", i) for i in range(6)], "p_partkey long, p_type string, p_brand string, p_size int").createOrReplaceTempView("part")
    occ = spark.sql(VIEWS["occurrences"])
    names = F.broadcast(spark.range(9).select(F.concat(F.lit("Genus0 sp"), "id").alias("species"), F.lit("Large").alias("occ_group")))
    bins = binning.bin_counts(apply_basis(occ, DEFAULT_BASIS).join(names, "species"), Graticule(1), extra_keys=("occ_group",))
    plan = bins._jdf.queryExecution().optimizedPlan().toString()
    for part in ("% 12000", "% 36000"):  # of the latitude, of the longitude
        assert 1 <= plan.count(part) <= 2
