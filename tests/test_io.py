"""Readers and writers on temporary files."""

import glob
import gzip
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from occuflow.sources import readers, sinks


def test_score_reader_many_gz_files(spark, tmp_path):
    for i in range(2):
        with gzip.open(tmp_path / f"s{i}.txt.gz", "wt") as f:
            f.write(f"8a1\tSp {i}\t1\n8a2\tSp {i}\t0.5\n")
    df = readers.read_scores(spark, str(tmp_path / "*.txt.gz"))
    assert df.dtypes == [("H3Index", "string"), ("Species", "string"), ("OutlierScore", "double")]
    assert df.count() == 4 and df.where("OutlierScore = 0.5").count() == 2


def test_species_list_keeps_commas_and_quotes(spark, tmp_path):
    p = tmp_path / "names.txt"
    p.write_text("Genus a\nX'y, z\n\n")
    assert [r.species for r in readers.read_species_list(spark, str(p)).collect()] == [
        "Genus a", "X'y, z"]


def test_species_lists_with_file_id(spark, tmp_path):
    for name in ("TreeA", "TreeB"):
        (tmp_path / f"{name}_large.txt").write_text(
            "species\tOccGroup\tNumUniqCoordsRounded2dp\nA a\tLarge\t200\n")
    df = readers.read_species_lists(spark, str(tmp_path), "large")
    assert sorted(r.FileID for r in df.collect()) == ["TreeA_large", "TreeB_large"]


def test_newick_and_nexus_tips(spark, tmp_path):
    nwk = tmp_path / "t.nwk"
    nwk.write_text("((Genus_a:1.0,'Genus b':2)inner:0.5,[comment]Genus_c__x:3);")
    tips = [r.tip_label for r in readers.read_tree_tips(spark, str(nwk), "T").collect()]
    assert tips == ["Genus_a", "Genus b", "Genus_c__x"]
    with gzip.open(tmp_path / "t.nex.gz", "wt") as f:
        f.write("#NEXUS\nBEGIN TREES;\n TRANSLATE\n 1 Genus_a,\n 2 Genus_b\n ;\n"
                " TREE t1 = (1:1,2:1);\nEND;\n")
    tips = [r.tip_label for r in
            readers.read_tree_tips(spark, str(tmp_path / "t.nex.gz"), "T", "source").collect()]
    assert tips == ["Genus_a", "Genus_b"]
    with pytest.raises(ValueError):
        readers.tree_format("tree.phy")


def test_manifest_drops_missing_trees(spark, tmp_path):
    ok = tmp_path / "a.nwk"
    ok.write_text("(A_a,B_b);")
    kept = readers.existing_trees(spark, [("A", None, str(ok)),
                                          ("B", None, str(tmp_path / "missing.nwk"))])
    assert [k[0] for k in kept] == ["A"]
    assert readers.read_trees(spark, kept).count() == 2


def test_pooled_parquet_files_are_evenly_sized(spark, tmp_path):
    df = spark.range(0, 2500).withColumn("v", F.col("id") * 2)
    out = str(tmp_path / "pooled")
    sinks.write_pooled(df, out, rows_per_file=1000, level=14)
    files = sorted(glob.glob(os.path.join(out, "*.parquet")))
    sizes = sorted(pq.ParquetFile(f).metadata.num_rows for f in files)
    assert sum(sizes) == 2500 and max(sizes) <= 1000
    assert all(pq.ParquetFile(f).metadata.num_row_groups == 1 for f in files)
    meta = pq.ParquetFile(files[0]).metadata.row_group(0).column(0)
    assert meta.compression == "ZSTD"


def test_tsv_exports(spark, tmp_path):
    df = spark.createDataFrame([("c", "S", 1.0)], "H3Index string, Species string, OutlierScore double")
    sinks.export_scores(df, str(tmp_path / "scores"))
    back = readers.read_scores(spark, str(tmp_path / "scores" / "*.csv.gz"), header=True)
    assert back.collect()[0].OutlierScore == 1.0
    labelled = spark.createDataFrame([(1, -1), (2, 0)], "id int, cluster int")
    kept, out = sinks.split_by_label(labelled)
    assert kept.columns == ["id"] and out.count() == 1
    assert sinks.noise_members(labelled).count() == 1
