"""Writers for the reference's outputs."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from occuflow.operators.counts import sorted_counts
from occuflow.session import _hadoop_path, cut_lineage


def check_zstd_level(level) -> int:
    """ZSTD compression level must be an integer 0-22."""
    if isinstance(level, bool) or not isinstance(level, int) or not 0 <= level <= 22:
        raise ValueError("ZSTD compression level must be an integer between 0 and 22")
    return level


def write_parquet_zstd(df: DataFrame, path: str, level: int = 10, mode: str = "overwrite",
                       partition_by: list[str] | None = None) -> None:
    """Parquet with ZSTD at ``level`` (S11 level 10, S12 level 14)."""
    check_zstd_level(level)
    w = (df.write.mode(mode).option("compression", "zstd")
           .option("parquet.compression.codec.zstd.level", str(level)))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_pooled(df: DataFrame, path: str, rows_per_file: int = 300_000, level: int = 14,
                 mode: str = "overwrite") -> None:
    """Evenly sized Parquet files: one row group of ``rows_per_file`` rows each.

    The input is written once as a stage table, whose count is free, and then
    spread over ceil(rows / rows_per_file) partitions, so each task writes
    about one full file and tails stay few.
    """
    check_zstd_level(level)
    if rows_per_file <= 0:
        raise ValueError("rows_per_file must be positive")
    df = cut_lineage(df)
    n = df.count()
    parts = max(1, math.ceil(n / rows_per_file))
    (df.repartition(parts).write.mode(mode)
       .option("compression", "zstd")
       .option("parquet.compression.codec.zstd.level", str(level))
       .option("maxRecordsPerFile", rows_per_file)
       .option("parquet.block.row.count.limit", rows_per_file)
       .parquet(path))


def write_tsv(df: DataFrame, path: str, header: bool = True, gzip: bool = True,
              single_file: bool = False, mode: str = "overwrite") -> None:
    """Tab-separated text (S14-S19).  ``single_file`` only for small tables."""
    out = df.coalesce(1) if single_file else df
    w = out.write.mode(mode).option("sep", "\t").option("header", header)
    if gzip:
        w = w.option("compression", "gzip")
    w.csv(path)


def export_counts(counts: DataFrame, path: str) -> None:
    """Sorted count table as gzip TSV with header.

    A global sort range-partitions the table; with ``coalesce(1)`` the
    sorted ranges are concatenated in order into one file.
    """
    write_tsv(sorted_counts(counts), path, header=True, gzip=True, single_file=True)


def export_cells(cells: DataFrame, path: str) -> None:
    """Headerless gzip CSV of LAT, LON, H3, Species."""
    (cells.select("LAT", "LON", "H3", "Species").write.mode("overwrite")
          .option("header", False).option("compression", "gzip").csv(path))


def export_scores(scores: DataFrame, path: str) -> None:
    """All species' scores in one gzip TSV with header."""
    write_tsv(scores.select("H3Index", "Species", "OutlierScore"), path, header=True, gzip=True)


def export_summary(summary: DataFrame, path: str) -> None:
    """Ten-row outlier summary as one TSV with header."""
    write_tsv(summary, path, header=True, gzip=False, single_file=True)


def export_species(species: DataFrame, path: str) -> None:
    """Headerless species names, one per line."""
    species.select(F.col("species").cast("string")).write.mode("overwrite").text(path)


def export_tree_tables(stats: DataFrame, split: DataFrame, path: str) -> None:
    """Tree statistics and Large/Small lists, one directory per tree."""
    write_tsv(stats.withColumn("tree", F.col("Tree")), f"{path}/stats", header=True, gzip=False)
    (split.write.mode("overwrite").partitionBy("tree", "OccGroup").option("sep", "\t")
          .option("header", True).csv(f"{path}/lists"))


def export_species_lists(split: DataFrame, directory: str) -> None:
    """Per-tree lists as single files ``<tree>_large.txt`` and ``<tree>_small.txt`` (S19, read by S7).

    One job writes all lists, one task per list (bounded by the species of a
    tree); each file then gets its name in place.
    """
    from urllib.parse import unquote

    spark, base = split.sparkSession, directory.rstrip("/")
    parts = f"{base}/.parts"
    (split.select(F.col("tree").alias("_tree"), F.lower("OccGroup").alias("_group"), "species", "OccGroup", "NumUniqCoordsRounded2dp")
          .repartition("_tree", "_group").sortWithinPartitions("_tree", "_group", "species")
          .write.mode("overwrite").partitionBy("_tree", "_group").option("sep", "\t").option("header", True).csv(parts))
    fs, top = _hadoop_path(spark, parts)
    for tree in fs.listStatus(top):
        for group in (fs.listStatus(tree.getPath()) if tree.isDirectory() else []):
            label = [unquote(x.getPath().getName().split("=", 1)[1]) for x in (tree, group)]
            for part in fs.listStatus(group.getPath()):
                if part.getPath().getName().startswith("part-"):
                    _, target = _hadoop_path(spark, f"{base}/{label[0]}_{label[1]}.txt")
                    fs.delete(target, False)
                    fs.rename(part.getPath(), target)
    fs.delete(top, True)


def export_trees(tips: DataFrame, directory: str, form: str = "nwk") -> list[tuple[str, str | None, str]]:
    """Star trees of the tips, one folder per (tree, stage) (inverse of S9); returns their manifest.

    ``form``: ``nwk`` or ``nex``.  The number of trees is small; a tree's labels
    make one text.
    """
    if form not in ("nwk", "nex"):
        raise ValueError("form must be 'nwk' or 'nex'")
    quoted = F.concat(F.lit("'"), F.regexp_replace("tip_label", "'", "''"), F.lit("'"))
    label = F.when(F.col("tip_label").rlike(r"[\s(),:;\[\]']"), quoted).otherwise(F.col("tip_label"))
    if form == "nwk":
        text = F.concat(F.lit("("), F.array_join(F.sort_array(F.collect_list(F.concat(label, F.lit(":1.0")))), ","), F.lit(");"))
    else:
        names = F.sort_array(F.collect_list(label))
        listed = F.transform(names, lambda x, i: F.concat((i + 1).cast("string"), F.lit(" "), x))
        text = F.concat(F.lit("#NEXUS\nBEGIN TREES;\n TRANSLATE\n"), F.array_join(listed, ",\n"), F.lit("\n ;\nEND;\n"))
    texts = cut_lineage(tips.groupBy("tree", "stage").agg(text.alias("value")))
    manifest: dict[str, dict[str, str]] = {}
    for r in texts.select("tree", "stage").collect():
        path = f"{directory.rstrip('/')}/{r['tree']}_{r['stage']}.{form}.gz"
        (texts.where((F.col("tree") == r["tree"]) & (F.col("stage") == r["stage"])).select("value")
              .coalesce(1).write.mode("overwrite").option("compression", "gzip").text(path))
        manifest.setdefault(r["tree"], {})[r["stage"]] = path
    return [(t, m.get("source"), m.get("processed", f"{directory}/{t}.missing")) for t, m in sorted(manifest.items())]


def noise_members(labelled: DataFrame, label: str = "cluster") -> DataFrame:
    """Members of the noise "cluster" (label -1)."""
    return labelled.where(F.col(label) == -1)


def split_by_label(labelled: DataFrame, label: str = "cluster") -> tuple[DataFrame, DataFrame]:
    """(retained, outliers): label != -1 kept, == -1 outliers."""
    retained = labelled.where(F.col(label) != -1).drop(label)
    outliers = labelled.where(F.col(label) == -1)
    return retained, outliers
