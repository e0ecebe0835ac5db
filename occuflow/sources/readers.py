"""Readers for the reference's inputs and hand-offs.

All readers return DataFrames with an explicit schema; nothing is inferred
from the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from occuflow.functions.text import file_stem

SCORE_SCHEMA = StructType([
    StructField("H3Index", StringType()),
    StructField("Species", StringType()),
    StructField("OutlierScore", DoubleType()),
])

CELLS_SCHEMA = StructType([
    StructField("LAT", DoubleType()),
    StructField("LON", DoubleType()),
    StructField("H3", StringType()),
    StructField("Species", StringType()),
])

SUMMARY_SCHEMA = StructType([
    StructField("Variable", StringType()),
    StructField("Value", StringType()),
])

COUNTS_SCHEMA = StructType([
    StructField("specieskey", LongType()),
    StructField("kingdom", StringType()),
    StructField("phylum", StringType()),
    StructField("class", StringType()),
    StructField("order", StringType()),
    StructField("family", StringType()),
    StructField("genus", StringType()),
    StructField("species", StringType()),
    StructField("NumRecords", LongType()),
    StructField("NumUniqCoordsRounded2dp", LongType()),
])

SPLIT_SCHEMA = StructType([
    StructField("species", StringType()),
    StructField("OccGroup", StringType()),
    StructField("NumUniqCoordsRounded2dp", LongType()),
])

EXTINCT_SCHEMA = StructType([
    StructField("specieskey", StringType()),
    StructField("highertaxon_key", StringType()),
    StructField("kingdom", StringType()),
    StructField("phylum", StringType()),
    StructField("order", StringType()),
    StructField("family", StringType()),
    StructField("genus", StringType()),
    StructField("species", StringType()),
])


def _is_dir(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_occurrences(spark: SparkSession, path: str) -> DataFrame:
    """Occurrence dump (S1): a directory (all data files in it), a glob or a file.

    A directory is passed as is, so Spark lists its data files and skips
    markers such as ``_SUCCESS``.
    """
    return spark.read.parquet(path)


def read_scores(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """Outlier scores (S2-S4): tab-separated H3Index, Species, OutlierScore.

    ``path`` may be a glob such as ``dir/*.txt.gz``; gzip is decoded by
    extension.  The schema is always explicit.
    """
    return (spark.read.schema(SCORE_SCHEMA).option("sep", "\t").option("header", header)
                 .option("mode", "FAILFAST").csv(path))


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """Exported cells: headerless CSV of LAT, LON, H3, Species."""
    return spark.read.schema(CELLS_SCHEMA).option("mode", "FAILFAST").csv(path)


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """An exported outlier summary: Variable and Value, tab-separated with header."""
    return spark.read.schema(SUMMARY_SCHEMA).option("sep", "\t").option("header", True).csv(path)


def read_species_list(spark: SparkSession, path: str) -> DataFrame:
    """One species name per line (S5), trimmed; names with commas or quotes survive."""
    return (spark.read.text(path).select(F.trim(F.col("value").cast("string")).alias("species"))
                 .where(F.length("species") > 0))


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """Count table exported as tab-separated text with header."""
    return spark.read.schema(COUNTS_SCHEMA).option("sep", "\t").option("header", True).csv(path)


def read_species_lists(spark: SparkSession, directory: str, group: str) -> DataFrame:
    """All ``*_<group>.txt`` lists of a directory with ``FileID``.

    ``group`` is ``large`` or ``small``; FileID is the file name without
    ``.txt``.  One read for all files.
    """
    if group not in ("large", "small"):
        raise ValueError("group must be 'large' or 'small'")
    df = (spark.read.schema(SPLIT_SCHEMA).option("sep", "\t").option("header", True)
               .csv(f"{directory.rstrip('/')}/*_{group}.txt"))
    return df.withColumn("FileID", file_stem(F.col("_metadata.file_name")))


def read_extinct(spark: SparkSession, path: str) -> DataFrame:
    """Extinct-taxa table, tab-separated with header."""
    return spark.read.schema(EXTINCT_SCHEMA).option("sep", "\t").option("header", True).csv(path)


# Newick: a tip label follows "(" or "," and ends before ":", ",", ")" or "[".
_NEWICK_TIP = r"[(,]\s*('(?:[^']|'')*'|[^\s(),:;\[\]']+)"


def tree_format(path: str) -> str:
    """Format from the extension (a trailing ``.gz`` is ignored)."""
    base = path[:-3] if path.lower().endswith(".gz") else path
    ext = base.rsplit(".", 1)[-1].lower() if "." in base else ""
    if ext in ("nex", "nexus"):
        return "nexus"
    if ext in ("tre", "nwk", "newick"):
        return "newick"
    raise ValueError(f"Unsupported file extension: {ext}")


def _unquote(c):
    return F.regexp_replace(F.regexp_replace(c, r"^'(.*)'$", "$1"), "''", "'")


def read_tree_tips(spark: SparkSession, path: str, tree: str, stage: str = "processed") -> DataFrame:
    """Tip labels of one tree file as (tree, stage, tip_label) rows.

    Only tip labels matter downstream, so topology and branch lengths are
    not parsed.  Newick: every label after "(" or ",".  Nexus: the TRANSLATE
    table's names if present, else the TAXLABELS list.
    """
    fmt = tree_format(path)
    text = spark.read.text(path, wholetext=True).select(F.col("value").alias("t"))
    if fmt == "newick":
        # Internal node labels follow ")" and are not matched.
        body = F.regexp_replace("t", r"\[[^\]]*\]", "")
        tips = F.regexp_extract_all(body, F.lit(_NEWICK_TIP), 1)
    else:
        translate = F.regexp_extract("t", r"(?is)\btranslate\b(.*?);", 1)
        taxlabels = F.regexp_extract("t", r"(?is)\btaxlabels\b(.*?);", 1)
        from_translate = F.regexp_extract_all(
            translate, F.lit(r"(?s)\S+\s+('(?:[^']|'')*'|[^\s,;']+)\s*(?:,|$)"), 1)
        from_taxlabels = F.regexp_extract_all(taxlabels, F.lit(r"('(?:[^']|'')*'|[^\s;']+)"), 1)
        tips = F.when(F.length(F.trim(translate)) > 0, from_translate).otherwise(from_taxlabels)
    return (text.select(F.explode(tips).alias("tip"))
                .select(F.lit(tree).alias("tree"), F.lit(stage).alias("stage"),
                        _unquote(F.col("tip")).alias("tip_label")))


def existing_trees(spark: SparkSession, manifest: list[tuple[str, str | None, str]]):
    """Drop manifest rows whose processed tree file is missing.

    ``manifest`` rows are (name, source_path or None, processed_path); the
    manifest is a small configuration list, checked on the driver.
    """
    kept = []
    for name, source, processed in manifest:
        if path_exists(spark, processed):
            kept.append((name, source, processed))
        else:
            print(f"Record removed: {name} (missing file: {processed})")
    return kept


def read_trees(spark: SparkSession, manifest: list[tuple[str, str | None, str]]) -> DataFrame:
    """All trees of a manifest as one (tree, stage, tip_label) table."""
    frames = []
    for name, source, processed in existing_trees(spark, manifest):
        frames.append(read_tree_tips(spark, processed, name, "processed"))
        if source:
            frames.append(read_tree_tips(spark, source, name, "source"))
    if not frames:
        raise ValueError("no tree file found")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
