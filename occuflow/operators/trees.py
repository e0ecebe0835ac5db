"""Tree coverage statistics and the Large/Small split.

Trees are only sets of tip labels here: one long table
``(tree, stage, tip_label)`` with ``stage`` = ``processed`` (after name
matching) or ``source`` (initial tree).  All trees are handled by one plan
grouped by ``tree`` instead of one job per tree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from occuflow.functions.text import percent, tip_to_species

STATS_COLUMNS = (
    "Tree", "SpeciesInSourceTree", "SpeciesInTree", "SpeciesInGBIF", "SpeciesNotInGBIF",
    "OverallTreeTipsNotInGBIF", "Pct_NameMatchedSpecies", "Pct_SpeciesInGBIF",
    "Pct_SpeciesNotInGBIF", "Pct_OverallTreeTipsNotInGBIF", "NumUniqueOccurrences",
    "NumNonRedundantOccurrences",
)
STATS_COLUMNS_NO_SOURCE = (
    "Tree", "SpeciesInTree", "SpeciesInGBIF", "SpeciesNotInGBIF", "Pct_SpeciesInGBIF",
    "Pct_SpeciesNotInGBIF", "NumUniqueOccurrences", "NumNonRedundantOccurrences",
)


def processed_tips(tips: DataFrame) -> DataFrame:
    """Processed tip rows with their species name (duplicates kept)."""
    return (tips.where(F.col("stage") == "processed")
                .select("tree", "tip_label", tip_to_species("tip_label").alias("species")))


def matched_counts(counts: DataFrame, tips: DataFrame) -> DataFrame:
    """Count rows whose species name is a tip of the tree, per tree.

    A semi-join per tree: count rows × distinct (tree, species) tips.  Two
    keys sharing a name both match, as in the reference.
    """
    tree_species = processed_tips(tips).select("tree", "species").distinct()
    return counts.join(tree_species, "species", "inner")


def tree_stats(counts: DataFrame, tips: DataFrame, with_source: bool = True) -> DataFrame:
    proc = processed_tips(tips)
    in_tree = proc.groupBy("tree").agg(F.count(F.lit(1)).alias("SpeciesInTree"))

    matched = (matched_counts(counts, tips)
               .groupBy("tree")
               .agg(F.count(F.lit(1)).alias("SpeciesInGBIF"),
                    F.sum("NumRecords").cast("long").alias("NumUniqueOccurrences"),
                    F.sum("NumUniqCoordsRounded2dp").cast("long")
                     .alias("NumNonRedundantOccurrences")))

    # Tip rows (duplicates count) whose name has no count row.
    count_names = counts.select("species").where(F.col("species").isNotNull()).distinct()
    not_in = (proc.join(count_names, "species", "left_anti")
                  .groupBy("tree").agg(F.count(F.lit(1)).alias("SpeciesNotInGBIF")))

    stats = (in_tree.join(matched, "tree", "left").join(not_in, "tree", "left")
             .select(F.col("tree").alias("Tree"), "SpeciesInTree",
                     F.coalesce("SpeciesInGBIF", F.lit(0)).cast("long").alias("SpeciesInGBIF"),
                     F.coalesce("SpeciesNotInGBIF", F.lit(0)).cast("long").alias("SpeciesNotInGBIF"),
                     F.coalesce("NumUniqueOccurrences", F.lit(0)).cast("long")
                      .alias("NumUniqueOccurrences"),
                     F.coalesce("NumNonRedundantOccurrences", F.lit(0)).cast("long")
                      .alias("NumNonRedundantOccurrences"))
             .withColumn("Pct_SpeciesInGBIF", percent("SpeciesInGBIF", "SpeciesInTree"))
             .withColumn("Pct_SpeciesNotInGBIF", percent("SpeciesNotInGBIF", "SpeciesInTree")))
    if not with_source:
        return stats.select(*STATS_COLUMNS_NO_SOURCE)

    source = (tips.where(F.col("stage") == "source").groupBy("tree")
                  .agg(F.count(F.lit(1)).alias("SpeciesInSourceTree"))
                  .withColumnRenamed("tree", "Tree"))
    # A tree without a source tree is still reported, its source columns NULL.
    stats = (stats.join(source, "Tree", "left")
             .withColumn("OverallTreeTipsNotInGBIF",
                         F.col("SpeciesInSourceTree") - F.col("SpeciesInGBIF"))
             .withColumn("Pct_NameMatchedSpecies", percent("SpeciesInTree", "SpeciesInSourceTree"))
             .withColumn("Pct_OverallTreeTipsNotInGBIF",
                         percent("OverallTreeTipsNotInGBIF", "SpeciesInSourceTree")))
    return stats.select(*STATS_COLUMNS)


def split_species(counts: DataFrame, tips: DataFrame, threshold: int = 100) -> DataFrame:
    """Per tree: matched species with ``OccGroup`` Large (≥ threshold) / Small."""
    if threshold is None or threshold < 0:
        raise ValueError("occurrence threshold must be a non-negative number")
    return (matched_counts(counts, tips)
            .select("tree", "species",
                    F.when(F.col("NumUniqCoordsRounded2dp") >= F.lit(threshold), F.lit("Large"))
                     .otherwise(F.lit("Small")).alias("OccGroup"),
                    "NumUniqCoordsRounded2dp"))
