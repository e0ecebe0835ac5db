"""Pool per-tree species lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pool_species(split: DataFrame, extinct: DataFrame | None = None) -> DataFrame:
    """Union of all trees' lists, unique by species within each group.

    Large and Small are deduplicated independently, so a name under two keys
    can land in both lists (as in the reference).  Extinct names are removed
    by an anti-join on the name.  Output: (occ_group, species), sorted.
    """
    pooled = split.select(F.col("OccGroup").alias("occ_group"), "species").distinct()
    if extinct is not None:
        names = extinct.select("species").where(F.col("species").isNotNull()).distinct()
        pooled = pooled.join(names, "species", "left_anti")
    return pooled.select("occ_group", "species").orderBy("occ_group", "species")


def species_list(pooled: DataFrame, group: str) -> DataFrame:
    return pooled.where(F.col("occ_group") == group).select("species")


def pool_progress(split: DataFrame, pooled: DataFrame) -> DataFrame:
    """Progress counts (A12): unique species per group before/after extinct removal."""
    before = (split.groupBy(F.col("OccGroup").alias("occ_group"))
                   .agg(F.countDistinct("species").alias("unique_species")))
    after = pooled.groupBy("occ_group").agg(F.count(F.lit(1)).alias("unique_species_not_extinct"))
    return before.join(after, "occ_group", "full")
