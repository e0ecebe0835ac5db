"""Whole-pipeline plans (W1-W4): one lazy plan for every species at once.

The reference runs one job per tree and two full scans per Large species;
here species is a key column, so each step is one scan/aggregate/join over
all species, and Spark schedules the stages.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from occuflow.functions.cells import HexCells, with_cells
from occuflow.operators.binning import bin_counts, species_cells
from occuflow.operators.counts import species_counts
from occuflow.operators.density import dbscan_noise
from occuflow.operators.outliers import (checked_flagged_cells, outlier_summary,
                                         remove_outliers)
from occuflow.operators.pool import pool_species, species_list
from occuflow.operators.predicates import DEFAULT_BASIS, apply_basis, parse_basis
from occuflow.operators.trees import split_species, tree_stats
from occuflow.session import broadcast_if_small, cut_lineage


@dataclass(frozen=True)
class Params:
    """Run parameters with the reference's defaults.

    Cells default to hexagons of H3's resolutions 6 (outlier detection) and 4
    (final bins) with ids of their own; pass ``H3Cells(6)`` and ``H3Cells(4)``
    where the ``h3`` package is installed, or ``Graticule`` cells, which are
    plain SQL.  Distances default to the WGS84 spheroid.
    """

    basis: tuple[str, ...] | None = DEFAULT_BASIS
    occurrence_threshold: int = 100
    dbscan_minpts: int = 3
    dbscan_eps_m: float = 1_000_000.0
    nodbscan: bool = False
    outlier_cells: object = field(default_factory=lambda: HexCells(6))
    final_cells: object = field(default_factory=lambda: HexCells(4))
    geomodel: str = "wgs84"
    summary_threshold: float = 0.5
    overlap: str = "both"

    def __post_init__(self):
        parse_basis(self.basis)
        if self.occurrence_threshold < 0:
            raise ValueError("occurrence threshold must be non-negative")
        if self.dbscan_minpts < 1 or self.dbscan_eps_m <= 0:
            raise ValueError("DBSCAN needs minpts >= 1 and eps > 0")
        if self.overlap not in ("both", "large"):
            raise ValueError("overlap must be 'both' or 'large'")


def run(occ: DataFrame, tips: DataFrame, extinct: DataFrame | None = None,
        params: Params = Params()) -> dict[str, DataFrame]:
    """W1 (outlier removal) or W2 (``nodbscan``); returns named DataFrames.

    ``binned`` is the union of the Small-species bins and the Large-species
    bins (cleaned or raw), without re-aggregation, as the pooled Parquet
    files of the reference.  With ``overlap='large'`` a name present in both
    lists is binned once, as Large.
    """
    out: dict[str, DataFrame] = {}
    # Cut once: four of the run's tables read the counts.
    counts = cut_lineage(species_counts(occ, params.basis))
    out["counts"] = counts
    out["tree_stats"] = tree_stats(counts, tips)
    split = split_species(counts, tips, params.occurrence_threshold)
    out["split"] = split
    # The pooled list feeds three later scans: cut it once so the counting
    # scan is not repeated, and broadcast it when its row count allows, so
    # the record side is never shuffled by species.
    pooled = broadcast_if_small(pool_species(split, extinct))
    out["pooled"] = pooled
    large = species_list(pooled, "Large")
    if params.overlap == "large":
        pooled = pooled.join(large.withColumn("_l", F.lit(1)), "species", "left")
        pooled = pooled.where((F.col("occ_group") == "Large") | F.col("_l").isNull()).drop("_l")

    # One scan for the final bins: each record is tagged with its list(s)
    # (a name in both lists is binned twice, as the reference does).
    tagged = (apply_basis(occ, params.basis)
              .join(pooled.select("species", "occ_group"), "species", "inner"))
    if params.nodbscan:
        kept = tagged
    else:
        cells = cut_lineage(species_cells(occ, params.outlier_cells, large, params.basis))
        scored = dbscan_noise(cells, params.dbscan_eps_m, params.dbscan_minpts,
                              geomodel=params.geomodel)
        scores = cut_lineage(scored.select(F.col("H3").alias("H3Index"), "Species", "OutlierScore"))
        out["cells"] = cells
        out["scores"] = scores
        out["outlier_summary"] = outlier_summary(scores, params.summary_threshold)
        flagged = checked_flagged_cells(scores)
        out["cleaned"] = remove_outliers(occ, scores, params.outlier_cells, large, params.basis,
                                         flagged=flagged)
        with_cell = (with_cells(tagged, params.outlier_cells, out="_ocell")
                     .withColumn("h3_index", params.outlier_cells.cell_string("_ocell")))
        # Small-list records never match a flagged (species, cell): only
        # Large-list copies are checked, by a condition of the one anti-join.
        bad = flagged.select(F.col("species").alias("_fs"), F.col("h3_index").alias("_fc"))
        kept = with_cell.join(
            bad, (F.col("occ_group") == "Large") & (F.col("species") == F.col("_fs"))
            & (F.col("h3_index") == F.col("_fc")), "left_anti").drop("_ocell", "h3_index")
    binned = bin_counts(kept, params.final_cells, None, None, extra_keys=("occ_group",))
    out["binned"] = binned.drop("occ_group")
    return out
