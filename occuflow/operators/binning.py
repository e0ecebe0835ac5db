"""Cells per species and final binning.

Record volume never reaches a single task: every grouping below first
reduces on a key that includes the spatial cell (and, for binning, the
dataset key), so a species holding a third of all rows is spread over as many
tasks as it has cells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from occuflow.functions.cells import valid_coordinates, with_cells
from occuflow.operators.predicates import apply_basis
from occuflow.session import broadcast_if_small

BINNED_COLUMNS = ("H3", "species", "year", "record_count", "dataset_keys")
CELL_COLUMNS = ("LAT", "LON", "H3", "Species")


def distinct_species(occ: DataFrame) -> DataFrame:
    """Sorted distinct non-NULL species names (A5, F8)."""
    return occ.select("species").where(F.col("species").isNotNull()).distinct().orderBy("species")


def restrict_species(occ: DataFrame, species: DataFrame | None) -> DataFrame:
    """Records whose species is in ``species`` (semi-join, J2/F3/F4).

    Without a list every non-NULL species is kept, which is what deriving the
    list from the same input amounts to.  The list is bounded by the number
    of species; it is broadcast after its row count is checked, so the
    record side is not shuffled.
    """
    if species is None:
        return occ.where(F.col("species").isNotNull())
    names = species.select("species").where(F.col("species").isNotNull()).distinct()
    return occ.join(broadcast_if_small(names), "species", "left_semi")


def species_cells(occ: DataFrame, indexer, species: DataFrame | None = None,
                  basis=None) -> DataFrame:
    """Distinct (species, cell) with centroids: LAT, LON, H3, Species, cell (A4).

    The dedupe runs before the centroid is computed, so the centroid (a UDF
    for some indexers) is evaluated once per distinct cell.
    """
    df = apply_basis(restrict_species(occ, species), basis).where(valid_coordinates())
    df = with_cells(df.select("species", "decimallatitude", "decimallongitude"), indexer)
    cells = df.select(F.col("species").alias("Species"), "cell").distinct()
    lat, lon = indexer.centroid("cell")
    return cells.select(lat.alias("LAT"), lon.alias("LON"),
                        indexer.cell_string("cell").alias("H3"), "Species", "cell")


def bin_counts(occ: DataFrame, indexer, species: DataFrame | None = None,
               basis=None, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """Record count and dataset keys per (cell, species, year) (A3).

    Two-stage: (cell, species, year, datasetkey) counts first, then one row
    per group with the summed count and the sorted distinct dataset keys.
    A NULL dataset key is kept as one list element, and a NULL year is a
    group of its own.
    """
    df = apply_basis(restrict_species(occ, species), basis).where(valid_coordinates())
    keys = list(extra_keys)
    df = with_cells(df.select(*keys, "species", "year", "datasetkey",
                              "decimallatitude", "decimallongitude"), indexer)
    per_key = (df.groupBy(*keys, "cell", "species", "year", "datasetkey")
                 .agg(F.count(F.lit(1)).alias("_n")))
    grouped = (per_key.groupBy(*keys, "cell", "species", "year")
                      .agg(F.sum("_n").cast("long").alias("record_count"),
                           F.sort_array(F.transform(F.collect_list(F.struct("datasetkey")),
                                                    lambda s: s["datasetkey"]))
                            .alias("dataset_keys")))
    return grouped.select(indexer.cell_string("cell").alias("H3"), "species", "year",
                          "record_count", "dataset_keys", *keys)
