"""Output layout (S20) and writing a whole run's tables (W1 outputs)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from occuflow.operators.pool import species_list
from occuflow.plans.pipeline import Params, run
from occuflow.session import stage_scope
from occuflow.sources import sinks


def output_paths(outdir: str, userid: str | None = None) -> dict[str, str]:
    """``<outdir>[/<userid>]/{Tree_stats,Filtered_parquet,Outliers}``."""
    base = outdir.rstrip("/") + (f"/{userid}" if userid else "")
    return {"tree_stats": f"{base}/Tree_stats", "filtered": f"{base}/Filtered_parquet",
            "outliers": f"{base}/Outliers"}


def write_outputs(results: dict[str, DataFrame], outdir: str, userid: str | None = None,
                  rows_per_file: int = 300_000) -> dict[str, str]:
    """Write the published tables of :func:`plans.pipeline.run`.

    Tree_stats: count table (Parquet ZSTD 14 and sorted gzip TSV), tree
    statistics and per-tree Large/Small lists, pooled species lists.
    Outliers (when outlier removal ran): cell centroids, merged scores,
    10-row summary.  Filtered_parquet: the binned table in evenly sized
    Parquet files.
    """
    p = output_paths(outdir, userid)
    sinks.write_parquet_zstd(results["counts"], f"{p['tree_stats']}/occurrence_counts.parquet", 14)
    sinks.export_counts(results["counts"], f"{p['tree_stats']}/occurrence_counts.tsv.gz")
    sinks.export_tree_tables(results["tree_stats"], results["split"], f"{p['tree_stats']}/trees")
    for group in ("Large", "Small"):
        sinks.export_species(species_list(results["pooled"], group).orderBy("species"),
                             f"{p['tree_stats']}/pooled_{group.lower()}")
    if "scores" in results:
        sinks.export_cells(results["cells"], f"{p['outliers']}/cells")
        sinks.export_scores(results["scores"], f"{p['outliers']}/outlier_scores")
        sinks.export_summary(results["outlier_summary"], f"{p['outliers']}/outlier_scores_summary")
    sinks.write_pooled(results["binned"], p["filtered"], rows_per_file=rows_per_file, level=14)
    return p



def run_and_write(occ: DataFrame, tips: DataFrame, outdir: str, extinct: DataFrame | None = None,
                  params: Params = Params(), userid: str | None = None,
                  rows_per_file: int = 300_000) -> dict[str, str]:
    """A whole run with its published tables; its stage tables go at the end."""
    with stage_scope(occ.sparkSession):
        return write_outputs(run(occ, tips, extinct, params), outdir, userid, rows_per_file)
