"""Using outlier scores: removal (J3, F6, P2), summary (A7), flags and
descriptive tables (A8-A11).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from occuflow.functions.cells import with_cells
from occuflow.functions.text import percent, round_half_away
from occuflow.operators.binning import restrict_species
from occuflow.operators.predicates import apply_basis
from occuflow.session import broadcast_if_small, cut_lineage

SCORE_COLUMNS = ("H3Index", "Species", "OutlierScore")
# Fixed value: cells scoring at or above this are removed (the reference's
# removal step keeps ``score < 0.5 OR score IS NULL``).
REMOVAL_THRESHOLD = 0.5


def flagged_cells(scores: DataFrame) -> DataFrame:
    """(species, cell string) pairs whose score removes them: NOT (score < 0.5).

    The score is compared as a 4-byte float, as the reference reads it; a
    NaN score removes the cell, a NULL score does not.
    """
    s = F.col("OutlierScore").cast("float")
    return (scores.where(s.isNotNull() & ~(s < F.lit(REMOVAL_THRESHOLD)))
                  .select(F.col("Species").alias("species"), F.col("H3Index").alias("h3_index"))
                  .distinct())


def checked_flagged_cells(scores: DataFrame) -> DataFrame:
    """Flagged cells materialised once and marked for broadcast when their
    row count is within the bound (see ``session.broadcast_if_small``)."""
    return broadcast_if_small(flagged_cells(scores))


def drop_flagged(records: DataFrame, scores: DataFrame | None = None,
                 flagged: DataFrame | None = None) -> DataFrame:
    """Anti-join of records (with ``species``, ``h3_index``) on flagged cells.

    Only the flagged (species, cell) pairs travel; materialised and broadcast
    when small, the record side is not shuffled.  Pass ``flagged`` (from
    :func:`checked_flagged_cells`) to share one materialisation.
    """
    if flagged is None:
        flagged = checked_flagged_cells(scores)
    return records.join(flagged, ["species", "h3_index"], "left_anti")


def remove_outliers(occ: DataFrame, scores: DataFrame, indexer, species: DataFrame | None = None,
                    basis=None, flagged: DataFrame | None = None) -> DataFrame:
    """All raw columns of the kept records plus ``h3_index`` (cell string).

    Keeps ``score < 0.5 OR score IS NULL`` of a left join on (species, cell):
    a cell flagged for one species must not remove another species' records.
    Records without coordinates have no cell, match no score and are kept, as
    in the reference.
    """
    if species is None:
        species = scores.select(F.col("Species").alias("species")).distinct()
    df = apply_basis(restrict_species(occ, species), basis)
    cols = df.columns
    df = (with_cells(df, indexer, out="_cell")
          .withColumn("h3_index", indexer.cell_string("_cell")).drop("_cell"))
    return drop_flagged(df, scores, flagged).select(*cols, "h3_index")


# Bins per group of the exact quantiles: a task ranks about 1/256 of a group's values.
QUANTILE_BINS = 256


def exact_quantiles(values: DataFrame, probs: list[float], by: list[str], value: str) -> DataFrame:
    """``by`` columns, ``n`` and ``q``: exact linear-interpolation quantiles (R type 7).

    No buffer holds a group's values.  Distinct values are counted; a sketch
    of bounded size splits them into ``QUANTILE_BINS`` bins of about equal
    size; exact bin counts say which bins hold the wanted ranks, and only the
    values of those bins are ranked, each bin in its own task.  NULL values
    are ignored; a group without values has no row.
    """
    key = F.struct(*by) if by else F.lit(0)
    per_value = cut_lineage(values.where(F.col(value).isNotNull())
                            .groupBy(*by, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_w"))
                            .withColumn("_g", key))
    cuts = per_value.groupBy("_g").agg(
        F.sum("_w").alias("_n"),
        F.percentile_approx("_v", [i / QUANTILE_BINS for i in range(1, QUANTILE_BINS)], 10_000).alias("_c"))
    binned = (per_value.join(cuts.select("_g", "_c"), "_g")
              .withColumn("_b", F.size(F.filter("_c", lambda c: c < F.col("_v")))).drop("_c"))
    bins = binned.groupBy("_g", "_b").agg(F.sum("_w").alias("_bn"))
    before = F.coalesce(F.sum("_bn").over(
        Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pos = lambda p: F.lit(float(p)) * (F.col("_n") - 1)
    ranks = cuts.select("_g", F.explode(F.array_distinct(F.flatten(F.array(*[
        F.array(F.floor(pos(p)), F.ceil(pos(p))) for p in probs])))).alias("_r"))
    wanted = (bins.withColumn("_before", before).join(ranks, "_g")
              .where((F.col("_r") >= F.col("_before")) & (F.col("_r") < F.col("_before") + F.col("_bn")))
              .groupBy("_g", "_b", "_before").agg(F.collect_list("_r").alias("_rs")))
    inner = F.sum("_w").over(Window.partitionBy("_g", "_b").orderBy("_v"))
    at = (binned.join(wanted, ["_g", "_b"]).withColumn("_end", F.col("_before") + inner)
          .withColumn("_rs", F.filter("_rs", lambda r: (r < F.col("_end")) & (r >= F.col("_end") - F.col("_w"))))
          .where(F.size("_rs") > 0).select("_g", F.explode("_rs").alias("_r"), "_v"))
    picked = at.groupBy("_g").agg(F.map_from_entries(F.collect_list(F.struct("_r", "_v"))).alias("_m")).join(
        cuts.select("_g", "_n"), "_g")

    def quantile(p: float):
        x = pos(p)
        lo, hi = F.col("_m")[F.floor(x)], F.col("_m")[F.ceil(x)]
        return F.when(F.floor(x) == F.ceil(x), lo).otherwise((F.ceil(x) - x) * lo + (x - F.floor(x)) * hi)

    return picked.select(*[F.col(f"_g.{c}") for c in by], F.col("_n").alias("n"),
                         F.array(*[quantile(p) for p in probs]).alias("q"))


SUMMARY_VARIABLES = (
    "Total_records", "Unique_H3_cells", "Unique_species", "Total_outliers",
    "Average_number_of_outliers_per_species", "Minimum_outlier_score", "Q1_outlier_score",
    "Median_outlier_score", "Q3_outlier_score", "Maximum_outlier_score",
)


def outlier_summary(scores: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Ten (Variable, Value) rows in the reference's order.

    One aggregate over the scores for counts and extremes, exact binned
    quantiles for the quartiles, then ``stack``.
    """
    t = F.lit(float(threshold))
    is_out = F.col("OutlierScore") > t
    counts = scores.agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("H3Index").alias("cells"),
        F.countDistinct("Species").alias("species"),
        F.count_if(is_out).alias("outliers"),
        F.countDistinct(F.when(is_out, F.col("Species"))).alias("out_species"))
    quart = scores.agg(F.min("OutlierScore").alias("mn"), F.max("OutlierScore").alias("mx")).join(
        F.broadcast(exact_quantiles(scores, [0.25, 0.5, 0.75], [], "OutlierScore")), F.lit(True), "left")
    c = counts.select(
        F.col("n").cast("string").alias("v1"), F.col("cells").cast("string").alias("v2"),
        F.col("species").cast("string").alias("v3"), F.col("outliers").cast("string").alias("v4"),
        round_half_away(F.try_divide(F.col("outliers").cast("double"), F.col("out_species")), 3)
         .cast("string").alias("v5"))
    q = quart.select(F.col("mn").cast("string").alias("v6"),
                     F.col("q")[0].cast("string").alias("v7"),
                     F.col("q")[1].cast("string").alias("v8"),
                     F.col("q")[2].cast("string").alias("v9"),
                     F.col("mx").cast("string").alias("v10"))
    rows_c = c.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("idx"), F.lit(SUMMARY_VARIABLES[i - 1]).alias("Variable"),
                 F.col(f"v{i}").alias("Value")) for i in range(1, 6)])))
    rows_q = q.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("idx"), F.lit(SUMMARY_VARIABLES[i - 1]).alias("Variable"),
                 F.col(f"v{i}").alias("Value")) for i in range(6, 11)])))
    return rows_c.unionByName(rows_q).orderBy("idx").select("Variable", "Value")


# --------------------------------------------------------------------------
# Report tables.

# IQR multipliers of the quantile outlier modes.
IQR_MULTIPLIER = {"low": 2.0, "medium": 1.5, "high": 1.0}


def quantile_thresholds(scores: DataFrame, by: str | None = "Species",
                        score: str = "OutlierScore") -> DataFrame:
    """Per group q1, q3 and the three ``q3 + m * IQR`` thresholds.

    Quantiles are exact with linear interpolation (R's default type 7).
    """
    grp = [by] if by else []
    q = exact_quantiles(scores.where(~F.isnan(score)), [0.25, 0.75], grp, score)
    out = q.select(*grp, F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"))
    for mode, m in IQR_MULTIPLIER.items():
        out = out.withColumn(f"threshold_{mode}",
                             F.col("q3") + F.lit(m) * (F.col("q3") - F.col("q1")))
    return out


def flag_outliers(scores: DataFrame, mode: str = "medium", threshold: float | None = None,
                  by: str | None = "Species", score: str = "OutlierScore",
                  display_multiplier: float = 5.0) -> DataFrame:
    """Rows with ``Outlier`` (1 if score >= threshold, NULL stays NULL).

    ``mode`` ``threshold`` uses the fixed ``threshold``; otherwise the
    per-group quantile threshold.  An infinite score counts as twice the
    threshold; ``DisplayScore`` is capped at ``display_multiplier`` times it.
    """
    if mode == "threshold":
        if threshold is None:
            raise ValueError("mode 'threshold' needs a threshold value")
        df = scores.withColumn("_thr", F.lit(float(threshold)))
    elif mode in IQR_MULTIPLIER:
        thr = quantile_thresholds(scores, by, score).select(
            *([by] if by else []), F.col(f"threshold_{mode}").alias("_thr"))
        if by:
            df = scores.join(thr, by, "left")
        else:
            # One aggregate row, joined by broadcast: nothing runs while the plan is built.
            df = scores.join(F.broadcast(thr), F.lit(True), "left")
    else:
        raise ValueError(f"unknown outlier mode {mode!r}")
    s = F.col(score)
    inf = s.isin(float("inf"), float("-inf"))
    eff = F.when(inf, F.col("_thr") * 2).otherwise(s)
    return (df.withColumn("Outlier", F.when(eff.isNull() | F.isnan(eff), F.lit(None).cast("int"))
                                      .when(eff < F.col("_thr"), F.lit(0)).otherwise(F.lit(1)))
              .withColumn("DisplayScore",
                          F.least(eff, F.col("_thr") * F.lit(display_multiplier)))
              .withColumnRenamed("_thr", "Threshold"))


def flag_stats(flagged: DataFrame, by: str | None = "Species") -> DataFrame:
    """n records, n outliers, percent (round 2) per group."""
    grp = [by] if by else []
    return (flagged.groupBy(*grp)
                   .agg(F.count(F.lit(1)).alias("n_records"),
                        F.count_if(F.col("Outlier") == 1).alias("n_outliers"))
                   .withColumn("pct_outliers", percent("n_outliers", "n_records")))


def score_summary(scores: DataFrame, by: str | None = "Species",
                  score: str = "OutlierScore") -> DataFrame:
    """Six-number summary per group: min, q1, median, mean, q3, max (A10)."""
    grp = [by] if by else []
    valid = scores.where(F.col(score).isNotNull())
    q = exact_quantiles(valid, [0.25, 0.5, 0.75], grp, score)
    per_value = valid.groupBy(*grp, score).agg(F.count(F.lit(1)).alias("_w"))
    ends = per_value.groupBy(*grp).agg(
        F.min(score).alias("min_score"), F.max(score).alias("max_score"),
        (F.sum(F.col(score) * F.col("_w")) / F.sum("_w")).alias("mean_score"))
    joined = ends.join(q, grp) if grp else ends.join(F.broadcast(q), F.lit(True))
    return joined.select(*grp, "min_score", F.col("q")[0].alias("q1_score"),
                         F.col("q")[1].alias("median_score"), "mean_score",
                         F.col("q")[2].alias("q3_score"), "max_score", F.col("n").alias("n_scored"))


def bounding_box(points: DataFrame, by: str | None = "Species", lat: str = "LAT",
                 lon: str = "LON") -> DataFrame:
    """Extent of the coordinates per group."""
    grp = [by] if by else []
    return points.groupBy(*grp).agg(F.min(lon).alias("min_lon"), F.max(lon).alias("max_lon"),
                                    F.min(lat).alias("min_lat"), F.max(lat).alias("max_lat"))

