"""Registered queries over the fixture views, each with its DuckDB oracle.

Every query reads the driver tables (through the fixture views of
FIXTURES.md) in full; none runs on made-up input.  ``QUERIES[name]`` is
``(build(spark, sf_dir) -> DataFrame, oracle_sql or None)``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occuflow.functions import tails
from occuflow.functions.cells import Graticule, HexCells
from occuflow.operators import (binning, counts, density, hierarchy, knn, models, outliers,
                                pool, predicates, trees)
from occuflow.plans import geo_sql, outputs
from occuflow.plans import sql as S
from occuflow.plans.pipeline import Params, run
from occuflow.session import broadcast_if_small, cut_lineage, ensure_checkpoint_dir
from occuflow.sources import readers, sinks
from occuflow.sources.fixtures import load_fixture, with_ctes

# Fixed parameters of the registered queries (the reference's defaults where
# it has them; graticule cells stand in for H3, see README).
OUTLIER_GRID = Graticule(4)
FINAL_GRID = Graticule(1)
EPS_M = 1_000_000.0
MINPTS = 3
THRESHOLD = 100
DB_OUTLIER_D_M = 500_000.0

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, oracle: str | None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = (fn, oracle)
        return fn
    return deco


def _fx(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return load_fixture(spark, sf_dir)


def _large_by_counts(fx) -> DataFrame:
    """Species names with >= THRESHOLD distinct rounded coordinates.

    Materialised once per query (and broadcast when small), so the counting
    scan is not repeated by every step that filters on the list.
    """
    if "_large" not in fx:
        c = counts.species_counts(fx["occurrences"])
        fx["_large"] = broadcast_if_small(
            c.where(F.col("NumUniqCoordsRounded2dp") >= THRESHOLD).select("species").distinct())
    return fx["_large"]


_LARGE_SQL = [f"large AS (SELECT DISTINCT species FROM counts WHERE NumUniqCoordsRounded2dp >= {THRESHOLD})"]


def _cells(fx) -> DataFrame:
    return binning.species_cells(fx["occurrences"], OUTLIER_GRID, _large_by_counts(fx))


def _scored(fx) -> DataFrame:
    return density.dbscan_noise(_cells(fx), EPS_M, MINPTS)


def _scores(fx) -> DataFrame:
    """The scores, written once: reports read them several times."""
    return cut_lineage(_scored(fx).select(F.col("H3").alias("H3Index"), "Species", "OutlierScore"))


_CELLS_SQL = S.counts_ctes() + _LARGE_SQL + S.cells_ctes(OUTLIER_GRID, "large")
_SCORED_SQL = _CELLS_SQL + S.dbscan_ctes("cells", EPS_M, MINPTS)
_SCORES_SQL = _SCORED_SQL + ["scores AS (SELECT H3 AS H3Index, Species, OutlierScore FROM scored)"]


def _q(select: str, ctes: list[str], *views: str) -> str:
    return with_ctes(S.compose(ctes, select) if ctes else select, *views)


# ---------------------------------------------------------------- counts

register("species_counts", _q("SELECT * FROM counts", S.counts_ctes(), "occurrences"))(
    lambda spark, d: counts.species_counts(_fx(spark, d)["occurrences"]))

register("species_counts_basis",
         _q("SELECT * FROM counts", S.counts_ctes(predicates.DEFAULT_BASIS), "occurrences"))(
    lambda spark, d: counts.species_counts(_fx(spark, d)["occurrences"], predicates.DEFAULT_BASIS))

QUERIES["species_names"] = (
    lambda spark, d: binning.distinct_species(_fx(spark, d)["occurrences"]),
    with_ctes("SELECT DISTINCT species FROM occurrences WHERE species IS NOT NULL ORDER BY species",
              "occurrences"))

# ---------------------------------------------------------------- trees, pooling


@register("coverage_by_tree",
          _q(S.stats_select(), S.counts_ctes() + S.tips_ctes(), "occurrences", "tree_tips"))
def _coverage(spark, d):
    fx = _fx(spark, d)
    return trees.tree_stats(counts.species_counts(fx["occurrences"]), fx["tree_tips"])


@register("species_split",
          _q("SELECT * FROM split", S.counts_ctes() + S.split_ctes(THRESHOLD),
             "occurrences", "tree_tips"))
def _split(spark, d):
    fx = _fx(spark, d)
    return trees.split_species(counts.species_counts(fx["occurrences"]), fx["tree_tips"], THRESHOLD)


@register("pooled_species",
          _q("SELECT occ_group, species FROM pooled",
             S.counts_ctes() + S.split_ctes(THRESHOLD) + S.pooled_ctes(False),
             "occurrences", "tree_tips"))
def _pooled(spark, d):
    fx = _fx(spark, d)
    split = trees.split_species(counts.species_counts(fx["occurrences"]), fx["tree_tips"], THRESHOLD)
    return pool.pool_species(split)


@register("pooled_no_extinct",
          _q("SELECT occ_group, species FROM pooled",
             S.counts_ctes() + S.split_ctes(THRESHOLD) + S.pooled_ctes(True),
             "occurrences", "tree_tips", "extinct_taxa"))
def _pooled_ext(spark, d):
    fx = _fx(spark, d)
    split = trees.split_species(counts.species_counts(fx["occurrences"]), fx["tree_tips"], THRESHOLD)
    return pool.pool_species(split, fx["extinct_taxa"])


@register("pool_progress",
          _q("""SELECT b.occ_group, b.unique_species, COALESCE(a.n, 0) AS unique_species_not_extinct
FROM (SELECT OccGroup AS occ_group, COUNT(DISTINCT species) AS unique_species FROM split GROUP BY OccGroup) b
LEFT JOIN (SELECT occ_group, COUNT(*) AS n FROM pooled GROUP BY occ_group) a ON a.occ_group = b.occ_group""",
             S.counts_ctes() + S.split_ctes(THRESHOLD) + S.pooled_ctes(True),
             "occurrences", "tree_tips", "extinct_taxa"))
def _progress(spark, d):
    fx = _fx(spark, d)
    split = trees.split_species(counts.species_counts(fx["occurrences"]), fx["tree_tips"], THRESHOLD)
    p = pool.pool_progress(split, pool.pool_species(split, fx["extinct_taxa"]))
    return p.withColumn("unique_species_not_extinct",
                        F.coalesce("unique_species_not_extinct", F.lit(0)).cast("long"))


# ---------------------------------------------------------------- cells, D1, removal

register("cells_distinct",
         _q("SELECT LAT, LON, H3, Species FROM cells", _CELLS_SQL, "occurrences"))(
    lambda spark, d: _cells(_fx(spark, d)).drop("cell"))

register("density_outlier_score",
         _q("SELECT Species, H3, LAT, LON, OutlierScore FROM scored", _SCORED_SQL, "occurrences"))(
    lambda spark, d: _scored(_fx(spark, d)).select("Species", "H3", "LAT", "LON", "OutlierScore"))

register("outlier_summary",
         _q(S.summary_select("scores"), _SCORES_SQL, "occurrences"))(
    lambda spark, d: outliers.outlier_summary(_scores(_fx(spark, d))))


@register("records_without_outliers",
          _q("SELECT * FROM cleaned",
             _SCORES_SQL + S.removed_ctes(OUTLIER_GRID, "scores", "large"), "occurrences"))
def _removed(spark, d):
    fx = _fx(spark, d)
    return outliers.remove_outliers(fx["occurrences"], _scores(fx), OUTLIER_GRID,
                                    _large_by_counts(fx))


# ---------------------------------------------------------------- binning, pipeline

register("binned_counts",
         _q(S.bin_select(FINAL_GRID, "occurrences", None), [], "occurrences"))(
    lambda spark, d: binning.bin_counts(_fx(spark, d)["occurrences"], FINAL_GRID))


def _pipeline_parts(nodbscan: bool) -> tuple[list[str], str]:
    """The tables of a run and the select of its bins."""
    basis = predicates.DEFAULT_BASIS
    ctes = (S.counts_ctes(basis) + S.split_ctes(THRESHOLD) + S.pooled_ctes(True)
            + ["large AS (SELECT species FROM pooled WHERE occ_group = 'Large')",
               "small AS (SELECT species FROM pooled WHERE occ_group = 'Small')"])
    small_sel = S.bin_select(FINAL_GRID, "occurrences", "small", basis)
    if nodbscan:
        large_sel = S.bin_select(FINAL_GRID, "occurrences", "large", basis)
    else:
        ctes += (S.cells_ctes(OUTLIER_GRID, "large", basis)
                 + S.dbscan_ctes("cells", EPS_M, MINPTS)
                 + ["scores AS (SELECT H3 AS H3Index, Species, OutlierScore FROM scored)"]
                 + S.removed_ctes(OUTLIER_GRID, "scores", "large", basis))
        large_sel = S.bin_select(FINAL_GRID, "cleaned", "large", basis)
    return ctes, f"{small_sel} UNION ALL {large_sel}"


def _pipeline_sql(nodbscan: bool) -> str:
    ctes, select = _pipeline_parts(nodbscan)
    return _q(select, ctes, "occurrences", "tree_tips", "extinct_taxa")


def _plain_params(nodbscan: bool) -> Params:
    return Params(nodbscan=nodbscan, outlier_cells=OUTLIER_GRID, final_cells=FINAL_GRID,
                  geomodel="sphere",
                  dbscan_eps_m=EPS_M, dbscan_minpts=MINPTS,
                  occurrence_threshold=THRESHOLD)


def _pipeline(nodbscan: bool) -> Builder:
    def build(spark, d):
        fx = _fx(spark, d)
        return run(fx["occurrences"], fx["tree_tips"], fx["extinct_taxa"], _plain_params(nodbscan))["binned"]
    return build


QUERIES["pipeline_binned"] = (_pipeline(False), _pipeline_sql(False))
QUERIES["binned_no_dbscan"] = (_pipeline(True), _pipeline_sql(True))


# ---------------------------------------------------------------- predicates

_QUALITY_TREE = predicates.drop_terms(predicates.DEFAULT_QUALITY_PREDICATE, {"HAS_COORDINATE"})
_QUALITY_SQL = with_ctes("""
SELECT * FROM quality
WHERE occurrencestatus = 'PRESENT'
  AND hasgeospatialissues = false
  AND year IS NOT NULL
  AND NOT COALESCE(degreeofestablishment IN ('MANAGED'), false)
  AND NOT COALESCE(basisofrecord IN ('FOSSIL_SPECIMEN', 'LIVING_SPECIMEN'), false)
  AND NOT COALESCE(list_has_any(issue, ['TAXON_MATCH_HIGHERRANK']), false)
  AND (coordinateuncertaintyinmeters < 100000 OR coordinateuncertaintyinmeters IS NULL)
  AND NOT COALESCE(coordinateuncertaintyinmeters IN (301, 3036, 999, 9999), false)
  AND NOT COALESCE(kingdomkey IN (4, 7, 8, 0), false)
  AND NOT COALESCE(genuskey IN (2436435), false)
  AND NOT COALESCE(specieskey IN (2435035), false)
""", "quality")

register("quality_filter", _QUALITY_SQL)(
    lambda spark, d: predicates.quality_filter(_fx(spark, d)["quality"], _QUALITY_TREE))

_EXTINCT_SQL = with_ctes(f"""
SELECT CAST(taxonkey AS VARCHAR) AS specieskey, CAST(highertaxonkey AS VARCHAR) AS highertaxon_key,
  '' AS kingdom, '' AS phylum, '' AS "order", COALESCE(family, '') AS family, '' AS genus,
  COALESCE(species, '') AS species
FROM taxonomy
WHERE taxonrank = 'SPECIES' AND status = 'ACCEPTED' AND isextinct
  AND highertaxonkey IN ({', '.join(str(k) for k in predicates.DEFAULT_HIGHER_TAXA)})
""", "taxonomy")

register("extinct_selection", _EXTINCT_SQL)(
    lambda spark, d: predicates.select_extinct(_fx(spark, d)["taxonomy"]))


# A backbone with parents: seven children a taxon.
_BACKBONE = """SELECT p_partkey AS taxonkey, CAST(floor(p_partkey / 7) AS BIGINT) AS parentkey,
  CASE WHEN p_partkey % 9 = 0 THEN 'GENUS' ELSE 'SPECIES' END AS taxonrank,
  CASE WHEN p_partkey % 5 = 0 THEN 'SYNONYM' ELSE 'ACCEPTED' END AS status,
  p_partkey % 4 = 0 AS isextinct, p_brand AS family, p_name AS species FROM part"""
_ROOTS = (1, 3, 24, 30)


@register("extinct_descendants", f"""
WITH RECURSIVE backbone AS ({_BACKBONE}),
under AS (SELECT unnest({list(_ROOTS)}) AS root, unnest({list(_ROOTS)}) AS taxonkey
  UNION SELECT u.root, b.taxonkey FROM under u JOIN backbone b ON b.parentkey = u.taxonkey AND b.taxonkey <> b.parentkey)
SELECT CAST(b.taxonkey AS VARCHAR) AS specieskey, CAST(u.root AS VARCHAR) AS highertaxon_key,
  '' AS kingdom, '' AS phylum, '' AS "order", COALESCE(family, '') AS family, '' AS genus, COALESCE(species, '') AS species
FROM backbone b JOIN under u ON u.taxonkey = b.taxonkey
WHERE taxonrank = 'SPECIES' AND status = 'ACCEPTED' AND isextinct""")
def _extinct_descendants(spark, d):
    """F13 on a backbone: every descendant of the listed taxa."""
    _fx(spark, d)
    return predicates.select_extinct(spark.sql(_BACKBONE), _ROOTS)


# ---------------------------------------------------------------- score reports

def _db_scores(fx) -> DataFrame:
    return density.db_outlier_score(_cells(fx), DB_OUTLIER_D_M)


def _db_sql_ctes() -> list[str]:
    d = S.haversine_sql("a", "b")
    return _CELLS_SQL + [
        f"""nb AS (SELECT a.Species, a.H3, COUNT(b.H3) AS k FROM cells a LEFT JOIN cells b
  ON a.Species = b.Species AND a.H3 <> b.H3 AND {d} <= {DB_OUTLIER_D_M!r} GROUP BY a.Species, a.H3)""",
        """gs AS (SELECT Species, COUNT(*) AS n FROM cells GROUP BY Species)""",
        """db AS (SELECT c.LAT, c.LON, c.H3, c.Species,
  ROUND(CASE WHEN gs.n > 1 THEN 1.0 - CAST(nb.k AS DOUBLE) / (gs.n - 1) ELSE 0.0 END, 6) AS OutlierScore
  FROM cells c JOIN nb ON c.Species = nb.Species AND c.H3 = nb.H3 JOIN gs ON c.Species = gs.Species)""",
    ]


def _round6(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.round(F.col(c), 6))
    return df


register("db_outlier", _q("SELECT LAT, LON, H3, Species, OutlierScore FROM db", _db_sql_ctes(),
                          "occurrences"))(
    lambda spark, d: _round6(_db_scores(_fx(spark, d)).drop("cell"), "OutlierScore"))


@register("score_summary", _q("""
SELECT Species, MIN(OutlierScore) AS min_score,
  PERCENTILE_CONT(0.25) WITHIN GROUP (ORDER BY OutlierScore) AS q1_score,
  PERCENTILE_CONT(0.5) WITHIN GROUP (ORDER BY OutlierScore) AS median_score,
  ROUND(AVG(OutlierScore), 6) AS mean_score,
  PERCENTILE_CONT(0.75) WITHIN GROUP (ORDER BY OutlierScore) AS q3_score,
  MAX(OutlierScore) AS max_score, COUNT(OutlierScore) AS n_scored
FROM db GROUP BY Species""", _db_sql_ctes(), "occurrences"))
def _score_summary(spark, d):
    s = _round6(_db_scores(_fx(spark, d)), "OutlierScore")
    return _round6(outliers.score_summary(s), "q1_score", "median_score", "mean_score", "q3_score")


@register("quantile_flags", _q("""
SELECT d.Species, COUNT(*) AS n_records,
  COUNT(*) FILTER (WHERE d.OutlierScore >= t.thr) AS n_outliers,
  ROUND(CAST(COUNT(*) FILTER (WHERE d.OutlierScore >= t.thr) AS DOUBLE) / COUNT(*) * 100, 2) AS pct_outliers
FROM db d JOIN (
  SELECT Species, q3 + 1.5 * (q3 - q1) AS thr FROM (
    SELECT Species, PERCENTILE_CONT(0.25) WITHIN GROUP (ORDER BY OutlierScore) AS q1,
           PERCENTILE_CONT(0.75) WITHIN GROUP (ORDER BY OutlierScore) AS q3
    FROM db GROUP BY Species) q) t ON d.Species = t.Species
GROUP BY d.Species""", _db_sql_ctes(), "occurrences"))
def _quantile_flags(spark, d):
    s = _round6(_db_scores(_fx(spark, d)), "OutlierScore")
    return outliers.flag_stats(outliers.flag_outliers(s, mode="medium"))


register("bounding_box", _q("""
SELECT Species, MIN(LON) AS min_lon, MAX(LON) AS max_lon, MIN(LAT) AS min_lat, MAX(LAT) AS max_lat
FROM cells GROUP BY Species""", _CELLS_SQL, "occurrences"))(
    lambda spark, d: outliers.bounding_box(_cells(_fx(spark, d))))


# ---------------------------------------------------------------- kNN family

K = 5


def _knn_ctes(k: int = K) -> list[str]:
    d = S.haversine_sql("a", "b")
    return _CELLS_SQL + [
        f"""pairs AS (SELECT a.Species, a.H3, b.H3 AS nid, CAST(floor({d} * 1000.0 + 0.5) AS BIGINT) AS dmm
  FROM cells a JOIN cells b ON a.Species = b.Species AND a.H3 <> b.H3)""",
        """ranked AS (SELECT *, row_number() OVER (PARTITION BY Species, H3 ORDER BY dmm, nid) AS rnk FROM pairs)""",
        f"""kd AS (SELECT Species, H3, dmm AS kdmm FROM ranked WHERE rnk = {k})""",
        """nb AS (SELECT r.Species, r.H3, r.nid, r.dmm / 1000.0 AS dist_m, r.rnk FROM ranked r
  LEFT JOIN kd ON r.Species = kd.Species AND r.H3 = kd.H3 WHERE kd.kdmm IS NULL OR r.dmm <= kd.kdmm)""",
        f"""kst AS (SELECT Species, H3, MAX(dist_m) FILTER (WHERE rnk <= {k}) AS kdist,
  SUM(dist_m) FILTER (WHERE rnk <= {k}) AS ksum, COUNT(*) AS nk, SUM(dist_m) AS nsum FROM nb GROUP BY Species, H3)""",
    ]


def _knn_query(name: str, fn, score_sql: str, extra_ctes: list[str] = (), digits: int = 6):
    sql = _q(f"""SELECT c.LAT, c.LON, c.H3, c.Species, ROUND({score_sql}, {digits}) AS OutlierScore
FROM cells c LEFT JOIN sc ON c.Species = sc.Species AND c.H3 = sc.H3""",
             _knn_ctes() + list(extra_ctes), "occurrences")

    def build(spark, d):
        out = fn(_cells(_fx(spark, d)).drop("cell"), K)
        return out.withColumn("OutlierScore", F.round("OutlierScore", digits))

    QUERIES[name] = (build, sql)


_knn_query("knn_distance", knn.knn_outlier, "sc.v", ["sc AS (SELECT Species, H3, kdist AS v FROM kst)"])
_knn_query("knn_weight", knn.knn_weight, "sc.v", ["sc AS (SELECT Species, H3, ksum AS v FROM kst)"])
_knn_query("local_isolation", knn.local_isolation, "sc.v",
           [f"sc AS (SELECT Species, H3, kdist + ksum / {float(K)!r} AS v FROM kst)"])
_knn_query("odin", knn.odin, f"COALESCE(sc.v, 0) / {float(K)!r}",
           ["sc AS (SELECT Species, nid AS H3, COUNT(*) AS v FROM nb GROUP BY Species, nid)"])
_knn_query("lof", knn.lof, "sc.v", [
    """reach AS (SELECT n.Species, n.H3, greatest(o.kdist, n.dist_m) AS r FROM nb n
  JOIN kst o ON o.Species = n.Species AND o.H3 = n.nid)""",
    """lrd AS (SELECT Species, H3, COUNT(*) / SUM(r) AS lrd FROM reach GROUP BY Species, H3)""",
    """sc AS (SELECT n.Species, n.H3, AVG(o.lrd) / MAX(p.lrd) AS v FROM nb n
  JOIN lrd o ON o.Species = n.Species AND o.H3 = n.nid JOIN lrd p ON p.Species = n.Species AND p.H3 = n.H3
  GROUP BY n.Species, n.H3)"""])
_knn_query("simplified_lof", lambda p, k: knn.lof(p, k, simplified=True), "sc.v", [
    """dens AS (SELECT Species, H3, nk / nsum AS lrd FROM kst)""",
    """sc AS (SELECT n.Species, n.H3, AVG(o.lrd) / MAX(p.lrd) AS v FROM nb n
  JOIN dens o ON o.Species = n.Species AND o.H3 = n.nid JOIN dens p ON p.Species = n.Species AND p.H3 = n.H3
  GROUP BY n.Species, n.H3)"""])
_knn_query("ldof", knn.ldof, "sc.v", [
    f"""kn AS (SELECT n.Species, n.H3, n.nid, n.dist_m, c.LAT, c.LON FROM nb n
  JOIN cells c ON c.Species = n.Species AND c.H3 = n.nid WHERE n.rnk <= {K})""",
    f"""inner_d AS (SELECT a.Species, a.H3, AVG(floor({S.haversine_sql('a', 'b')} * 1000.0 + 0.5) / 1000.0) AS d
  FROM kn a JOIN kn b ON a.Species = b.Species AND a.H3 = b.H3 AND a.nid <> b.nid GROUP BY a.Species, a.H3)""",
    """sc AS (SELECT o.Species, o.H3, o.d / i.d AS v FROM
  (SELECT Species, H3, AVG(dist_m) AS d FROM kn GROUP BY Species, H3) o
  LEFT JOIN inner_d i ON o.Species = i.Species AND o.H3 = i.H3)"""])

_knn_query("knndd", knn.knndd, "sc.v", [
    f"""sc AS (SELECT n.Species, n.H3, MAX(p.kdist) / AVG(o.kdist) AS v FROM nb n
  JOIN kst o ON o.Species = n.Species AND o.H3 = n.nid JOIN kst p ON p.Species = n.Species AND p.H3 = n.H3
  WHERE n.rnk <= {K} GROUP BY n.Species, n.H3)"""])
_knn_query("inflo", knn.inflo, "sc.v", [
    f"""fwd AS (SELECT Species, H3, nid FROM nb WHERE rnk <= {K})""",
    """space AS (SELECT Species, H3, nid FROM fwd UNION SELECT Species, nid AS H3, H3 AS nid FROM fwd)""",
    """sc AS (SELECT s.Species, s.H3, AVG(1.0 / o.kdist) / (1.0 / MAX(p.kdist)) AS v FROM space s
  JOIN kst o ON o.Species = s.Species AND o.H3 = s.nid JOIN kst p ON p.Species = s.Species AND p.H3 = s.H3
  GROUP BY s.Species, s.H3)"""])
_knn_query("variance_of_volume", knn.variance_of_volume, "sc.v", [
    f"""vol AS (SELECT Species, H3, pi() * (kdist / 1000000.0) * (kdist / 1000000.0) AS v FROM kst)""",
    f"""mem AS (SELECT n.Species, n.H3, o.v FROM nb n JOIN vol o ON o.Species = n.Species AND o.H3 = n.nid
  WHERE n.rnk <= {K} UNION ALL SELECT Species, H3, v FROM vol)""",
    """sc AS (SELECT Species, H3, var_samp(v) AS v FROM mem GROUP BY Species, H3)"""], digits=10)


def _erf_sql(x: str) -> str:
    t = f"(1.0 / (1.0 + 0.3275911 * abs({x})))"
    poly = (f"(((((1.061405429 * {t} + -1.453152027) * {t} + 1.421413741) * {t} + -0.284496736) * {t}"
            f" + 0.254829592) * {t})")
    return f"(sign({x}) * (1.0 - {poly} * exp(-abs({x}) * abs({x}))))"


_knn_query("loop", knn.loop, "sc.v", [
    f"""pdist AS (SELECT Species, H3, 2.0 * sqrt(AVG(dist_m * dist_m)) AS pd FROM nb WHERE rnk <= {K}
  GROUP BY Species, H3)""",
    f"""plof AS (SELECT n.Species, n.H3, MAX(p.pd) / AVG(o.pd) - 1.0 AS pl FROM nb n
  JOIN pdist o ON o.Species = n.Species AND o.H3 = n.nid JOIN pdist p ON p.Species = n.Species AND p.H3 = n.H3
  WHERE n.rnk <= {K} GROUP BY n.Species, n.H3)""",
    """nplof AS (SELECT Species, 2.0 * sqrt(AVG(pl * pl)) AS np FROM plof GROUP BY Species)""",
    f"""sc AS (SELECT p.Species, p.H3, greatest(0.0, {_erf_sql('(p.pl / (n.np * sqrt(2.0)))')}) AS v
  FROM plof p JOIN nplof n ON n.Species = p.Species)"""])

def _trail_ctes(k: int) -> list[str]:
    """COF by k explicit extensions of each point's trail (nearest remaining node first)."""
    out = [
        f"""node AS (SELECT Species, H3, 0 AS i, LAT, LON FROM cells UNION ALL
  SELECT n.Species, n.H3, n.rnk AS i, c.LAT, c.LON FROM nb n
  JOIN cells c ON c.Species = n.Species AND c.H3 = n.nid WHERE n.rnk <= {k})""",
        f"""hop AS (SELECT a.Species, a.H3, a.i AS a, b.i AS b,
  floor({S.haversine_sql('a', 'b')} * 1000.0 + 0.5) / 1000.0 AS d
  FROM node a JOIN node b ON a.Species = b.Species AND a.H3 = b.H3 AND a.i <> b.i)""",
        """t0 AS (SELECT Species, H3, MAX(i) AS n, [0] AS seen, 0.0 AS total FROM node GROUP BY Species, H3)""",
    ]
    for step in range(1, k + 1):
        out += [
            f"""h{step} AS (SELECT * FROM (SELECT t.Species, t.H3, h.b, h.d,
  row_number() OVER (PARTITION BY t.Species, t.H3 ORDER BY h.d, h.a, h.b) AS r
  FROM t{step - 1} t JOIN hop h ON h.Species = t.Species AND h.H3 = t.H3
    AND list_contains(t.seen, h.a) AND NOT list_contains(t.seen, h.b)) WHERE r = 1)""",
            f"""t{step} AS (SELECT t.Species, t.H3, t.n,
  CASE WHEN h.b IS NULL THEN t.seen ELSE list_append(t.seen, h.b) END AS seen,
  t.total + COALESCE(2.0 * (t.n + 1 - {step}) / (t.n * (t.n + 1)) * h.d, 0.0) AS total
  FROM t{step - 1} t LEFT JOIN h{step} h ON h.Species = t.Species AND h.H3 = t.H3)""",
        ]
    return out + [
        f"""ac AS (SELECT Species, H3, total AS ac FROM t{k} WHERE n > 0)""",
        f"""sc AS (SELECT n.Species, n.H3, MAX(p.ac) / AVG(o.ac) AS v FROM nb n
  JOIN ac o ON o.Species = n.Species AND o.H3 = n.nid JOIN ac p ON p.Species = n.Species AND p.H3 = n.H3
  WHERE n.rnk <= {k} GROUP BY n.Species, n.H3)"""]


_knn_query("cof", knn.cof, "sc.v", _trail_ctes(K))

HYSORT_BINS = 5


def _hysort_sql() -> str:
    cell = ("LEAST(FLOOR(CASE WHEN {hi} - {lo} > 0 THEN ({c} - {lo}) / ({hi} - {lo}) ELSE 0.0 END"
            f" * {HYSORT_BINS}), {HYSORT_BINS - 1})")
    return _q(f"""SELECT b.LAT, b.LON, b.H3, b.Species, ROUND(1.0 - d.d / m.mx, 6) AS OutlierScore
FROM binned b JOIN dens d ON d.Species = b.Species AND d.bi = b.bi AND d.bj = b.bj
JOIN (SELECT Species, MAX(d) AS mx FROM dens GROUP BY Species) m ON m.Species = b.Species""",
              _CELLS_SQL + [
                  """ext AS (SELECT Species, MIN(LAT) AS la0, MAX(LAT) AS la1, MIN(LON) AS lo0, MAX(LON) AS lo1
  FROM cells GROUP BY Species)""",
                  f"""binned AS (SELECT c.LAT, c.LON, c.H3, c.Species,
  {cell.format(c='c.LAT', lo='e.la0', hi='e.la1')} AS bi, {cell.format(c='c.LON', lo='e.lo0', hi='e.lo1')} AS bj
  FROM cells c JOIN ext e ON e.Species = c.Species)""",
                  """cube AS (SELECT Species, bi, bj, COUNT(*) AS n FROM binned GROUP BY Species, bi, bj)""",
                  """dens AS (SELECT a.Species, a.bi, a.bj, SUM(b.n) AS d FROM cube a JOIN cube b
  ON a.Species = b.Species AND abs(a.bi - b.bi) <= 1 AND abs(a.bj - b.bj) <= 1 GROUP BY a.Species, a.bi, a.bj)""",
              ], "occurrences")


QUERIES["hysortod"] = (
    lambda spark, d: _round6(models.hysortod(_cells(_fx(spark, d)).drop("cell"), HYSORT_BINS)
                             .select("LAT", "LON", "H3", "Species", "OutlierScore"), "OutlierScore"),
    _hysort_sql())

_knn_query("kernel_density_lof", knn.kernel_density_lof, "sc.v", [
    """kern AS (SELECT n.Species, n.H3,
  exp(-power(greatest(n.dist_m, o.kdist) / p.kdist, 2) / 2.0) / (2.0 * pi() * p.kdist * p.kdist) AS kv
  FROM nb n JOIN kst o ON o.Species = n.Species AND o.H3 = n.nid
  JOIN kst p ON p.Species = n.Species AND p.H3 = n.H3)""",
    """dens AS (SELECT Species, H3, AVG(kv) AS dn FROM kern GROUP BY Species, H3)""",
    """sc AS (SELECT n.Species, n.H3, AVG(o.dn) / MAX(p.dn) AS v FROM nb n
  JOIN dens o ON o.Species = n.Species AND o.H3 = n.nid JOIN dens p ON p.Species = n.Species AND p.H3 = n.H3
  GROUP BY n.Species, n.H3)"""])

def _cells_with_counts(fx) -> DataFrame:
    """Cells of the Large species with their record count as the attribute."""
    occ = fx["occurrences"]
    ids = (binning.restrict_species(occ, _large_by_counts(fx))
                  .where("decimallatitude IS NOT NULL AND decimallongitude IS NOT NULL")
                  .select(F.col("species").alias("Species"),
                          OUTLIER_GRID.cell_id("decimallatitude", "decimallongitude").alias("cell"))
                  .groupBy("Species", "cell").agg(F.count(F.lit(1)).alias("n_records")))
    lat, lon = OUTLIER_GRID.centroid("cell")
    return ids.select(lat.alias("LAT"), lon.alias("LON"),
                      OUTLIER_GRID.cell_string("cell").alias("H3"), "Species", "n_records")


_cid = OUTLIER_GRID.cell_id_sql("decimallatitude", "decimallongitude")
_clat, _clon = OUTLIER_GRID.centroid_sql("cell")
QUERIES["scatterplot_outlier"] = (
    lambda spark, d: knn.scatterplot_outlier(_cells_with_counts(_fx(spark, d)), K, "n_records")
                        .withColumn("OutlierScore", F.round("OutlierScore", 6)),
    _q(f"""SELECT c.LAT, c.LON, c.H3, c.Species, c.n_records, ROUND(abs(r.e - m.em) / m.es, 6) AS OutlierScore
FROM cells c JOIN res r ON r.Species = c.Species AND r.H3 = c.H3 JOIN mom m ON m.Species = c.Species""",
       S.counts_ctes() + _LARGE_SQL + [
           f"""cid AS (SELECT species AS Species, {_cid} AS cell, COUNT(*) AS n_records FROM occurrences
  WHERE species IN (SELECT species FROM large) AND decimallatitude IS NOT NULL AND decimallongitude IS NOT NULL
  GROUP BY species, cell)""",
           f"""cells AS (SELECT {_clat} AS LAT, {_clon} AS LON, {OUTLIER_GRID.cell_string_sql('cell')} AS H3,
  Species, n_records FROM cid)""",
       ] + _knn_ctes()[len(_CELLS_SQL):] + [
           f"""av AS (SELECT n.Species, n.H3, AVG(CAST(o.n_records AS DOUBLE)) AS mval, MAX(p.n_records) AS a
  FROM nb n JOIN cells o ON o.Species = n.Species AND o.H3 = n.nid
  JOIN cells p ON p.Species = n.Species AND p.H3 = n.H3 WHERE n.rnk <= {K} GROUP BY n.Species, n.H3)""",
           """fit AS (SELECT Species, regr_slope(a, mval) AS b, regr_intercept(a, mval) AS c FROM av GROUP BY Species)""",
           """res AS (SELECT v.Species, v.H3, v.a - (f.c + f.b * v.mval) AS e FROM av v JOIN fit f ON f.Species = v.Species)""",
           """mom AS (SELECT Species, AVG(e) AS em, stddev_samp(e) AS es FROM res GROUP BY Species)""",
       ], "occurrences"))

_COP_L1 = "((m.a + m.c) / 2.0 + sqrt(power((m.a - m.c) / 2.0, 2) + m.b * m.b))"
_COP_L2 = "((m.a + m.c) / 2.0 - sqrt(power((m.a - m.c) / 2.0, 2) + m.b * m.b))"
_COP_FIRST = (f"(power({_COP_L2} - m.c, 2) + m.b * m.b >= m.b * m.b + power({_COP_L2} - m.a, 2))")
_COP_EX = f"(CASE WHEN {_COP_FIRST} THEN {_COP_L2} - m.c ELSE m.b END)"
_COP_EY = f"(CASE WHEN {_COP_FIRST} THEN m.b ELSE {_COP_L2} - m.a END)"
_COP_NORM = f"sqrt({_COP_EX} * {_COP_EX} + {_COP_EY} * {_COP_EY})"
_knn_query("simple_cop", knn.simple_cop, "sc.v", [
    f"""mo AS (SELECT n.Species, n.H3, AVG(o.LAT) AS mx, AVG(o.LON) AS my, var_pop(o.LAT) AS a,
  covar_pop(o.LAT, o.LON) AS b, var_pop(o.LON) AS c FROM nb n
  JOIN cells o ON o.Species = n.Species AND o.H3 = n.nid WHERE n.rnk <= {K} GROUP BY n.Species, n.H3)""",
    f"""sc AS (SELECT m.Species, m.H3, CASE WHEN {_COP_L1} / ({_COP_L1} + {_COP_L2}) >= 0.85 AND {_COP_NORM} > 0
  THEN abs((p.LAT - m.mx) * {_COP_EX} + (p.LON - m.my) * {_COP_EY}) / {_COP_NORM} ELSE 0.0 END AS v
  FROM mo m JOIN cells p ON p.Species = m.Species AND p.H3 = m.H3)"""])

_ATTR_CTES = (S.counts_ctes() + _LARGE_SQL + [
    f"""cid AS (SELECT species AS Species, {_cid} AS cell, COUNT(*) AS n_records FROM occurrences
  WHERE species IN (SELECT species FROM large) AND decimallatitude IS NOT NULL AND decimallongitude IS NOT NULL
  GROUP BY species, cell)""",
    f"""cells AS (SELECT {_clat} AS LAT, {_clon} AS LON, {OUTLIER_GRID.cell_string_sql('cell')} AS H3,
  Species, n_records FROM cid)""",
] + _knn_ctes()[len(_CELLS_SQL):] + [
    """ad AS (SELECT n.Species, n.H3, n.nid, abs(CAST(p.n_records AS DOUBLE) - o.n_records) AS d FROM nb n
  JOIN cells o ON o.Species = n.Species AND o.H3 = n.nid JOIN cells p ON p.Species = n.Species AND p.H3 = n.H3)""",
])


def _attr_query(name: str, fn, ctes: list[str]):
    # Scores here are ratios of small integers and often end exactly in a 5
    # at the 7th decimal; the two engines can land one ulp either side of
    # it, so both round (v + 1e-12) to make exact halves round alike.
    QUERIES[name] = (
        lambda spark, d: fn(_cells_with_counts(_fx(spark, d)), K, "n_records")
                            .withColumn("OutlierScore", F.round(F.col("OutlierScore") + F.lit(1e-12), 6)),
        _q("""SELECT c.LAT, c.LON, c.H3, c.Species, c.n_records, ROUND(sc.v + 1e-12, 6) AS OutlierScore
FROM cells c LEFT JOIN sc ON sc.Species = c.Species AND sc.H3 = c.H3""", _ATTR_CTES + ctes, "occurrences"))


_attr_query("sof", knn.sof, [
    """lrd AS (SELECT Species, H3, 1.0 / NULLIF(AVG(d), 0) AS l FROM ad GROUP BY Species, H3)""",
    """sc AS (SELECT a.Species, a.H3, AVG(o.l) / MAX(p.l) AS v FROM ad a
  JOIN lrd o ON o.Species = a.Species AND o.H3 = a.nid JOIN lrd p ON p.Species = a.Species AND p.H3 = a.H3
  GROUP BY a.Species, a.H3)"""])
_attr_query("slom", knn.slom, [
    """dt AS (SELECT Species, H3, CASE WHEN COUNT(*) > 1 THEN (SUM(d) - MAX(d)) / (COUNT(*) - 1)
  ELSE MAX(d) END AS t FROM ad GROUP BY Species, H3)""",
    """mem AS (SELECT a.Species, a.H3, x.t FROM (SELECT Species, H3, nid FROM ad
  UNION ALL SELECT Species, H3, H3 FROM dt) a JOIN dt x ON x.Species = a.Species AND x.H3 = a.nid)""",
    """av AS (SELECT Species, H3, AVG(t) AS avg_t, COUNT(*) AS n FROM mem GROUP BY Species, H3)""",
    """osc AS (SELECT m.Species, m.H3, MAX(v.avg_t) AS avg_t, MAX(v.n) AS n,
  COUNT(*) FILTER (WHERE m.t - v.avg_t > 1e-9 * (1.0 + abs(v.avg_t))) AS up,
  COUNT(*) FILTER (WHERE v.avg_t - m.t > 1e-9 * (1.0 + abs(v.avg_t))) AS dn
  FROM mem m JOIN av v ON v.Species = m.Species AND v.H3 = m.H3 GROUP BY m.Species, m.H3)""",
    """sc AS (SELECT o.Species, o.H3, d.t * (CASE WHEN o.n > 2 THEN (greatest(o.up, o.dn) - least(o.up, o.dn))
  / (o.n - 2.0) ELSE 0.0 END) / (1.0 + o.avg_t) AS v FROM osc o JOIN dt d ON d.Species = o.Species AND d.H3 = o.H3)"""])


def _sos_sql() -> str:
    """KNNSOS with the bandwidth bisection as a recursive CTE over the interval."""
    k, h = 3 * K, K
    weight = f"list_transform(d2, lambda x: exp(-(x - list_min(d2)) * exp({{}})))"
    mid = weight.format("(lo + hi) / 2")
    entropy = ("list_sum(list_transform(list_transform(w, lambda x: x / list_sum(w)), "
               "lambda q: -q * ln(greatest(q, 1e-300))))")
    body = S.compose(_knn_ctes(k) + [
        f"""nb15 AS (SELECT Species, H3, list(nid ORDER BY rnk) AS nids, list(dist_m ORDER BY rnk) AS ds
  FROM nb WHERE rnk <= {k} GROUP BY Species, H3)""",
        """scaled AS (SELECT Species, H3, nids, least(CAST(%r AS DOUBLE), greatest(len(nids) - 1e-9, 1.0)) AS h,
  list_transform(ds, lambda x: pow(x / CASE WHEN list_avg(ds) > 0 THEN list_avg(ds) ELSE 1.0 END, 2)) AS d2
  FROM nb15)""" % float(h),
        f"""halving AS (SELECT Species, H3, nids, h, d2, 0 AS it, -40.0::DOUBLE AS lo, 40.0::DOUBLE AS hi FROM scaled
  UNION ALL
  SELECT Species, H3, nids, h, d2, it + 1, CASE WHEN flat THEN (lo + hi) / 2 ELSE lo END,
    CASE WHEN flat THEN hi ELSE (lo + hi) / 2 END
  FROM (SELECT *, {entropy} > ln(h) AS flat FROM (SELECT *, {mid} AS w FROM halving WHERE it < 60)))""",
        f"""bound AS (SELECT Species, unnest(nids) AS nid, unnest(list_transform(w, lambda x: x / list_sum(w))) AS b
  FROM (SELECT *, {mid} AS w FROM halving WHERE it = 60))""",
        """sc AS (SELECT Species, nid AS H3, exp(SUM(ln(1.0 - least(b, 1.0 - 1e-16)))) AS v
  FROM bound GROUP BY Species, nid)""",
    ], """SELECT c.LAT, c.LON, c.H3, c.Species, ROUND(COALESCE(sc.v, 1.0), 6) AS OutlierScore
FROM cells c LEFT JOIN sc ON c.Species = sc.Species AND c.H3 = sc.H3""")
    sql = with_ctes(body, "occurrences")
    return "WITH RECURSIVE " + sql[len("WITH "):]


QUERIES["knn_sos"] = (
    lambda spark, d: knn.knn_sos(_cells(_fx(spark, d)).drop("cell"), 3 * K)
                        .withColumn("OutlierScore", F.round("OutlierScore", 6)),
    _sos_sql())

def _recursive(ctes: list[str], select: str) -> str:
    sql = with_ctes(S.compose(_CELLS_SQL + ctes, select), "occurrences")
    return "WITH RECURSIVE " + sql[len("WITH "):]


# The first k points of a species by a hash both engines share.
_FIRST = """first AS (SELECT * FROM (SELECT Species, H3, LAT, LON, row_number() OVER (
  PARTITION BY Species ORDER BY md5('42|' || Species || '|' || H3), H3) AS r FROM cells) WHERE r <= {k})"""


def _kmeans_sql(k: int, l: int) -> str:
    """One row a species and round: its centres, and whether any of them moved."""
    near = ("list_min(list_transform(cs, lambda s: struct_pack(d := sqrt(pow(s.x - p.LAT, 2) + pow(s.y - p.LON, 2)), "
            "c := s.c)))")
    pick = "list_filter(news, lambda n: n.c = s.c)[1]"
    return _recursive([_FIRST.format(k=k), f"""fit AS (
  SELECT Species, 0 AS it, list(struct_pack(c := r - 1, x := LAT, y := LON) ORDER BY r) AS cs, true AS moving
  FROM first GROUP BY Species
  UNION ALL
  SELECT Species, it + 1, after, list_bool_or(list_transform(range(1, len(cs) + 1), lambda i:
    abs(after[i].x - cs[i].x) > 1e-9 OR abs(after[i].y - cs[i].y) > 1e-9))
  FROM (SELECT *, list_transform(cs, lambda s: struct_pack(c := s.c, x := coalesce({pick}.x, s.x),
          y := coalesce({pick}.y, s.y))) AS after
    FROM (SELECT Species, it, any_value(cs) AS cs, list(struct_pack(c := c, x := x, y := y)) AS news
      FROM (SELECT Species, it, any_value(cs) AS cs, best.c AS c,
              avg(LAT) FILTER (far > {l}) AS x, avg(LON) FILTER (far > {l}) AS y
        FROM (SELECT *, row_number() OVER (PARTITION BY Species ORDER BY best.d DESC, H3) AS far
          FROM (SELECT p.Species, p.H3, p.LAT, p.LON, f.it, f.cs, {near} AS best
            FROM fit f JOIN cells p ON p.Species = f.Species WHERE f.moving AND f.it < 200))
        GROUP BY Species, it, best.c)
      GROUP BY Species, it)))""",
        "last AS (SELECT Species, arg_max(cs, it) AS cs, NOT arg_max(moving, it) AS converged FROM fit GROUP BY Species)",
        f"scored AS (SELECT p.LAT, p.LON, p.H3, p.Species, f.converged, {near} AS best "
        "FROM last f JOIN cells p ON p.Species = f.Species)"],
        f"""SELECT LAT, LON, H3, Species, CAST(best.c AS INT) AS cluster, ROUND(best.d, 6) AS OutlierScore,
  row_number() OVER (PARTITION BY Species ORDER BY best.d DESC, H3) <= {l} AS is_outlier, converged FROM scored""")


def _em_sql(k: int) -> str:
    """One row a species and round: its components, the log-likelihood before them, and whether it still changed."""
    det = "(s.sxx * s.syy - s.sxy * s.sxy)"
    dx, dy = "(p.LAT - s.mx)", "(p.LON - s.my)"
    ld = (f"list_transform(cs, lambda s: ln(s.w) - (s.syy * {dx} * {dx} - 2.0 * s.sxy * {dx} * {dy} + s.sxx * {dy} * {dy})"
          f" / {det} / 2.0 - ln(2.0 * pi()) - ln({det}) / 2.0)")
    return _recursive([_FIRST.format(k=k),
        """spread AS (SELECT Species, var_pop(LAT) AS vx, var_pop(LON) AS vy, covar_pop(LAT, LON) AS cxy
  FROM cells GROUP BY Species)""",
        f"""fit AS (
  SELECT Species, 0 AS it, list(struct_pack(c := r - 1, w := {1.0 / k!r}::DOUBLE, mx := LAT, my := LON, sxx := vx + 1e-6,
    sxy := cxy, syy := vy + 1e-6) ORDER BY r) AS cs, NULL::DOUBLE AS ll, true AS moving
  FROM first JOIN spread USING (Species) GROUP BY Species
  UNION ALL
  SELECT Species, it + 1, cs, ll, it = 0 OR abs(ll - before) > 1e-3
  FROM (SELECT Species, it, any_value(before) AS before, sum(ll0) / sum(n0) AS ll,
      list(struct_pack(c := c, w := n / total, mx := sx / n, my := sy / n,
        sxx := sxx / n - (sx / n) * (sx / n) + 1e-6, sxy := sxy / n - (sx / n) * (sy / n),
        syy := syy / n - (sy / n) * (sy / n) + 1e-6) ORDER BY c) AS cs
    FROM (SELECT *, sum(n) OVER (PARTITION BY Species) AS total
      FROM (SELECT Species, it, any_value(before) AS before, c, sum(r) AS n, sum(r * LAT) AS sx, sum(r * LON) AS sy,
          sum(r * LAT * LAT) AS sxx, sum(r * LAT * LON) AS sxy, sum(r * LON * LON) AS syy,
          sum(CASE WHEN c = 0 THEN lt END) AS ll0, sum(CASE WHEN c = 0 THEN 1 END) AS n0
        FROM (SELECT Species, it, before, LAT, LON, lt, unnest(range(0, len(ld))) AS c,
            unnest(list_transform(ld, lambda v: exp(v - lt))) AS r
          FROM (SELECT *, list_max(ld) + ln(list_sum(list_transform(ld, lambda v: exp(v - list_max(ld))))) AS lt
            FROM (SELECT p.Species, p.LAT, p.LON, f.it, f.ll AS before, {ld} AS ld
              FROM fit f JOIN cells p ON p.Species = f.Species WHERE f.moving AND f.it < 100)))
        GROUP BY Species, it, c))
    GROUP BY Species, it))""",
        "last AS (SELECT Species, arg_max(cs, it) AS cs, NOT arg_max(moving, it) AS converged FROM fit GROUP BY Species)"],
        f"""SELECT p.LAT, p.LON, p.H3, p.Species, ROUND(-list_max({ld}), 6) AS OutlierScore, f.converged
FROM last f JOIN cells p ON p.Species = f.Species""")


QUERIES["kmeans_minus_minus"] = (
    lambda spark, d: models.kmeans_minus_minus(_cells(_fx(spark, d)).drop("cell"), k=K, l=K)
                           .withColumn("OutlierScore", F.round("OutlierScore", 6)),
    _kmeans_sql(K, K))

QUERIES["em_outlier"] = (
    lambda spark, d: models.em_outlier(_cells(_fx(spark, d)).drop("cell"), k=3)
                           .withColumn("OutlierScore", F.round("OutlierScore", 6)),
    _em_sql(3))

def _forest_sql(n_trees: int = 100, sample: int = 256, seed: int = 42) -> str:
    """Trees grow level by level over the sampled points; every cell then walks down each tree."""
    word = lambda h, i: f"('0x' || substr({h}, {i}, 8))::BIGINT / 4294967296.0"
    leaf = ("CASE WHEN {n} > 2 THEN 2.0 * (ln({n} - 1.0) + 0.5772156649015329) - 2.0 * ({n} - 1.0) / {n} "
            "WHEN {n} = 2 THEN 1.0 ELSE 0.0 END")
    return _recursive([
        f"""draw AS (SELECT c.Species, c.H3, c.LAT, c.LON, t.t, {word("md5(concat_ws('|', " + str(seed) + ", t.t // 4, c.Species, c.H3))", "(t.t % 4) * 8 + 1")} AS u,
    count(*) OVER (PARTITION BY c.Species, t.t) AS total FROM cells c, range({n_trees}) t(t))""",
        f"""sampled AS (SELECT *, count(*) OVER (PARTITION BY Species, t) AS psi FROM (
    SELECT *, row_number() OVER (PARTITION BY Species, t ORDER BY u, H3) AS r FROM draw
    WHERE u < least(1.0, {4.0 * sample!r} / total)) WHERE r <= {sample})""",
        f"""grown AS (
  SELECT Species, t, H3, LAT, LON, '' AS path, CAST(ceil(log2(greatest(psi, 2))) AS INT) AS lim FROM sampled
  UNION ALL
  SELECT Species, t, H3, LAT, LON, path || CASE WHEN (CASE WHEN f = 0 THEN LAT ELSE LON END) <
      (CASE WHEN f = 0 THEN la0 + w * (la1 - la0) ELSE lo0 + w * (lo1 - lo0) END) THEN 'L' ELSE 'R' END, lim
  FROM (SELECT *, CASE WHEN la1 > la0 AND lo1 > lo0 THEN CAST(floor({word("h", 1)} * 2) AS INT)
      WHEN la1 > la0 THEN 0 ELSE 1 END AS f, {word("h", 9)} AS w
    FROM (SELECT *, md5(concat_ws('|', {seed}, t, Species, '') || path) AS h, count(*) OVER q AS n,
        min(LAT) OVER q AS la0, max(LAT) OVER q AS la1, min(LON) OVER q AS lo0, max(LON) OVER q AS lo1
      FROM grown WINDOW q AS (PARTITION BY Species, t, path))
    WHERE length(path) < lim AND n > 1 AND (la1 > la0 OR lo1 > lo0)))""",
        f"""node AS (SELECT Species, t, path, n, length(path) < lim AND n > 1 AND (la1 > la0 OR lo1 > lo0) AS inner_node,
    CASE WHEN la1 > la0 AND lo1 > lo0 THEN CAST(floor({word("h", 1)} * 2) AS INT) WHEN la1 > la0 THEN 0 ELSE 1 END AS f,
    {word("h", 9)} AS w, la0, la1, lo0, lo1
  FROM (SELECT Species, t, path, any_value(lim) AS lim, count(*) AS n, min(LAT) AS la0, max(LAT) AS la1,
      min(LON) AS lo0, max(LON) AS lo1, md5(concat_ws('|', {seed}, t, Species, '') || path) AS h
    FROM grown GROUP BY Species, t, path))""",
        """walk AS (
  SELECT c.Species, c.H3, c.LAT, c.LON, r.t, '' AS path FROM cells c JOIN (SELECT DISTINCT Species, t FROM sampled) r USING (Species)
  UNION ALL
  SELECT k.Species, k.H3, k.LAT, k.LON, k.t, k.path || CASE WHEN (CASE WHEN f = 0 THEN k.LAT ELSE k.LON END) <
      (CASE WHEN f = 0 THEN la0 + w * (la1 - la0) ELSE lo0 + w * (lo1 - lo0) END) THEN 'L' ELSE 'R' END
  FROM walk k JOIN node o ON o.Species = k.Species AND o.t = k.t AND o.path = k.path AND o.inner_node)""",
        f"""ended AS (SELECT k.Species, k.H3, avg(length(k.path) + {leaf.format(n="coalesce(o.n, 0)")}) AS h
  FROM walk k LEFT JOIN node o ON o.Species = k.Species AND o.t = k.t AND o.path = k.path
  WHERE o.path IS NULL OR NOT o.inner_node GROUP BY k.Species, k.H3)""",
        f"""psis AS (SELECT Species, CASE WHEN {leaf.format(n="max(psi)")} = 0 THEN 1.0 ELSE {leaf.format(n="max(psi)")} END AS c
  FROM sampled GROUP BY Species)"""],
        """SELECT p.LAT, p.LON, p.H3, p.Species, ROUND(pow(2.0, -e.h / s.c), 6) AS OutlierScore
FROM cells p JOIN ended e ON e.Species = p.Species AND e.H3 = p.H3 JOIN psis s ON s.Species = p.Species""")


QUERIES["isolation_forest"] = (
    lambda spark, d: models.isolation_forest(_cells(_fx(spark, d)).drop("cell"))
                           .withColumn("OutlierScore", F.round("OutlierScore", 6)),
    _forest_sql())

ALOCI_NMIN, ALOCI_ALPHA, ALOCI_DEPTH = 20, 4, 10


def _aloci_sql() -> str:
    a, dp, nm = ALOCI_ALPHA, ALOCI_DEPTH, ALOCI_NMIN
    unit = "CASE WHEN e.{hi} - e.{lo} > 0 THEN (c.{c} - e.{lo}) / (e.{hi} - e.{lo}) ELSE 0.0 END"
    box = "CAST(least(floor({c} * pow(2, {l})), pow(2, {l}) - 1) AS BIGINT)"
    return _q("""SELECT c.LAT, c.LON, c.H3, c.Species, ROUND(COALESCE(s.r, 0.0), 6) AS OutlierScore
FROM cells c LEFT JOIN (SELECT Species, H3, MAX(r) AS r FROM per GROUP BY Species, H3) s
  ON s.Species = c.Species AND s.H3 = c.H3""", _CELLS_SQL + [
        """ext AS (SELECT Species, MIN(LAT) AS la0, MAX(LAT) AS la1, MIN(LON) AS lo0, MAX(LON) AS lo1
  FROM cells GROUP BY Species)""",
        f"""base AS (SELECT c.Species, c.H3, {unit.format(c='LAT', lo='la0', hi='la1')} AS u,
  {unit.format(c='LON', lo='lo0', hi='lo1')} AS v FROM cells c JOIN ext e ON e.Species = c.Species)""",
        f"""lv AS (SELECT b.Species, b.H3, b.u, b.v, t.l, {box.format(c='b.u', l='t.l')} AS bi,
  {box.format(c='b.v', l='t.l')} AS bj FROM base b CROSS JOIN range(0, {dp + 1}) t(l))""",
        """cnt AS (SELECT Species, l, bi, bj, COUNT(*) AS c FROM lv GROUP BY Species, l, bi, bj)""",
        f"""sub AS (SELECT Species, l - {a} AS l, bi >> {a} AS bi, bj >> {a} AS bj, SUM(c) AS s1,
  SUM(c * c) AS s2, SUM(CAST(c AS DOUBLE) * c * c) AS s3 FROM cnt WHERE l >= {a}
  GROUP BY Species, l - {a}, bi >> {a}, bj >> {a})""",
        f"""mom AS (SELECT m.Species, m.H3, fc.c AS n, s.s2 / s.s1 AS nh,
  sqrt(greatest(0.0, s.s3 / s.s1 - (s.s2 / s.s1) * (s.s2 / s.s1))) AS sd
  FROM lv m JOIN sub s ON s.Species = m.Species AND s.l = m.l AND s.bi = m.bi AND s.bj = m.bj
  JOIN lv f ON f.Species = m.Species AND f.H3 = m.H3 AND f.l = m.l + {a}
  JOIN cnt fc ON fc.Species = f.Species AND fc.l = f.l AND fc.bi = f.bi AND fc.bj = f.bj
  WHERE m.l <= {dp - a} AND s.s1 >= {nm})""",
        """per AS (SELECT Species, H3, (1.0 - n / nh) / (sd / nh) AS r FROM mom WHERE sd > 0)""",
    ], "occurrences")


QUERIES["aloci"] = (
    lambda spark, d: models.aloci(_cells(_fx(spark, d)).drop("cell"), ALOCI_NMIN, ALOCI_ALPHA,
                                  ALOCI_DEPTH)
                           .withColumn("OutlierScore", F.round("OutlierScore", 6)),
    _aloci_sql())

ALOCI_GRIDS = 4


def _aloci_shifted_sql() -> str:
    """Several grids: the box best centred on a place is the least (distance, grid) of all."""
    al, dp, nm = ALOCI_ALPHA, ALOCI_DEPTH, ALOCI_NMIN
    grids = ", ".join(f"({i}, {u!r}, {v!r})" for i, (u, v) in enumerate(models.grid_shifts(ALOCI_GRIDS)))
    unit = "CASE WHEN e.{hi} - e.{lo} > 0 THEN (c.{c} - e.{lo}) / (e.{hi} - e.{lo}) ELSE 0.0 END"

    def box(c: str, s: str, level: str) -> str:
        return (f"CAST(CASE WHEN {s} = 0 THEN least(floor({c} * pow(2.0, {level})), pow(2.0, {level}) - 1) "
                f"ELSE floor(({c} + {s}) * pow(2.0, {level})) END AS BIGINT)")

    dist = ("round(pow(((bi + 0.5) * pow(2.0, -{l}) - su - {u}) / pow(2.0, -{l}), 2) "
            "+ pow(((bj + 0.5) * pow(2.0, -{l}) - sv - {v}) / pow(2.0, -{l}), 2), 9)")
    return _q("""SELECT c.LAT, c.LON, c.H3, c.Species, ROUND(COALESCE(s.r, 0.0), 6) AS OutlierScore
FROM cells c LEFT JOIN (SELECT Species, H3, MAX(r) AS r FROM per GROUP BY Species, H3) s
  ON s.Species = c.Species AND s.H3 = c.H3""", _CELLS_SQL + [
        """ext AS (SELECT Species, MIN(LAT) AS la0, MAX(LAT) AS la1, MIN(LON) AS lo0, MAX(LON) AS lo1
  FROM cells GROUP BY Species)""",
        f"grid AS (SELECT * FROM (VALUES {grids}) t(g, su, sv))",
        f"""base AS (SELECT c.Species, c.H3, {unit.format(c='LAT', lo='la0', hi='la1')} AS u,
  {unit.format(c='LON', lo='lo0', hi='lo1')} AS v FROM cells c JOIN ext e ON e.Species = c.Species)""",
        f"""lv AS (SELECT b.Species, b.H3, b.u, b.v, t.l, g.*, {box('b.u', 'g.su', 't.l')} AS bi,
  {box('b.v', 'g.sv', 't.l')} AS bj FROM base b, grid g, range(0, {dp + 1}) t(l))""",
        """cnt AS (SELECT Species, l, g, bi, bj, COUNT(*) AS c FROM lv GROUP BY ALL)""",
        f"""sub AS (SELECT Species, l - {al} AS l, g, bi >> {al} AS bi, bj >> {al} AS bj, SUM(c) AS s1,
  SUM(c * c) AS s2, SUM(CAST(c AS DOUBLE) * c * c) AS s3 FROM cnt WHERE l >= {al} GROUP BY ALL)""",
        f"""counting AS (SELECT * FROM lv WHERE l >= {al} QUALIFY row_number() OVER (
    PARTITION BY Species, H3, l ORDER BY {dist.format(l='l', u='u', v='v')}, g) = 1)""",
        f"""centre AS (SELECT Species, H3, l, l - {al} AS sl, g, bi, bj, (bi + 0.5) * pow(2.0, -l) - su AS cu,
  (bj + 0.5) * pow(2.0, -l) - sv AS cv FROM counting)""",
        f"""around AS (SELECT c.Species, c.H3, c.l, c.sl, c.g AS cg, c.bi AS ci, c.bj AS cj, c.cu, c.cv, g.*,
  {box('c.cu', 'g.su', 'c.sl')} AS bi, {box('c.cv', 'g.sv', 'c.sl')} AS bj FROM centre c, grid g)""",
        f"""sampling AS (SELECT * FROM around QUALIFY row_number() OVER (
    PARTITION BY Species, H3, l ORDER BY {dist.format(l='sl', u='cu', v='cv')}, g) = 1)""",
        f"""per AS (SELECT Species, H3, (1.0 - n / nh) / (sd / nh) AS r FROM (
    SELECT m.Species, m.H3, k.c AS n, s.s2 / s.s1 AS nh, sqrt(greatest(0.0, s.s3 / s.s1 - (s.s2 / s.s1) * (s.s2 / s.s1))) AS sd
    FROM sampling m JOIN sub s ON s.Species = m.Species AND s.l = m.sl AND s.g = m.g AND s.bi = m.bi AND s.bj = m.bj
    JOIN cnt k ON k.Species = m.Species AND k.l = m.l AND k.g = m.cg AND k.bi = m.ci AND k.bj = m.cj WHERE s.s1 >= {nm})
  WHERE sd > 0)""",
    ], "occurrences")


QUERIES["aloci_shifted"] = (
    lambda spark, d: _round6(models.aloci(_cells(_fx(spark, d)).drop("cell"), ALOCI_NMIN, ALOCI_ALPHA, ALOCI_DEPTH,
                                          ALOCI_GRIDS), "OutlierScore"),
    _aloci_shifted_sql())

QUERIES["trivial_average"] = (
    lambda spark, d: _round6(knn.trivial_average(_cells(_fx(spark, d)).drop("cell")), "OutlierScore"),
    _q("SELECT LAT, LON, H3, Species, ROUND((LAT + LON) / 2.0, 6) AS OutlierScore FROM cells",
       _CELLS_SQL, "occurrences"))


# ---------------------------------------------------------------- clusters, sweep

_AWAY_SQL = f"""away AS (SELECT a.Species, a.H3 AS a, b.H3 AS b, CAST(floor({S.haversine_sql("a", "b")} * 1000.0 + 0.5) AS BIGINT) AS mm
  FROM cells a JOIN cells b ON a.Species = b.Species AND a.H3 <> b.H3)"""

COP_K, COP_EXPECT = 5, 0.001


def _cop_sql(k: int = COP_K, expect: float = COP_EXPECT) -> str:
    trims = ", ".join(f"({i}, {t})" for i, t in enumerate(knn.cop_trims(k)))
    sums = ", ".join(f"sum({e}) AS {n}" for e, n in (("x", "sx"), ("y", "sy"), ("x * x", "sxx"), ("x * y", "sxy"), ("y * y", "syy")))
    tail = []
    for both in (0, 1):
        chi = "exp(-x1 / 2.0)" if both else tails.gamma_tail_sql("0.5", "(x0 / 2.0)")
        tail.append(f"CASE WHEN k{both} IS NULL THEN {chi} ELSE "
                    f"{tails.gamma_tail_sql(f'k{both}', f'(x{both} * k{both} / m{both})')} END")
    dev = "pow(({x} - mx) * ex + ({y} - my) * ey, 2) / (greatest(l2, 0.0) + fl)"
    both_dev = dev + " + pow(({y} - my) * ex - ({x} - mx) * ey, 2) / (l1 + fl)"
    fit = """CASE WHEN n{i} >= 2 AND s{i} >= """ + repr(knn._COP_SPREAD) + """ THEN
    (3.0 - s{i} + sqrt(pow(s{i} - 3.0, 2) + 24.0 * s{i})) / (12.0 * s{i}) END AS k{i}"""
    return _recursive([
        _AWAY_SQL,
        f"""hood AS (SELECT w.Species, w.a, w.r, o.LAT - p.LAT AS x, o.LON - p.LON - 360.0 * floor((o.LON - p.LON + 180.0) / 360.0) AS y
  FROM (SELECT *, row_number() OVER (PARTITION BY Species, a ORDER BY mm, b) AS r FROM away) w
  JOIN cells p ON p.Species = w.Species AND p.H3 = w.a JOIN cells o ON o.Species = w.Species AND o.H3 = w.b WHERE w.r <= {k})""",
        f"trims AS (SELECT * FROM (VALUES {trims}) t(nr, gone))",
        f"""part AS (SELECT h.Species, h.a, t.nr, count(*) AS n, {sums} FROM hood h JOIN trims t ON NOT list_contains(t.gone, h.r - 1) GROUP BY ALL)""",
        """cov AS (SELECT Species, a, nr, sx / n AS mx, sy / n AS my, sxx / n - pow(sx / n, 2) AS ca, sxy / n - (sx / n) * (sy / n) AS cb,
    syy / n - pow(sy / n, 2) AS cc FROM part)""",
        "picked AS (SELECT * FROM cov QUALIFY row_number() OVER (PARTITION BY Species, a ORDER BY round(ca * cc - cb * cb, 9), nr) = 1)",
        f"""axes AS (SELECT *, (ca + cc) / 2.0 - sqrt(pow((ca - cc) / 2.0, 2) + cb * cb) AS l2,
    (ca + cc) / 2.0 + sqrt(pow((ca - cc) / 2.0, 2) + cb * cb) AS l1, (ca + cc) * {knn._COP_FLOOR!r} + 1e-12 AS fl FROM picked)""",
        """dirs AS (SELECT *, CASE WHEN pow(l2 - cc, 2) + cb * cb >= cb * cb + pow(l2 - ca, 2) THEN l2 - cc ELSE cb END AS ux,
    CASE WHEN pow(l2 - cc, 2) + cb * cb >= cb * cb + pow(l2 - ca, 2) THEN cb ELSE l2 - ca END AS uy FROM axes)""",
        """unit AS (SELECT *, CASE WHEN ux * ux + uy * uy > 0 THEN ux / sqrt(ux * ux + uy * uy) ELSE 1.0 END AS ex,
    CASE WHEN ux * ux + uy * uy > 0 THEN uy / sqrt(ux * ux + uy * uy) ELSE 0.0 END AS ey FROM dirs)""",
        f"""dev AS (SELECT u.*, h.r, {dev.format(x='h.x', y='h.y')} AS d0, {both_dev.format(x='h.x', y='h.y')} AS d1
  FROM unit u JOIN hood h ON h.Species = u.Species AND h.a = u.a)""",
        f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY Species, a ORDER BY d0) AS r0,
    row_number() OVER (PARTITION BY Species, a ORDER BY d1) AS r1, count(*) OVER (PARTITION BY Species, a) AS n FROM dev)""",
        f"""fitted AS (SELECT Species, a, """ + ", ".join(
            f"""count(*) FILTER ({c}) AS n{i}, avg(d{i}) FILTER ({c}) AS m{i}, ln(avg(d{i}) FILTER ({c})) - avg(CASE WHEN d{i} > 0 THEN ln(d{i}) END) FILTER ({c}) AS s{i}"""
            for i in (0, 1) for c in [f"r{i} <= floor(n * {1 - knn.COP_TRIM!r}) AND d{i} > 0"]) + f""",
    any_value({dev.format(x='0.0', y='0.0')}) AS x0, any_value({both_dev.format(x='0.0', y='0.0')}) AS x1 FROM ranked GROUP BY Species, a)""",
        f"shaped AS (SELECT *, {fit.format(i=0)}, {fit.format(i=1)} FROM fitted)",
        f"tailed AS (SELECT Species, a, least({tail[0]}, {tail[1]}) AS q FROM shaped)"],
        f"""SELECT c.LAT, c.LON, c.H3, c.Species, ROUND(coalesce({expect} * (1.0 - q) / ({expect} + q), 0.0), 6) AS OutlierScore
FROM cells c LEFT JOIN tailed t ON t.Species = c.Species AND t.a = c.H3""")


QUERIES["cop"] = (
    lambda spark, d: _round6(knn.cop(_cells(_fx(spark, d)).drop("cell"), COP_K, COP_EXPECT), "OutlierScore"),
    _cop_sql())

HIERARCHY_K, HIERARCHY_MIN = 3, 5


# Cells in Prim's order over the edges of ``reach``: the components at a level are
# the runs in which every cell but the first was added within it.
_ORDER_SQL = [
    """prim AS (
  SELECT Species, 0 AS step, H3, CAST(4611686018427387904 AS BIGINT) AS best FROM core
  UNION ALL
  SELECT r.Species, r.step + 1, r.H3, least(r.best, e.w) FROM (
    SELECT *, first_value(H3) OVER (PARTITION BY Species ORDER BY best, H3) AS taken FROM prim) r
  JOIN reach e ON e.Species = r.Species AND e.a = r.taken AND e.b = r.H3)""",
    """placed AS (SELECT p.Species, p.pos, p.H3, p.w, c.core FROM (
    SELECT Species, step AS pos, arg_min(H3, (best, H3)) AS H3, min(best) AS w FROM prim GROUP BY Species, step) p
  JOIN core c USING (Species, H3))""",
]


def _prim_sql(k: int) -> list[str]:
    """The order over mutual reachability."""
    return [
        _AWAY_SQL,
        f"""core AS (SELECT Species, a AS H3, mm AS core FROM (SELECT *, row_number() OVER (PARTITION BY Species, a ORDER BY mm) AS r FROM away)
  WHERE r = {k - 1})""",
        """reach AS (SELECT w.Species, w.a, w.b, greatest(w.mm, x.core, y.core) AS w FROM away w
  JOIN core x ON x.Species = w.Species AND x.H3 = w.a JOIN core y ON y.Species = w.Species AND y.H3 = w.b)""",
        *_ORDER_SQL,
    ]


def _runs_sql(level: str) -> str:
    """The run around each placed cell ``p`` at a level: its first and last place."""
    return f"""(SELECT max(j.pos) FROM placed j WHERE j.Species = p.Species AND j.pos <= p.pos AND j.w > {level}) AS l,
    coalesce((SELECT min(j.pos) FROM placed j WHERE j.Species = p.Species AND j.pos > p.pos AND j.w > {level}),
             (SELECT max(j.pos) + 1 FROM placed j WHERE j.Species = p.Species)) - 1 AS r"""


def _glosh_sql() -> str:
    return _recursive(_prim_sql(HIERARCHY_K) + [
        f"around AS (SELECT p.*, {_runs_sql('p.core')} FROM placed p)",
        """low AS (SELECT a.Species, a.H3, a.core, min(b.core) AS low FROM around a
  JOIN placed b ON b.Species = a.Species AND b.pos BETWEEN a.l AND a.r GROUP BY ALL)"""],
        """SELECT c.LAT, c.LON, c.H3, c.Species,
  ROUND(CASE WHEN core > 0 THEN 1.0 - CAST(low AS DOUBLE) / core ELSE 0.0 END, 6) AS OutlierScore
FROM cells c LEFT JOIN low USING (Species, H3)""")


QUERIES["glosh"] = (
    lambda spark, d: _round6(hierarchy.glosh(_cells(_fx(spark, d)).drop("cell"), HIERARCHY_K), "OutlierScore"),
    _glosh_sql())


DWOF_K, DWOF_DELTA = 3, 1.1


def _dwof_sql() -> str:
    k, delta = DWOF_K, DWOF_DELTA
    return _recursive([
        _AWAY_SQL,
        f"""hood AS (SELECT Species, a, b FROM (SELECT *, rank() OVER (PARTITION BY Species, a ORDER BY mm) AS r FROM away) WHERE r <= {k})""",
        """among AS (SELECT x.Species, x.a AS H3, w.mm FROM hood x JOIN hood y ON y.Species = x.Species AND y.a = x.a AND x.b < y.b
  JOIN away w ON w.Species = x.Species AND w.a = x.b AND w.b = y.b)""",
        """first_mean AS (SELECT Species, H3, CAST(sum(mm) AS DOUBLE) / count(*) / 1000.0 AS mean, min(mm) AS near FROM among GROUP BY ALL)""",
        """core AS (SELECT Species, H3, mean * (CAST(min(near) OVER s AS DOUBLE) / 1000.0) / min(mean) OVER s AS core
  FROM first_mean WINDOW s AS (PARTITION BY Species))""",
        f"""reach AS (SELECT w.Species, w.a, w.b,
    greatest(1, CAST(ceil(ln(w.mm / 1000.0 / greatest(x.core, y.core)) / ln({delta}) - 1e-9) AS BIGINT)) AS w FROM away w
  JOIN core x ON x.Species = w.Species AND x.H3 = w.a JOIN core y ON y.Species = w.Species AND y.H3 = w.b)""",
        *_ORDER_SQL,
        """until AS (SELECT Species, max(w) AS last FROM (SELECT Species, a, min(w) AS w FROM reach GROUP BY Species, a) GROUP BY Species)""",
        """steps AS (SELECT p.Species, p.H3, t.t, sum(CASE WHEN p.w > t.t THEN 1 ELSE 0 END) OVER (PARTITION BY p.Species, t.t ORDER BY p.pos) AS run
  FROM placed p JOIN until u ON u.Species = p.Species, LATERAL (SELECT unnest(range(1, u.last + 1)) AS t) t)""",
        """sized AS (SELECT Species, H3, t, count(*) OVER (PARTITION BY Species, t, run) AS n FROM steps)""",
        """gained AS (SELECT Species, H3, (coalesce(lag(n) OVER (PARTITION BY Species, H3 ORDER BY t), 1) - 1.0) / n AS g FROM sized)""",
        """score AS (SELECT Species, H3, sum(g) AS s FROM gained GROUP BY ALL)"""],
        """SELECT c.LAT, c.LON, c.H3, c.Species, ROUND(coalesce(s, 0.0), 6) AS OutlierScore
FROM cells c LEFT JOIN score USING (Species, H3)""")


QUERIES["dwof"] = (
    lambda spark, d: _round6(hierarchy.dwof(_cells(_fx(spark, d)).drop("cell"), DWOF_K, DWOF_DELTA), "OutlierScore"),
    _dwof_sql())


def _hdbscan_ctes() -> list[str]:
    m = HIERARCHY_MIN
    unit = lambda w: f"CASE WHEN {w} = 0 THEN {2 * hierarchy.DENSITY_UNIT} ELSE {hierarchy.DENSITY_UNIT} // {w} END"
    return _prim_sql(HIERARCHY_K) + [
        f"""part AS (SELECT DISTINCT Species, l, r, w FROM (SELECT p.Species, p.w, {_runs_sql('p.w')} FROM placed p WHERE p.pos > 0)
  WHERE r - l + 1 >= {m})""",
        # the least part around a part, and whether several meet there
        """within_part AS (SELECT a.*, arg_min(struct_pack(l := b.l, r := b.r, w := b.w), b.r - b.l) AS up
  FROM part a LEFT JOIN part b ON b.Species = a.Species AND b.l <= a.l AND b.r >= a.r AND b.r - b.l > a.r - a.l GROUP BY ALL)""",
        """headed AS (SELECT *, up IS NULL OR count(*) OVER (PARTITION BY Species, up.l, up.r) > 1 AS head FROM within_part)""",
        f"""clust AS (SELECT Species, l, r, up, CASE WHEN up IS NULL THEN 0 ELSE {unit('up.w')} END AS birth,
  row_number() OVER (PARTITION BY Species ORDER BY r - l, l) AS i FROM headed WHERE head)""",
        """owner AS (SELECT p.Species, p.l, p.r, p.w, arg_min(c.i, c.r - c.l) AS i FROM part p
  JOIN clust c ON c.Species = p.Species AND c.l <= p.l AND c.r >= p.r GROUP BY ALL)""",
        """host AS (SELECT p.Species, p.pos, p.H3, arg_min(struct_pack(w := o.w, i := o.i), o.r - o.l) AS h FROM placed p
  JOIN owner o ON o.Species = p.Species AND p.pos BETWEEN o.l AND o.r GROUP BY ALL)""",
        f"""ended AS (SELECT Species, h.i AS i, CAST({unit('h.w')} AS HUGEINT) AS lev, 1 AS n FROM host
  UNION ALL SELECT c.Species, o.i, CAST({unit('c.up.w')} AS HUGEINT), c.r - c.l + 1 FROM clust c
  JOIN owner o ON o.Species = c.Species AND o.l = c.up.l AND o.r = c.up.r)""",
        """mass AS (SELECT e.Species, e.i, sum(n * (lev - c.birth)) AS own FROM ended e JOIN clust c USING (Species, i) GROUP BY ALL)""",
        """kin AS (SELECT m.Species, m.i, any_value(m.own) AS own, coalesce(list(k.i) FILTER (k.i IS NOT NULL), []) AS kids FROM mass m
  LEFT JOIN (SELECT c.Species, c.i, o.i AS p FROM clust c JOIN owner o ON o.Species = c.Species AND o.l = c.up.l AND o.r = c.up.r) k
  ON k.Species = m.Species AND k.p = m.i GROUP BY m.Species, m.i)""",
        """eom AS (
  SELECT DISTINCT Species, CAST(0 AS BIGINT) AS i, CAST([] AS HUGEINT[]) AS best, CAST([] AS BOOLEAN[]) AS sel FROM kin
  UNION ALL
  SELECT e.Species, e.i + 1, list_append(e.best, greatest(CAST(k.own AS HUGEINT), k.below)), list_append(e.sel, k.own >= k.below)
  FROM eom e JOIN LATERAL (SELECT own, CAST(coalesce(list_sum(list_transform(kids, lambda j: e.best[j])), 0) AS HUGEINT) AS below
    FROM kin WHERE kin.Species = e.Species AND kin.i = e.i + 1) k ON TRUE)""",
        """chosen AS (SELECT c.Species, c.l, c.r FROM clust c JOIN (SELECT Species, arg_max(sel, i) AS sel FROM eom GROUP BY Species) s
  USING (Species) WHERE c.up IS NOT NULL AND s.sel[c.i])""",
        """member AS (SELECT p.Species, p.H3, arg_max(struct_pack(l := c.l, r := c.r), c.r - c.l) AS c FROM placed p
  JOIN chosen c ON c.Species = p.Species AND p.pos BETWEEN c.l AND c.r GROUP BY p.Species, p.H3)""",
        """labelled AS (SELECT *, min(H3) OVER (PARTITION BY Species, c.l, c.r) AS rep FROM member)""",
    ]


QUERIES["hdbscan_clusters"] = (
    lambda spark, d: hierarchy.hdbscan_labels(_cells(_fx(spark, d)).drop("cell"), HIERARCHY_K, HIERARCHY_MIN)
                              .drop("cluster"),
    _recursive(_hdbscan_ctes(), "SELECT c.LAT, c.LON, c.H3, c.Species, m.rep AS cluster_rep "
                                "FROM cells c LEFT JOIN labelled m USING (Species, H3)"))


def _removed_by_hdbscan(spark, d):
    """Cells as records, HDBSCAN noise per species removed (D3)."""
    # written once: the removal reads its records four times
    cells = cut_lineage(_cells(_fx(spark, d)).select("Species", "H3", "LAT", "LON"))
    kept, gone = density.remove_by_clustering(cells, None, HIERARCHY_K, "HDBSCAN", "LAT", "LON", "Species", HIERARCHY_MIN)
    return (kept.select("Species", "H3", F.lit(0).alias("removed"))
            .unionByName(gone.select("Species", "H3", F.lit(1).alias("removed"))))


QUERIES["record_hdbscan"] = (
    _removed_by_hdbscan,
    _recursive(_hdbscan_ctes(), "SELECT c.Species, c.H3, CASE WHEN m.rep IS NULL THEN 1 ELSE 0 END AS removed "
                                "FROM cells c LEFT JOIN labelled m USING (Species, H3)"))

SWEEP_EPS = (250_000.0, 500_000.0, 1_000_000.0)


def _clusters_sql() -> str:
    d = S.haversine_sql("a", "b")
    ctes = _SCORED_SQL + [
        f"""cpairs AS (SELECT a.Species, a.H3 AS a, b.H3 AS b FROM scored_core a JOIN scored_core b
  ON a.Species = b.Species AND a.H3 <> b.H3 AND {d} <= {EPS_M!r})""",
        """RECURSIVE_PLACEHOLDER""",
        """comp AS (SELECT Species, node, MIN(rep) AS rep FROM reach GROUP BY Species, node)""",
        f"""border AS (SELECT a.Species, a.H3, MIN(c.rep) AS rep FROM cells a JOIN scored_core b
  ON a.Species = b.Species AND {d} <= {EPS_M!r}
  JOIN comp c ON c.Species = b.Species AND c.node = b.H3
  WHERE NOT EXISTS (SELECT 1 FROM scored_core x WHERE x.Species = a.Species AND x.H3 = a.H3)
  GROUP BY a.Species, a.H3)""",
    ]
    body = S.compose(ctes, """
SELECT p.Species, p.H3, p.LAT, p.LON, COALESCE(c.rep, b.rep) AS cluster_rep,
  c.rep IS NOT NULL AS is_core
FROM cells p LEFT JOIN comp c ON c.Species = p.Species AND c.node = p.H3
LEFT JOIN border b ON b.Species = p.Species AND b.H3 = p.H3""")
    recursive = ("reach(Species, node, rep) AS (SELECT Species, H3, H3 FROM scored_core "
                 "UNION SELECT r.Species, e.b, r.rep FROM reach r JOIN cpairs e "
                 "ON r.Species = e.Species AND r.node = e.a)")
    sql = with_ctes(body, "occurrences").replace("RECURSIVE_PLACEHOLDER", recursive)
    return "WITH RECURSIVE " + sql[len("WITH "):]


@register("dbscan_clusters", _clusters_sql())
def _clusters(spark, d):
    lab = density.dbscan_labels(_cells(_fx(spark, d)), EPS_M, MINPTS)
    return lab.select("Species", "H3", "LAT", "LON", "cluster_rep", "is_core")


def _sweep_sql() -> str:
    d = S.haversine_sql("a", "b")
    flags = ", ".join(f"CAST(CASE WHEN s.reach_dist > {e!r} THEN 1.0 ELSE 0.0 END AS DOUBLE) AS noise_{int(e)}"
                      for e in SWEEP_EPS)
    ctes = _CELLS_SQL + [
        f"""sp AS (SELECT a.Species, a.H3, b.H3 AS nid, floor({d} * 1000.0 + 0.5) / 1000.0 AS dm
  FROM cells a JOIN cells b ON a.Species = b.Species AND a.H3 <> b.H3)""",
        f"""sr AS (SELECT *, row_number() OVER (PARTITION BY Species, H3 ORDER BY dm, nid) AS rnk FROM sp)""",
        f"""core AS (SELECT Species, H3, dm AS core_dist FROM sr WHERE rnk = {MINPTS - 1})""",
        """via AS (SELECT p.Species, p.H3, MIN(greatest(p.dm, q.core_dist)) AS v FROM sp p
  JOIN core q ON q.Species = p.Species AND q.H3 = p.nid GROUP BY p.Species, p.H3)""",
        """s AS (SELECT c.Species, c.H3, c.core_dist, least(c.core_dist, COALESCE(v.v, c.core_dist)) AS reach_dist
  FROM core c LEFT JOIN via v ON v.Species = c.Species AND v.H3 = c.H3)""",
    ]
    return _q(f"""SELECT p.LAT, p.LON, p.H3, p.Species, s.core_dist, s.reach_dist, {flags}
FROM cells p JOIN s ON s.Species = p.Species AND s.H3 = p.H3""", ctes, "occurrences")


QUERIES["density_sweep"] = (
    lambda spark, d: knn.density_sweep(_cells(_fx(spark, d)).drop("cell"), MINPTS, SWEEP_EPS),
    _sweep_sql())


# ---------------------------------------------------------------- a run's own cells and Earth model

HEX_OUTLIER, HEX_FINAL = 6, 4


def _hex_cells_sql(species: str | None, basis, final: bool = False) -> list[str]:
    """Hexagons of the located records, and the cells of the listed species."""
    at = geo_sql.face_ctes() + geo_sql.hex_ctes("fine", "occurrences", HEX_OUTLIER)
    if final:
        at += geo_sql.hex_ctes("coarse", "occurrences", HEX_FINAL)
    listed = f"o.species IN (SELECT species FROM {species})" if species else "o.species IS NOT NULL"
    return at + [f"""cells AS (SELECT DISTINCT f.clat AS LAT, f.clon AS LON, printf('%x', f.cell) AS H3, o.species AS Species
  FROM occurrences o JOIN fine f ON f.lat = o.decimallatitude AND f.lon = o.decimallongitude
  WHERE {listed}{S.basis_sql(basis).replace('basisofrecord', 'o.basisofrecord')})""",
                 # one centre per cell: its coordinates differ in the last digit between the points it is reached from
                 """hexed AS (SELECT any_value(LAT) AS LAT, any_value(LON) AS LON, H3, Species FROM cells GROUP BY H3, Species)"""]


@register("hex_cells", _q("SELECT ROUND(LAT, 6) AS LAT, ROUND(LON, 6) AS LON, H3, Species FROM hexed",
                          S.counts_ctes() + _LARGE_SQL + _hex_cells_sql("large", None), "occurrences"))
def _hex_cells(spark, d):
    """Distinct hexagons of resolution 6 and their centres."""
    fx = _fx(spark, d)
    return _round6(binning.species_cells(fx["occurrences"], HexCells(HEX_OUTLIER), _large_by_counts(fx)).drop("cell"), "LAT", "LON")


@register("hex_bins", _q("""SELECT printf('%x', f.cell) AS H3, species, year, count(*) AS record_count,
  list_sort(list(DISTINCT datasetkey), 'ASC', 'NULLS FIRST') AS dataset_keys
FROM occurrences o JOIN coarse f ON f.lat = o.decimallatitude AND f.lon = o.decimallongitude
WHERE species IS NOT NULL GROUP BY f.cell, species, year""",
                         geo_sql.face_ctes() + geo_sql.hex_ctes("coarse", "occurrences", HEX_FINAL), "occurrences"))
def _hex_bins(spark, d):
    """Final bins in hexagons of resolution 4 (A3)."""
    return binning.bin_counts(_fx(spark, d)["occurrences"], HexCells(HEX_FINAL))


@register("dbscan_wgs84", _q("SELECT Species, H3, LAT, LON, OutlierScore FROM scored",
                             _CELLS_SQL + geo_sql.noise_ctes("cells", EPS_M, MINPTS), "occurrences"))
def _dbscan_wgs84(spark, d):
    """D1 on the spheroid."""
    return (density.dbscan_noise(_cells(_fx(spark, d)), EPS_M, MINPTS, geomodel="wgs84")
            .select("Species", "H3", "LAT", "LON", "OutlierScore"))


KNN_WGS84_M = 3_000_000.0


@register("within_wgs84", _q(f"""SELECT c.LAT, c.LON, c.H3, c.Species, count(g.b) AS n_neighbours
FROM cells c LEFT JOIN geo g ON g.Species = c.Species AND g.a = c.H3 AND g.metres <= {KNN_WGS84_M!r} GROUP BY ALL""",
                             _CELLS_SQL + [geo_sql.near_pairs_cte("near", "cells", KNN_WGS84_M * 1.01)]
                             + geo_sql.vincenty_ctes("geo", "near"), "occurrences"))
def _within_wgs84(spark, d):
    """Neighbour counts on the spheroid."""
    return density.neighbour_counts(_cells(_fx(spark, d)).drop("cell"), KNN_WGS84_M, geomodel="wgs84", include_self=False)


def _default_run_sql() -> str:
    basis = predicates.DEFAULT_BASIS
    ctes = (S.counts_ctes(basis) + S.split_ctes(THRESHOLD) + S.pooled_ctes(True)
            + ["large AS (SELECT species FROM pooled WHERE occ_group = 'Large')",
               "small AS (SELECT species FROM pooled WHERE occ_group = 'Small')"]
            + _hex_cells_sql("large", basis, final=True) + geo_sql.noise_ctes("hexed", EPS_M, MINPTS)
            + [f"""kept AS (SELECT o.*, 'Small' AS occ_group, printf('%x', c.cell) AS H3 FROM occurrences o
    JOIN coarse c ON c.lat = o.decimallatitude AND c.lon = o.decimallongitude WHERE o.species IN (SELECT species FROM small)
  UNION ALL SELECT o.*, 'Large', printf('%x', c.cell) FROM occurrences o
    JOIN coarse c ON c.lat = o.decimallatitude AND c.lon = o.decimallongitude
    JOIN fine f ON f.lat = o.decimallatitude AND f.lon = o.decimallongitude
    LEFT JOIN scored s ON s.Species = o.species AND s.H3 = printf('%x', f.cell)
  WHERE o.species IN (SELECT species FROM large) AND coalesce(s.OutlierScore, 0.0) < 0.5)"""])
    return _q(f"""SELECT H3, species, year, count(*) AS record_count,
  list_sort(list(DISTINCT datasetkey), 'ASC', 'NULLS FIRST') AS dataset_keys
FROM kept WHERE true{S.basis_sql(basis)} GROUP BY occ_group, H3, species, year""", ctes, "occurrences", "tree_tips", "extinct_taxa")


@register("pipeline_default", _default_run_sql())
def _pipeline_default(spark, d):
    """W1 with the parameters a run has by itself: hexagons of resolutions 6 and 4, distances on the spheroid."""
    fx = _fx(spark, d)
    return run(fx["occurrences"], fx["tree_tips"], fx["extinct_taxa"], Params())["binned"]


# ---------------------------------------------------------------- files and record clustering

def _out(spark: SparkSession) -> str:
    """A folder of its own below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/occuflow-files-{uuid.uuid4().hex}"


@register("files_scores", _q("SELECT * FROM scores", _SCORES_SQL, "occurrences"))
def _files_scores(spark, d):
    """Scores written as gzip TSV (S16) and read back."""
    path = _out(spark)
    sinks.export_scores(_scores(_fx(spark, d)), path)
    return readers.read_scores(spark, path, header=True)


@register("files_counts", _q("SELECT * FROM counts", S.counts_ctes(), "occurrences"))
def _files_counts(spark, d):
    """The count table in export order (O1), as one TSV (S14), read back."""
    path = _out(spark)
    sinks.export_counts(counts.species_counts(_fx(spark, d)["occurrences"]), path)
    return readers.read_counts(spark, path)


@register("files_species", _q("SELECT species FROM pooled WHERE occ_group = 'Large'",
                              S.counts_ctes() + S.split_ctes(THRESHOLD) + S.pooled_ctes(False),
                              "occurrences", "tree_tips"))
def _files_species(spark, d):
    """The pooled Large list as plain text (S18), read back."""
    path = _out(spark)
    sinks.export_species(pool.species_list(_pooled(spark, d), "Large"), path)
    return readers.read_species_list(spark, path)


@register("files_tree_lists", _q("SELECT tree, OccGroup, species, NumUniqCoordsRounded2dp FROM split",
                                 S.counts_ctes() + S.split_ctes(THRESHOLD), "occurrences", "tree_tips"))
def _files_tree_lists(spark, d):
    """Per-tree Large/Small lists, one folder each (S19), read back with their folder names."""
    path, split = _out(spark), _split(spark, d)
    stats = _coverage(spark, d)
    sinks.export_tree_tables(stats, split, path)
    return (spark.read.schema("species string, NumUniqCoordsRounded2dp long, tree string, OccGroup string")
            .option("sep", "\t").option("header", True).csv(f"{path}/lists")
            .select("tree", "OccGroup", "species", "NumUniqCoordsRounded2dp"))


@register("files_pooled", _pipeline_sql(True))
def _files_pooled(spark, d):
    """The binned table in even ZSTD files (S11, S13), read back as a dump."""
    path = _out(spark)
    sinks.write_pooled(QUERIES["binned_no_dbscan"][0](spark, d), path, rows_per_file=5_000)
    return readers.read_occurrences(spark, path)


@register("files_trees", _q(S.stats_select(), S.counts_ctes() + S.tips_ctes(), "occurrences", "tree_tips"))
def _files_trees(spark, d):
    """Trees as Newick and Nexus files, read through a manifest with a missing tree."""
    path, fx = _out(spark), _fx(spark, d)
    tips = fx["tree_tips"]
    manifest = (sinks.export_trees(tips.where("tree = 'TreeA'"), path, "nwk")
                + sinks.export_trees(tips.where("tree <> 'TreeA'"), path, "nex")
                + [("Lost", None, f"{path}/lost.nwk")])
    return trees.tree_stats(counts.species_counts(fx["occurrences"]), readers.read_trees(spark, manifest))


@register("files_lists", _q("""SELECT concat(tree, '_', lower(OccGroup)) AS FileID, species, OccGroup, NumUniqCoordsRounded2dp
FROM split""", S.counts_ctes() + S.split_ctes(THRESHOLD), "occurrences", "tree_tips"))
def _files_lists(spark, d):
    """Lists named after their tree (S19), read back with the file they come from."""
    path = _out(spark)
    sinks.export_species_lists(_split(spark, d), path)
    both = readers.read_species_lists(spark, path, "large").unionByName(readers.read_species_lists(spark, path, "small"))
    return both.select("FileID", "species", "OccGroup", "NumUniqCoordsRounded2dp")


@register("files_extinct", with_ctes(f"""
SELECT CAST(specieskey AS VARCHAR) AS specieskey, species, NumRecords FROM (
  SELECT c.specieskey, c.species, c.NumRecords FROM ({S.compose(S.counts_ctes(), 'SELECT * FROM counts')}) c
  WHERE EXISTS (SELECT 1 FROM extinct_taxa e WHERE e.species = c.species))""", "occurrences", "extinct_taxa"))
def _files_extinct(spark, d):
    """The extinct table as TSV with header, read back (S8) and matched with the counts."""
    path, fx = _out(spark), _fx(spark, d)
    table = fx["extinct_taxa"].select(F.col("specieskey").cast("string").alias("specieskey"), *[
        F.lit(None).cast("string").alias(c) for c in ("highertaxon_key", "kingdom", "phylum", "order", "family", "genus")], "species")
    sinks.write_tsv(table, path)
    found = readers.read_extinct(spark, path).select("species").distinct()
    return (counts.species_counts(fx["occurrences"]).join(found, "species", "left_semi")
            .select(F.col("specieskey").cast("string").alias("specieskey"), "species", "NumRecords"))


@register("files_cells", _q("SELECT LAT, LON, H3, Species FROM cells", _CELLS_SQL, "occurrences"))
def _files_cells(spark, d):
    """Cells as headerless gzip CSV (S15), read back."""
    path = _out(spark)
    sinks.export_cells(_cells(_fx(spark, d)), path)
    return readers.read_cells(spark, path)


@register("files_summary", _q(S.summary_select("scores"), _SCORES_SQL, "occurrences"))
def _files_summary(spark, d):
    """The ten-row summary as one TSV (S17), read back."""
    path = _out(spark)
    sinks.export_summary(outliers.outlier_summary(_scores(_fx(spark, d))), path)
    return readers.read_summary(spark, path)


@register("files_clusters", _q("SELECT Species, H3, CAST(1.0 - OutlierScore AS INT) AS kept FROM scored", _SCORED_SQL, "occurrences"))
def _files_clusters(spark, d):
    """Members of clusters as Parquet (S22), those of the noise as TSV (S21), read back."""
    path = _out(spark)
    labelled = cut_lineage(density.dbscan_labels(_cells(_fx(spark, d)), EPS_M, MINPTS).drop("cell", "cluster_rep", "is_core"))
    kept, _ = sinks.split_by_label(labelled)
    sinks.write_parquet_zstd(kept, f"{path}/retained", 10)
    sinks.write_tsv(sinks.noise_members(labelled).select("Species", "H3"), f"{path}/noise")
    noise = spark.read.schema("Species string, H3 string").option("sep", "\t").option("header", True).csv(f"{path}/noise")
    return (spark.read.parquet(f"{path}/retained").select("Species", "H3", F.lit(1).alias("kept"))
            .unionByName(noise.select("Species", "H3", F.lit(0).alias("kept"))))


def _files_run_sql() -> str:
    ctes, bins = _pipeline_parts(False)
    return _q("""SELECT 'counts' AS output, count(*) AS n, CAST(sum(NumRecords) AS BIGINT) AS total FROM counts
UNION ALL SELECT 'filtered', count(*), CAST(sum(record_count) AS BIGINT) FROM binned
UNION ALL SELECT 'scores', count(*), CAST(sum(OutlierScore) AS BIGINT) FROM scores
UNION ALL SELECT 'cells', count(*), count(DISTINCT Species) FROM cells
UNION ALL SELECT 'large', count(*), count(*) FROM large
UNION ALL SELECT 'small', count(*), count(*) FROM small""", ctes + [f"binned AS ({bins})"],
              "occurrences", "tree_tips", "extinct_taxa")


@register("files_run", _files_run_sql())
def _files_run(spark, d):
    """A whole run written in its layout (S11, S12, S20) and read back table by table."""
    fx = _fx(spark, d)
    at = outputs.run_and_write(fx["occurrences"], fx["tree_tips"], _out(spark), fx["extinct_taxa"], _plain_params(False), "user")
    stats, out = at["tree_stats"], at["outliers"]
    rows = [
        ("counts", spark.read.parquet(f"{stats}/occurrence_counts.parquet"), F.sum("NumRecords")),
        ("filtered", readers.read_occurrences(spark, at["filtered"]), F.sum("record_count")),
        ("scores", readers.read_scores(spark, f"{out}/outlier_scores", header=True), F.sum("OutlierScore")),
        ("cells", readers.read_cells(spark, f"{out}/cells"), F.countDistinct("Species")),
        ("large", readers.read_species_list(spark, f"{stats}/pooled_large"), F.count(F.lit(1))),
        ("small", readers.read_species_list(spark, f"{stats}/pooled_small"), F.count(F.lit(1))),
    ]
    tables = [df.agg(F.lit(name).alias("output"), F.count(F.lit(1)).alias("n"), total.cast("long").alias("total"))
              for name, df, total in rows]
    return reduce(DataFrame.unionByName, tables)


CLUSTER_EPS_KM, CLUSTER_MIN = 20.0, 4


def _record_noise_sql() -> str:
    d = S.haversine_sql("a", "b")
    eps = repr(CLUSTER_EPS_KM * 1000.0)
    return _q("""SELECT o.gbifid, o.species, CASE WHEN z.species IS NULL AND o.decimallatitude IS NOT NULL
    THEN 0 ELSE 1 END AS removed
FROM occurrences o LEFT JOIN lone z ON z.species = o.species AND z.LAT = o.decimallatitude AND z.LON = o.decimallongitude""", [
        """spots AS (SELECT species, decimallatitude AS LAT, decimallongitude AS LON, COUNT(*) AS w
  FROM occurrences WHERE decimallatitude IS NOT NULL GROUP BY ALL)""",
        f"""close AS (SELECT a.species, a.LAT, a.LON, b.LAT AS LAT2, b.LON AS LON2, b.w FROM spots a JOIN spots b
  ON a.species = b.species AND abs(a.LAT - b.LAT) <= 0.3 AND {d} <= {eps})""",
        f"""dense AS (SELECT species, LAT, LON FROM close GROUP BY ALL HAVING SUM(w) >= {CLUSTER_MIN})""",
        """reached AS (SELECT DISTINCT c.species, c.LAT, c.LON FROM close c
  JOIN dense k ON k.species = c.species AND k.LAT = c.LAT2 AND k.LON = c.LON2)""",
        """lone AS (SELECT species, LAT, LON FROM spots ANTI JOIN reached USING (species, LAT, LON))"""],
              "occurrences")


@register("record_clustering", _record_noise_sql())
def _record_clustering(spark, d):
    """Raw records clustered per species, noise marked."""
    kept, gone = density.remove_by_clustering(
        _fx(spark, d)["occurrences"], CLUSTER_EPS_KM, CLUSTER_MIN, by="species")
    return (kept.select("gbifid", "species", F.lit(0).alias("removed"))
            .unionByName(gone.select("gbifid", "species", F.lit(1).alias("removed"))))


_LOCATED = {"type": "and", "predicates": [
    {"type": "equals", "key": "HAS_COORDINATE", "value": "true"}, {"type": "isNotNull", "parameter": "YEAR"}]}


@register("located_records", with_ctes("""SELECT gbifid FROM occurrences
WHERE decimallatitude IS NOT NULL AND decimallongitude IS NOT NULL AND year IS NOT NULL""", "occurrences"))
def _located(spark, d):
    """The HAS_COORDINATE leaf, derived from both coordinates."""
    return predicates.quality_filter(_fx(spark, d)["occurrences"], _LOCATED).select("gbifid")


def queries() -> dict[str, Builder]:
    return {k: v[0] for k, v in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in QUERIES.items() if v[1] is not None}
