"""DuckDB oracle text for the registered queries.

Each function returns CTE definitions (``name AS (...)``) that compose into
one statement with the fixture views of ``sources.fixtures``.  The SQL
states each result from SURVEY's semantics (single grouped aggregates,
brute-force pairwise neighbourhoods) so that it checks the Spark plans rather
than repeating them.
"""

from __future__ import annotations

from occuflow.functions.cells import Graticule
from occuflow.functions.geo import haversine_sql


def basis_sql(basis) -> str:
    if not basis:
        return ""
    return " AND basisofrecord IN (" + ", ".join(f"'{b}'" for b in basis) + ")"


def counts_ctes(basis=None) -> list[str]:
    """One grouped aggregate per species key: records, rounded places, names."""
    names = ",\n    ".join(f'max("{c}") AS "{c}"'
                           for c in ("kingdom", "phylum", "class", "order", "family", "genus", "species"))
    return [f"""counts AS (
  SELECT specieskey,
    {names},
    count(*) AS NumRecords,
    count(DISTINCT round(decimallatitude, 2)::VARCHAR || round(decimallongitude, 2)::VARCHAR) AS NumUniqCoordsRounded2dp
  FROM occurrences
  WHERE specieskey IS NOT NULL AND decimallatitude + decimallongitude IS NOT NULL{basis_sql(basis)}
  GROUP BY specieskey)"""]


def tips_ctes() -> list[str]:
    return [
        """tips AS (SELECT tree, tip_label, regexp_replace(tip_label, '_', ' ') AS species
  FROM tree_tips WHERE stage = 'processed')""",
        """matched AS (SELECT t.tree, c.* FROM counts c JOIN (SELECT DISTINCT tree, species FROM tips) t
  ON c.species = t.species)""",
    ]


def split_ctes(threshold: int = 100) -> list[str]:
    return tips_ctes() + [
        f"""split AS (SELECT tree, species,
  CASE WHEN NumUniqCoordsRounded2dp >= {threshold} THEN 'Large' ELSE 'Small' END AS OccGroup,
  NumUniqCoordsRounded2dp FROM matched)""",
    ]


def pooled_ctes(extinct: bool) -> list[str]:
    anti = (" WHERE NOT EXISTS (SELECT 1 FROM extinct_taxa e WHERE e.species = s.species)"
            if extinct else "")
    return [f"""pooled AS (SELECT DISTINCT OccGroup AS occ_group, species FROM split s{anti})"""]


def stats_select() -> str:
    pct = "ROUND(CAST({a} AS DOUBLE) / {b} * 100, 2)"
    return f"""
SELECT p.tree AS Tree, src.n AS SpeciesInSourceTree, p.n AS SpeciesInTree,
  COALESCE(m.n, 0) AS SpeciesInGBIF, COALESCE(ni.n, 0) AS SpeciesNotInGBIF,
  src.n - COALESCE(m.n, 0) AS OverallTreeTipsNotInGBIF,
  {pct.format(a='p.n', b='src.n')} AS Pct_NameMatchedSpecies,
  {pct.format(a='COALESCE(m.n, 0)', b='p.n')} AS Pct_SpeciesInGBIF,
  {pct.format(a='COALESCE(ni.n, 0)', b='p.n')} AS Pct_SpeciesNotInGBIF,
  {pct.format(a='(src.n - COALESCE(m.n, 0))', b='src.n')} AS Pct_OverallTreeTipsNotInGBIF,
  CAST(COALESCE(m.rec, 0) AS BIGINT) AS NumUniqueOccurrences,
  CAST(COALESCE(m.uniq, 0) AS BIGINT) AS NumNonRedundantOccurrences
FROM (SELECT tree, COUNT(*) AS n FROM tips GROUP BY tree) p
LEFT JOIN (SELECT tree, COUNT(*) AS n FROM tree_tips WHERE stage = 'source' GROUP BY tree) src ON p.tree = src.tree
LEFT JOIN (SELECT tree, COUNT(*) AS n, SUM(NumRecords) AS rec, SUM(NumUniqCoordsRounded2dp) AS uniq
           FROM matched GROUP BY tree) m ON p.tree = m.tree
LEFT JOIN (SELECT tree, COUNT(*) AS n FROM tips t
           WHERE NOT EXISTS (SELECT 1 FROM counts c WHERE c.species = t.species) GROUP BY tree) ni
  ON p.tree = ni.tree
"""


def cells_ctes(grid: Graticule, species_cte: str, basis=None, name: str = "cells",
               source: str = "occurrences") -> list[str]:
    cid = grid.cell_id_sql("decimallatitude", "decimallongitude")
    lat, lon = grid.centroid_sql("cell")
    return [
        f"""{name}_ids AS (SELECT DISTINCT species AS Species, {cid} AS cell FROM {source}
  WHERE species IN (SELECT species FROM {species_cte}){basis_sql(basis)}
    AND decimallatitude IS NOT NULL AND decimallongitude IS NOT NULL)""",
        f"""{name} AS (SELECT {lat} AS LAT, {lon} AS LON, {grid.cell_string_sql('cell')} AS H3, Species, cell
  FROM {name}_ids)""",
    ]


def dbscan_ctes(points: str, eps_m: float, minpts: int, name: str = "scored") -> list[str]:
    d = haversine_sql("a", "b")
    return [
        f"""{name}_n AS (SELECT a.Species, a.H3, COUNT(*) AS n FROM {points} a JOIN {points} b
  ON a.Species = b.Species AND {d} <= {eps_m!r} GROUP BY a.Species, a.H3)""",
        f"""{name}_core AS (SELECT p.* FROM {points} p JOIN {name}_n n ON p.Species = n.Species AND p.H3 = n.H3
  WHERE n.n >= {minpts})""",
        f"""{name} AS (SELECT a.*, CAST(CASE WHEN n.n < {minpts} AND NOT EXISTS (
    SELECT 1 FROM {name}_core b WHERE b.Species = a.Species AND {d} <= {eps_m!r})
  THEN 1.0 ELSE 0.0 END AS DOUBLE) AS OutlierScore
  FROM {points} a JOIN {name}_n n ON a.Species = n.Species AND a.H3 = n.H3)""",
    ]


def summary_select(scores: str, threshold: float = 0.5) -> str:
    """One row of aggregates, turned into (Variable, Value) rows by two parallel lists."""
    above = f"OutlierScore > {float(threshold)!r}"
    facts = {
        "Total_records": "count(*)",
        "Unique_H3_cells": "count(DISTINCT H3Index)",
        "Unique_species": "count(DISTINCT Species)",
        "Total_outliers": f"count(*) FILTER ({above})",
        "Average_number_of_outliers_per_species":
            f"round(count(*) FILTER ({above}) / nullif(count(DISTINCT Species) FILTER ({above}), 0), 3)",
        "Minimum_outlier_score": "min(OutlierScore)",
        "Q1_outlier_score": "quantile_cont(OutlierScore, 0.25)",
        "Median_outlier_score": "quantile_cont(OutlierScore, 0.5)",
        "Q3_outlier_score": "quantile_cont(OutlierScore, 0.75)",
        "Maximum_outlier_score": "max(OutlierScore)",
    }
    labels = ", ".join(f"'{name}'" for name in facts)
    values = ", ".join(f"CAST({e} AS VARCHAR)" for e in facts.values())
    return f"""
SELECT unnest([{labels}]) AS Variable, unnest(vals) AS Value
FROM (SELECT [{values}] AS vals FROM {scores})
"""


def removed_ctes(grid: Graticule, scores: str, species_cte: str, basis=None,
                 name: str = "cleaned") -> list[str]:
    cid = grid.cell_id_sql("r.decimallatitude", "r.decimallongitude")
    return [
        f"""{name} AS (SELECT r.*, {grid.cell_string_sql(cid)} AS h3_index
  FROM occurrences r
  LEFT JOIN {scores} o ON o.Species = r.species AND o.H3Index = {grid.cell_string_sql(cid)}
  WHERE r.species IN (SELECT species FROM {species_cte}){basis_sql(basis).replace('basisofrecord', 'r.basisofrecord')}
    AND (CAST(o.OutlierScore AS FLOAT) < 0.5 OR o.OutlierScore IS NULL))""",
    ]


def bin_select(grid: Graticule, source: str, species_cte: str | None, basis=None) -> str:
    cid = grid.cell_id_sql("decimallatitude", "decimallongitude")
    where = (f"species IN (SELECT species FROM {species_cte})" if species_cte
             else "species IS NOT NULL")
    return f"""
SELECT {grid.cell_string_sql('cell')} AS H3, species, year, COUNT(*) AS record_count,
  list_sort(LIST(DISTINCT datasetkey), 'ASC', 'NULLS FIRST') AS dataset_keys
FROM (SELECT {cid} AS cell, datasetkey, species, year FROM {source}
      WHERE {where}{basis_sql(basis)}) inp
WHERE cell IS NOT NULL
GROUP BY cell, species, year
"""


def compose(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select.strip()
