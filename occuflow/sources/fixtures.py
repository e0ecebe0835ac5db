"""Test inputs derived from the driver tables (FIXTURES.md).

The test tables hold no coordinates, so each reference input is derived from
them by SQL that runs unchanged in Spark and DuckDB.  The same text is used as
a Spark temp view by ``queries()`` and as a CTE by ``oracle_sql()``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("lineitem", "part", "supplier", "customer")

_SID = "CASE WHEN l.l_partkey % 7 < 4 THEN l.l_partkey % 20 ELSE 100 + l.l_partkey END"
_PSID = "CASE WHEN p_partkey % 7 < 4 THEN p_partkey % 20 ELSE 100 + p_partkey END"

OCCURRENCES = f"""
WITH li AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_partkey, l.l_returnflag, l.l_linestatus, l.l_shipdate,
         p.p_type, p.p_brand, p.p_size,
         {_SID} AS sid
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)
SELECT
  l_orderkey * 10 + l_linenumber AS gbifid,
  concat('ds-', CAST(l_suppkey AS VARCHAR(20))) AS datasetkey,
  CASE WHEN l_orderkey % 211 = 0 THEN NULL ELSE 1000000 + sid END AS specieskey,
  CASE WHEN sid % 3 = 0 THEN 'Animalia' WHEN sid % 3 = 1 THEN 'Plantae' ELSE 'Fungi' END AS kingdom,
  concat('Phylum', CAST(sid % 4 AS VARCHAR(20))) AS phylum,
  concat('Class', CAST(sid % 8 AS VARCHAR(20))) AS class,
  concat('Order', CAST(sid % 16 AS VARCHAR(20))) AS `order`,
  concat('Family', CAST(sid % 32 AS VARCHAR(20))) AS family,
  concat('Genus', CAST(sid % 50 AS VARCHAR(20))) AS genus,
  concat('Genus', CAST(sid % 50 AS VARCHAR(20)), ' sp', CAST(sid AS VARCHAR(20))) AS species,
  CASE WHEN l_orderkey % 101 = 0 THEN NULL
       WHEN l_orderkey % 97 = 0 THEN CAST((l_orderkey * 31 + l_linenumber * 1009) % 12000 AS DOUBLE) / 100 - 60
       ELSE CAST(sid * 37 % 120 - 60 AS DOUBLE) + CAST((l_orderkey * 13 + l_linenumber * 7) % 4000 - 2000 AS DOUBLE) / 1000 END AS decimallatitude,
  CASE WHEN l_orderkey % 101 = 0 THEN NULL
       WHEN l_orderkey % 97 = 0 THEN CAST((l_orderkey * 29 + l_linenumber * 2003) % 36000 AS DOUBLE) / 100 - 180
       ELSE CAST(sid * 53 % 350 - 175 AS DOUBLE) + CAST((l_orderkey * 17 + l_suppkey) % 4000 - 2000 AS DOUBLE) / 1000 END AS decimallongitude,
  CASE concat(l_returnflag, l_linestatus) WHEN 'AF' THEN 'PRESERVED_SPECIMEN' WHEN 'AO' THEN 'MATERIAL_CITATION'
       WHEN 'RF' THEN 'MACHINE_OBSERVATION' WHEN 'RO' THEN 'HUMAN_OBSERVATION' WHEN 'NF' THEN 'FOSSIL_SPECIMEN' ELSE 'OBSERVATION' END AS basisofrecord,
  CAST(year(l_shipdate) AS INT) AS year
FROM li
"""

TREE_TIPS = f"""
SELECT 'TreeA' AS tree, 'processed' AS stage, concat('Genus', CAST(sid % 50 AS VARCHAR(20)), '_sp', CAST(sid AS VARCHAR(20))) AS tip_label
FROM (SELECT DISTINCT {_PSID} AS sid FROM part) a WHERE sid % 3 <> 1
UNION ALL
SELECT 'TreeB', 'processed', concat('Genus', CAST(sid % 50 AS VARCHAR(20)), '_sp', CAST(sid AS VARCHAR(20)))
FROM (SELECT DISTINCT {_PSID} AS sid FROM part) b WHERE sid % 3 <> 2
UNION ALL
SELECT 'TreeA', 'processed', concat('Absent_sp_', CAST(s_suppkey AS VARCHAR(20))) FROM supplier
UNION ALL
SELECT 'TreeA', 'source', concat('raw', CAST(c_custkey AS VARCHAR(20))) FROM customer
UNION ALL
SELECT 'TreeB', 'source', concat('raw', CAST(p_partkey AS VARCHAR(20))) FROM part
"""

EXTINCT_TAXA = f"""
SELECT DISTINCT 1000000 + sid AS specieskey, concat('Genus', CAST(sid % 50 AS VARCHAR(20)), ' sp', CAST(sid AS VARCHAR(20))) AS species
FROM (SELECT {_PSID} AS sid FROM part) a WHERE sid % 10 = 3
"""

TAXONOMY = """
SELECT p_partkey AS taxonkey, CASE WHEN p_partkey % 9 = 0 THEN 'GENUS' ELSE 'SPECIES' END AS taxonrank,
  CASE WHEN p_partkey % 5 = 0 THEN 'SYNONYM' ELSE 'ACCEPTED' END AS status,
  p_partkey % 4 = 0 AS isextinct, CAST(700 + p_size AS BIGINT) AS highertaxonkey,
  CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE p_brand END AS family, p_name AS species
FROM part
"""

QUALITY = """
SELECT l_orderkey * 10 + l_linenumber AS gbifid,
  CASE WHEN l_orderkey % 13 = 0 THEN 'ABSENT' ELSE 'PRESENT' END AS occurrencestatus,
  CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE CAST(year(l_shipdate) AS INT) END AS year,
  l_partkey % 17 = 0 AS hasgeospatialissues,
  CASE WHEN l_suppkey % 5 = 0 THEN 'MANAGED' WHEN l_suppkey % 5 = 1 THEN 'NATIVE' ELSE NULL END AS degreeofestablishment,
  CASE WHEN l_linenumber % 4 = 0 THEN 'FOSSIL_SPECIMEN' WHEN l_linenumber % 4 = 1 THEN 'LIVING_SPECIMEN' ELSE 'HUMAN_OBSERVATION' END AS basisofrecord,
  CASE WHEN l_partkey % 8 = 0 THEN NULL WHEN l_partkey % 8 = 1 THEN 301.0 WHEN l_partkey % 8 = 2 THEN 9999.0 WHEN l_partkey % 8 = 3 THEN 250000.0 ELSE l_quantity END AS coordinateuncertaintyinmeters,
  CAST(l_partkey % 10 AS INT) AS kingdomkey, CAST(2436430 + l_partkey % 10 AS INT) AS genuskey, CAST(2435030 + l_suppkey % 10 AS INT) AS specieskey,
  CASE WHEN l_partkey % 3 = 0 THEN NULL WHEN l_partkey % 3 = 1 THEN array('TAXON_MATCH_HIGHERRANK', 'COORDINATE_ROUNDED') ELSE array('COORDINATE_ROUNDED') END AS issue
FROM lineitem
"""

VIEWS = {
    "occurrences": OCCURRENCES,
    "tree_tips": TREE_TIPS,
    "extinct_taxa": EXTINCT_TAXA,
    "taxonomy": TAXONOMY,
    "quality": QUALITY,
}


def to_duckdb(sql: str) -> str:
    """Spark dialect of the fixture text → DuckDB dialect."""
    return (sql.replace("`", '"')
               .replace("array('TAXON_MATCH_HIGHERRANK', 'COORDINATE_ROUNDED')",
                        "ARRAY['TAXON_MATCH_HIGHERRANK', 'COORDINATE_ROUNDED']")
               .replace("array('COORDINATE_ROUNDED')", "ARRAY['COORDINATE_ROUNDED']"))


def register_base_tables(spark: SparkSession, sf_dir: str) -> None:
    """Register the driver tables the fixture views read.

    The test tables are single Parquet row groups, which Spark cannot split,
    so a table arriving as fewer partitions than the session has cores is
    spread round-robin first; otherwise the per-row view expressions would
    all run in one task.  A real occurrence dump has many files and is read
    as is.
    """
    cores = spark.sparkContext.defaultParallelism
    for name in BASE_TABLES:
        df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        if name == "lineitem" and df.rdd.getNumPartitions() < cores:
            df = df.repartition(cores)
        df.createOrReplaceTempView(name)


def load_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Build one fixture view as a DataFrame over the tables in ``sf_dir``.

    The base tables are re-registered first, so the returned (already
    analysed) DataFrame is bound to ``sf_dir`` even if the views are later
    re-pointed elsewhere.
    """
    register_base_tables(spark, sf_dir)
    return spark.sql(VIEWS[name])


def load_fixture(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    register_base_tables(spark, sf_dir)
    return {name: spark.sql(text) for name, text in VIEWS.items()}


def with_ctes(body: str, *names: str) -> str:
    """DuckDB oracle text: the named fixture views as CTEs ahead of ``body``.

    ``body`` may itself start with further CTE definitions (without WITH).
    """
    ctes = ",\n".join(f"{n} AS ({to_duckdb(VIEWS[n])})" for n in names)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
