"""Row predicates: basis-of-record allow-list (F1), the download quality
predicate tree (F11, F12) and extinct-taxa selection (F13).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occuflow.session import cut_lineage

# The basis-of-record names the reference accepts.
BASIS_OF_RECORD_NAMES = (
    "OBSERVATION", "OCCURRENCE", "MACHINE_OBSERVATION", "MATERIAL_SAMPLE",
    "HUMAN_OBSERVATION", "MATERIAL_CITATION", "PRESERVED_SPECIMEN",
    "FOSSIL_SPECIMEN", "LIVING_SPECIMEN",
)

# Fixed value: default allow-list of the pipeline.
DEFAULT_BASIS = ("PRESERVED_SPECIMEN", "MATERIAL_CITATION", "MACHINE_OBSERVATION")


def parse_basis(basis: str | list[str] | tuple[str, ...] | None) -> tuple[str, ...] | None:
    """Validate a comma list (or sequence) of basis-of-record names."""
    if basis is None or basis == "":
        return None
    vals = tuple(v.strip() for v in basis.split(",")) if isinstance(basis, str) else tuple(basis)
    bad = [v for v in vals if v not in BASIS_OF_RECORD_NAMES]
    if bad or not vals:
        raise ValueError(f"invalid basis of record value(s): {bad}; "
                         f"allowed: {', '.join(BASIS_OF_RECORD_NAMES)}")
    return vals


def basis_filter(basis) -> Column | None:
    """``basisofrecord IN (...)``; NULL basis is dropped when a list is set."""
    vals = parse_basis(basis)
    if vals is None:
        return None
    return F.col("basisofrecord").isin(*vals)


def apply_basis(df: DataFrame, basis) -> DataFrame:
    pred = basis_filter(basis)
    return df if pred is None else df.where(pred)


# --------------------------------------------------------------------------
# Download predicate tree (F11) over occurrence terms.

# Occurrence search terms accepted by the download predicate.
SEARCH_TERMS = """
ACCEPTED_TAXON_KEY ASSOCIATED_SEQUENCES BASIS_OF_RECORD BED CATALOG_NUMBER CLASS_KEY
COLLECTION_CODE COLLECTION_KEY CONTINENT COORDINATE_UNCERTAINTY_IN_METERS COUNTRY CRAWL_ID
DATASET_ID DATASET_KEY DATASET_NAME DECIMAL_LATITUDE DECIMAL_LONGITUDE DEGREE_OF_ESTABLISHMENT
DEPTH DISTANCE_FROM_CENTROID_IN_METERS DWCA_EXTENSION EARLIEST_AGE_OR_LOWEST_STAGE
EARLIEST_EON_OR_LOWEST_EONOTHEM EARLIEST_EPOCH_OR_LOWEST_SERIES EARLIEST_ERA_OR_LOWEST_ERATHEM
EARLIEST_PERIOD_OR_LOWEST_SYSTEM ELEVATION END_DAY_OF_YEAR ESTABLISHMENT_MEANS EVENT_DATE
EVENT_DATE_GTE EVENT_ID FAMILY_KEY FIELD_NUMBER FORMATION GADM_GID GADM_LEVEL_0_GID
GADM_LEVEL_1_GID GADM_LEVEL_2_GID GADM_LEVEL_3_GID GBIF_ID GBIF_REGION GENUS_KEY GEO_DISTANCE
GEOMETRY GEOREFERENCED_BY GROUP HAS_COORDINATE HAS_GEOSPATIAL_ISSUE HIGHER_GEOGRAPHY
HIGHEST_BIOSTRATIGRAPHIC_ZONE HOSTING_ORGANIZATION_KEY IDENTIFIED_BY IDENTIFIED_BY_ID
INSTALLATION_KEY INSTITUTION_CODE INSTITUTION_KEY IS_IN_CLUSTER IS_SEQUENCED ISLAND ISLAND_GROUP
ISSUE IUCN_RED_LIST_CATEGORY KINGDOM_KEY LAST_INTERPRETED LATEST_AGE_OR_HIGHEST_STAGE
LATEST_EON_OR_HIGHEST_EONOTHEM LATEST_EPOCH_OR_HIGHEST_SERIES LATEST_ERA_OR_HIGHEST_ERATHEM
LATEST_PERIOD_OR_HIGHEST_SYSTEM LICENSE LIFE_STAGE LOCALITY LOWEST_BIOSTRATIGRAPHIC_ZONE
MEDIA_TYPE MEMBER MODIFIED MONTH NETWORK_KEY OCCURRENCE_ID OCCURRENCE_STATUS ORDER_KEY
ORGANISM_ID ORGANISM_QUANTITY ORGANISM_QUANTITY_TYPE OTHER_CATALOG_NUMBERS PARENT_EVENT_ID
PATHWAY PHYLUM_KEY PREPARATIONS PREVIOUS_IDENTIFICATIONS PROGRAMME PROJECT_ID PROTOCOL
PUBLISHED_BY_GBIF_REGION PUBLISHING_COUNTRY PUBLISHING_ORG RECORD_NUMBER RECORDED_BY
RECORDED_BY_ID RELATIVE_ORGANISM_QUANTITY REPATRIATED SAMPLE_SIZE_UNIT SAMPLE_SIZE_VALUE
SAMPLING_PROTOCOL SCIENTIFIC_NAME SEX SPECIES_KEY START_DAY_OF_YEAR STATE_PROVINCE
SUBGENUS_KEY TAXON_CONCEPT_ID TAXON_ID TAXON_KEY TAXONOMIC_STATUS TYPE_STATUS
VERBATIM_SCIENTIFIC_NAME WATER_BODY YEAR
""".split()

# Terms whose column in occurrence Parquet dumps is not the
# plain lower-case, underscore-free form of the term.
TERM_COLUMN_OVERRIDES = {
    "HAS_GEOSPATIAL_ISSUE": "hasgeospatialissues",
}

# Fixed value: the quality predicate of the reference's download request.
DEFAULT_QUALITY_PREDICATE = {
    "type": "and",
    "predicates": [
        {"type": "equals", "key": "OCCURRENCE_STATUS", "value": "PRESENT"},
        {"type": "equals", "key": "HAS_COORDINATE", "value": "true"},
        {"type": "equals", "key": "HAS_GEOSPATIAL_ISSUE", "value": "false"},
        {"type": "isNotNull", "parameter": "YEAR"},
        {"type": "not", "predicate": {"type": "in", "key": "DEGREE_OF_ESTABLISHMENT",
                                      "values": ["MANAGED"]}},
        {"type": "not", "predicate": {"type": "in", "key": "BASIS_OF_RECORD",
                                      "values": ["FOSSIL_SPECIMEN", "LIVING_SPECIMEN"]}},
        {"type": "not", "predicate": {"type": "in", "key": "ISSUE",
                                      "values": ["TAXON_MATCH_HIGHERRANK"]}},
        {"type": "or", "predicates": [
            {"type": "lessThan", "key": "COORDINATE_UNCERTAINTY_IN_METERS", "value": "100000"},
            {"type": "isNull", "parameter": "COORDINATE_UNCERTAINTY_IN_METERS"}]},
        {"type": "not", "predicate": {"type": "in", "key": "COORDINATE_UNCERTAINTY_IN_METERS",
                                      "values": ["301", "3036", "999", "9999"]}},
        {"type": "not", "predicate": {"type": "in", "key": "KINGDOM_KEY",
                                      "values": ["4", "7", "8", "0"]}},
        {"type": "not", "predicate": {"type": "in", "key": "GENUS_KEY", "values": ["2436435"]}},
        {"type": "not", "predicate": {"type": "in", "key": "SPECIES_KEY", "values": ["2435035"]}},
    ],
}


def term_column(term: str, overrides: dict[str, str] | None = None) -> str:
    if term not in SEARCH_TERMS:
        raise ValueError(f"unknown occurrence term {term!r}")
    table = dict(TERM_COLUMN_OVERRIDES, **(overrides or {}))
    return table.get(term, term.lower().replace("_", ""))


def _literal_for(df_types: dict[str, str], column: str, value: str) -> Column:
    dtype = df_types.get(column, "string")
    if dtype == "boolean":
        return F.lit(str(value).lower() == "true")
    if dtype.startswith("array"):
        return F.lit(value)
    if dtype != "string":
        return F.lit(value).cast(dtype)
    return F.lit(value)


def _term_expr(df: DataFrame, term: str, overrides) -> tuple[Column, str]:
    if term == "HAS_COORDINATE" and "hascoordinate" not in df.columns:
        # Derived when the dump has no flag column: both coordinates present.
        return (F.col("decimallatitude").isNotNull() & F.col("decimallongitude").isNotNull(),
                "boolean")
    col = term_column(term, overrides)
    types = dict(df.dtypes)
    if col not in types:
        raise ValueError(f"term {term!r} needs column {col!r}, absent from the input")
    return F.col(col), types[col]


def compile_predicate(tree: dict, df: DataFrame, overrides: dict[str, str] | None = None) -> Column:
    """Nested predicate dict → one boolean Column (three-valued logic aside).

    ``not in`` keeps NULL values, as a search index would: a record without a
    degree of establishment is not *in* {MANAGED}.  ``in`` over an array
    column means "any element in the list".
    """
    kind = tree["type"]
    if kind in ("and", "or"):
        parts = [compile_predicate(p, df, overrides) for p in tree["predicates"]]
        if not parts:
            raise ValueError(f"empty {kind!r} predicate")
        return reduce((lambda a, b: a & b) if kind == "and" else (lambda a, b: a | b), parts)
    if kind == "not":
        inner = compile_predicate(tree["predicate"], df, overrides)
        return ~F.coalesce(inner, F.lit(False))
    if kind in ("isNull", "isNotNull"):
        col, _ = _term_expr(df, tree["parameter"], overrides)
        return col.isNull() if kind == "isNull" else col.isNotNull()
    col, dtype = _term_expr(df, tree["key"], overrides)
    types = {"_": dtype}
    if kind == "equals":
        lit = _literal_for(types, "_", tree["value"])
        if dtype.startswith("array"):
            return F.array_contains(col, lit)
        return col == lit
    if kind == "in":
        lits = [_literal_for(types, "_", v) for v in tree["values"]]
        if dtype.startswith("array"):
            return F.arrays_overlap(col, F.array(*lits))
        return col.isin(*lits)
    if kind in ("lessThan", "lessThanOrEquals", "greaterThan", "greaterThanOrEquals"):
        lit = _literal_for(types, "_", tree["value"])
        return {"lessThan": col < lit, "lessThanOrEquals": col <= lit,
                "greaterThan": col > lit, "greaterThanOrEquals": col >= lit}[kind]
    raise ValueError(f"unsupported predicate type {kind!r}")


def drop_terms(tree: dict, terms: set[str]) -> dict:
    """Copy of ``tree`` without leaves on ``terms`` (for dumps lacking them)."""
    kind = tree["type"]
    if kind in ("and", "or"):
        kept = [drop_terms(p, terms) for p in tree["predicates"]]
        kept = [p for p in kept if p is not None]
        return dict(tree, predicates=kept) if kept else None
    if kind == "not":
        inner = drop_terms(tree["predicate"], terms)
        return None if inner is None else dict(tree, predicate=inner)
    key = tree.get("key") or tree.get("parameter")
    return None if key in terms else tree


def quality_filter(df: DataFrame, tree: dict | None = None,
                   overrides: dict[str, str] | None = None) -> DataFrame:
    return df.where(compile_predicate(tree or DEFAULT_QUALITY_PREDICATE, df, overrides))


# --------------------------------------------------------------------------
# Extinct-taxa selection (F13) over a taxonomy backbone table.

# Higher taxa whose extinct species are listed by default.
DEFAULT_HIGHER_TAXA = (
    797, 1457,
    131, 11493978, 212, 11592253, 11418114,
    731, 732, 733, 734, 735, 736, 737, 783, 784, 785, 790, 791, 792, 794, 795, 796, 798,
    799, 801, 802, 803, 804, 828, 829, 1452, 1453, 1454, 1459, 1494,
    494, 495, 496, 497, 498, 499, 537, 538, 547, 548, 549, 550, 587, 588, 589, 590, 708,
    772, 773, 774, 888, 889, 890, 1067, 1068, 1069, 1103, 1104, 1105, 1106, 1107, 1153,
    1162, 1163, 1164, 1165, 1166, 1167, 1305, 1306, 1307, 1308, 1310, 1311, 1312, 1313,
    95, 34, 12238325,
    194, 196, 220, 228, 244, 245, 282, 7228684,
)

EXTINCT_COLUMNS = ("specieskey", "highertaxon_key", "kingdom", "phylum", "order",
                   "family", "genus", "species")


def taxon_descendants(taxonomy: DataFrame, roots, key: str = "taxonkey", parent: str = "parentkey") -> DataFrame:
    """(taxonkey, root) of every taxon at or below each listed root.

    Level by level: each round joins the last level's keys to their children,
    so rounds grow with the depth of the taxonomy.  A cycle ends it, as a pair
    found before is not followed again.
    """
    spark = taxonomy.sparkSession
    links = cut_lineage(taxonomy.select(F.col(key).cast("long").alias("child"), F.col(parent).cast("long").alias("above"))
                        .where("child IS NOT NULL AND above IS NOT NULL AND child <> above").distinct())
    found = spark.createDataFrame([(int(r), int(r)) for r in dict.fromkeys(roots)], "taxonkey long, root long")
    level = found
    while True:
        level = cut_lineage(links.join(level, F.col("above") == F.col("taxonkey"))
                            .select(F.col("child").alias("taxonkey"), "root").distinct()
                            .join(found, ["taxonkey", "root"], "left_anti"))
        if level.isEmpty():
            return found
        found = found.unionByName(level)


def select_extinct(taxonomy: DataFrame, higher_taxa=DEFAULT_HIGHER_TAXA,
                   dataset_key: str | None = None) -> DataFrame:
    """Accepted, extinct species under any listed higher taxon.

    With a ``parentkey`` column every descendant of a listed taxon counts, once
    per listed taxon it lies under; otherwise ``highertaxonkey`` is compared.

    Output fields follow the reference's TSV; a field the backbone lacks or
    leaves NULL becomes ''.  ``higher_taxa`` is a fixed parameter list
    (an IN literal, no join).
    """
    df = taxonomy.where((F.col("taxonrank") == "SPECIES") & (F.col("status") == "ACCEPTED") & F.col("isextinct"))
    if "parentkey" in taxonomy.columns:
        under = taxon_descendants(taxonomy, higher_taxa)
        df = df.drop("highertaxonkey").join(under.withColumnRenamed("root", "highertaxonkey"), "taxonkey")
    else:
        df = df.where(F.col("highertaxonkey").isin(*[int(k) for k in higher_taxa]))
    if dataset_key is not None:
        if "datasetkey" not in taxonomy.columns:
            raise ValueError("dataset_key given, but the taxonomy has no datasetkey column")
        df = df.where(F.col("datasetkey") == dataset_key)

    def field(name: str) -> Column:
        if name in taxonomy.columns:
            return F.coalesce(F.col(name).cast("string"), F.lit(""))
        return F.lit("")

    return df.select(F.col("taxonkey").cast("string").alias("specieskey"),
                     F.col("highertaxonkey").cast("string").alias("highertaxon_key"),
                     *[field(c).alias(c) for c in EXTINCT_COLUMNS[2:]])
