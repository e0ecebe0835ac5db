"""Per-species record and rounded-coordinate counts.

The reference builds two grouped tables and joins them on ``specieskey``.
Here the two aggregates read disjoint column sets (coordinates vs. taxonomy
strings), so Parquet still reads each column once, and both run as hash
aggregates:

1. coordinates: group by (specieskey, coordinate key) — the big reduction,
   shuffled on both columns so one hot species is spread over many tasks,
   with map-side partial aggregation — then by ``specieskey``;
2. taxonomy: group by (specieskey, the seven names) — a handful of rows per
   key after the map-side combine — then ``max`` per key on that tiny table
   (``max`` of strings cannot hash-aggregate, so it only sees this table).

The per-key results meet in a join of one row per species.  The inner join
of the reference drops the NULL-key group; the filter below does the same
before any shuffle.  No ``countDistinct`` (an Expand that doubles rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from occuflow.functions.text import coordinate_key
from occuflow.operators.predicates import basis_filter

TAXONOMY_COLUMNS = ("kingdom", "phylum", "class", "order", "family", "genus", "species")
COUNT_COLUMNS = ("specieskey",) + TAXONOMY_COLUMNS + ("NumRecords", "NumUniqCoordsRounded2dp")
SORT_COLUMNS = TAXONOMY_COLUMNS + ("specieskey",)


def species_counts(occ: DataFrame, basis: str | list[str] | None = None,
                   coords_key: str = "concat") -> DataFrame:
    df = occ.where(F.col("decimallatitude").isNotNull() & F.col("decimallongitude").isNotNull()
                   & F.col("specieskey").isNotNull())
    pred = basis_filter(basis)
    if pred is not None:
        df = df.where(pred)
    per_coord = (df.groupBy("specieskey",
                            coordinate_key("decimallatitude", "decimallongitude", coords_key)
                            .alias("_ck"))
                   .agg(F.count(F.lit(1)).alias("_n")))
    per_key = (per_coord.groupBy("specieskey")
                        .agg(F.sum("_n").cast("long").alias("NumRecords"),
                             F.count(F.lit(1)).alias("NumUniqCoordsRounded2dp")))
    names = (df.groupBy("specieskey", *TAXONOMY_COLUMNS).agg(F.count(F.lit(1)).alias("_t"))
               .groupBy("specieskey").agg(*[F.max(c).alias(c) for c in TAXONOMY_COLUMNS]))
    return per_key.join(names, "specieskey").select(*COUNT_COLUMNS)


def sorted_counts(counts: DataFrame) -> DataFrame:
    """Export order of the count table (O1): taxonomy then key, NULLs last."""
    return counts.orderBy(*[F.asc_nulls_last(c) for c in SORT_COLUMNS])
