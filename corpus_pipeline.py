"""Corpus pipeline: toxicity, near duplicates, secrets, mixing, packing.

``STAGES`` lists (name, function); every function takes (spark, docs, sf_dir)
and returns a DataFrame, the next stage's ``docs``.  All but the last return
the columns they were given, so extra columns pass through whatever their
names are.  Null or empty texts, repeated rows and empty tables are handled as
each operator defines it:

* toxicity: rows judged toxic go; a text without words is kept;
* near duplicates: of each group of linked documents (similarity 0.8 and more
  on word 5-grams, linked directly or through others) the row with the least
  id stays, one row even if it is repeated; texts without words all stay;
* secrets: every span is replaced by a mark; no row goes;
* mixing: a row appears once per copy that the mix takes, perhaps never; a
  shard's copies lie together, in an order of its own;
* packing: one row per piece of each remaining row.

No stage has a DuckDB form as a whole (model fit, recall-target join,
vocabulary test, seeded draws, byte-pair ids), hence no ``ORACLE_SQL``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from occuflow.llm import jaccard_join, mixing, packing, secret_scan, toxicity
from occuflow.session import cut_lineage, stage_scope


def _boxed(docs: DataFrame, *columns: str) -> DataFrame:
    """Some columns, and the whole row in one column that clashes with no result."""
    return docs.select(*columns, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose expected grade says toxic go (operator 10)."""
    model = toxicity.fit_severity(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score_severity(_boxed(docs, "text"), model)
    return scored.filter(~F.col("toxic")).select("__row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays (operator 9)."""
    with stage_scope(spark):
        groups = cut_lineage(jaccard_join.jaccard_groups(docs.select("doc_id", "text")), outlive=True)
    keep = (groups.filter("size > 0").groupBy("label")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "cls")).alias("k"))
            .select(F.col("k.doc_id").alias("k_id"), F.col("k.cls").alias("k_cls")))
    rows = jaccard_join.classify(_boxed(docs, "doc_id", "text")).drop("text")
    first = W.partitionBy("doc_id", "__cls").orderBy(F.xxhash64("__row"))
    kept = (rows.filter("__size > 0")
            .join(keep, F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("__cls") == F.col("k_cls")), "left_semi")
            .withColumn("__n", F.row_number().over(first)).filter("__n = 1"))
    return kept.select("__row.*").union(rows.filter("__size = 0").select("__row.*"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a mark (operator 4); ``n_chars`` follows the text."""
    scanned = secret_scan.scan_secrets(_boxed(docs, "text"), redact=True)
    changed = F.size("secret_spans") > 0
    out = []
    for field in docs.schema.fields:
        old = F.col("__row").getField(field.name)
        if field.name == "text":
            old = F.col("text")
        elif field.name == "n_chars":
            old = F.when(changed, F.length("text").cast(field.dataType)).otherwise(old)
        out.append(old.alias(field.name))
    return scanned.select(*out)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it, shard by shard in its order (operator 1)."""
    sized = _boxed(docs, "doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    return mixing.arranged(mixing.mix(sized)).select("__row.*")


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in windows of 2048 ids (operator 7)."""
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut_lineage(docs)
    return docs
