"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. *Targets.*  Sources in code-point order (null last) weigh ``weights``,
   repeating, and share the total of all sizes; a target stops at
   ``max_repeat`` times its source's size and the excess is reshared by weight
   (water filling, in closed form over one row a source).
2. *Blocks.*  Each source's documents fall into hash blocks of about
   ``block_docs``.  A source gives every block once per whole epoch of
   ``target / size``, and for the rest the first blocks in hash order whose
   sizes fit; of the block at the edge it takes the documents that still fit,
   in hash order.  This fixes an exact quota of block draws per source.
3. *Splitting tree.*  The quotas are split among ``2 ** depth`` output shards:
   at each node the left half gets half of the node's draws, distributed over
   the sources by an exact multivariate hypergeometric draw (conditional
   hypergeometrics by inverse CDF, seeded by node and source), the right half
   the rest.
4. *Draws.*  Shards take disjoint runs of each source's permuted block draws;
   the documents of a shard are ordered by a hash (``arranged``).

All steps are DataFrame functions, and everything is a function of the rows
and the seed, so reruns agree.  Nothing but one row a source is ever held
together; prefix sums over blocks go in two levels.

Defined cases: a null text has size 0; null sources are one source; a source
without words has target 0; repeated rows (equal id and size) are taken or
left together; an empty table gives an empty mix; extra columns are carried,
columns named like the results are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from occuflow.session import broadcast_if_small, cut_lineage, stage_scope

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
RESULTS = ("size", "source_size", "target", "placements")
# Two-level prefix sums: blocks per super-block.
_SUPER = 1024
# Half width, in standard deviations, of the hypergeometric support that is
# summed; what lies outside has a mass below double precision.
_SIGMAS = 12


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeat: int = 3) -> DataFrame:
    """One row a source (of ``source``, ``size`` rows): number, sizes and target.

    The windows run over one row a source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    w = F.array(*[F.lit(float(x)) for x in weights])
    per = (per.withColumn("sid", F.row_number().over(W.orderBy(F.asc_nulls_last("source"))) - 1)
           .withColumn("weight", F.element_at(w, F.col("sid") % len(weights) + 1))
           .withColumn("cap", F.col("source_size").cast("double") * max_repeat)
           .withColumn("ratio", F.col("cap") / F.col("weight")))
    by_ratio = W.orderBy("ratio", "sid")
    all_rows = W.orderBy("ratio", "sid").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    before = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(by_ratio.rowsBetween(0, W.unboundedFollowing))
    per = (per.withColumn("total", F.sum("source_size").over(all_rows).cast("double"))
           .withColumn("level", (F.col("total") - before) / after)
           .withColumn("place", F.row_number().over(by_ratio)))
    open_level = F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("place", "level"))).over(all_rows)
    return (per.withColumn("fill", open_level["level"])
            .withColumn("target", F.when(F.col("fill").isNull(), F.col("cap"))
                        .otherwise(F.least("cap", F.col("weight") * F.col("fill"))))
            .select("source", F.col("sid").cast("int").alias("sid"), "source_size", "n_docs", "target"))


def hypergeometric(u: Column, total: Column, good: Column, draws: Column) -> Column:
    """Exact draw of the good ones among ``draws`` of ``total`` (``good`` of them), from uniform ``u``.

    Inverse CDF over the support around the mean, by the ratio of successive
    probabilities.
    """
    n, g, d = (c.cast("double") for c in (total, good, draws))
    low, high = F.greatest(F.lit(0.0), d - (n - g)), F.least(d, g)
    mean = d * g / n
    sd = F.sqrt(F.greatest(F.lit(0.0), mean * (1 - g / n) * (n - d) / F.greatest(n - 1, F.lit(1.0))))
    first = F.greatest(low, F.floor(mean - sd * _SIGMAS) - 2).cast("long")
    last = F.least(high, F.ceil(mean + sd * _SIGMAS) + 2).cast("long")
    steps = F.sequence(first, last)
    ratio = lambda k: ((g - k) * (d - k)) / ((k + 1) * (n - g - d + k + 1))

    def weigh(acc, k):
        return F.struct((acc["p"] * ratio(k.cast("double"))).alias("p"), (acc["s"] + acc["p"]).alias("s"))

    mass = F.aggregate(steps, F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("s")), weigh)["s"]

    def pick(acc, k):
        s = acc["s"] + acc["p"]
        hit = (acc["at"] < 0) & ((s >= acc["goal"]) | (k == last))
        return F.struct((acc["p"] * ratio(k.cast("double"))).alias("p"), s.alias("s"), acc["goal"].alias("goal"),
                        F.when(hit, k).otherwise(acc["at"]).alias("at"))

    start = F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("s"), (u * mass).alias("goal"),
                     F.lit(-1).cast("long").alias("at"))
    drawn = F.aggregate(steps, start, pick)["at"]
    return F.when((n <= 0) | (d <= 0) | (g <= 0), F.lit(0).cast("long")).otherwise(drawn)


def _uniform(*columns) -> Column:
    return (F.pmod(F.xxhash64(*columns), F.lit(1 << 53)).cast("double") + 0.5) / float(1 << 53)


def splitting_tree(quotas: DataFrame, depth: int, seed: int) -> DataFrame:
    """(shard, sid, quota) of ``2 ** depth`` shards from (sid, quota) of all of them.

    A node is one row with the quotas of its sources; empty ones are dropped,
    so the leaves hold no more entries than draws.
    """
    node = quotas.filter("quota > 0").agg(F.sort_array(F.collect_list(F.struct("sid", "quota"))).alias("q")).select(
        F.lit(0).cast("long").alias("node"), "q").filter(F.size("q") > 0)
    entry = "array<struct<sid:int,left:bigint,right:bigint>>"
    for level in range(depth):
        if level and level % 6 == 0:
            node = node.repartition(F.col("node"))
        total = F.aggregate("q", F.lit(0).cast("long"), lambda a, x: a + x["quota"])

        def step(acc, x):
            left = hypergeometric(_uniform(F.lit(seed), F.lit(level), F.col("node"), x["sid"]),
                                  acc["rest"], x["quota"], acc["draws"])
            return F.struct((acc["rest"] - x["quota"]).alias("rest"), (acc["draws"] - left).alias("draws"),
                            F.concat(acc["out"], F.array(F.struct(
                                x["sid"].alias("sid"), left.alias("left"),
                                (x["quota"] - left).alias("right")))).alias("out"))

        start = F.struct(total.alias("rest"), F.floor(total / 2).cast("long").alias("draws"),
                         F.array().cast(entry).alias("out"))
        split = node.select("node", F.aggregate("q", start, step)["out"].alias("parts"))
        sides = split.select("node", "parts", F.explode(F.array(F.lit(0), F.lit(1))).alias("side"))
        node = sides.select(
            (F.col("node") * 2 + F.col("side")).alias("node"),
            F.filter(F.transform("parts", lambda p: F.struct(
                p["sid"].alias("sid"), F.when(F.col("side") == 0, p["left"]).otherwise(p["right"]).alias("quota"))),
                lambda x: x["quota"] > 0).alias("q"))
    return node.select(F.col("node").alias("shard"), F.explode("q").alias("e")).select(
        "shard", F.col("e.sid").alias("sid"), F.col("e.quota").alias("quota"))


def mix(docs: DataFrame, weights=WEIGHTS, max_repeat: int = 3, block_docs: int = 256,
        blocks_per_shard: int = 64, seed: int = 17) -> DataFrame:
    """``docs`` (doc_id, source, text or size, ...) plus size, source_size, target, placements.

    ``placements`` has one (epoch, shard) per copy that the mix takes of the
    document; it is empty for a document left out.
    """
    own_size = "size" in docs.columns and "text" not in docs.columns
    size = F.col("size") if own_size else word_count(F.col("text"))
    keys = cut_lineage(docs.select("doc_id", "source", size.alias("size")))
    sources = broadcast_if_small(
        source_targets(keys, weights, max_repeat)
        .withColumn("n_blocks", F.greatest(F.lit(1), F.ceil(F.col("n_docs") / block_docs)).cast("long"))
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                    .otherwise(0).cast("long"))
        .withColumn("rest", F.when(F.col("source_size") > 0,
                                   F.col("target") - F.col("epochs") * F.col("source_size")).otherwise(0.0))
        .withColumnRenamed("source", "s_source"), max_rows=100_000)
    item = F.xxhash64(F.lit(seed), "doc_id", "size")
    block = F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "size"), F.col("n_blocks"))
    placed = (keys.join(sources, F.col("source").eqNullSafe(F.col("s_source")))
              .select("sid", block.alias("block"), item.alias("item"), "size"))

    # Where each block begins in its source's hash order: prefix sums in two levels.
    blocks = placed.groupBy("sid", "block").agg(F.sum("size").alias("b_size")).withColumn(
        "super", F.floor(F.col("block") / _SUPER))
    supers = (blocks.groupBy("sid", "super").agg(F.sum("b_size").alias("s_size"))
              .withColumn("s_start", F.sum("s_size").over(
                  W.partitionBy("sid").orderBy("super").rowsBetween(W.unboundedPreceding, -1)))
              .select("sid", "super", F.coalesce("s_start", F.lit(0)).alias("s_start")))
    inner = F.sum("b_size").over(W.partitionBy("sid", "super").orderBy("block").rowsBetween(W.unboundedPreceding, -1))
    facts = sources.select("sid", "n_blocks", "epochs", "rest")
    begun = (blocks.withColumn("inner", F.coalesce(inner, F.lit(0))).join(supers, ["sid", "super"])
             .join(facts, "sid")
             .withColumn("start", F.col("s_start") + F.col("inner"))
             .withColumn("extra", F.col("start") < F.col("rest"))
             .withColumn("edge", F.col("extra") & (F.col("start") + F.col("b_size") > F.col("rest"))))
    begun = cut_lineage(begun.select("sid", "block", "n_blocks", "epochs", "extra", "edge",
                                     (F.col("rest") - F.col("start")).alias("room")))

    # The block at the edge (one a source): documents that still fit, in hash order.
    at_edge = (placed.join(begun.filter("edge").select("sid", "block", "room"), ["sid", "block"])
               .groupBy("sid", "block", "room", "item").agg(F.sum("size").alias("words"))
               .groupBy("sid", "block", "room")
               .agg(F.sort_array(F.collect_list(F.struct("item", "words"))).alias("items")))

    def fit(acc, x):
        ok = x["words"] <= acc["room"]
        return F.struct((acc["room"] - F.when(ok, x["words"]).otherwise(0)).alias("room"),
                        F.when(ok, F.concat(acc["taken"], F.array(x["item"]))).otherwise(acc["taken"]).alias("taken"))

    chosen = at_edge.select("sid", "block", F.aggregate("items", F.struct(
        F.col("room").alias("room"), F.array().cast("array<bigint>").alias("taken")), fit)["taken"].alias("taken"))

    # Quotas, the tree, and the shard of every block draw.
    draws = begun.groupBy("sid").agg(
        (F.max("n_blocks") * F.max("epochs") + F.max(F.when(F.col("extra"), F.col("block") + 1).otherwise(0)))
        .alias("quota"))
    total = draws.agg(F.sum("quota")).first()[0] or 0
    depth = max(0, math.ceil(math.log2(max(1.0, total / blocks_per_shard))))
    leaves = splitting_tree(draws, depth, seed)
    ends = F.sum("quota").over(W.partitionBy("sid").orderBy("shard"))
    runs = leaves.select("sid", "shard", (ends - F.col("quota")).alias("first"), "quota")
    taken = (begun.select("sid", "block", F.explode(F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("epochs")), lambda e: F.struct(
            e.alias("epoch"),
            # each whole epoch starts at another block
            F.when(e < F.col("epochs"), e * F.col("n_blocks") + F.pmod(
                F.col("block") + F.pmod(F.xxhash64(F.lit(seed + 2), "sid", e), F.col("n_blocks")), F.col("n_blocks")))
            .when(F.col("extra"), e * F.col("n_blocks") + F.col("block")).alias("draw")))).alias("d"))
        .select("sid", "block", "d.epoch", "d.draw").filter("draw IS NOT NULL"))
    drawn = (runs.select("sid", "shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("quota") - 1)).alias("draw"))
             .join(taken, ["sid", "draw"])
             .groupBy("sid", "block").agg(F.sort_array(F.collect_list(F.struct("epoch", "shard"))).alias("all")))
    plan = (begun.select("sid", "block", "edge", "epochs").join(drawn, ["sid", "block"], "left")
            .join(chosen, ["sid", "block"], "left")
            .select(F.col("sid").alias("p_sid"), F.col("block").alias("p_block"), "edge",
                    F.col("epochs").alias("p_epochs"), "all", "taken"))

    carry = [c for c in docs.columns if c.lower() not in RESULTS and not (own_size and c == "size")]
    given = (keys if set(carry) == {"doc_id", "source"} else  # no text is read again
             docs.select(*[F.col(f"`{c}`") for c in carry], size.alias("size")))
    marked = (given.join(sources, F.col("source").eqNullSafe(F.col("s_source")))
              .withColumn("__block", block).withColumn("__item", item))
    joined = marked.join(plan, (F.col("sid") == F.col("p_sid")) & (F.col("__block") == F.col("p_block")))
    whole = F.coalesce(F.col("all"), F.array().cast("array<struct<epoch:bigint,shard:bigint>>"))
    placements = F.when(F.col("edge") & ~F.array_contains("taken", F.col("__item")),
                        F.filter(whole, lambda x: x["epoch"] < F.col("p_epochs"))).otherwise(whole)
    return joined.select(*[F.col(f"`{c}`") for c in carry], "size", "source_size", "target",
                         placements.alias("placements"))


def copies(mixed: DataFrame) -> DataFrame:
    """One row per copy that the mix takes, with its shard and epoch."""
    return (mixed.select(*[c for c in mixed.columns if c != "placements"], F.explode("placements").alias("__p"))
            .select("*", F.col("__p.shard").alias("shard"), F.col("__p.epoch").alias("epoch")).drop("__p"))


def arranged(mixed: DataFrame, seed: int = 17) -> DataFrame:
    """The copies dealt to their shards, each shard in its own random order."""
    out = copies(mixed).withColumn("__order", F.xxhash64(F.lit(seed + 3), "shard", "epoch", "doc_id", "size"))
    return out.repartition("shard").sortWithinPartitions("shard", "__order", "doc_id").drop("__order")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    keys = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    with stage_scope(spark):
        return cut_lineage(mix(keys).select(
            "doc_id", "size", "source_size", "target",
            (F.col("size") * F.size("placements")).cast("long").alias("taken"),
            F.transform("placements", lambda p: p["shard"]).alias("shards")), outlive=True)
