"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

Every byte covered by a string of ``length`` bytes that also starts anywhere
else in the corpus (same text included) is removed; texts are judged as given.
Suffixes are ordered only through their first ``length`` bytes, by passes over
ever smaller groups, and only as long as a group is undecided:

* the first digit of a suffix is its *anchor block*: the winnowing choice among
  its first ``W`` k-grams and the bytes from there on that every suffix with
  this choice holds.  Equal strings have equal choices, so a suffix whose block
  occurs once is alone and leaves; the block stands for all suffixes with the
  same choice (their offsets to it fill a range below ``W``);
* a group of suffixes (anchor, offset range) is decided at once if the union of
  its strings occurs twice (all repeated) or their common part occurs once (none);
* undecided ranges are split (256 -> 16 -> 1 offsets) and looked at again,
  together with one decided range of each content they may share strings with,
  down to single suffixes, whose whole string is then the digit: groups that
  are equal now are exactly the repeated strings.

Digits are compared as 64-bit hashes with their length.  Within a task equal
digits are settled and sent on as one row, so a passage that half of all texts
share does not pile up anywhere.  Texts equal as a whole are one occurrence;
if there are several (by SHA-256), every one of at least ``length`` bytes is
removed whole.

Defined cases: a null text is empty; texts shorter than ``length`` keep all;
repeated rows are copies of each other; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from occuflow.llm import textarrays as ta
from occuflow.llm.workers import prepare
from occuflow.session import cut_lineage, stage_scope

LENGTH, GRAM = 400, 16
# Digits settled together inside a task.
FLUSH_ROWS = 400_000
_ROW_SCHEMA = "deal long, key long, uid long, node long, known boolean"
_NODE = 1024  # node = anchor * _NODE + offset * 2 + part (0 common part, 1 union)


def first_range(length: int) -> int:
    """Offsets per anchor at the first level: a power of two, about 0.64 of the length."""
    return 1 << (int(length * 0.64).bit_length() - 1)


def levels(length: int) -> list[int]:
    """Range sizes of the passes: each a sixteenth of the one before, down to 1."""
    out = [first_range(length)]
    while out[-1] > 1:
        out.append(max(1, out[-1] // 16))
    return out


class Anchored:
    """Anchors of a slice of texts, the offset range each stands for, and span hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int):
        w = first_range(length)
        self.length = length
        self.sizes = np.diff(offsets)
        laid, self.starts = ta.padded(data, offsets, GRAM + w)
        n_grams = np.maximum(self.sizes - GRAM + 1, 0)
        n_windows = np.maximum(self.sizes - length + 1, 0)
        begin, at, _, self.rolling = ta.window_choices(laid, self.starts, n_grams, n_windows, GRAM, w)
        change = np.ones(len(at) + 1, dtype=bool)
        change[1:-1] = at[1:] != at[:-1]
        edge = np.flatnonzero(change)
        first, last = edge[:-1], edge[1:] - 1
        at = at[first] if len(at) else at
        self.owner = np.searchsorted(self.starts, at, side="right") - 1
        self.anchor = at - self.starts[self.owner]
        self.low, self.high = at - begin[last], at - begin[first]

    def find(self, owner: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Index of the given (text, anchor) pairs, which must be anchors."""
        return np.searchsorted(self.starts[self.owner] + self.anchor, self.starts[owner] + anchor)

    def digits(self, owner: np.ndarray, anchor: np.ndarray, low: np.ndarray, size: int
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(entry, part, start, hash) of the common parts and unions of offset ranges."""
        start = anchor - low
        common = self.rolling.at(self.starts[owner] + start, self.length - size + 1)
        entry, part, key = [np.arange(len(owner))], [np.zeros(len(owner), np.int64)], [common]
        begin = [start]
        if size > 1:
            u_start = start - size + 1
            ok = np.flatnonzero((u_start >= 0) & (start + self.length <= self.sizes[owner]))
            entry.append(ok)
            part.append(np.ones(len(ok), np.int64))
            begin.append(u_start[ok])
            key.append(self.rolling.at(self.starts[owner[ok]] + u_start[ok], self.length + size - 1))
        return tuple(np.concatenate(x) for x in (entry, part, begin, key))


class _Settler:
    """Gathers digits of a task and settles the equal ones among them."""

    def __init__(self):
        self.held, self.n = [], 0

    def add(self, key, uid, node, start) -> bool:
        self.held.append((key, uid, node, ta.mix(uid.view(np.uint64) + ta.mix(start.astype(np.uint64)))))
        self.n += len(key)
        return self.n >= FLUSH_ROWS

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.n:
            return
        key, uid, node, place = (np.concatenate([h[i] for h in self.held]) for i in range(4))
        self.held, self.n = [], 0
        order = np.lexsort((place, key))
        key, uid, node, place = key[order], uid[order], node[order], place[order]
        new_key = np.concatenate([[True], key[1:] != key[:-1]])
        new_place = new_key | np.concatenate([[True], place[1:] != place[:-1]])
        group = np.cumsum(new_key) - 1
        several = np.bincount(group[new_place]) > 1
        # one place may stand for several nodes: all of them get the answer
        known = several[group]
        tell = key[new_key][several]
        ask = ~known
        blank = np.zeros(len(tell), dtype=bool)
        yield pa.RecordBatch.from_arrays([
            # settled rows are only passed on: dealt by place, not by digit
            pa.array(np.concatenate([ta.mix(place[known]), tell, key[ask]]).view(np.int64)),
            pa.array(np.concatenate([key[known], tell, key[ask]]).view(np.int64)),
            pa.array(np.concatenate([uid[known], np.zeros(len(tell), np.int64), uid[ask]]),
                     mask=np.concatenate([np.zeros(known.sum(), bool), ~blank, np.zeros(ask.sum(), bool)])),
            pa.array(np.concatenate([node[known], np.zeros(len(tell), np.int64), node[ask]])),
            pa.array(np.concatenate([np.ones(known.sum() + len(tell), bool), np.zeros(ask.sum(), bool)]))],
            names=["deal", "key", "uid", "node", "known"])


def _first_digits(length: int):
    size = first_range(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle = _Settler()
        for rows, data, offsets in ta.text_slices(batches, "__text"):
            t = Anchored(data, offsets, length)
            uid = rows.column(0).to_numpy()
            entry, part, start, key = t.digits(t.owner, t.anchor, np.zeros(len(t.anchor), np.int64), size)
            if settle.add(key, uid[t.owner[entry]], t.anchor[entry] * _NODE + part, start):
                yield from settle.rows()
        yield from settle.rows()

    return run


def _next_digits(length: int, parent: int, size: int):
    """Digits of the parts of open ranges; rows are (uid, nodes, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle = _Settler()
        for rows, data, offsets in ta.text_slices(batches, "__text"):
            t = Anchored(data, offsets, length)
            uid = rows.column(0).to_numpy()
            nodes = rows.column(1)
            owner = np.repeat(np.arange(len(offsets) - 1), pa.compute.list_value_length(nodes).to_numpy())
            node = pa.compute.list_flatten(nodes).to_numpy()
            anchor, low = node // _NODE, node % _NODE // 2
            at = t.find(owner, anchor)
            child = np.arange(0, parent, size)
            low = (low[:, None] + child[None, :]).ravel()
            owner, anchor, at = (np.repeat(x, len(child)) for x in (owner, anchor, at))
            own = (low <= t.high[at]) & (low + size - 1 >= t.low[at])
            owner, anchor, low = owner[own], anchor[own], low[own]
            entry, part, start, key = t.digits(owner, anchor, low, size)
            if settle.add(key, uid[owner[entry]], anchor[entry] * _NODE + low[entry] * 2 + part, start):
                yield from settle.rows()
        yield from settle.rows()

    return run


def _repeated(rows: DataFrame, size: int) -> DataFrame:
    """(uid, node, key) of the digits that occur at two places or more."""
    node = F.col("node")
    start = F.floor(node / _NODE) - F.floor(node % _NODE / 2) - F.when(node % 2 == 1, size - 1).otherwise(0)
    place = F.when(F.col("uid").isNotNull(), F.xxhash64("uid", start))
    same = W.partitionBy("deal")
    return (rows.withColumn("place", place)
            .withColumn("told", F.max("known").over(same))
            .withColumn("first", F.min("place").over(same)).withColumn("last", F.max("place").over(same))
            .filter(F.col("uid").isNotNull() & (F.col("told") | (F.col("first") != F.col("last"))))
            .select("uid", "node", "key").distinct())


def _open_nodes(found: DataFrame) -> DataFrame:
    """(uid, node) to split further: undecided ranges, and what they have to be compared with.

    A range whose union is repeated is decided, but an undecided one with the
    same common part may still share some of its strings; one range of each
    distinct union goes on for that.
    """
    common = found.filter("node % 2 = 0").select("uid", "node", F.col("key").alias("common"))
    union = found.filter("node % 2 = 1").select("uid", (F.col("node") - 1).alias("node"), F.col("key").alias("union"))
    both = common.join(union, ["uid", "node"], "left")
    undecided = both.filter("union IS NULL")
    # summed before the join: a passage that many texts share is one row there
    others = (both.filter("union IS NOT NULL")
              .groupBy("common", "union").agg(F.min("uid").alias("u"), F.min_by("node", "uid").alias("n"))
              .join(undecided.select("common").distinct(), "common", "left_semi"))
    return undecided.select("uid", "node").union(others.select("u", "n"))


def _spans(length: int, sizes: list[int]):
    """(uid, n_removed, n_spans, kept_sha256) from the repeated ranges of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in ta.text_slices(batches, "__text"):
            t = Anchored(data, offsets, length)
            n = len(offsets) - 1
            edge = np.zeros(len(data) + 1, dtype=np.int64)
            for level, size in enumerate(sizes):
                nodes = rows.column(1 + level)
                owner = np.repeat(np.arange(n), pa.compute.list_value_length(nodes).to_numpy())
                node = pa.compute.list_flatten(nodes).to_numpy()
                anchor, low = node // _NODE, node % _NODE // 2
                at = t.find(owner, anchor)
                first = anchor - np.minimum(low + size - 1, t.high[at])
                last = anchor - np.maximum(low, t.low[at])
                ok = first <= last
                np.add.at(edge, offsets[owner[ok]] + first[ok], 1)
                np.add.at(edge, offsets[owner[ok]] + last[ok] + length, -1)
            gone = np.cumsum(edge[:-1]) > 0
            removed, spans, digest = [], [], []
            for i in range(n):
                g = gone[offsets[i]:offsets[i + 1]]
                removed.append(int(np.count_nonzero(g)))
                spans.append(int(np.count_nonzero(g[1:] & ~g[:-1]) + (len(g) > 0 and g[0])))
                digest.append(hashlib.sha256(data[offsets[i]:offsets[i + 1]][~g].tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest)],
                names=["uid", "n_removed", "n_spans", "kept_sha256"])

    return run


def repeated_ranges(docs: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The passes: (facts per document, texts with a repeated block, their repeated ranges).

    The ranges are (uid, level, node); ``Anchored`` and ``levels`` turn them
    into positions.
    """
    spark = docs.sparkSession
    prepare(spark)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select("doc_id", text.alias("__text")).withColumn("uid", F.xxhash64("__text"))
    facts = cut_lineage(base.select("doc_id", "uid", F.octet_length("__text").cast("long").alias("n_bytes"),
                                    F.sha2("__text", 256).alias("sha")))
    long_enough = base.filter(F.octet_length("__text") >= length)
    sizes = levels(length)
    rows = long_enough.select("uid", "__text").mapInArrow(_first_digits(length), _ROW_SCHEMA)
    found = cut_lineage(_repeated(rows, sizes[0]))
    ranges = _full(found, 0)

    # Texts with a repeated block, one of each set of copies.
    per_uid = facts.groupBy("uid").agg(F.min("doc_id").alias("rep"))
    wanted = (found.filter("node % 2 = 0").select("uid").distinct().join(per_uid, "uid")
              .select(F.col("uid").alias("w_uid"), "rep"))
    texts = cut_lineage(long_enough.join(
        wanted.hint("shuffle_hash"), (F.col("uid") == F.col("w_uid")) & F.col("doc_id").eqNullSafe(F.col("rep")))
        .select("uid", "__text"))
    for level in range(1, len(sizes)):
        opened = _open_nodes(found).groupBy("uid").agg(F.collect_list("node").alias("nodes"))
        rows = (texts.join(opened.hint("shuffle_hash"), "uid").select("uid", "nodes", "__text")
                .mapInArrow(_next_digits(length, sizes[level - 1], sizes[level]), _ROW_SCHEMA))
        found = cut_lineage(_repeated(rows, sizes[level]))
        ranges = ranges.union(_full(found, level, sizes[level] == 1))
    return facts, texts, ranges


def _full(found: DataFrame, level: int, single: bool = False) -> DataFrame:
    return (found.filter("node % 2 = 0" if single else "node % 2 = 1")
            .select("uid", F.lit(level).alias("level"), "node"))


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per row of ``docs`` (doc_id, text)."""
    facts, texts, ranges = repeated_ranges(docs, length)
    sizes = levels(length)
    per_level: list[Column] = [
        F.collect_list(F.when(F.col("level") == i, F.col("node"))).alias(f"n{i}") for i in range(len(sizes))]
    judged = (texts.join(ranges.groupBy("uid").agg(*per_level).hint("shuffle_hash"), "uid")
              .select("uid", *[f"n{i}" for i in range(len(sizes))], "__text")
              .mapInArrow(_spans(length, sizes), "uid long, n_removed long, n_spans long, kept_sha256 string"))
    judged = judged.dropDuplicates(["uid"]).withColumnRenamed("uid", "j_uid")
    copies = facts.groupBy(F.col("sha").alias("c_sha")).agg((F.count("*") > 1).alias("copied"))
    whole = F.col("copied") & (F.col("n_bytes") >= length)
    nothing = hashlib.sha256(b"").hexdigest()
    return (facts.join(copies, F.col("sha") == F.col("c_sha")).join(judged, F.col("uid") == F.col("j_uid"), "left")
            .select("doc_id", "n_bytes",
                    F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
                    F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
                    F.when(whole, F.lit(nothing)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256")))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    with stage_scope(spark):
        return cut_lineage(remove_repeats(docs), outlive=True)


OP2_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, octet_length(encode(coalesce(text, ''))) AS n,
         hex(encode(coalesce(text, ''))) AS h
  FROM documents
), starts AS (
  SELECT rid, h, unnest(range(0, n - 399)) AS p FROM d WHERE n >= 400
), key AS (
  SELECT rid, p, md5(substr(h, 2 * p + 1, 800)) AS k FROM starts
), repeated AS (
  SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY k) AS c FROM key) WHERE c > 1
), marked AS (
  SELECT rid, p, CASE WHEN p <= lag(p) OVER (PARTITION BY rid ORDER BY p) + 400 THEN 0 ELSE 1 END AS fresh FROM repeated
), runs AS (
  SELECT rid, min(p) AS s, max(p) + 400 AS e
  FROM (SELECT rid, p, sum(fresh) OVER (PARTITION BY rid ORDER BY p) AS run FROM marked) GROUP BY rid, run
), pieces AS (
  SELECT rid, coalesce(lag(e) OVER (PARTITION BY rid ORDER BY s), 0) AS a, s AS b FROM runs
  UNION ALL SELECT d.rid, coalesce(max(e), 0), any_value(n) FROM d LEFT JOIN runs USING (rid) GROUP BY d.rid
), kept AS (
  SELECT rid, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS k FROM pieces JOIN d USING (rid) GROUP BY rid
), gone AS (
  SELECT rid, sum(e - s) AS n_removed, count(*) AS n_spans FROM runs GROUP BY rid
)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM d JOIN kept USING (rid) LEFT JOIN gone USING (rid)
"""
