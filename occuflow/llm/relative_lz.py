"""Substring removal by relative Lempel-Ziv parsing.

The corpus is its own reference: a word goes if a window of ``length`` words
that covers it also starts earlier (smaller id, or same id and earlier start).
Every text is parsed into factors that copy from an earlier place:

1. *Index.*  Texts are cut into reference blocks at winnowing anchors: the
   least ``GRAM``-gram of the first ``length - GRAM + 1`` of a window, so equal
   windows have the same anchor at the same offset.  A block is the stretch of
   all windows that choose one anchor; it is indexed by its anchor's words.
   Blocks whose anchor words occur once anywhere have no match and leave.
2. *Factors.*  A block equal to an earlier block of the index is copied as a
   whole; neighbouring copies with the same displacement are one factor.
3. *Factor boundaries.*  Where a factor ends, a window may still occur earlier
   with other surroundings: in the first block of each content whose anchor words
   are shared by other blocks, every window is looked up by itself.  The first
   occurrence of any window lies in such a block (a later equal block would have
   an earlier copy of it), so nothing else has to be compared.
4. Factors of at least ``length`` words are the removed spans.

The index holds one row for about seven words.  Within a task equal blocks (or windows) are settled and one of them
goes on; blocks of one anchor that differ are dealt by their content.  So a
passage or a copy that a third of all texts share is one row per task and key,
and no text is compared with another one by one.  Copies of whole texts need no
treatment of their own.

Anchors are compared by 64 bits (they only select), blocks by these and 64 more
bits, windows by 128 bits.

Defined cases: a null or empty text has no words; texts shorter than ``length``
words keep all; rows that share an id are judged as starting together, so
repeated rows are judged alike and neither removes the other; a null id comes
after all others; very long texts are handled whole (memory grows with the
longest one); an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from occuflow.llm import textarrays as ta
from occuflow.llm.periodic import joined
from occuflow.llm.workers import prepare
from occuflow.session import cut_lineage, stage_scope

LENGTH = 20
# Rows settled together inside a task.
FLUSH_ROWS = 400_000
NO_ID = (1 << 63) - 1  # stands for a null id: after all others
# place = start << TAG_BITS | tag; the tag tells rows of one id apart
TAG_BITS = 24
ASK, TOLD, OPEN, COPY = range(4)

_BLOCK_ROWS = ("deal long, key long, block long, doc long, place long, state byte, "
               "from_doc long, from_place long")
FACTORS = "array<struct<start: long, length: long, ref_doc_id: long, ref_start: long>>"


def gram_words(length: int) -> int:
    """Words of an anchor: three tenths of the window, which makes one anchor for seven words of prose."""
    return max(2, length * 3 // 10)


class _Sums(ta.Rolling):
    """Prefix sums of a polynomial hash over word values."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.prefix = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * ta._power_table(ta._BASE, n), out=self.prefix[1:]) if n else None
        self.inverse = ta._power_table(ta._BASE_INV, n + 1)


class Parsed:
    """Words, anchors and window hashes of a slice of texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int):
        self.data, self.length = data, length
        self.start, self.end, self.owner = ta.words(data, offsets)
        n = len(self.start)
        self.bounds = np.searchsorted(self.owner, np.arange(len(offsets)))
        values = ta.word_hashes(data, self.start, self.end) if n else np.empty(0, np.uint64)
        self.one = _Sums(values)
        self._values = values
        k = gram_words(length)
        w = length - k + 1
        empty = np.empty(0, dtype=np.int64)
        self.anchor = self.first = self.last = empty
        if n < length:
            return
        grams = self.one.at(np.arange(n - k + 1), k)
        place = np.arange(len(grams), dtype=np.uint64)
        low = ta.U64(0xFFFFFFFF)
        least = ta.sliding_min((grams & ~low) | (low - place), w)
        begin = np.flatnonzero(self.owner[:n - length + 1] == self.owner[length - 1:])
        at = (low - (least[begin] & low)).astype(np.int64)
        edge = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else empty
        self.anchor = at[edge]
        # first and last start of the windows that choose it
        self.first = begin[edge]
        self.last = begin[np.append(edge[1:], len(at)) - 1] if len(at) else empty

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the anchors' words and of their blocks (with the anchor's offset)."""
        key = self.one.at(self.anchor, gram_words(self.length))
        stretch = self.one.at(self.first, self.last - self.first + self.length)
        return key.view(np.int64), ta.mix(stretch + (self.anchor - self.first).astype(np.uint64)).view(np.int64)

    def windows(self, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two independent hashes of the windows at ``start``."""
        if not hasattr(self, "two"):
            self.two = _Sums(ta.mix(self._values ^ ta.U64(0x5DEECE66D1234567)))
        return (self.one.at(start, self.length).view(np.int64), self.two.at(start, self.length).view(np.int64))

    def find(self, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Index of the anchors at word ``at`` of the given texts."""
        return np.searchsorted(self.anchor, self.bounds[owner] + at)


def _changes(*columns: np.ndarray) -> np.ndarray:
    out = np.ones(len(columns[0]), dtype=bool)
    if len(out) > 1:
        out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return out


class _Settler:
    """Gathers (key, block, doc, place) rows of a task and settles equal ones among them."""

    def __init__(self, ask_by_key: bool):
        self.held, self.n, self.ask_by_key = [], 0, ask_by_key

    def add(self, key, block, doc, place) -> bool:
        self.held.append((key, block, doc, place))
        self.n += len(key)
        return self.n >= FLUSH_ROWS

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.n:
            return
        key, block, doc, place = (np.concatenate([h[i] for h in self.held]) for i in range(4))
        self.held, self.n = [], 0
        order = np.lexsort((place, doc, block, key))
        key, block, doc, place = key[order], block[order], doc[order], place[order]
        new = _changes(key, block)
        first = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
        start = place >> TAG_BITS
        later = (doc != doc[first]) | (start != start[first])
        copy = later & ~new
        head = ~copy  # the earliest of each content, and rows that start together with it
        new_key = _changes(key)
        group = np.cumsum(new_key) - 1
        several = np.bincount(group[new]) > 1 if self.ask_by_key else np.zeros(group[-1] + 1, bool)
        opened = head & several[group]
        ask = head & ~opened
        told = key[new_key][several]
        by = key if self.ask_by_key else ta.mix(key.view(np.uint64) + block.view(np.uint64)).view(np.int64)
        spread = ta.mix(ta.mix(doc.view(np.uint64)) + place.view(np.uint64)).view(np.int64)
        parts = [(ask, by, ASK), (opened, spread, OPEN), (copy, spread, COPY)]
        n_told = len(told)
        none = np.zeros(n_told, dtype=np.int64)
        pick = [np.flatnonzero(p[0]) for p in parts]
        rows = np.concatenate(pick)
        refs = np.concatenate([np.zeros(len(pick[0]) + len(pick[1]) + n_told, bool), np.ones(len(pick[2]), bool)])
        head_n = len(pick[0]) + len(pick[1])

        def column(values, extra):
            v = values[rows]
            return np.concatenate([v[:head_n], extra, v[head_n:]])

        state = np.concatenate([np.full(len(pick[0]), ASK, np.int8), np.full(len(pick[1]), OPEN, np.int8),
                                np.full(n_told, TOLD, np.int8), np.full(len(pick[2]), COPY, np.int8)])
        deal = np.concatenate([by[pick[0]], spread[pick[1]], told, spread[pick[2]]])
        yield pa.RecordBatch.from_arrays([
            pa.array(deal), pa.array(column(key, told)), pa.array(column(block, none)),
            pa.array(column(doc, none)), pa.array(column(place, none)), pa.array(state),
            pa.array(column(doc[first], none), mask=~refs), pa.array(column(place[first], none), mask=~refs)],
            names=["deal", "key", "block", "doc", "place", "state", "from_doc", "from_place"])


def _places(owner: np.ndarray, at: np.ndarray, docs: np.ndarray, tags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return docs[owner], (at << TAG_BITS) | tags[owner]


def _index_rows(length: int):
    """A row per anchor of (doc, tag, text) rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle = _Settler(ask_by_key=True)
        for rows, data, offsets in ta.text_slices(batches, "__text"):
            t = Parsed(data, offsets, length)
            if not len(t.anchor):
                continue
            owner = t.owner[t.anchor]
            key, block = t.keys()
            if settle.add(key, block, *_places(owner, t.anchor - t.bounds[owner],
                                               rows.column(0).to_numpy(), rows.column(1).to_numpy())):
                yield from settle.rows()
        yield from settle.rows()

    return run


def _boundary_rows(length: int):
    """A row per window of the open blocks; rows are (doc, tag, open anchors, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle = _Settler(ask_by_key=False)
        for rows, data, offsets in ta.text_slices(batches, "__text"):
            if not len(rows.column(2).flatten()):
                continue
            t = Parsed(data, offsets, length)
            owner = _rows_of(rows.column(2))
            at = t.find(owner, pa.compute.list_flatten(rows.column(2)).to_numpy())
            count = t.last[at] - t.first[at] + 1
            start = np.repeat(t.first[at], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            owner = np.repeat(owner, count)
            if settle.add(*t.windows(start), *_places(owner, start - t.bounds[owner],
                                                      rows.column(0).to_numpy(), rows.column(1).to_numpy())):
                yield from settle.rows()
        yield from settle.rows()

    return run


def _rows_of(lists: pa.Array) -> np.ndarray:
    """Row of every entry of a list column (null lists are empty)."""
    sizes = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy()
    return np.repeat(np.arange(len(lists)), sizes)


def _repeated(rows: DataFrame) -> DataFrame:
    """Rows of keys that occur at two places or more, in this or another task."""
    same = W.partitionBy("deal")
    place = F.when(F.col("state") == ASK, F.xxhash64("doc", F.shiftright("place", TAG_BITS)))
    return (rows.withColumn("told", F.max(F.col("state") == TOLD).over(same))
            .withColumn("at", place)
            .withColumn("a", F.min("at").over(same)).withColumn("b", F.max("at").over(same))
            .filter((F.col("state") != TOLD)
                    & ((F.col("state") != ASK) | F.col("told") | (F.col("a") != F.col("b"))))
            .select("key", "block", "doc", "place", "state", "from_doc", "from_place"))


def _judged(found: DataFrame) -> DataFrame:
    """The same rows, each with the earliest equal block (``from_*``) if there is an earlier one."""
    start = F.shiftright("place", TAG_BITS)
    # rows settled in their task are groups of their own
    settled = F.col("state") == COPY
    groups = W.partitionBy(F.when(settled, F.xxhash64("doc", "place")).otherwise(F.col("key")),
                           F.when(settled, F.col("place")).otherwise(F.col("block")))
    first = F.min(F.struct("doc", start.alias("start"), "place")).over(groups)
    later = (F.col("doc") != F.col("first.doc")) | (start != F.col("first.start"))
    return (found.withColumn("first", first)
            .withColumn("from_doc", F.when(settled, F.col("from_doc")).when(later, F.col("first.doc")))
            .withColumn("from_place", F.when(settled, F.col("from_place")).when(later, F.col("first.place")))
            .drop("first"))


def _tag() -> F.Column:
    return F.xxhash64("__text").bitwiseAND(F.lit((1 << TAG_BITS) - 1))


def _base(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    base = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(NO_ID)).alias("doc"),
                       F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("__text"))
    return base.select("doc", _tag().alias("tag"), "__text")


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, tag, n_words, sha256 of all words) of (doc, tag, text) rows."""
    for rows, data, offsets in ta.text_slices(batches, "__text"):
        start, end, owner = ta.words(data, offsets)
        bounds = np.searchsorted(owner, np.arange(len(offsets)))
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), rows.column(1), pa.array(np.diff(bounds), pa.int64()),
             pa.array(_digests(data, start, end, bounds))], names=["doc", "tag", "n_words", "sha"])


def _digests(data: np.ndarray, start: np.ndarray, end: np.ndarray, bounds: np.ndarray) -> list[str]:
    out, at = joined(data, start, end)
    flat, cut = memoryview(out), at[bounds].tolist()
    return [hashlib.sha256(flat[a:max(a, b - 1)]).hexdigest() for a, b in zip(cut[:-1], cut[1:])]


def _greedy(start: np.ndarray, source: np.ndarray, ref: np.ndarray, owner: np.ndarray, length: int, n_rows: int
            ) -> pa.Array:
    """Factors per row from copied windows in order: a factor goes on while its displacement holds."""
    fresh = _changes(owner, source, ref - start)
    fresh[1:] |= start[1:] > start[:-1] + length
    edge = np.flatnonzero(fresh) if len(start) else np.empty(0, np.int64)
    last = np.append(edge[1:], len(start)) - 1 if len(edge) else edge
    parts = pa.StructArray.from_arrays([
        pa.array(start[edge], pa.int64()), pa.array(start[last] - start[edge] + length, pa.int64()),
        pa.array(source[edge], pa.int64(), mask=source[edge] == NO_ID), pa.array(ref[edge], pa.int64())],
        names=["start", "length", "ref_doc_id", "ref_start"])
    return pa.ListArray.from_arrays(
        pa.array(np.searchsorted(owner[edge], np.arange(n_rows + 1)), pa.int32()), parts)


def _spans(length: int, keep_text: bool):
    """Factors and what is left; rows are (doc, tag, text, blocks, windows)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in ta.text_slices(batches, "__text"):
            n = len(offsets) - 1
            t = Parsed(data, offsets, length)
            by = _rows_of(rows.column(3))
            block = [_field(rows.column(3), i) for i in range(3)]
            at = t.find(by, block[0])
            count = t.last[at] - t.first[at] + 1
            start = np.repeat(t.first[at], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            owner = np.repeat(by, count)
            anchor = np.repeat(t.anchor[at], count)
            source = np.repeat(block[1], count)
            ref = np.repeat(block[2], count) - (anchor - start)
            by2 = _rows_of(rows.column(4))
            window = [_field(rows.column(4), i) for i in range(3)]
            start = np.concatenate([start, t.bounds[by2] + window[0]])
            source, ref = np.concatenate([source, window[1]]), np.concatenate([ref, window[2]])
            owner = np.concatenate([owner, by2])
            order = np.argsort(start, kind="stable")
            start, source, ref, owner = start[order], source[order], ref[order], owner[order]
            edge = np.zeros(len(t.start) + 1, dtype=np.int64)
            np.add.at(edge, start, 1)
            np.add.at(edge, start + length, -1)
            kept = np.cumsum(edge[:-1]) == 0
            upto = np.concatenate([[0], np.cumsum(kept)])[t.bounds]
            out, place = joined(data, t.start[kept], t.end[kept])
            flat, cut = memoryview(out), place[upto].tolist()
            pieces = [flat[a:max(a, b - 1)] for a, b in zip(cut[:-1], cut[1:])]
            factors = _greedy(start - t.bounds[owner], source, ref, owner, length, n)
            yield pa.RecordBatch.from_arrays([
                rows.column(0), rows.column(1), pa.array(np.diff(t.bounds) - np.diff(upto), pa.int64()), factors,
                pa.array([bytes(p) for p in pieces] if keep_text else [None] * n, pa.binary()).cast(pa.string()),
                pa.array([hashlib.sha256(p).hexdigest() for p in pieces])],
                names=["doc", "tag", "n_removed", "factors", "kept_text", "kept_sha256"])

    return run


def _field(lists: pa.Array, i: int) -> np.ndarray:
    return pa.compute.struct_field(pa.compute.list_flatten(lists), i).to_numpy()


def _copies(judged: DataFrame, name: str) -> DataFrame:
    """(doc, tag, list of (start, from_doc, from_start)) of the rows that are copies."""
    entry = F.struct(F.shiftright("place", TAG_BITS).alias("at"), "from_doc",
                     F.shiftright("from_place", TAG_BITS).alias("ref"))
    return (judged.filter("from_doc IS NOT NULL")
            .groupBy("doc", F.col("place").bitwiseAND(F.lit((1 << TAG_BITS) - 1)).alias("tag"))
            .agg(F.collect_set(entry).alias(name)))


def remove_repeated_windows(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text",
                            keep_text: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, factors, kept_text, kept_sha256) per row of ``docs``.

    ``factors`` are (start, length, ref_doc_id, ref_start) in words, in order;
    their union is what was removed.  ``kept_text`` (the words left, joined by
    one space) is null for texts that keep all, and without ``keep_text``.
    """
    if length < 4:
        raise ValueError("windows of fewer than four words have no anchors of two")
    spark = docs.sparkSession
    prepare(spark)
    base = _base(docs, doc_id, text)
    facts = cut_lineage(base.mapInArrow(_facts, "doc long, tag long, n_words long, sha string"))
    judged = cut_lineage(_judged(_repeated(base.mapInArrow(_index_rows(length), _BLOCK_ROWS))))

    # First blocks of each content, where other blocks have the same anchor words.
    first = judged.filter("from_doc IS NULL")
    shared = (judged.filter(F.col("state") != COPY).groupBy("key")
              .agg(((F.min("block") != F.max("block")) | (F.max("state") == OPEN)).alias("several")).filter("several"))
    tag = F.col("place").bitwiseAND(F.lit((1 << TAG_BITS) - 1)).alias("tag")
    opened = (first.join(shared, "key", "left_semi").groupBy("doc", tag)
              .agg(F.collect_set(F.shiftright("place", TAG_BITS)).alias("open")))
    lists = opened.join(_copies(judged, "blocks"), ["doc", "tag"], "full")
    texts = cut_lineage(base.join(lists.hint("shuffle_hash"), ["doc", "tag"]).dropDuplicates(["doc", "tag"])
                        .select("doc", "tag", "open", "blocks", "__text"))
    windows = _judged(_repeated(texts.select("doc", "tag", "open", "__text").mapInArrow(_boundary_rows(length), _BLOCK_ROWS)))
    texts = (texts.join(_copies(windows, "windows").hint("shuffle_hash"), ["doc", "tag"], "left")
             .filter("blocks IS NOT NULL OR windows IS NOT NULL"))
    parsed = (texts.select("doc", "tag", "__text", "blocks", "windows").mapInArrow(
        _spans(length, keep_text),
        f"doc long, tag long, n_removed long, factors {FACTORS}, kept_text string, kept_sha256 string"))
    kind = docs.select(F.col(f"`{doc_id}`")).dtypes[0][1]
    return (facts.join(parsed, ["doc", "tag"], "left").select(
        F.when(F.col("doc") != NO_ID, F.col("doc")).cast(kind).alias(doc_id), "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("factors", F.array().cast(FACTORS)).alias("factors"), "kept_text",
        F.coalesce("kept_sha256", "sha").alias("kept_sha256")))


def op12_relative_lz(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    with stage_scope(spark):
        found = remove_repeated_windows(docs, keep_text=False)
        return cut_lineage(found.select("doc_id", "n_words", "n_removed", "kept_sha256"), outlive=True)


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), word AS (SELECT rid, doc_id, len(w) AS n, w, unnest(range(len(w))) AS i FROM d
), win AS (
  SELECT rid, i, coalesce(doc_id, 9223372036854775807) AS doc, array_to_string(w[i + 1:i + 20], ' ') AS k
  FROM word WHERE i + 20 <= n
), first AS (
  SELECT rid, i, (doc, i) > min((doc, i)) OVER (PARTITION BY k) AS later FROM win
), dup AS (SELECT rid, i FROM first WHERE later
), near AS (
  SELECT rid, n, i, w[i + 1] AS x, max(dup.j) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS hit
  FROM (SELECT rid, n, w, i FROM word) LEFT JOIN (SELECT rid, i, i AS j FROM dup) dup USING (rid, i)
), kept AS (
  SELECT rid, string_agg(x, ' ' ORDER BY i) FILTER (WHERE hit IS NULL) AS t, count(hit) AS gone FROM near GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""
