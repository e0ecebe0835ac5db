"""Periodic runs of words by maximal pairs of an LCP-interval tree.

A run is a stretch of consecutive words with smallest period ``q`` and length of
at least ``max(min_words, exponent * q)`` that no neighbouring word extends.
Two occurrences of the same words are a maximal pair if neither the words
before nor those after them are equal.  A run ``[s, e)`` of period ``q`` is the
maximal pair ``(s, s + q)`` of ``e - s - q`` words, and every maximal pair whose
distance is small enough for its length spans a stretch that nothing extends:

1. words get exact numbers (dictionary of the slice), and suffixes that share
   fewer words with any other suffix of their document than the shortest pair
   of a run has (5 at the defaults) leave; the rest is one in twenty or fewer
   in prose;
2. the suffixes left are ordered by prefix doubling (numpy, all documents of a
   slice at once, settled suffixes leave), common lengths by Kasai's scan;
3. the intervals of equal common length are joined bottom-up.  An interval keeps
   its occurrences in text order, each with its class (the word to its left);
   joining looks for pairs of different classes whose distance satisfies the
   length constraint.  Occurrences closer than a third of their length lie at
   multiples of one period, so a run's pair is adjacent in that order: each
   occurrence of the smaller list looks only at its neighbours in the larger
   one (n log n in all), and the least distance of a stretch is its period.

Work is per document; a document is never split, so a task holds one slice
(1 MB) or one document, with about 100 bytes a word that takes part.

Defined cases: a null or empty text has no words and no run; very long texts
are handled whole; repeated rows are judged alike; ties of the longest exponent
go to the smallest start, then period; an empty table gives an empty result;
extra columns are ignored, whatever their names; a null id is not rewritten.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occuflow.llm import textarrays as ta
from occuflow.llm.workers import prepare

MIN_WORDS, EXPONENT = 6, 4

Rewrite = Callable[[object, int], tuple[int, int] | None]


def word_codes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Equal numbers for equal words, by a dictionary of the words themselves."""
    if not len(start):
        return np.empty(0, dtype=np.int64)
    sizes = end - start
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    raw = data[np.arange(ends[-1]) + np.repeat(start - ends[:-1], sizes)]
    column = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(raw)])
    return column.dictionary_encode().indices.to_numpy().astype(np.int64)


def suffix_ranks(keys: np.ndarray) -> np.ndarray:
    """Rank of every suffix; ``keys`` ends in a value that occurs once."""
    n = len(keys)
    order = np.argsort(keys, kind="stable")
    fresh = np.concatenate([[True], keys[order][1:] != keys[order][:-1]])
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    alone = fresh & np.concatenate([fresh[1:], [True]])
    left, k = order[~alone], 1
    while len(left):
        both = rank[left] * n + rank[left + k]
        by = np.argsort(both, kind="stable")
        left, both = left[by], both[by]
        old = rank[left]
        at = np.arange(len(left))
        first = np.concatenate([[True], old[1:] != old[:-1]])
        fresh = np.concatenate([[True], both[1:] != both[:-1]])
        rank[left] = (old + np.maximum.accumulate(np.where(fresh, at, 0))
                      - np.maximum.accumulate(np.where(first, at, 0)))
        left = left[~(fresh & np.concatenate([fresh[1:], [True]]))]
        k *= 2
    return rank


def common_lengths(keys: list[int], rank: list[int], order: list[int]) -> list[int]:
    """Words that each suffix shares with the one before it in order (Kasai)."""
    out, h = [0] * len(keys), 0
    for i, r in enumerate(rank):
        if not r:
            h = 0
            continue
        j = order[r - 1]
        while keys[i + h] == keys[j + h]:
            h += 1
        out[r] = h
        if h:
            h -= 1
    return out


class Runs:
    """Maximal pairs that are runs, from the joins of the interval tree."""

    def __init__(self, place: list[int], left: list[int], min_words: int, exponent: int):
        self.place, self.left = place, left
        self.min_words, self.exponent = min_words, exponent
        self.found: dict[tuple[int, int], int] = {}

    def join(self, a: list[int], b: list[int], depth: int) -> list[int]:
        """One list of two children's occurrences; reports the pairs between them."""
        if len(a) < len(b):
            a, b = b, a
        far, near = depth // (self.exponent - 1), self.min_words - depth
        place, left, n = self.place, self.left, len(a)
        at = [bisect_left(a, p) for p in b]
        for p, k in zip(b, at):
            if k:
                self._pair(a[k - 1], p, depth, near, far, place, left)
            if k < n:
                self._pair(p, a[k], depth, near, far, place, left)
        if len(b) == 1:
            a.insert(at[0], b[0])
            return a
        a += b
        a.sort()
        return a

    def _pair(self, i, j, depth, near, far, place, left):
        s = place[i]
        q = place[j] - s
        if near <= q <= far and left[i] != left[j]:
            stretch = (s, s + q + depth)
            if q < self.found.get(stretch, q + 1):
                self.found[stretch] = q

    def tree(self, order: list[int], common: list[int], least: int) -> None:
        """Bottom-up over the intervals of common length ``least`` and more."""
        depths: list[int] = []
        lists: list[list[int]] = []
        for r in range(1, len(order) + 1):
            h = common[r] if r < len(order) else 0
            if h >= least and not depths:
                lists = [[order[r - 1]]]
            while depths and depths[-1] >= h:
                b = lists.pop()
                lists.append(self.join(lists.pop(), b, depths.pop()))
            if h >= least:
                depths.append(h)
                lists.append([order[r]])


def least_pair(min_words: int, exponent: int) -> int:
    """Words that the two ends of the shortest run share."""
    return min(max(min_words, exponent * q) - q for q in range(1, min_words + 1))


def find_runs(codes: np.ndarray, owner: np.ndarray, min_words: int = MIN_WORDS, exponent: int = EXPONENT
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, length, period) of all runs in ``codes`` (words, end to end), ``owner`` being their text.

    Ordered by start, then period; places count from the first word of all.
    """
    none = np.empty(0, dtype=np.int64)
    least, n = least_pair(min_words, exponent), len(codes)
    if n <= least:
        return none, none, none
    # suffixes whose first words occur again in their text (by hash: a superset)
    value = ta.mix((codes + 1).astype(np.uint64) * ta.U64(0x9E3779B97F4A7C15))
    gram = ta.mix(owner[:n - least + 1].astype(np.uint64) + ta.U64(1))
    for k in range(least):
        gram = gram * ta.U64(0xD6E8FEB86659FD93) + value[k:n - least + 1 + k]
    whole = owner[:n - least + 1] == owner[least - 1:]
    ranked = np.sort(gram[whole])
    twice = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
    if not len(twice):
        return none, none, none
    hit = twice[np.minimum(np.searchsorted(twice, gram), len(twice) - 1)] == gram
    start = np.flatnonzero(hit & whole)
    # their words and the next one; each stretch ends in a number of its own
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, np.minimum(start + least + 1, np.searchsorted(owner, owner[start], side="right")), -1)
    place = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
    cut = np.flatnonzero((np.diff(place) > 1) | (owner[place[1:]] != owner[place[:-1]])) + 1
    cut = np.append(cut, len(place))
    width = int(codes.max()) + 1
    keys = np.insert(owner[place] * width + codes[place], cut, int(owner[-1] + 1) * width + np.arange(len(cut)))
    place = np.insert(place, cut, -1)
    before = np.where((place > 0) & (owner[place - 1] == owner[place]), codes[place - 1], -1)
    rank = suffix_ranks(keys)
    order = np.empty(len(rank), dtype=np.int64)
    order[rank] = np.arange(len(rank))
    order = order.tolist()
    runs = Runs(place.tolist(), before.tolist(), min_words, exponent)
    runs.tree(order, common_lengths(keys.tolist(), rank.tolist(), order), least)
    if not runs.found:
        return none, none, none
    rows = np.array(sorted((s, q, e - s) for (s, e), q in runs.found.items()), dtype=np.int64)
    return rows[:, 0], rows[:, 2], rows[:, 1]


def joined(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words, a space after each, and where each begins (and the end of all)."""
    sizes = end - start + 1
    at = np.concatenate([[0], np.cumsum(sizes)])
    index = np.arange(at[-1]) + np.repeat(start - at[:-1], sizes)
    out = data[np.minimum(index, len(data) - 1)] if len(data) else np.empty(0, np.uint8)
    out[at[1:] - 1] = 0x20
    return out, at


def rewrite_order(ids: list, bounds: np.ndarray, rewrite: Rewrite | None) -> np.ndarray:
    """Which word stands at each place once ``rewrite`` made texts periodic."""
    source = np.arange(bounds[-1])
    for i, key in enumerate(ids if rewrite else ()):
        n = int(bounds[i + 1] - bounds[i])
        if n and (how := rewrite(key, n)):
            first, period = how
            tail = np.arange(n - first)
            source[bounds[i] + first:bounds[i + 1]] = bounds[i] + first + tail % period
    return source


RUNS = "array<struct<start: long, length: long, period: long>>"


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS,
                  exponent: int = EXPONENT, rewrite: Rewrite | None = None, keep_text: bool = True) -> DataFrame:
    """(doc_id, n_words, runs, collapsed, collapsed_sha256) per row of ``docs``.

    ``runs`` are in order of start, then period; ``collapsed`` holds the words
    that are in no run after its first period, joined by one space (null
    without ``keep_text``).  ``rewrite(id, n_words)`` may name a first word and a
    period from there on, by which the text is made periodic before it is judged.
    """
    if exponent < 3 or min_words < 1:
        raise ValueError("runs need an exponent of 3 or more: the pairs of shorter ones need not be adjacent")
    prepare(docs.sparkSession)
    source = docs.select(F.col(f"`{doc_id}`").alias(doc_id), F.col(f"`{text}`").cast("string").alias("__text"))
    schema = (f"`{doc_id}` {source.dtypes[0][1]}, n_words long, runs {RUNS}, "
              "collapsed string, collapsed_sha256 string")
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in ta.text_slices(batches, "__text"):
            n = len(offsets) - 1
            start, end, owner = ta.words(data, offsets)
            bounds = np.searchsorted(owner, np.arange(n + 1))
            order = rewrite_order(rows.column(0).to_pylist() if rewrite else [], bounds, rewrite)
            start, end = start[order], end[order]
            place, length, period = find_runs(word_codes(data, start, end), owner, min_words, exponent)
            text_of = np.searchsorted(bounds, place, side="right") - 1
            edge = np.zeros(len(start) + 1, dtype=np.int64)
            np.add.at(edge, place + period, 1)
            np.add.at(edge, place + length, -1)
            kept = np.cumsum(edge[:-1]) == 0
            out, at = joined(data, start[kept], end[kept])
            cut = at[np.concatenate([[0], np.cumsum(kept)])[bounds]]
            flat = memoryview(out)
            pieces = [flat[a:max(a, b - 1)] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
            lists = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(text_of, np.arange(n + 1)), pa.int32()),
                pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (
                    place - bounds[text_of], length, period)], names=["start", "length", "period"]))
            yield pa.RecordBatch.from_arrays([
                rows.column(0), pa.array(np.diff(bounds), pa.int64()), lists.cast(kind),
                pa.array([bytes(p) for p in pieces] if keep_text else [None] * n, pa.binary()).cast(pa.string()),
                pa.array([hashlib.sha256(p).hexdigest() for p in pieces])],
                names=[doc_id, "n_words", "runs", "collapsed", "collapsed_sha256"])

    return source.mapInArrow(run, schema)


def every_tenth_periodic(key: object, n: int) -> tuple[int, int] | None:
    """The rewriting of the query: about one document in ten gets a periodic end."""
    h = zlib.crc32(str(key).encode()) if key is not None else 1
    if h % 10:
        return None
    g = h // 10
    first = g % n
    return first, 1 + (n - first) // (3 + g % 8)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = periodic_runs(docs, rewrite=every_tenth_periodic, keep_text=False)

    def better(best, r):
        # exact: length/period compared by cross products; earlier runs win ties
        return F.when(best["start"].isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)

    nothing = F.lit(None).cast("struct<start: long, length: long, period: long>")
    best = F.aggregate("runs", nothing, better)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"], ))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return (found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(F.expr("1000 * best.length div best.period")).cast("long").alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"), "collapsed_sha256"))


OP11_SQL = r"""
WITH bits AS (
  SELECT b, list_reduce([CAST(b AS BIGINT)] || CAST(range(8) AS BIGINT[]),
         lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS t FROM range(256) r(b)
), crc AS (SELECT list(t ORDER BY b) AS t FROM bits
), d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), h AS (
  SELECT rid, doc_id, w, len(w) AS n, coalesce(xor(list_reduce(
           [4294967295] || list_transform(regexp_extract_all(CAST(doc_id AS VARCHAR), '.'), lambda c: CAST(ascii(c) AS BIGINT)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295), 1) AS h
  FROM d, crc
), g AS (
  SELECT *, h // 10 AS g, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n END AS a FROM h
), plan AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM g
), word AS (
  SELECT rid, n, i, w[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END] AS x
  FROM (SELECT *, unnest(range(n)) AS i FROM plan)
), gram AS (
  SELECT rid, n, i, x, concat_ws(' ', x, lead(x, 1) OVER o, lead(x, 2) OVER o, lead(x, 3) OVER o, lead(x, 4) OVER o) AS k
  FROM word WINDOW o AS (PARTITION BY rid ORDER BY i)
), pair AS (
  SELECT a.rid, a.i, b.i - a.i AS q FROM gram a JOIN gram b USING (rid, k)
  WHERE a.i < b.i AND 4 * (b.i - a.i) <= a.n AND b.i + 4 < b.n
), island AS (
  SELECT rid, q, i, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS isl FROM pair
), stretch AS (
  SELECT rid, q, min(i) AS s, count(*) + 4 + q AS l FROM island GROUP BY rid, q, isl
), run AS (
  SELECT rid, s, l, min(q) AS q FROM stretch WHERE l >= greatest(6, 4 * q) GROUP BY rid, s, l
), best AS (
  SELECT rid, count(*) AS n_runs, string_agg(concat(s, ',', l, ',', q, chr(10)), '' ORDER BY s, q) AS listed,
         min(struct_pack(e := -CAST(l AS DECIMAL(30, 15)) / q, s := s, q := q, l := l)) AS b FROM run GROUP BY rid
), kept AS (
  SELECT rid, string_agg(x, ' ' ORDER BY i) AS t FROM word
  WHERE NOT EXISTS (SELECT 1 FROM run r WHERE r.rid = word.rid AND word.i >= r.s + r.q AND word.i < r.s + r.l) GROUP BY rid
)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(b.s AS BIGINT) AS start, CAST(b.l AS BIGINT) AS length,
       CAST(b.q AS BIGINT) AS period, CAST(1000 * b.l // b.q AS BIGINT) AS exponent_milli,
       sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM d LEFT JOIN best USING (rid) LEFT JOIN kept USING (rid)
"""
