"""Document fingerprints by winnowing.

Of every window of ``w`` consecutive byte k-grams the one with the least
rolling hash is chosen, the rightmost on ties; its position is kept.  Two
texts that share any string of ``w + k - 1`` bytes share a chosen k-gram, and
strings shorter than ``k`` bytes never match.  The likeness of two
fingerprints is the Jaccard index of their hash sets.

``fingerprints`` gives the chosen hashes with their positions per document;
``neighbour_fingerprints`` also pairs each document with the next one in
descending id order and fingerprints the edited text.

Order and pairing: documents are dealt by id ranges into partitions of about
equal size, each sorted there; the first document of every range is also sent
to the range before it, so each partition pairs its rows alone.  Ids that are
equal are ordered by text, null ids come last, null texts count as empty.

Defined cases: a text of fewer than ``k`` bytes has the hash of the whole text
as its fingerprint; an empty text has none, and two texts without a
fingerprint have likeness 1.  A single document is its own next one.  Extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from occuflow.llm import textarrays as ta
from occuflow.llm.workers import prepare


K, W = 16, 64


def winnow_texts(texts: list[bytes], k: int = K, w: int = W) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, position, 32-bit hash) of the chosen k-grams of each text."""
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    owner, position, grams, rolling, starts = ta.winnow(data, offsets, k, w)
    lengths = np.diff(offsets)
    short = np.flatnonzero((lengths > 0) & (lengths < k))
    if len(short):
        owner = np.concatenate([owner, short])
        position = np.concatenate([position, np.zeros(len(short), dtype=np.int64)])
        grams = np.concatenate([grams, rolling.at(starts[short], lengths[short])])
        order = np.argsort(owner, kind="stable")
        owner, position, grams = owner[order], position[order], grams[order]
    return owner, position, (grams >> ta.U64(32)).astype(np.uint32)


def hash_sets(texts: list[bytes], k: int = K, w: int = W) -> list[np.ndarray]:
    """Sorted distinct fingerprint hashes of each text."""
    owner, _, hashes = winnow_texts(texts, k, w)
    key = np.unique((owner.astype(np.uint64) << ta.U64(32)) | hashes)
    ends = np.searchsorted(key, (np.arange(len(texts) + 1, dtype=np.uint64)) << ta.U64(32))
    low = key.astype(np.uint32)
    return [low[ends[i]:ends[i + 1]] for i in range(len(texts))]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard index of two sorted hash sets; 1 if both are empty."""
    if not len(a) and not len(b):
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    both = np.sort(np.concatenate([a, b]))
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return shared / (len(a) + len(b) - shared)


def as_text(hashes: np.ndarray) -> str:
    """The set as text: 8 hexadecimal digits a hash, ascending."""
    return hashes.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame, text: str = "text", k: int = K, w: int = W) -> DataFrame:
    """``docs`` without the text, plus ``fingerprint``: array of (position, hash), by position."""
    prepare(docs.sparkSession)
    carry = [c for c in docs.columns if c != text and c.lower() != "fingerprint"]
    source = docs.select(*[F.col(f"`{c}`") for c in carry], F.col(f"`{text}`").cast("string").alias("__text"))
    schema = source.select(*[F.col(f"`{c}`") for c in carry],
                           F.lit(None).cast("array<struct<position:long,hash:long>>").alias("fingerprint")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in ta.text_slices(batches, "__text"):
            raw = data.tobytes()
            texts = [raw[offsets[i]:offsets[i + 1]] for i in range(len(offsets) - 1)]
            owner, position, hashes = winnow_texts(texts, k, w)
            ends = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
            values = pa.StructArray.from_arrays(
                [pa.array(position), pa.array(hashes.astype(np.int64))], names=["position", "hash"])
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(i) for i in range(len(carry))),
                 pa.ListArray.from_arrays(pa.array(ends), values)], names=[*carry, "fingerprint"])

    return source.mapInArrow(run, schema)


def edit(text: str, following: str) -> str:
    """The last half of the text's code points replaced by the next text's first ones."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _pairs(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list, list, list]]:
    """(ids, texts, next texts) of about ``size`` rows, from rows in (range, order) order.

    A row marked ``guest`` only serves as the next one of the row before it.
    """
    ids, texts, nexts, chars = [], [], [], 0
    held = None
    for batch in batches:
        for part, doc, text, guest in zip(*(c.to_pylist() for c in batch.columns)):
            text = text or ""
            if held is not None and held[0] == part:
                ids.append(held[1])
                texts.append(held[2])
                nexts.append(text)
                chars += len(held[2])
                if chars >= size:
                    yield ids, texts, nexts
                    ids, texts, nexts, chars = [], [], [], 0
            held = None if guest else (part, doc, text)
    if ids:
        yield ids, texts, nexts


def _ranges_above(bounds: np.ndarray) -> Column:
    """How many of the descending ``bounds`` exceed doc_id: a search of two short steps."""
    step = max(1, math.isqrt(len(bounds)))
    coarse = bounds[step - 1::step]
    skip = F.size(F.filter(F.lit(coarse), lambda b: b > F.col("doc_id"))) * step if len(coarse) else F.lit(0)
    return skip + F.size(F.filter(F.slice(F.lit(bounds), skip + 1, F.lit(step)), lambda b: b > F.col("doc_id")))


def neighbour_fingerprints(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """Per document: digests of its text and edited text, and the likenesses (see module)."""
    spark = docs.sparkSession
    prepare(spark)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n_parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    # Range bounds: as many ids as there are partitions, never more.
    cuts = sorted(set(base.filter("doc_id IS NOT NULL").approxQuantile(
        "doc_id", [i / n_parts for i in range(1, n_parts)], 0.2 / n_parts)))
    # descending: range 0 holds the largest ids, null ids form the last range
    part = F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(
        _ranges_above(np.array(cuts[::-1], dtype=np.int64)) if cuts else F.lit(0))
    # The first document of each range (one row a range): the largest id, then the least text.
    heads = {r["p"]: r["doc_id"] for r in base.select(part.alias("p"), "doc_id")
             .groupBy("p").agg(F.max("doc_id").alias("doc_id")).collect()}
    order = sorted(heads)
    before = {p: order[i - 1] for i, p in enumerate(order)}
    if not order:
        order, before, heads = [0], {0: 0}, {0: None}
    home = base.withColumn("part", part.cast("int"))
    # By range: its first id (unused for the null range) and the range before it.
    starts, goes = (np.zeros(len(cuts) + 2, dtype=np.int64) for _ in range(2))
    for p in order:
        starts[p], goes[p] = -1 if heads[p] is None else heads[p], before[p]
    is_head = F.col("doc_id").isNull() | (F.col("doc_id") == F.element_at(F.lit(starts), F.col("part") + 1))
    target = F.element_at(F.lit(goes), F.col("part") + 1).cast("int")
    dealt = (home.withColumn("to", F.when(is_head, F.array(
        F.struct(F.col("part").alias("p"), F.lit(False).alias("guest")),
        F.struct(target.alias("p"), F.lit(True).alias("guest")))).otherwise(
        F.array(F.struct(F.col("part").alias("p"), F.lit(False).alias("guest")))))
        .select(F.explode("to").alias("to"), "doc_id", "text")
        .select(F.col("to.p").alias("part"), "doc_id", "text", F.col("to.guest").alias("guest")))
    placed = (dealt.repartitionById(len(cuts) + 2, F.col("part"))
              .sortWithinPartitions("part", "guest", F.desc_nulls_last("doc_id"), "text"))
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, nexts in _pairs(batches, ta.SLICE_BYTES // 4):
            edited = [edit(t, n).encode() for t, n in zip(texts, nexts)]
            # a next text is nearly always the following row: fingerprint each text once
            fresh = [i for i in range(len(texts)) if i + 1 == len(texts) or texts[i + 1] != nexts[i]]
            prints = hash_sets([t.encode() for t in texts] + edited + [nexts[i].encode() for i in fresh], k, w)
            n = len(texts)
            following = [prints[i + 1] if i + 1 < n else None for i in range(n)]
            for j, i in enumerate(fresh):
                following[i] = prints[2 * n + j]
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(e).hexdigest() for e in edited], pa.string()),
                pa.array([as_text(p) for p in prints[:n]], pa.string()),
                pa.array([as_text(p) for p in prints[n:2 * n]], pa.string()),
                pa.array([likeness(prints[i], prints[n + i]) for i in range(n)], pa.float64()),
                pa.array([likeness(prints[i], following[i]) for i in range(n)], pa.float64()),
            ], names=names)

    return placed.mapInArrow(run, schema)


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return neighbour_fingerprints(docs)
