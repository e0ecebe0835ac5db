"""Interpolated modified Kneser-Ney bigram model, counted in Spark.

Counting: each task turns its training texts into (context, token) hash pairs,
sums equal pairs of about ``flush_tokens`` tokens, and sends them as compressed
arrays to the bucket of their key.  The key's high bits come from the context
and four bits of the token, so a very common context is spread over sixteen
places; a bucket sums its pairs and writes them as sorted arrays to the shared
folder, and sends per-context and per-token sums on to word buckets, which
write the vocabulary the same way.  Counts of counts give the discounts.

Scoring: workers memory-map the sorted arrays and look up the distinct pairs
and words of a slice of texts by binary search, so only touched pages are
read.  ``P(v|u) = max(c(uv) - D, 0) / c(u) + g(u) * Pc(v)`` with three
discounts per order; ``Pc`` interpolates continuation counts with the uniform
distribution over the vocabulary and one unknown token.

Tokens are words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, then one end
token a text; a start mark is the first token's context and no token itself.

Defined cases: a null or empty text is the end token alone; null ids count as
training texts; without training texts every probability is that of the one
unknown token, 1, and ``c = N = V = 0``; repeated rows count each; extra
columns are carried unless they have a result's name.

The model's files stay in the shared checkpoint folder until ``drop`` is called.
"""

from __future__ import annotations

import io
import os
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from occuflow.llm import textarrays as ta
from occuflow.llm.workers import lean_heap, prepare
from occuflow.session import cut_lineage, ensure_checkpoint_dir

U64 = np.uint64
END, START = U64(0xE5D0F7A2C4B39681), U64(0x51A7E0B6D38C2F94)
FLUSH_TOKENS = 1_000_000
RESULTS = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
# Key layout: this many high bits from (context, 4 bits of the token).
_HIGH = U64(((1 << 24) - 1) << 40)


def shared_folder(uri: str) -> tuple[object, str]:
    """(file system, path) of a folder; the file system is None for a plain path."""
    if uri.startswith("file:"):
        return None, "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return None, uri
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def save_array(folder: str, name: str, values: np.ndarray) -> None:
    """Write ``values`` whole or not at all; a repeated task writes the same bytes."""
    fs, path = shared_folder(folder)
    part = f"{path}/.{name}.{uuid.uuid4().hex}"
    if fs is None:
        os.makedirs(path, exist_ok=True)
        with open(part, "wb") as f:
            np.save(f, values)
        os.replace(part, f"{path}/{name}")
        return
    fs.create_dir(path, recursive=True)
    out = io.BytesIO()
    np.save(out, values)
    with fs.open_output_stream(part) as f:
        f.write(out.getbuffer())
    fs.move(part, f"{path}/{name}")


def map_array(folder: str, name: str) -> np.ndarray:
    """The array, memory-mapped; from a remote store through an unlinked local copy."""
    fs, path = shared_folder(folder)
    if fs is None:
        return np.load(f"{path}/{name}", mmap_mode="r")
    with tempfile.NamedTemporaryFile() as local, fs.open_input_stream(f"{path}/{name}") as f:
        while chunk := f.read(8 << 20):
            local.write(chunk)
        local.flush()
        return np.load(local.name, mmap_mode="r")


def pack_arrays(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, side by side, compressed."""
    raw = b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack_arrays(blob: bytes, *kinds) -> list[np.ndarray]:
    n = int.from_bytes(blob[:8], "little")
    raw = pa.decompress(blob[8:], decompressed_size=n, codec="zstd", asbytes=True)
    rows, at, out = n // sum(np.dtype(k).itemsize for k in kinds), 0, []
    for k in kinds:
        out.append(np.frombuffer(raw, dtype=k, count=rows, offset=at))
        at += rows * np.dtype(k).itemsize
    return out


def pair_keys(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    """64-bit key of a pair; see the module for its layout."""
    high = ta.mix(context + ta.mix((token & U64(15)) + U64(1)))
    return (high & _HIGH) | (ta.mix(context * U64(3) + ta.mix(token)) & ~_HIGH)


def bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    """Bucket by the key's high bits: ascending with the key."""
    return ((keys >> U64(32)) * U64(n) >> U64(32)).astype(np.int64)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, context hash, token hash) of every token, in order."""
    n = len(offsets) - 1
    lower = ta.LOWER[data]
    start, end, owner = ta.words(lower, offsets)
    hashes = ta.word_hashes(lower, start, end)
    first = np.searchsorted(owner, np.arange(n))
    at = np.append(first[1:], len(owner)) if n else first
    token = np.insert(hashes, at, END)
    owner = np.insert(owner, at, np.arange(n))
    context = np.empty_like(token)
    context[1:] = token[:-1]
    if n:
        context[first + np.arange(n)] = START
    return owner, context, token


def _count_pairs(n_buckets: int, flush_tokens: int):
    def flush(contexts, toks):
        context, token = np.concatenate(contexts), np.concatenate(toks)
        contexts.clear()
        toks.clear()
        key = pair_keys(context, token)
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        count = np.diff(np.append(first, len(key))).astype(np.uint32)
        key, at = key[first], order[first]
        context, token = context[at], token[at]
        ends = np.searchsorted(bucket_of(key, n_buckets), np.arange(n_buckets + 1))
        full = [b for b in range(n_buckets) if ends[b] < ends[b + 1]]
        for i in range(0, len(full), 8):
            part = full[i:i + 8]
            yield pa.RecordBatch.from_arrays([
                pa.array(part, pa.int32()),
                pa.array([pack_arrays(context[s:e], token[s:e], count[s:e])
                          for s, e in ((ends[b], ends[b + 1]) for b in part)], pa.binary())],
                names=["bucket", "pairs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_heap()
        contexts, toks, n = [], [], 0
        for _, data, offsets in ta.text_slices(batches, "__text"):
            _, context, token = tokens(data, offsets)
            contexts.append(context)
            toks.append(token)
            n += len(token)
            if n >= flush_tokens:
                yield from flush(contexts, toks)
                n = 0
        if n:
            yield from flush(contexts, toks)

    return run


def _sum_by(key: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Distinct keys, ascending, with the sums of each value array."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    return [key[first], *(np.add.reduceat(v[order], first) if len(first) else v[:0] for v in values)]


_STATS = "array<bigint>"


def _merge_pairs(folder: str, n_words: int):
    """Sum a bucket's pairs, store them sorted, and send on the sums per word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_heap()
        parts, held, bucket = [], 0, None
        for batch in batches:
            for b, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                bucket = b
                parts.append(unpack_arrays(blob, np.uint64, np.uint64, np.uint32))
                held += len(parts[-1][0])
                if held > 4 * FLUSH_TOKENS:  # sum early: memory follows the distinct pairs
                    parts = [merge(parts)]
                    held = len(parts[0][0])
        if bucket is None:
            return
        context, token, count = merge(parts)
        key = pair_keys(context, token)
        save_array(folder, f"pair-{bucket:06d}.key.npy", key)
        save_array(folder, f"pair-{bucket:06d}.count.npy", count)
        stats = [int(np.count_nonzero(count == k)) for k in (1, 2, 3, 4)]
        c = [(count == 1).astype(np.int64), (count == 2).astype(np.int64), (count >= 3).astype(np.int64)]
        left = _sum_by(context, *c)
        right = _sum_by(token, np.ones(len(token), np.int64), count.astype(np.int64))
        cut_l = np.searchsorted(bucket_of(left[0], n_words), np.arange(n_words + 1))
        cut_r = np.searchsorted(bucket_of(right[0], n_words), np.arange(n_words + 1))
        for w in range(n_words):
            s, e = slice(cut_l[w], cut_l[w + 1]), slice(cut_r[w], cut_r[w + 1])
            yield pa.RecordBatch.from_arrays([
                pa.array([w], pa.int32()), pa.array([pack_arrays(*(a[s] for a in left))], pa.binary()),
                pa.array([pack_arrays(*(a[e] for a in right))], pa.binary()),
                pa.array([stats if w == 0 else [0] * 4], pa.list_(pa.int64()))],
                names=["bucket", "contexts", "tokens", "stats"])

    def merge(parts):
        context, token, count = (np.concatenate([p[i] for p in parts]) for i in range(3))
        key = pair_keys(context, token)
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        total = np.add.reduceat(count[order].astype(np.uint64), first)
        at = order[first]
        # counts are 32-bit up to 2**32 - 1 and the whole array 64-bit beyond
        return context[at], token[at], total.astype(np.uint32) if total.max() < 1 << 32 else total

    return run


def _merge_words(folder: str):
    """Store a word bucket: hash, token count, followers by count 1, 2, 3+, distinct contexts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_heap()
        left, right, pair_stats, bucket = [], [], np.zeros(4, np.int64), None
        for batch in batches:
            for b, c, t, s in zip(*(x.to_pylist() for x in batch.columns)):
                bucket = b
                left.append(unpack_arrays(c, np.uint64, *[np.int64] * 3))
                right.append(unpack_arrays(t, np.uint64, *[np.int64] * 2))
                pair_stats += np.asarray(s, dtype=np.int64)
                if len(left) >= 64:
                    left, right = ([_sum_by(*(np.concatenate([p[i] for p in x]) for i in range(len(x[0]))))]
                                   for x in (left, right))
        if bucket is None:
            return
        lk, n1, n2, n3 = _sum_by(*(np.concatenate([p[i] for p in left]) for i in range(4)))
        rk, contexts, count = _sum_by(*(np.concatenate([p[i] for p in right]) for i in range(3)))
        word = np.union1d(lk, rk)
        table = np.zeros((5, len(word)), dtype=np.int64)
        table[0, np.searchsorted(word, rk)] = count
        table[4, np.searchsorted(word, rk)] = contexts
        for i, v in enumerate((n1, n2, n3)):
            table[1 + i, np.searchsorted(word, lk)] = v
        save_array(folder, f"word-{bucket:06d}.key.npy", word)
        save_array(folder, f"word-{bucket:06d}.table.npy", table)
        stats = [int(count.sum()), len(rk), int(contexts.sum()),
                 *(int(np.count_nonzero(contexts == k)) for k in (1, 2, 3, 4)),
                 int(np.count_nonzero(contexts >= 3)), *map(int, pair_stats)]
        yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([stats], pa.list_(pa.int64()))],
                                         names=["bucket", "stats"])

    return run


def discounts(t1: float, t2: float, t3: float, t4: float) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from counts of counts, within [0, count]."""
    if t1 <= 0 or t2 <= 0:
        return 0.5, 1.0, 1.5
    y = t1 / (t1 + 2.0 * t2)
    d1 = 1 - 2 * y * t2 / t1
    d2 = 2 - 3 * y * t3 / t2
    d3 = 3 - 4 * y * t4 / t3 if t3 > 0 else 1.5
    return min(max(d1, 0.05), 1.0), min(max(d2, 0.05), 2.0), min(max(d3, 0.05), 3.0)


@dataclass
class KneserNey:
    """Where the model's arrays are, and its corpus-wide numbers."""

    folder: str
    n_pair_buckets: int
    n_word_buckets: int
    pair_files: list[int]
    word_files: list[int]
    n_tokens: int
    n_types: int
    n_pairs: int
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    word_rest: float

    def drop(self, spark: SparkSession) -> None:
        """Delete the model's folder."""
        jvm = spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Lookup:
    """Memory-mapped model inside a worker."""

    def __init__(self, model: KneserNey):
        self.m = model
        self.pairs = {b: (map_array(model.folder, f"pair-{b:06d}.key.npy"),
                          map_array(model.folder, f"pair-{b:06d}.count.npy")) for b in model.pair_files}
        self.words = {b: (map_array(model.folder, f"word-{b:06d}.key.npy"),
                          map_array(model.folder, f"word-{b:06d}.table.npy")) for b in model.word_files}

    @staticmethod
    def _find(files, n_buckets, keys, width):
        out = np.zeros((width, len(keys)), dtype=np.int64)
        ends = np.searchsorted(bucket_of(keys, n_buckets), np.arange(n_buckets + 1))
        for b, (known, values) in files.items():
            s, e = ends[b], ends[b + 1]
            if s == e or not len(known):
                continue
            at = np.minimum(np.searchsorted(known, keys[s:e]), len(known) - 1)
            hit = known[at] == keys[s:e]
            got = values[at] if width == 1 else values[:, at]
            out[:, s:e] = np.where(hit, got, 0)
        return out

    def word_rows(self, keys: np.ndarray) -> np.ndarray:
        """[count, n1, n2, n3+, contexts] of ascending word hashes; zeros if unknown."""
        return self._find(self.words, self.m.n_word_buckets, keys, 5)

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        return self._find(self.pairs, self.m.n_pair_buckets, keys, 1)[0]

    def log10(self, context: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count of the token, log10 P(token | context)) per position."""
        m = self.m
        word, at = np.unique(np.concatenate([token, context]), return_inverse=True)
        rows = self.word_rows(word)
        t, c = at[:len(token)], at[len(token):]
        pair, back = np.unique(pair_keys(context, token), return_inverse=True)
        joint = self.pair_counts(pair)[back].astype(float)
        n_texts = self.word_rows(np.array([END]))[0, 0]
        total = np.where(context == START, n_texts, rows[0, c]).astype(float)
        d1, d2, d3 = m.pair_discounts
        b1, b2, b3 = m.word_discounts
        cont = rows[4].astype(float)
        held = np.maximum(cont - np.select([cont == 1, cont == 2, cont >= 3], [b1, b2, b3], 0.0), 0.0)
        low = held / max(m.n_pairs, 1) + m.word_rest / (m.n_types + 1)
        gamma = (d1 * rows[1] + d2 * rows[2] + d3 * rows[3])[c]
        joint = np.maximum(joint - np.select([joint == 1, joint == 2, joint >= 3], [d1, d2, d3], 0.0), 0.0)
        known = total > 0
        safe = np.where(known, total, 1.0)
        p = np.where(known, joint / safe + gamma / safe * low[t], low[t])
        return rows[0, t], np.log10(p)


def train(docs: DataFrame, text: str = "text", flush_tokens: int = FLUSH_TOKENS,
          n_buckets: int | None = None) -> KneserNey:
    """Count the model over all rows of ``docs``; arrays go to the shared folder."""
    spark = docs.sparkSession
    prepare(spark)
    n = n_buckets or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    n_words = max(1, round(2 * n ** 0.5))
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/occuflow-lm-{uuid.uuid4().hex}"
    pairs = (docs.select(F.col(f"`{text}`").cast("string").alias("__text"))
             .mapInArrow(_count_pairs(n, flush_tokens), "bucket int, pairs binary"))
    sums = (pairs.repartitionById(n, "bucket")
            .mapInArrow(_merge_pairs(folder, n_words), f"bucket int, contexts binary, tokens binary, stats {_STATS}"))
    # one row a word bucket reaches the driver
    rows = (sums.repartitionById(n_words, "bucket")
            .mapInArrow(_merge_words(folder), f"bucket int, stats {_STATS}").collect())
    s = np.sum([r["stats"] for r in rows], axis=0) if rows else np.zeros(12, np.int64)
    n_tokens, n_types, n_pairs, w1, w2, w3, w4, w3p, p1, p2, p3, p4 = (int(x) for x in s)
    wd = discounts(w1, w2, w3, w4)
    rest = (wd[0] * w1 + wd[1] * w2 + wd[2] * w3p) / n_pairs if n_pairs else 1.0
    return KneserNey(folder, n, n_words, [], sorted(r["bucket"] for r in rows), n_tokens, n_types, n_pairs,
                     discounts(p1, p2, p3, p4), wd, rest)


def _pair_files(model: KneserNey) -> list[int]:
    """Buckets that hold pairs, listed where the files are."""
    fs, path = shared_folder(model.folder)
    if fs is None:
        names = os.listdir(path) if os.path.isdir(path) else []
    else:
        from pyarrow.fs import FileSelector

        names = [f.base_name for f in fs.get_file_info(FileSelector(path, allow_not_found=True))]
    return sorted(int(x[5:11]) for x in names if x.startswith("pair-") and x.endswith(".key.npy"))


def score(docs: DataFrame, model: KneserNey, text: str = "text") -> DataFrame:
    """``docs`` without the text, plus token counts, ``base_score`` and ``score`` (log10)."""
    spark = docs.sparkSession
    prepare(spark)
    carry = [c for c in docs.columns if c != text and c.lower() not in RESULTS]
    source = docs.select(*[F.col(f"`{c}`") for c in carry], F.col(f"`{text}`").cast("string").alias("__text"))
    schema = source.select(
        *[F.col(f"`{c}`") for c in carry], *[F.lit(0).cast("long").alias(c) for c in RESULTS[:3]],
        *[F.lit(0.0).alias(c) for c in RESULTS[3:]]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_heap()
        model.pair_files = _pair_files(model)
        lookup = Lookup(model)
        floor = model.n_tokens + 0.5 * (model.n_types + 1)
        for rows, data, offsets in ta.text_slices(batches, "__text"):
            n = len(offsets) - 1
            owner, context, token = tokens(data, offsets)
            count, logp = lookup.log10(context, token)
            base = np.log10((count + 0.5) / floor)
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(i) for i in range(len(carry))),
                 pa.array(np.bincount(owner, minlength=n).astype(np.int64)),
                 pa.array(np.bincount(owner[count > 0], minlength=n).astype(np.int64)),
                 pa.array(np.full(n, model.n_tokens, dtype=np.int64)),
                 pa.array(np.bincount(owner, weights=base, minlength=n)),
                 pa.array(np.bincount(owner, weights=logp, minlength=n))], names=[*carry, *RESULTS])

    return source.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Texts kept from training: crc32 of the id as text leaves 1 modulo 5."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 1, F.lit(False))


def op8_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = (spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
            .withColumn("held_out", held_out(F.col("doc_id"))))
    model = train(docs.filter(~F.col("held_out")))
    scored = cut_lineage(score(docs, model).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"))
    model.drop(spark)
    return scored
