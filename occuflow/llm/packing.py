"""Packing documents into fixed windows by non-negative least squares.

1. Every text is encoded (byte-pair ids, then one end id) and cut at multiples
   of the window, so a document gives whole windows and one rest.
2. The histogram of piece lengths (at most ``window`` rows) goes to the driver.
3. All pairs and triples of present lengths that fill the window exactly are
   enumerated; non-negative least squares (multiplicative updates) finds how
   often to repeat each so that the histogram is used up.
4. The solution is rounded and clipped to the histogram; what is left is
   packed greedily, largest first, each gap filled with the largest length
   that fits.  Both steps work on the histogram: the plan's size depends on
   the window, not on the number of documents.
5. Each piece gets its rank among the pieces of its length (two-level prefix
   sums) and looks up its sequence and offset in the plan.

Defined cases: a null or empty text is the end id alone; repeated rows are
packed as documents of their own; an empty table gives no pieces; extra
columns are ignored, the id column's name is a parameter.

``tiktoken`` reads the rank file of the same vocabulary as the ``tokenizers``
file and gives the same ids several times faster; texts with a very long run
without space go to ``tokenizers``, whose time does not grow with the square
of the run.  The literal of an added token (``<|endoftext|>``) in a text is
that token, as ``tokenizers`` reads it by default; ``added=False`` reads it as
ordinary text.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from occuflow.llm.secret_scan import load_encoder
from occuflow.llm.workers import lean_heap, prepare
from occuflow.session import cut_lineage

WINDOW, END_ID = 2048, 1
LONG_RUN = 4096
# Pieces of one length are ranked inside hash shards of about this many pieces.
SHARD_PIECES = 10_000
NNLS_ROUNDS = 120

_slow: dict[tuple[str, bool], object] = {}
_added: dict[str, tuple[tuple[tuple[str, int], ...], list[str]]] = {}


def _slow_encoder(path: str, added: bool):
    if (path, added) not in _slow:
        import public_tokenizers
        from tokenizers import Tokenizer

        _slow[path, added] = Tokenizer.from_file(public_tokenizers.path(path))
        if not added:
            _slow[path, added].encode_special_tokens = True
    return _slow[path, added]


def _added_tokens(model: str) -> tuple[tuple[tuple[str, int], ...], list[str]]:
    """(literal, id) of the model's added tokens, and the literals ``tiktoken`` cannot read as ``tokenizers`` does."""
    if model not in _added:
        import public_tokenizers

        with open(public_tokenizers.path(model), encoding="utf-8") as f:
            tokens = json.load(f).get("added_tokens") or []
        plain = lambda t: not any(t.get(k) for k in ("single_word", "lstrip", "rstrip", "normalized"))
        _added[model] = (tuple((t["content"], t["id"]) for t in tokens if plain(t)),
                         [t["content"] for t in tokens if not plain(t)])
    return _added[model]


def encode(text: str, ranks: str, model: str, added: bool = False) -> np.ndarray:
    """Ids of a text, no special ones put around it; with ``added``, literals of added tokens are these tokens."""
    known, other = _added_tokens(model) if added else ((), [])
    if (len(text) > LONG_RUN and max(map(len, text.split()), default=0) > LONG_RUN) or any(t in text for t in other):
        return np.asarray(_slow_encoder(model, added).encode(text, add_special_tokens=False).ids, dtype=np.uint32)
    return load_encoder(ranks, known).encode_to_numpy(
        text, allowed_special="all" if added else set(), disallowed_special=())


def token_pieces(docs: DataFrame, window: int = WINDOW, end_id: int = END_ID, doc_id: str = "doc_id",
                 text: str = "text", ranks: str = "byte_bpe_50k.tiktoken",
                 model: str = "byte_bpe_50k.json") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens) per piece of at most ``window`` ids."""
    prepare(docs.sparkSession)
    source = docs.select(F.col(f"`{doc_id}`").alias(doc_id), F.col(f"`{text}`").cast("string").alias("__text"))
    names = [doc_id, "start", "length", "ids_crc32", "doc_tokens"]
    schema = source.select(F.col(f"`{doc_id}`"), *[F.lit(0).cast("long").alias(c) for c in names[1:]]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_heap()
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                row, start, length, crc, tokens = [], [], [], [], []
                for i, value in enumerate(part.column(1).to_pylist()):
                    ids = np.concatenate([encode(value or "", ranks, model, added=True).astype("<u4"), end])
                    for s in range(0, len(ids), window):
                        piece = ids[s:s + window]
                        row.append(i)
                        start.append(s)
                        length.append(len(piece))
                        crc.append(zlib.crc32(piece.tobytes()))
                        tokens.append(len(ids))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row, pa.int64()))]
                    + [pa.array(x, pa.int64()) for x in (start, length, crc, tokens)], names=names)

    return source.mapInArrow(run, schema)


def fills(lengths: np.ndarray, window: int) -> np.ndarray:
    """All pairs and triples of ``lengths`` (ascending) that sum to ``window``; pairs padded with 0."""
    present = np.zeros(window + 1, dtype=bool)
    present[lengths] = True
    out = []
    pair = lengths[(lengths * 2 <= window) & present[window - lengths]]
    out.append(np.stack([pair, window - pair, np.zeros_like(pair)], axis=1))
    for a in lengths[lengths * 3 <= window]:
        b = lengths[(lengths >= a) & (lengths * 2 <= window - a)]
        b = b[present[window - a - b]]
        out.append(np.stack([np.full_like(b, a), b, window - a - b], axis=1))
    return np.concatenate(out) if out else np.zeros((0, 3), dtype=np.int64)


def nnls_counts(combos: np.ndarray, histogram: np.ndarray, rounds: int = NNLS_ROUNDS) -> np.ndarray:
    """x >= 0 that minimises ``|A x - h|``, A the lengths used by each combination."""
    if not len(combos):
        return np.zeros(0)
    h = histogram.astype(float).copy()
    h[0] = 0.0
    size = len(h)

    def gather(v):
        return v[combos[:, 0]] + v[combos[:, 1]] + v[combos[:, 2]]

    def scatter(x):
        y = np.zeros(size)
        for j in range(3):
            y += np.bincount(combos[:, j], weights=x, minlength=size)
        y[0] = 0.0
        return y

    goal = gather(h)
    x = goal / np.maximum(gather((h > 0).astype(float) * len(combos) / max(1, np.count_nonzero(h))), 1e-9)
    for _ in range(rounds):
        x *= goal / np.maximum(gather(scatter(x)), 1e-12)
    return x


def plan_sequences(histogram: np.ndarray, window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in order) with their repeat counts; they use the histogram up exactly."""
    left = histogram.astype(np.int64).copy()
    plan: list[tuple[tuple[int, ...], int]] = []
    if left[window]:
        plan.append(((window,), int(left[window])))
        left[window] = 0
    lengths = np.flatnonzero(left)
    combos = fills(lengths, window)
    repeats = np.rint(nnls_counts(combos, left)).astype(np.int64)
    for i in np.argsort(-repeats, kind="stable"):
        n = int(repeats[i])
        if n <= 0:
            break
        combo = [int(v) for v in combos[i] if v]
        n = min(n, *(int(left[v]) // combo.count(v) for v in set(combo)))
        if n > 0:
            for v in combo:
                left[v] -= n
            plan.append((tuple(sorted(combo, reverse=True)), n))
    present = list(np.flatnonzero(left))
    while present:
        pattern, gap, used = [], window, {}
        choice = present
        while True:
            at = int(np.searchsorted(choice, gap, side="right")) - 1
            while at >= 0 and used.get(choice[at], 0) >= left[choice[at]]:
                at -= 1
            if at < 0:
                break
            v = int(choice[at])
            pattern.append(v)
            used[v] = used.get(v, 0) + 1
            gap -= v
        n = min(int(left[v]) // m for v, m in used.items())
        for v in pattern:
            left[v] -= n
        plan.append((tuple(pattern), n))
        present = [v for v in present if left[v]]
    return plan


def lookup_table(plan: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """Slots of the plan sorted by (length, first rank): key, first sequence, offset."""
    used: dict[int, int] = {}
    key, sequence, offset, first = [], [], [], 0
    for pattern, n in plan:
        at = 0
        for v in pattern:
            key.append((v << 48) + used.get(v, 0))
            sequence.append(first)
            offset.append(at)
            used[v] = used.get(v, 0) + n
            at += v
        first += n
    order = np.argsort(np.asarray(key, dtype=np.int64), kind="stable")
    return {"key": np.asarray(key, dtype=np.int64)[order],
            "sequence": np.asarray(sequence, dtype=np.int64)[order],
            "offset": np.asarray(offset, dtype=np.int64)[order]}


def pack(docs: DataFrame, window: int = WINDOW, end_id: int = END_ID, doc_id: str = "doc_id",
         text: str = "text", ranks: str = "byte_bpe_50k.tiktoken", model: str = "byte_bpe_50k.json") -> DataFrame:
    """Pieces of all documents with their ``sequence_id`` and ``offset`` (see module)."""
    spark = docs.sparkSession
    pieces = cut_lineage(token_pieces(docs, window, end_id, doc_id, text, ranks, model))
    histogram = np.zeros(window + 1, dtype=np.int64)
    for r in pieces.groupBy("length").count().collect():  # at most `window` rows
        histogram[r["length"]] = r["count"]
    table = spark.sparkContext.broadcast(lookup_table(plan_sequences(histogram, window)))

    n_shards = max(1, -(-int(histogram.sum()) // SHARD_PIECES))
    dealt = pieces.withColumn("__shard", F.pmod(F.xxhash64(f"`{doc_id}`", "start"), F.lit(n_shards)))
    before = (dealt.groupBy("length", "__shard").agg(F.count("*").alias("__n"))
              .withColumn("__before", F.sum("__n").over(
                  W.partitionBy("length").orderBy("__shard").rowsBetween(W.unboundedPreceding, -1)))
              .select("length", "__shard", F.coalesce("__before", F.lit(0)).cast("long").alias("__before")))
    inside = W.partitionBy("length", "__shard").orderBy(f"`{doc_id}`", "start", "ids_crc32")
    names = [doc_id, "start", "length", "ids_crc32", "doc_tokens"]
    ranked = (dealt.withColumn("__row", F.row_number().over(inside) - 1).join(before, ["length", "__shard"])
              .select(*[F.col(f"`{c}`") for c in names], (F.col("__before") + F.col("__row")).alias("__rank")))
    out_names = [*names, "sequence_id", "offset"]
    schema = ranked.select(*[F.col(f"`{c}`") for c in names], F.lit(0).cast("long").alias("sequence_id"),
                           F.lit(0).cast("long").alias("offset")).schema

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_heap()
        t = table.value
        for batch in batches:
            if not batch.num_rows:
                continue
            key = (batch.column(2).to_numpy() << 48) + batch.column(5).to_numpy()
            slot = np.searchsorted(t["key"], key, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(5)),
                 pa.array(t["sequence"][slot] + key - t["key"][slot]), pa.array(t["offset"][slot])],
                names=out_names)

    return ranked.mapInArrow(place, schema)


def op7_pack_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
