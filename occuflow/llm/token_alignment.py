"""Alignment of two tokenizers' tokens with external spill counting.

Every text is encoded by a byte-pair vocabulary (A, over space + text) and a
sentence-piece model (B, which adds the space).  Offsets where both end a token
cut a text into groups; every A and B token whose bytes overlap are a link.

1. *Runs.*  A map task turns its links into records (pair, document, times),
   pair being ``B id << 16 | A id``, so records are in order of the B side
   first.  Full buffers are radix-partitioned by the low bits of the B id, sorted
   and spilled as zstd runs: lists of frames, no pair spread over two frames.
   The runs of all tasks are one written table.
2. *Counts.*  Runs are dealt by (radix, group), a group being a bounded number
   of spills, so the records of a frequent token are spread over as many tasks
   as there are groups.  Each task merges its runs through a heap of the last
   pairs in hand and counts each pair; the groups' counts of a pair are summed.
3. *Maxima.*  Side-major again: all counts of one B id lie together (at most one
   for each A id), which gives its highest.
4. *Contributions.*  Each (radix, group) gets the sums of its own pairs, streams
   its runs once more and sends one row per document and radix back.

Shuffles carry compressed runs, never a row per link.  A task holds the runs of
one (radix, group), bounded by ``GROUP_SPILLS`` spills of ``SPILL_RECORDS``
records, or one document.

Defined cases: a null or empty text, and one whose joined A or B bytes differ
from space + text (U+2581 in it, invalid UTF-8), has no tokens; special tokens'
strings are plain text; very long texts are encoded whole; repeated rows all
count; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from occuflow.llm import textarrays as ta
from occuflow.llm.packing import encode
from occuflow.llm.workers import lean_heap, prepare
from occuflow.session import cut_lineage, stage_scope

RANKS, MODEL, PIECES = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"
RADIX_BITS = 4
SPILL_RECORDS, SPILL_DOCS = 1_500_000, 60_000
FRAME_RECORDS = 16_384
GROUP_SPILLS = 64
A_BITS = 16  # of a pair's number; the B id is above

_cached: dict[tuple, object] = {}


class Pieces:
    """Bytes of every id of a vocabulary, and its decimal number, as padded rows of a table."""

    def __init__(self, pieces: list[bytes], separators: bytes):
        self.size = np.array([len(p) for p in pieces], dtype=np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.size)[:-1]])
        self.flat = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        # decimal id and one of two separators in eight bytes: row id * 2 + which
        text = [str(i).encode() + separators[k:k + 1] for i in range(len(pieces)) for k in range(2)]
        self.digits = np.frombuffer(b"".join(t.ljust(8, b"\0") for t in text), dtype=np.uint64)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        at = np.cumsum(size) - size
        return self.flat[np.repeat(self.begin[ids] - at, size) + np.arange(size.sum())]


def _piece_bytes(piece: str) -> bytes:
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


def vocabularies(ranks: str, pieces: str):
    """(A pieces, B pieces, B encoder), kept per process."""
    if (ranks, pieces) not in _cached:
        import public_tokenizers
        import sentencepiece

        with open(public_tokenizers.path(ranks), "rb") as f:
            known = {int(b): base64.b64decode(a) for a, b in map(bytes.split, f)}
        if max(known) >> A_BITS:
            raise ValueError(f"{ranks} has ids of more than {A_BITS} bits")
        a = Pieces([known.get(i, b"") for i in range(max(known) + 1)], b",|")
        model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces))
        b = Pieces([_piece_bytes(model.id_to_piece(i)) for i in range(model.get_piece_size())], b",;")
        _cached[ranks, pieces] = a, b, model
    return _cached[ranks, pieces]


def _sizes(ids: list[np.ndarray]) -> np.ndarray:
    return np.array([len(x) for x in ids], dtype=np.int64)


class Aligned:
    """Tokens, groups and links of the texts of a slice."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, ranks: str, model: str, pieces: str):
        va, vb, encoder = vocabularies(ranks, pieces)
        n = len(offsets) - 1
        raw = data.tobytes()
        texts = [raw[s:e].decode("utf-8", "replace") for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        nothing = np.empty(0, dtype=np.int64)
        a = [encode(" " + t, ranks, model).astype(np.int64) if t else nothing for t in texts]
        b = [np.asarray(encoder.encode(t, num_threads=1), dtype=np.int64) if t else nothing for t in texts]
        want = np.diff(offsets) + (np.diff(offsets) > 0)
        ok = np.array([va.size[x].sum() == w and vb.size[y].sum() == w for x, y, w in zip(a, b, want.tolist())], dtype=bool)
        texts_bytes = [b"" if not (k and e > s) else b" " + raw[s:e]
                       for k, s, e in zip(ok, offsets[:-1].tolist(), offsets[1:].tolist())]
        spaced = np.frombuffer(b"".join(texts_bytes), dtype=np.uint8)
        ends = np.cumsum([len(t) for t in texts_bytes])
        for side, vocabulary in ((a, va), (b, vb)):
            got = vocabulary.joined(np.concatenate([x for x, k in zip(side, ok) if k] or [nothing]))
            ok[np.unique(np.searchsorted(ends, np.flatnonzero(got != spaced), side="right"))] = False
        a = [x if k else nothing for x, k in zip(a, ok)]
        b = [x if k else nothing for x, k in zip(b, ok)]
        self.n_a, self.n_b = _sizes(a), _sizes(b)
        self.a, self.b = np.concatenate(a or [nothing]), np.concatenate(b or [nothing])
        self.doc_a = np.repeat(np.arange(n), self.n_a)
        size_a, size_b = va.size[self.a], vb.size[self.b]
        end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
        same_a, same_b = np.isin(end_a, end_b, assume_unique=True), np.isin(end_b, end_a, assume_unique=True)
        self.last_a, self.last_b = same_a, same_b
        self.n_groups = np.bincount(self.doc_a[same_a], minlength=n)
        first = np.searchsorted(end_b, end_a - size_a, side="right")
        count = np.searchsorted(end_b - size_b, end_a, side="left") - first
        self.n_links = np.zeros(n, dtype=np.int64)
        np.add.at(self.n_links, self.doc_a, count)
        at = np.cumsum(count) - count
        link_b = np.repeat(first - at, count) + np.arange(count.sum())
        self.pair = (self.b[link_b] << A_BITS) | np.repeat(self.a, count)
        self.pair_doc = np.repeat(self.doc_a, count)
        self._va, self._vb = va, vb

    def digests(self) -> list[str]:
        """sha256 of ``a1,a2|b1;a3|b2,b3`` per text; '' without tokens."""
        group_a = np.cumsum(self.last_a) - self.last_a
        group_b = np.cumsum(self.last_b) - self.last_b
        groups = int(self.last_a.sum())
        upto_b = np.concatenate([[0], np.cumsum(np.bincount(group_b, minlength=groups))])
        upto_a = np.cumsum(np.bincount(group_a, minlength=groups))
        rows = np.empty(len(self.a) + len(self.b), dtype=np.uint64)
        rows[np.arange(len(self.a)) + upto_b[group_a]] = self._va.digits[self.a * 2 + self.last_a]
        rows[np.arange(len(self.b)) + upto_a[group_b]] = self._vb.digits[self.b * 2 + self.last_b]
        flat = rows.view(np.uint8)
        used = flat != 0
        text = memoryview(flat[used])
        items = np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])
        cut = np.concatenate([[0], np.cumsum(used.reshape(-1, 8).sum(axis=1))])[items].tolist()
        return [hashlib.sha256(text[s:e - 1]).hexdigest() if e > s else "" for s, e in zip(cut[:-1], cut[1:])]


def frames_of(pair: np.ndarray, doc: np.ndarray, times: np.ndarray) -> list[bytes]:
    """One sorted run as zstd frames; all records of a pair are in one frame."""
    import zstandard

    new = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
    cut, at = [0], 0
    while at + FRAME_RECORDS < len(pair):
        at = int(new[np.searchsorted(new, at + FRAME_RECORDS, side="right") - 1])
        if at == cut[-1]:
            k = int(np.searchsorted(new, at, side="right"))
            if k == len(new):
                break
            at = int(new[k])
        cut.append(at)
    cut.append(len(pair))
    zip_ = zstandard.ZstdCompressor(level=1).compress
    return [zip_(np.concatenate([np.diff(pair[s:e], prepend=0), doc[s:e], times[s:e]]).astype("<u4").tobytes())
            for s, e in zip(cut[:-1], cut[1:])]


def read_frame(frame: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, document, times) of a frame."""
    import zstandard

    values = np.frombuffer(zstandard.ZstdDecompressor().decompress(frame), dtype="<u4").reshape(3, -1).astype(np.int64)
    return np.cumsum(values[0]), values[1], values[2]


def merge_counts(runs: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(pairs, links) of several runs in order, a frame of each in memory."""
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    heap: list[tuple[int, int]] = []
    following = [iter(r) for r in runs]

    def load(i: int) -> None:
        frame = next(following[i], None)
        if frame is not None:
            pair, _, times = read_frame(frame)
            held[i] = pair, times
            heapq.heappush(heap, (int(pair[-1]), i))

    for i in range(len(runs)):
        load(i)
    while heap:
        upto = heap[0][0]
        pairs, times = [], []
        for i, (pair, n) in held.items():
            k = int(np.searchsorted(pair, upto, side="right"))
            if k:
                pairs.append(pair[:k])
                times.append(n[:k])
                held[i] = pair[k:], n[k:]
        pair, n = np.concatenate(pairs), np.concatenate(times)
        order = np.argsort(pair, kind="stable")
        pair = pair[order]
        first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        yield pair[first], np.add.reduceat(n[order], first)
        while heap and heap[0][0] == upto:
            i = heapq.heappop(heap)[1]
            del held[i]
            load(i)


_TOKENS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


class _Spill:
    """Records of a task, flushed as one run per radix."""

    def __init__(self, radix_bits: int):
        self.mask = (1 << radix_bits) - 1
        self.held, self.n, self.docs = [], 0, 0

    def add(self, pair: np.ndarray, doc: np.ndarray) -> bool:
        if len(pair):
            record, times = np.unique((pair << 32) | (doc + self.docs), return_counts=True)
            self.held.append((record, times))
            self.n += len(record)
        return self.n >= SPILL_RECORDS

    def runs(self) -> Iterator[tuple[int, list[bytes]]]:
        if self.held:
            record, times = (np.concatenate([h[i] for h in self.held]) for i in range(2))
            self.held = []
            radix = (record >> (32 + A_BITS)) & self.mask
            order = np.lexsort((record, radix))
            record, times, radix = record[order], times[order], radix[order]
            edge = np.searchsorted(radix, np.arange(self.mask + 2))
            for r in range(self.mask + 1):
                if edge[r + 1] > edge[r]:
                    part = slice(edge[r], edge[r + 1])
                    yield r, frames_of(record[part] >> 32, record[part] & 0xFFFFFFFF, times[part])
        self.n = self.docs = 0


def encode_links(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ranks: str = RANKS, model: str = MODEL,
                 pieces: str = PIECES, radix_bits: int = RADIX_BITS) -> DataFrame:
    """Facts per document and spilled runs, as one written table.

    A fact row has (spill, doc, the id, counts and groups_sha256), a run row
    (spill, radix, frames); ``doc`` numbers the documents of a spill.
    """
    prepare(docs.sparkSession)
    source = docs.select(F.col(f"`{doc_id}`").alias(doc_id), F.col(f"`{text}`").cast("string").alias("__text"))
    schema = (f"spill long, doc long, `{doc_id}` {source.dtypes[0][1]}, {_TOKENS}, radix int, frames array<binary>")
    names = ["spill", "doc", doc_id, "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "radix", "frames"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_heap()
        base, number, spill = TaskContext.get().partitionId() << 32, 0, _Spill(radix_bits)
        ids = None

        def flushed() -> Iterator[pa.RecordBatch]:
            for radix, frames in spill.runs():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([base + number], pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, ids)]
                    + [pa.nulls(1, pa.int64())] * 4
                    + [pa.nulls(1, pa.string()), pa.array([radix], pa.int32()), pa.array([frames], pa.list_(pa.binary()))],
                    names=names)

        for rows, data, offsets in ta.text_slices(batches, "__text"):
            n, ids = rows.num_rows, rows.column(0).type
            if spill.docs + n > SPILL_DOCS:
                yield from flushed()
                number += 1
            t = Aligned(data, offsets, ranks, model, pieces)
            full = spill.add(t.pair, t.pair_doc)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, base + number), pa.int64()), pa.array(np.arange(n) + spill.docs, pa.int64()),
                 rows.column(0)]
                + [pa.array(x, pa.int64()) for x in (t.n_a, t.n_b, t.n_groups, t.n_links)]
                + [pa.array(t.digests(), pa.string()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.binary()))],
                names=names)
            spill.docs += n
            if full:
                yield from flushed()
                number += 1
        yield from flushed()

    return cut_lineage(source.mapInArrow(run, schema))


def _runs(encoded: DataFrame) -> DataFrame:
    """The run rows with their group: about ``GROUP_SPILLS`` spills each."""
    runs = encoded.filter("radix IS NOT NULL").select("spill", "radix", "frames")
    spills = runs.select("spill").distinct().count()
    return runs.withColumn("grp", F.pmod(F.xxhash64("spill"), F.lit(max(1, -(-spills // GROUP_SPILLS)))))


def _by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], pa.RecordBatch]]:
    """Pieces of sorted batches whose rows have one (radix, grp)."""
    for batch in batches:
        radix, group = (batch.column(i).to_numpy() for i in range(2))
        edge = np.flatnonzero((radix[1:] != radix[:-1]) | (group[1:] != group[:-1])) + 1
        for s, e in zip([0, *edge.tolist()], [*edge.tolist(), len(radix)]):
            if e > s:
                yield (int(radix[s]), int(group[s])), batch.slice(s, e - s)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links per pair of each (radix, grp); rows are (radix, grp, frames) in order."""
    lean_heap()
    at, runs = None, []

    def counted() -> Iterator[pa.RecordBatch]:
        for pair, links in merge_counts(runs) if runs else ():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(pair), at[0]), pa.int32()), pa.array(np.full(len(pair), at[1]), pa.int64()),
                 pa.array(pair), pa.array(links)], names=["radix", "grp", "pair", "links"])

    for key, rows in _by_group(batches):
        if key != at:
            yield from counted()
            at, runs = key, []
        runs += rows.column(2).to_pylist()
    yield from counted()


def _contribute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(spill, doc, n_best, count_sum) of runs; rows are (radix, grp, spill, frames, pair, links, best), answers first."""
    lean_heap()
    at, held, answers = None, [], None
    for key, rows in _by_group(batches):
        if key != at:
            at, held, answers = key, [], None
        pair = rows.column(4)
        told = rows.num_rows - pair.null_count
        if told:
            held.append([rows.column(i).slice(0, told).to_numpy(zero_copy_only=False) for i in (4, 5, 6)])
        for i in range(told, rows.num_rows):
            if answers is None:
                answers = [np.concatenate([h[k] for h in held]) for k in range(3)]
                held = []
            found = [read_frame(f) for f in rows.column(3)[i].as_py()]
            pairs, doc, times = (np.concatenate([f[k] for f in found]) for k in range(3))
            where = np.searchsorted(answers[0], pairs)
            order = np.argsort(doc, kind="stable")
            doc, where, times = doc[order], where[order], times[order]
            first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(first), rows.column(2)[i].as_py()), pa.int64()), pa.array(doc[first]),
                 pa.array(np.add.reduceat(times * answers[2][where], first)),
                 pa.array(np.add.reduceat(times * answers[1][where], first))],
                names=["spill", "doc", "n_best", "count_sum"])


def partial_counts(runs: DataFrame) -> DataFrame:
    """(radix, grp, pair, links): what each task of a (radix, group) counted, as a written table."""
    dealt = runs.repartition("radix", "grp").sortWithinPartitions("radix", "grp").select("radix", "grp", "frames")
    return cut_lineage(dealt.mapInArrow(_count, "radix int, grp long, pair long, links long"))


def pair_counts(partial: DataFrame) -> DataFrame:
    """(pair, links, best) over the whole corpus; ``best`` marks the highest of the pair's B id."""
    b = F.shiftright("pair", A_BITS)
    total = partial.groupBy("pair").agg(F.sum("links").alias("links"))
    return total.select("pair", "links", (F.col("links") == F.max("links").over(W.partitionBy(b))).alias("best"))


def token_map(encoded: DataFrame) -> DataFrame:
    """(b, a, links): for each B id the A ids it shares most links with."""
    return pair_counts(partial_counts(_runs(encoded))).filter("best").select(
        F.shiftright("pair", A_BITS).alias("b"),
        F.col("pair").bitwiseAND(F.lit((1 << A_BITS) - 1)).alias("a"), "links")


def align_tokens(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **vocabulary) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per row of ``docs``."""
    encoded = encode_links(docs, doc_id, text, **vocabulary)
    runs = _runs(encoded)
    partial = partial_counts(runs)
    answers = (partial.select("radix", "grp", "pair").join(pair_counts(partial), "pair")
               .select("radix", "grp", F.lit(None).cast("long").alias("spill"),
                       F.lit(None).cast("array<binary>").alias("frames"), "pair", "links", F.col("best").cast("long").alias("best")))
    none = F.lit(None).cast("long")
    told = answers.union(runs.select("radix", "grp", "spill", "frames", none, none, none))
    sums = (told.repartition("radix", "grp")
            .sortWithinPartitions("radix", "grp", F.asc_nulls_last("pair"))
            .mapInArrow(_contribute, "spill long, doc long, n_best long, count_sum long")
            .groupBy("spill", "doc").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
    facts = encoded.filter("radix IS NULL").drop("radix", "frames")
    zero = F.lit(0).cast("long")
    return facts.join(sums, ["spill", "doc"], "left").select(
        F.col(f"`{doc_id}`"), "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    with stage_scope(spark):
        return cut_lineage(align_tokens(docs), outlive=True)
