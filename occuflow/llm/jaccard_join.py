"""N-gram Jaccard join by chosen paths (set similarity >= 0.8 on word 5-grams).

1. Texts become sets of hashed ``n``-word shingles; texts with equal sets form
   one *class* (exact copies never meet each other again).
2. *Chosen paths.*  In each run a class picks about ``branch`` of its shingles
   by a shared hash; a pick is the first step of a path.  Two sets of similarity
   s pick at least ``branch * s`` common shingles on average, so all runs miss a
   pair with probability at most ``exp(-runs * branch * s)``; runs are repeated
   until the target recall (8 runs for 0.99999).  Classes that share a path form
   a bucket.
3. Buckets of at most ``small`` classes are searched by brute force on 64-byte
   one-permutation sketches, with a bound that a true pair fails with
   probability below 1e-5.  Larger buckets are split again on further sampled
   shingles (``kids`` a level, ``depth`` levels); what is still large then is
   dealt as pairs of blocks to many tasks, so that the same search meets all
   pairs there too.
4. Buckets give only a spanning forest of their likely pairs.  Its components
   hold every true pair; in each, all pairs are verified exactly on the whole
   shingle sets.  Large components are cut into pairs of blocks, so no task
   holds more than two blocks.  Results are sums and a forest: pairs are
   counted, never emitted.

The result has a row per document: ``class_id`` (least doc_id of its group of
linked documents) and ``n_links`` (other documents of similarity >= 0.8).

Defined cases: a text of one to four words has one shingle, its whole word
sequence; a text without words is linked to nothing; null texts count as
empty; repeated rows are copies of each other; null ids group as the least
id only when the whole group has none; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occuflow.llm import textarrays as ta
from occuflow.llm.workers import lean_heap, prepare
from occuflow.session import cut_lineage, stage_scope

U64 = np.uint64
SHINGLE, THRESHOLD = 5, 0.8
RECALL, BRANCH, KIDS, DEPTH = 0.99999, 2.0, 4, 2
SMALL, BLOCK = 4096, 800
BINS = 64


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(text index, shingle hash), distinct and ascending within each text."""
    start, end, owner = ta.words(data, offsets)
    h = ta.word_hashes(data, start, end)
    n_texts = len(offsets) - 1
    counts = np.bincount(owner, minlength=n_texts)
    value = np.zeros(max(len(h) - n + 1, 0), dtype=np.uint64)
    for j in range(n):
        value = ta.mix(value * U64(3) + h[j:j + len(value)])
    whole = owner[:len(value)] == owner[n - 1:] if len(value) else np.empty(0, bool)
    own, val = owner[:len(value)][whole], value[whole]
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        first = np.searchsorted(owner, short)
        few = np.zeros(len(short), dtype=np.uint64)
        for j in range(n - 1):
            there = counts[short] > j
            few[there] = ta.mix(few[there] * U64(3) + h[first[there] + j] + U64(1))
        own, val = np.concatenate([own, short]), np.concatenate([val, few])
    order = np.lexsort((val, own))
    own, val = own[order], val[order]
    keep = np.ones(len(own), dtype=bool)
    keep[1:] = (own[1:] != own[:-1]) | (val[1:] != val[:-1])
    return own[keep], val[keep]


def class_ids(own: np.ndarray, val: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """(class id, set size) per text; texts without shingles have size 0."""
    size = np.bincount(own, minlength=n_texts)
    total = np.zeros(len(val) + 1, dtype=np.uint64)
    np.cumsum(ta.mix(val), out=total[1:])
    ends = np.concatenate([[0], np.cumsum(size)])
    return ta.mix(total[ends[1:]] - total[ends[:-1]] + size.astype(np.uint64)).view(np.int64), size


def sketches(own: np.ndarray, val: np.ndarray, n_texts: int) -> np.ndarray:
    """One-permutation sketch: per bin of the shingle's high bits, a byte of the least one; 0 if empty."""
    out = np.zeros((n_texts, BINS), dtype=np.uint8)
    b = (val >> U64(58)).astype(np.int64)
    first = np.ones(len(own), dtype=bool)
    first[1:] = (own[1:] != own[:-1]) | (b[1:] != b[:-1])
    out[own[first], b[first]] = (ta.mix(val[first]) % U64(250)).astype(np.uint8) + 1
    return out


def _picks(own, val, size, salt: int, rate: float) -> np.ndarray:
    """Entries whose salted hash lies under ``rate / size``: shared by all texts alike."""
    cut = np.minimum(rate / np.maximum(size, 1), 1.0) * float(1 << 53)
    return np.flatnonzero((ta.mix(val ^ U64(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> U64(11)).astype(float) < cut[own])


def _paths(runs: int, branch: float, kids: int, depth: int, n: int):
    """Rows (path, cls, size, sketch, kids): one per picked shingle of each class, once a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_heap()
        seen: set[int] = set()
        for _, data, offsets in ta.text_slices(batches, "__text"):
            n_texts = len(offsets) - 1
            own, val = shingle_sets(data, offsets, n)
            cls, size = class_ids(own, val, n_texts)
            fresh = np.zeros(n_texts, dtype=bool)
            for i, c in enumerate(cls.tolist()):
                if size[i] and c not in seen:
                    seen.add(c)
                    fresh[i] = True
            sketch = sketches(own, val, n_texts)
            row, path, more = [], [], []
            for r in range(runs):
                at = _picks(own, val, size, 2 * r + 1, branch)
                at = at[fresh[own[at]]]
                levels = []
                for d in range(depth):
                    k = _picks(own, val, size, 1000 + 31 * r + d, kids)
                    ends = np.searchsorted(own[k], np.arange(n_texts + 1))
                    levels.append((ta.mix(val[k] + U64(d)), ends))
                row.append(own[at])
                path.append(ta.mix(val[at] + U64(r + 1)))
                more += [b"".join(len(part).to_bytes(2, "little") + part.tobytes()
                                  for v, e in levels for part in [v[e[o]:e[o + 1]]]) for o in own[at].tolist()]
            row, path = np.concatenate(row), np.concatenate(path)
            if len(row):
                yield pa.RecordBatch.from_arrays([
                    pa.array(path.view(np.int64)), pa.array(cls[row]), pa.array(size[row].astype(np.int32)),
                    pa.array([s.tobytes() for s in sketch[row]], pa.binary()), pa.array(more, pa.binary())],
                    names=["path", "cls", "size", "sketch", "kids"])

    return run


_PATH_SCHEMA = "path long, cls long, size int, sketch binary, kids binary"
_FOUND_SCHEMA = "a long, b long, " + _PATH_SCHEMA


def _alike(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Likely similar: the sketches agree in all but an improbable number of bins."""
    same = np.count_nonzero((x == y) & (x != 0), axis=-1)
    used = np.count_nonzero((x != 0) | (y != 0), axis=-1)
    return same >= THRESHOLD * used - 4.5 * np.sqrt(used * THRESHOLD * (1 - THRESHOLD)) - 1


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least index of each index's component under edges (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if np.array_equal(label, before):
            break
    return label


def bucket_forest(size: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """Root index of each member, over all likely pairs of a bucket."""
    order = np.argsort(size, kind="stable")
    size, sketch = size[order], sketch[order]
    # a similar set is at most 1 / THRESHOLD times as large
    until = np.searchsorted(size, np.floor(size / THRESHOLD + 1e-9), side="right")
    a, b, m = [], [], len(size)
    step = max(1, (1 << 18) // max(m, 1))
    for s in range(0, m, step):
        e = min(m, s + step)
        hi = int(until[e - 1])
        hit = _alike(sketch[s:e, None, :], sketch[None, s:hi, :])
        i, j = np.nonzero(hit)
        ok = (i < j) & (j + s < until[i + s])
        a.append(i[ok] + s)
        b.append(j[ok] + s)
    root = np.empty(m, dtype=np.int64)
    root[order] = order[_roots(m, np.concatenate(a), np.concatenate(b))]
    return root


def block_pairs(size: np.ndarray, block: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(i, j, members) of the pairs of blocks, by size, that hold all likely pairs of a bucket of two blocks or more."""
    order = np.argsort(size, kind="stable")
    parts = [order[s:s + block] for s in range(0, len(order), block)]
    for i, low in enumerate(parts):
        for j in range(i + 1, len(parts)):
            # neighbouring blocks meet anyway, each with itself as well
            if j > i + 1 and size[parts[j][0]] > np.floor(size[low[-1]] / THRESHOLD + 1e-9):
                break
            yield i, j, np.concatenate([low, parts[j]])


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups, many small ones together, from rows sorted by ``keys``."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < 4000:
            continue
        table = pa.Table.from_batches(held)
        change = np.zeros(table.num_rows, dtype=bool)
        for k in keys:
            v = table.column(k).to_numpy()
            change[1:] |= v[1:] != v[:-1]
        cut = np.flatnonzero(change)
        if not len(cut):
            continue
        yield table.slice(0, cut[-1]).combine_chunks()
        held = table.slice(cut[-1]).to_batches()
        rows = table.num_rows - cut[-1]
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _bounds(table: pa.Table, keys: list[str]) -> np.ndarray:
    change = np.zeros(table.num_rows, dtype=bool)
    change[0] = True
    for k in keys:
        v = table.column(k).to_numpy()
        change[1:] |= v[1:] != v[:-1]
    return np.append(np.flatnonzero(change), table.num_rows)


def _search(level: int, depth: int, small: int):
    """Forest edges of small buckets; members of large ones with their next paths.

    After ``depth`` a large bucket is dealt as pairs of blocks, whose pairs are all searched at the level after.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_heap()
        for table in _groups(batches, ["path"]):
            path, cls = table.column("path").to_numpy(), table.column("cls").to_numpy()
            size = table.column("size").to_numpy().astype(np.int64)
            bound = _bounds(table, ["path"])
            several = np.flatnonzero(np.diff(bound) > 1)
            if not len(several):
                continue
            sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, BINS)
            kids = table.column("kids")
            a, b = [], []
            for s, e in zip(bound[several], bound[several + 1]):
                _, one = np.unique(cls[s:e], return_index=True)  # a class may come from several tasks
                one = one + s
                if len(one) < 2:
                    continue
                if len(one) > small and level < depth:
                    nxt, row = [], []
                    for i in one.tolist():
                        raw, at = kids[i].as_py(), 0
                        for _ in range(level):
                            at += 2 + 8 * int.from_bytes(raw[at:at + 2], "little")
                        k = int.from_bytes(raw[at:at + 2], "little")
                        nxt.append(np.frombuffer(raw, np.uint64, k, at + 2))
                        row += [i] * k
                    new = ta.mix(np.concatenate(nxt) + ta.mix(path[s:e][:1].view(np.uint64)))
                    part = table.take(pa.array(row, pa.int64()))
                    empty = pa.nulls(len(row), pa.int64())
                    yield from pa.table(
                        [empty, empty, pa.array(new.view(np.int64)), *(part.column(c) for c in ("cls", "size", "sketch", "kids"))],
                        names=["a", "b", "path", "cls", "size", "sketch", "kids"]).to_batches()
                    continue
                if len(one) > small and level == depth:
                    for i, j, at in block_pairs(size[one], max(small // 2, 1)):
                        part = table.take(pa.array(one[at], pa.int64()))
                        empty = pa.nulls(len(at), pa.int64())
                        new = ta.mix(path[s:s + 1].view(np.uint64) + ta.mix(np.array([(i << 32) + j], np.uint64)))
                        yield from pa.table(
                            [empty, empty, pa.array(np.repeat(new.view(np.int64), len(at))),
                             *(part.column(c) for c in ("cls", "size", "sketch")), pa.nulls(len(at), pa.binary())],
                            names=["a", "b", "path", "cls", "size", "sketch", "kids"]).to_batches()
                    continue
                root = bucket_forest(size[one], sketch[one])
                member = np.flatnonzero(root != np.arange(len(one)))
                a.append(cls[one[root[member]]])
                b.append(cls[one[member]])
            if a and sum(map(len, a)):
                left, right = np.concatenate(a), np.concatenate(b)
                edge = np.unique(np.stack([np.minimum(left, right), np.maximum(left, right)], axis=1), axis=0)
                none = lambda t: pa.nulls(len(edge), t)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(edge[:, 0]), pa.array(edge[:, 1]), none(pa.int64()), none(pa.int64()), none(pa.int32()),
                     none(pa.binary()), none(pa.binary())],
                    names=["a", "b", "path", "cls", "size", "sketch", "kids"])

    return run


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, label): least node of each component of the edges (a, b).

    Each round takes the least label around and then the label's label, so
    rounds grow with the logarithm of the longest path.  Raises if it has not
    settled after ``max_rounds``.
    """
    both = cut_lineage(edges.select("a", "b").union(edges.select("b", "a")).toDF("a", "b").distinct())
    labels = cut_lineage(both.groupBy("a").agg(F.min("b").alias("m"))
                         .select(F.col("a").alias("node"), F.least("a", "m").alias("label")))
    for _ in range(max_rounds):
        around = (both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("l")), "b")
                  .groupBy("a").agg(F.min("l").alias("l")))
        nearer = (labels.join(around, labels["node"] == around["a"])
                  .select("node", F.col("label").alias("old"), F.least("label", "l").alias("label")))
        jump = labels.select(F.col("node").alias("n2"), F.col("label").alias("l2"))
        new = cut_lineage(nearer.join(jump, F.col("label") == F.col("n2"))
                          .select("node", "old", F.least("label", "l2").alias("label")))
        labels = new.select("node", "label")
        if new.filter("old != label").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Shared shingles of each pair of a left and a right set."""
    out = np.zeros((len(left), len(right)), dtype=np.int32)
    lo = np.repeat(np.arange(len(left)), [len(x) for x in left])
    ro = np.repeat(np.arange(len(right)), [len(x) for x in right])
    lv, rv = np.concatenate(left), np.concatenate(right)
    l_order, r_order = np.argsort(lv, kind="stable"), np.argsort(rv, kind="stable")
    lv, lo, rv, ro = lv[l_order], lo[l_order], rv[r_order], ro[r_order]
    shared = np.intersect1d(lv, rv)
    ls, le = np.searchsorted(lv, shared), np.searchsorted(lv, shared, side="right")
    rs, re = np.searchsorted(rv, shared), np.searchsorted(rv, shared, side="right")
    single = (le - ls == 1) & (re - rs == 1)
    np.add.at(out, (lo[ls[single]], ro[rs[single]]), 1)
    for a, b, c, d in zip(ls[~single], le[~single], rs[~single], re[~single]):
        out[np.ix_(lo[a:b], ro[c:d])] += 1
    return out


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per class and block pair: linked documents and the root of its links."""
    lean_heap()
    keys = ["cluster", "bi", "bj"]
    for table in _groups(batches, keys):
        bound = _bounds(table, keys)
        cls, mult = table.column("cls").to_numpy(), table.column("mult").to_numpy()
        block = table.column("block").to_numpy()
        bi, bj = table.column("bi").to_numpy(), table.column("bj").to_numpy()
        sets = table.column("set").to_pylist()
        out_cls, out_links, out_root = [], [], []
        for s, e in zip(bound[:-1], bound[1:]):
            _, one = np.unique(cls[s:e], return_index=True)
            at = np.sort(one) + s
            own = [np.frombuffer(sets[i], np.uint64) for i in at]
            c, m, n = cls[at], mult[at], np.array([len(x) for x in own])
            if bi[s] == bj[s]:
                li = ri = np.arange(len(at))
            else:
                li, ri = np.flatnonzero(block[at] == bi[s]), np.flatnonzero(block[at] == bj[s])
            if not len(li) or not len(ri):
                continue
            inter = _overlaps([own[i] for i in li], [own[i] for i in ri])
            # |x & y| >= t * |x | y| in integers: 5 * i >= 4 * (a + b - i)
            hit = 9 * inter.astype(np.int64) >= 4 * (n[li][:, None] + n[ri][None, :])
            if bi[s] == bj[s]:
                np.fill_diagonal(hit, False)
            i, j = np.nonzero(hit)
            links = np.zeros(len(at), dtype=np.int64)
            np.add.at(links, li[i], m[ri[j]])
            if bi[s] != bj[s]:
                np.add.at(links, ri[j], m[li[i]])
            linked = np.flatnonzero(links)
            root = _roots(len(at), li[i], ri[j])
            out_cls.append(c[linked])
            out_links.append(links[linked])
            out_root.append(c[root[linked]])
        if out_cls:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x)) for x in (out_cls, out_links, out_root)], names=["cls", "links", "root"])


def classify(docs: DataFrame, n: int = SHINGLE) -> DataFrame:
    """``docs`` (with text) plus its class id ``cls`` and shingle count ``size``; columns as given."""
    prepare(docs.sparkSession)
    names = [*docs.columns, "__cls", "__size"]
    schema = docs.select("*", F.lit(0).cast("long").alias("__cls"), F.lit(0).cast("int").alias("__size")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_heap()
        for rows, data, offsets in ta.text_slices(batches, "text"):
            own, val = shingle_sets(data, offsets, n)
            cls, size = class_ids(own, val, len(offsets) - 1)
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(cls), pa.array(size.astype(np.int32))], names=names)

    return docs.mapInArrow(run, schema)


def runs_for(recall: float, branch: float = BRANCH) -> int:
    """Runs after which a pair at the threshold has met with the target probability.

    A run gives it ``branch * THRESHOLD`` common picks on average (Poisson).
    """
    return max(1, math.ceil(-math.log(1 - recall) / (branch * THRESHOLD)))


def jaccard_groups(docs: DataFrame, n: int = SHINGLE, recall: float = RECALL, branch: float = BRANCH,
                   kids: int = KIDS, depth: int = DEPTH, small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """(doc_id, cls, size, label, class_id, n_links) per row of ``docs`` (see module).

    ``label`` is the group: the least class of its linked documents, null for
    texts without words.
    """
    spark = docs.sparkSession
    prepare(spark)
    base = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    members = cut_lineage(classify(base, n).select("doc_id", F.col("__cls").alias("cls"), F.col("__size").alias("size")))
    classes = members.filter("size > 0").groupBy("cls").agg(F.count("*").alias("mult"), F.min("doc_id").alias("rep"))

    runs = runs_for(recall, branch)
    rows = base.select(F.col("text").alias("__text")).mapInArrow(_paths(runs, branch, kids, depth, n), _PATH_SCHEMA)
    edges = None
    for level in range(depth + 2):
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        found = cut_lineage(rows.repartition(parts, "path").sortWithinPartitions("path")
                            .mapInArrow(_search(level, depth, small), _FOUND_SCHEMA))
        new = found.filter("a IS NOT NULL").select("a", "b")
        edges = new if edges is None else edges.union(new)
        rows = found.filter("path IS NOT NULL").select("path", "cls", "size", "sketch", "kids")
        if level > depth or rows.isEmpty():
            break
    cluster = components(edges).select(F.col("node").alias("cls"), F.col("label").alias("cluster"))
    sized = cluster.join(cluster.groupBy("cluster").agg(F.count("*").alias("m")), "cluster")
    wanted = (sized.join(classes, "cls").withColumn("blocks", F.ceil(F.col("m") / block).cast("int"))
              .select("cluster", "blocks", F.col("cls").alias("want"), "mult", "rep"))
    fetched = base.join(wanted.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("rep"))).select(
        "cluster", "blocks", "want", "mult", "text")

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_heap()
        for part, data, offsets in ta.text_slices(batches, "text"):
            own, val = shingle_sets(data, offsets, n)
            cls, size = class_ids(own, val, len(offsets) - 1)
            ends = np.concatenate([[0], np.cumsum(size)])
            # equal ids may carry other texts: those belong to another class
            right = np.flatnonzero(cls == part.column(2).to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*(part.column(i).take(pa.array(right)) for i in range(4)),
                 pa.array([val[ends[i]:ends[i + 1]].tobytes() for i in right], pa.binary())],
                names=["cluster", "blocks", "cls", "mult", "set"])

    sets = fetched.mapInArrow(to_sets, "cluster long, blocks int, cls long, mult long, set binary")
    own_block = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    dealt = (sets.withColumn("block", own_block)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("cluster", "cls", "mult", "block", F.least("block", "other").alias("bi"),
                     F.greatest("block", "other").alias("bj"), "set"))
    linked = cut_lineage(dealt.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "cluster", "bi", "bj")
                         .sortWithinPartitions("cluster", "bi", "bj")
                         .mapInArrow(_verify, "cls long, links long, root long"))
    links = linked.groupBy("cls").agg(F.sum("links").alias("links"))
    groups = components(linked.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    label = (classes.join(links, "cls", "left").join(groups.withColumnRenamed("node", "cls"), "cls", "left")
             .select("cls", "mult", "rep", F.coalesce("links", F.lit(0)).alias("links"),
                     F.coalesce("label", "cls").alias("label")))
    least = label.groupBy("label").agg(F.min("rep").alias("class_id"))
    final = label.join(least, "label").select(
        F.col("cls").alias("f_cls"), "label", "class_id", (F.col("links") + F.col("mult") - 1).alias("n_links"))
    return (members.join(final, (F.col("cls") == F.col("f_cls")) & (F.col("size") > 0), "left")
            .select("doc_id", "cls", "size", "label",
                    F.when(F.col("size") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    with stage_scope(spark):
        return cut_lineage(jaccard_groups(docs).select("doc_id", "class_id", "n_links"), outlive=True)


OP9_SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), sh AS (
  SELECT DISTINCT rid, md5(s) AS s FROM (
    SELECT rid, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
      ELSE [array_to_string(ws[i:i + 4], ' ') for i in range(1, len(ws) - 3)] END) AS s FROM d)
), size AS (
  SELECT rid, count(*) AS n FROM sh GROUP BY rid
), common AS (
  SELECT a.rid AS x, b.rid AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.rid < b.rid GROUP BY ALL
), pairs AS (
  SELECT x, y FROM common JOIN size p ON p.rid = x JOIN size q ON q.rid = y WHERE 5 * c >= 4 * (p.n + q.n - c)
), links AS (
  SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs
), reach AS (
  SELECT rid AS x, rid AS y FROM d UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y
), groups AS (
  SELECT r.x AS rid, min(o.doc_id) AS class_id FROM reach r JOIN d o ON o.rid = r.y GROUP BY r.x
), degree AS (
  SELECT x AS rid, count(*) AS n FROM links GROUP BY x
)
SELECT doc_id, class_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links
FROM d JOIN groups USING (rid) LEFT JOIN degree USING (rid)
"""
