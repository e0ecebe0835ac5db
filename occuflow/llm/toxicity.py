"""Toxicity by cumulative-link ordinal regression on sparse text features.

Model: ``P(grade <= k) = sigmoid(theta_k - w . x)`` with one weight vector
shared by all ordered thresholds ``theta_0 < theta_1 < ...``.  The result is
the expected severity ``sum_k P(grade > k)`` and the probability of any
toxicity.

Features are lower-cased words (runs of ASCII letters and non-ASCII
characters, so trailing marks do not hide a word) and their prefixes of 3 to 8
characters, so an inflected stem counts whatever its ending.  A feature's
value is its rate: ``100 * count / (words + 100)``; the constant keeps one
chance hit in a short text from looking like abuse.  Fitting:

* a bounded sample of labelled rows (``max_rows``, chosen by a hash of the id);
* per feature, the numbers of sampled texts with it by toxic or not, summed in
  Spark; the features most tied to toxicity or to its absence (log-likelihood
  ratio) form the vocabulary of ``max_features``;
* grades of toxic texts, when the labels only say toxic or not: 2 for the half
  with the higher total rate of features tied to toxicity, 1 for the others;
* weights and thresholds by gradient descent on the driver over the sampled
  rows' vocabulary hits.

Scoring reads every document once and looks its features up in the sorted hash
array of the vocabulary.  Defined cases: a null or empty text has no word and
gets the severity of the thresholds alone; labels without document, repeated
and null labels are ignored or counted as rows; without any toxic label every
severity is 0; an empty table gives an empty result; result columns replace
input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occuflow.llm import textarrays as ta
from occuflow.llm.workers import lean_heap, prepare
from occuflow.session import cut_lineage, stage_scope

MAX_ROWS, MAX_FEATURES = 20_000, 2048
MIN_TEXTS, MIN_LLR, MARKER_LIFT = 4, 15.0, 5.0
PREFIXES, SMOOTH = range(3, 9), 100.0
RESULTS = ("severity", "p_toxic", "toxic")

_NOT_LETTER = np.ones(256, dtype=bool)
_NOT_LETTER[65:91] = _NOT_LETTER[97:123] = False
_NOT_LETTER[128:] = False


def text_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, feature hash) of every word and proper word prefix; words per text."""
    lower = ta.LOWER[data]
    start, end, owner = ta.words(lower, offsets, _NOT_LETTER)
    rolling = ta.Rolling(lower)
    owners, hashes = [owner], [rolling.at(start, end - start)]
    first_byte = (lower & 0xC0) != 0x80
    char_start = np.flatnonzero(first_byte)
    char = np.cumsum(first_byte)[start] - 1 if len(start) else start
    for k in PREFIXES:
        stop = char + k
        has = np.flatnonzero(stop < len(char_start))
        has = has[char_start[stop[has]] < end[has]]
        owners.append(owner[has])
        hashes.append(ta.mix(rolling.at(start[has], char_start[stop[has]] - start[has])))
    return np.concatenate(owners), np.concatenate(hashes), np.bincount(owner, minlength=len(offsets) - 1)


@dataclass
class SeverityModel:
    """Vocabulary (sorted word hashes), shared weights, ordered thresholds."""

    words: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray
    markers: np.ndarray = field(default_factory=lambda: np.empty(0, bool))

    def hits(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, vocabulary index, rate) of the features that occur."""
        if not len(self.words):
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        owner, hashes, n_words = text_features(data, offsets)
        # few features are known: a bit per hash prefix settles nearly all
        maybe = np.zeros(1 << 20, dtype=bool)
        maybe[self.words >> ta.U64(44)] = True
        near = np.flatnonzero(maybe[hashes >> ta.U64(44)])
        owner, hashes = owner[near], hashes[near]
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        known = self.words[at] == hashes
        key, count = np.unique(owner[known].astype(np.int64) * len(self.words) + at[known], return_counts=True)
        row = key // len(self.words)
        return row, key % len(self.words), 100.0 * count / (n_words[row] + SMOOTH)

    def exceed(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """P(grade > k) per text and threshold."""
        n = len(offsets) - 1
        row, word, rate = self.hits(data, offsets)
        score = np.bincount(row, weights=self.weights[word] * rate, minlength=n) if len(row) else np.zeros(n)
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -60, 60)))


def fit_ordinal(row: np.ndarray, word: np.ndarray, value: np.ndarray, grade: np.ndarray, n_words: int,
                n_grades: int, l2: float = 1e-4, steps: int = 800, rate: float = 0.5) -> tuple[np.ndarray, np.ndarray]:
    """Weights and increasing thresholds by Adam on the cumulative-link likelihood.

    ``row``/``word``/``value`` are the non-zero entries of the feature matrix.  The
    thresholds are ``theta_0`` and exponentials of the gaps, so they stay ordered.
    """
    n = len(grade)
    w, base, gaps = np.zeros(n_words), 1.0, np.zeros(n_grades - 2)
    first, second, t = None, None, 0
    weight = np.full(n, 1.0 / n)
    cut = lambda: base + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
    sig = lambda z: 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))
    for t in range(1, steps + 1):
        theta = cut()
        score = np.bincount(row, weights=w[word] * value, minlength=n)
        upper = np.where(grade < n_grades - 1, sig(theta[np.minimum(grade, n_grades - 2)] - score), 1.0)
        lower = np.where(grade > 0, sig(theta[np.maximum(grade - 1, 0)] - score), 0.0)
        p = np.maximum(upper - lower, 1e-12)
        d_up, d_low = upper * (1 - upper) / p * weight, lower * (1 - lower) / p * weight
        g_theta = np.zeros(n_grades - 1)
        np.add.at(g_theta, np.minimum(grade, n_grades - 2), -d_up * (grade < n_grades - 1))
        np.add.at(g_theta, np.maximum(grade - 1, 0), d_low * (grade > 0))
        g_w = np.bincount(word, weights=(d_up - d_low)[row] * value, minlength=n_words) + l2 * w / max(1, n_grades)
        g_gap = np.array([g_theta[j + 1:].sum() * np.exp(gaps[j]) for j in range(n_grades - 2)])
        g = np.concatenate([g_w, [g_theta.sum()], g_gap])
        if first is None:
            first, second = np.zeros_like(g), np.zeros_like(g)
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        move = rate * min(1.0, 20.0 / t ** 0.5) * 0.2 * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.999 ** t)) + 1e-8)
        w = w - move[:n_words]
        base -= move[n_words]
        gaps = np.clip(gaps - move[n_words + 1:], -4.0, 4.0)
    return w, cut()


def _llr(a: np.ndarray, b: np.ndarray, n_a: float, n_b: float) -> np.ndarray:
    """Log-likelihood ratio of a word held by a of n_a and b of n_b texts."""
    def part(k, n, p):
        q = np.clip(p, 1e-12, 1 - 1e-12)
        return k * np.log(q) + (n - k) * np.log(1 - q)

    p = (a + b) / (n_a + n_b)
    return 2 * (part(a, n_a, a / n_a) + part(b, n_b, b / n_b) - part(a, n_a, p) - part(b, n_b, p))


def fit_severity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS,
                 max_features: int = MAX_FEATURES) -> SeverityModel:
    """Fit on at most about ``max_rows`` labelled documents.

    ``labels`` has doc_id and either ``grade`` (0, 1, ...) or ``toxic`` (0/1).
    """
    with stage_scope(docs.sparkSession):  # the sample goes once the model is fitted
        return _fit(docs, labels, max_rows, max_features)


def _fit(docs: DataFrame, labels: DataFrame, max_rows: int, max_features: int) -> SeverityModel:
    spark = docs.sparkSession
    prepare(spark)
    graded = "grade" in labels.columns
    grade = F.col("grade" if graded else "toxic").cast("int")
    chosen = labels.select("doc_id", grade.alias("grade")).filter("doc_id IS NOT NULL AND grade IS NOT NULL")
    n_labels = chosen.count()
    if n_labels > max_rows:
        chosen = chosen.filter(F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1 << 30))
                               < int((1 << 30) * max_rows / n_labels))
    chosen = chosen.groupBy("doc_id").agg(F.max("grade").alias("grade"))
    # at most about max_rows rows: a proven bound for the broadcast
    sample = cut_lineage(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))
    totals = {r["t"]: r["n"] for r in sample.groupBy((F.col("grade") > 0).alias("t")).agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = totals.get(True, 0), totals.get(False, 0)
    nothing = SeverityModel(np.empty(0, np.uint64), np.empty(0), np.array([60.0, 61.0]))
    if not n_toxic or not n_clean:
        return nothing if not n_toxic else SeverityModel(np.empty(0, np.uint64), np.empty(0), np.array([-60.0, 60.0]))

    def count_words(batches):
        lean_heap()
        for rows, data, offsets in ta.text_slices(batches, "text"):
            owner, hashes, _ = text_features(data, offsets)
            toxic = rows.column(rows.schema.get_field_index("grade")).to_numpy() > 0
            order = np.lexsort((owner, hashes))
            owner, hashes = owner[order], hashes[order]
            fresh = np.ones(len(owner), dtype=bool)  # a feature counts once a text
            fresh[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
            owner, hashes = owner[fresh], hashes[fresh]
            first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.empty(0, np.int64)
            word, at = hashes[first], np.repeat(np.arange(len(first)), np.diff(np.append(first, len(hashes))))
            flag = toxic[owner]
            yield pa.RecordBatch.from_arrays([
                pa.array(word.view(np.int64)),
                pa.array(np.bincount(at[flag], minlength=len(word)).astype(np.int64)),
                pa.array(np.bincount(at[~flag], minlength=len(word)).astype(np.int64))],
                names=["word", "toxic", "clean"])

    counted = (sample.select("text", "grade").mapInArrow(count_words, "word long, toxic long, clean long")
               .groupBy("word").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
               .filter(F.col("a") + F.col("b") >= MIN_TEXTS))
    a, b, na, nb = F.col("a"), F.col("b"), F.lit(float(n_toxic)), F.lit(float(n_clean))
    lift = (a + 0.5) / na / ((b + 0.5) / nb)
    tied = F.abs(F.log(lift)) * F.sqrt(F.greatest(a / na, b / nb))
    rows = counted.withColumn("tied", tied).orderBy(F.desc("tied"), "word").limit(max_features * 4).collect()
    word = np.array([r["word"] for r in rows], dtype=np.int64).view(np.uint64)
    a, b = (np.array([r[c] for r in rows], dtype=float) for c in ("a", "b"))
    best = np.argsort(-_llr(a, b, n_toxic, n_clean), kind="stable")[:max_features]
    # chance ties of so large a vocabulary would only add noise: 15 is p ~ 1e-4
    best = best[_llr(a, b, n_toxic, n_clean)[best] > MIN_LLR]
    word, a, b = word[best], a[best], b[best]
    order = np.argsort(word)
    word, a, b = word[order], a[order], b[order]
    markers = (a / n_toxic) / ((b + 0.5) / n_clean) >= MARKER_LIFT
    model = SeverityModel(word, np.zeros(len(word)), np.zeros(1), markers)

    def vocabulary_hits(batches):
        lean_heap()
        for rows, data, offsets in ta.text_slices(batches, "text"):
            row, hit, value = model.hits(data, offsets)
            ends = pa.array(np.searchsorted(row, np.arange(rows.num_rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [rows.column(rows.schema.get_field_index("grade")),
                 pa.ListArray.from_arrays(ends, pa.array(hit.astype(np.int32))),
                 pa.ListArray.from_arrays(ends, pa.array(value))], names=["grade", "hits", "rates"])

    rows = (sample.select("text", "grade")
            .mapInArrow(vocabulary_hits, "grade int, hits array<int>, rates array<double>").collect())
    grade = np.array([r["grade"] for r in rows], dtype=np.int64)
    row = np.repeat(np.arange(len(rows)), [len(r["hits"]) for r in rows])
    hit = np.array([h for r in rows for h in r["hits"]], dtype=np.int64)
    value = np.array([v for r in rows for v in r["rates"]], dtype=float)
    if not graded:
        strength = np.bincount(row, weights=value * markers[hit], minlength=len(rows)) if len(row) else np.zeros(len(rows))
        middle = np.median(strength[grade > 0])
        grade = np.where(grade > 0, np.where(strength > middle, 2, 1), 0)
    present = np.unique(grade)  # grades without rows have no threshold of their own
    level = np.searchsorted(present, grade)
    if not len(word):
        return SeverityModel(word, np.zeros(0), np.array([np.log(n_clean / n_toxic)]), markers)
    weights, thresholds = fit_ordinal(row, hit, value, level, len(word), len(present))
    return SeverityModel(word, weights, thresholds, markers)


def score_severity(docs: DataFrame, model: SeverityModel, threshold: float = 0.5, keep_text: bool = False) -> DataFrame:
    """``docs`` (text only with ``keep_text``) plus severity, p_toxic and toxic.

    The model is bounded by ``max_features`` and travels with the task.
    """
    prepare(docs.sparkSession)
    carry = [c for c in docs.columns if c.lower() not in RESULTS and (keep_text or c != "text")]
    source = docs.select(*[F.col(f"`{c}`") for c in carry], F.col("text").cast("string").alias("__text"))
    schema = source.select(*[F.col(f"`{c}`") for c in carry], F.lit(0.0).alias("severity"),
                           F.lit(0.0).alias("p_toxic"), F.lit(False).alias("toxic")).schema

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_heap()
        for rows, data, offsets in ta.text_slices(batches, "__text"):
            p = model.exceed(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(i) for i in range(len(carry))),
                 pa.array(p.sum(axis=1)), pa.array(p[:, 0]), pa.array(p[:, 0] >= threshold)],
                names=[*carry, *RESULTS])

    return source.mapInArrow(score, schema)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit_severity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_severity(docs, model)
