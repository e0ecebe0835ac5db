"""Quality rules kept as a bitmask ledger.

``quality_ledger`` evaluates every rule once per document and stores the
measurements and one failure bit per rule.  Policies are versioned masks over
those bits: ``apply_policy`` is one bitwise AND, and ``ablation`` finds, for
every rule of a policy, how many documents fail it, fail only it, and would
be kept without it, by bitwise aggregation over the ledger — no text is read
again.

Words are maximal runs of ``[^\\x20\\x09-\\x0D]``.  Measurements per text:

=================  =====================================================
n_words            words
word_chars         code points in words
n_symbols          characters of ``# * $ % & | < >``
n_dup_lines        lines (split at ``\\n``) with a word that equal an earlier line
n_lines            lines with a word
n_repeat_words     words inside 3-word windows found twice or more in the text
n_top_word         occurrences of the most frequent word
n_letters/n_upper  ASCII letters / upper-case ones
n_bangs            words ending in ``!``
=================  =====================================================

Defined cases: a null or empty text has no words, fails ``few_words`` and is
not kept; repeated rows are judged alike; texts are always judged whole; an
empty table gives an empty ledger; columns of the input that bear the name of
a ledger column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occuflow.llm import textarrays as ta
from occuflow.llm.workers import prepare


# The symbols counted.
SYMBOLS = "#*$%&|<>"
# Rule -> bit, in evaluation order.  Bits are never renumbered; new rules append.
RULES = ["few_words", "repeated_windows", "many_symbols", "duplicate_lines",
         "one_word_dominates", "shouting", "word_length"]
BIT = {name: 1 << i for i, name in enumerate(RULES)}
# Policy version -> rules it applies.
POLICIES = {
    "base": ["few_words", "repeated_windows"],
    "v1": ["few_words", "repeated_windows", "many_symbols", "duplicate_lines",
           "one_word_dominates", "shouting", "word_length"],
}
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines",
            "n_repeat_words", "n_top_word", "n_letters", "n_upper", "n_bangs"]

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_BANG = np.zeros(256, dtype=bool)
_BANG[ord("!")] = True


def policy_mask(version: str) -> int:
    """Bits of the rules of a policy version."""
    return sum(BIT[r] for r in POLICIES[version])


def _sum_by_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeats(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Per text: words covered by 3-word windows that occur at least twice in it."""
    if len(hashes) < 3:
        return np.zeros(n, dtype=np.int64)
    whole = owner[2:] == owner[:-2]
    key = ta.mix(hashes[:-2] * ta.U64(3) + ta.mix(hashes[1:-1] * ta.U64(5) + ta.mix(hashes[2:])))
    key = ta.mix(key ^ (owner[:-2].astype(np.uint64) * ta.U64(0x9E3779B97F4A7C15)))
    at = np.flatnonzero(whole)
    order = np.argsort(key[at])
    ordered = key[at][order]
    same = ordered[1:] == ordered[:-1]
    twice = np.zeros(len(at), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(hashes), dtype=bool)
    for shift in range(3):
        covered[at[twice] + shift] = True
    return np.bincount(owner[covered], minlength=n)


def _top_word(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, dtype=np.int64)
    if len(hashes):
        key = np.sort(ta.mix(hashes ^ ta.mix(owner.astype(np.uint64))))
        order = np.argsort(ta.mix(hashes ^ ta.mix(owner.astype(np.uint64))), kind="stable")
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        np.maximum.at(out, owner[order[first]], np.diff(np.append(first, len(key))))
    return out


def _duplicate_lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(offsets) - 1
    duplicate, total = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    raw = data.tobytes()
    for i in range(n):
        lines = [x for x in raw[offsets[i]:offsets[i + 1]].split(b"\n") if x and not x.isspace()]
        total[i] = len(lines)
        duplicate[i] = len(lines) - len(set(lines))
    return duplicate, total


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """All measurements of a batch of texts."""
    n = len(offsets) - 1
    start, end, owner = ta.words(data, offsets)
    hashes = ta.word_hashes(data, start, end)
    duplicate, lines = _duplicate_lines(data, offsets)
    in_word = ~ta.WORD_SPACE[data] & ((data & 0xC0) != 0x80)
    return {
        "n_words": np.bincount(owner, minlength=n),
        "word_chars": _sum_by_text(in_word, offsets),
        "n_symbols": _sum_by_text(_SYMBOL[data], offsets),
        "n_dup_lines": duplicate,
        "n_lines": lines,
        "n_repeat_words": _repeats(hashes, owner, n),
        "n_top_word": _top_word(hashes, owner, n),
        "n_letters": _sum_by_text(_LETTER[data], offsets),
        "n_upper": _sum_by_text(_UPPER[data], offsets),
        "n_bangs": np.bincount(owner[_BANG[data[end - 1]]], minlength=n) if len(end) else np.zeros(n, np.int64),
    }


def failure_bits(m: dict[str, np.ndarray]) -> np.ndarray:
    """One failure bit per rule; integer arithmetic only, so exact everywhere."""
    n = m["n_words"]
    failed = {
        "few_words": n < 50,
        "repeated_windows": 100 * m["n_repeat_words"] > 50 * n,
        # clean prose has almost none; symbol-littered or tabular text nears one a word
        "many_symbols": 100 * m["n_symbols"] > 25 * n,
        "duplicate_lines": 100 * m["n_dup_lines"] > 50 * m["n_lines"],
        "one_word_dominates": 100 * m["n_top_word"] > 30 * n,
        "shouting": (100 * m["n_upper"] > 70 * np.maximum(m["n_letters"], 1)) | (100 * m["n_bangs"] > 50 * n),
        "word_length": (m["word_chars"] < 2 * n) | (m["word_chars"] > 25 * n),
    }
    bits = np.zeros(len(n), dtype=np.int64)
    for name, bad in failed.items():
        bits |= np.where(bad, BIT[name], 0)
    return bits


def quality_ledger(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns (default: all but the text) plus measurements and ``fail_bits``."""
    prepare(docs.sparkSession)
    results = [*MEASURES, "fail_bits"]
    carry = [c for c in (carry if carry is not None else docs.columns)
             if c != text and c.lower() not in results]
    source = docs.select(*[F.col(f"`{c}`") for c in carry], F.col(f"`{text}`").cast("string").alias("__text"))
    schema = source.select(*[F.col(f"`{c}`") for c in carry],
                           *[F.lit(0).cast("long").alias(c) for c in results]).schema

    def ledger(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in ta.text_slices(batches, "__text"):
            m = measure(data, offsets)
            m["fail_bits"] = failure_bits(m)
            yield pa.RecordBatch.from_arrays(
                [rows.column(i) for i in range(len(carry))]
                + [pa.array(m[c].astype(np.int64)) for c in results], names=[*carry, *results])

    return source.mapInArrow(ledger, schema)


def apply_policy(ledger: DataFrame, version: str, kept: str = "kept") -> DataFrame:
    """The ledger plus a boolean: no rule of the policy failed."""
    return ledger.withColumn(kept, F.col("fail_bits").bitwiseAND(F.lit(policy_mask(version))) == 0)


def ablation(ledger: DataFrame, version: str) -> DataFrame:
    """Per rule of a policy: documents failing it, failing only it, kept by the rest.

    Documents are first counted per distinct bit pattern (map-side combined),
    so the aggregate handles at most ``2 ** len(RULES)`` rows.
    """
    mask = policy_mask(version)
    patterns = (ledger.select(F.col("fail_bits").bitwiseAND(F.lit(mask)).alias("bits"))
                .groupBy("bits").agg(F.count("*").alias("n")))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit"))
                      for r in POLICIES[version]])
    return (patterns.select("bits", "n", F.explode(rules).alias("r"))
            .groupBy(F.col("r.rule").alias("rule"))
            .agg(F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
                 F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_failed_only"),
                 F.sum(F.when(F.col("bits").bitwiseAND(F.lit(mask) - F.col("r.bit")) == 0, F.col("n"))
                       .otherwise(0)).alias("n_kept_without")))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    ledger = apply_policy(apply_policy(quality_ledger(docs), "base", "base_ok"), "v1", "policy_ok")
    return ledger.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~F.col("base_ok")).alias("base_failed"),
        (F.col("base_ok") & F.col("policy_ok")).alias("kept"))


OP5_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT row_id, generate_subscripts(ws, 1) AS i, unnest(ws) AS word
  FROM (SELECT row_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d)
), tri AS (
  SELECT row_id, i, count(*) OVER (PARTITION BY row_id, word, w2, w3) AS n
  FROM (SELECT row_id, i, word, lead(word) OVER q AS w2, lead(word, 2) OVER q AS w3
        FROM w WINDOW q AS (PARTITION BY row_id ORDER BY i))
  WHERE w3 IS NOT NULL
), rep AS (
  SELECT row_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT row_id, i + unnest([0, 1, 2]) AS p FROM tri WHERE n >= 2) GROUP BY row_id
), tops AS (
  SELECT row_id, max(n) AS n_top_word, sum(n) AS n_words, sum(bangs) AS n_bangs
  FROM (SELECT row_id, word, count(*) AS n, count(*) FILTER (ends_with(word, '!')) AS bangs
        FROM w GROUP BY row_id, word) GROUP BY row_id
), lines AS (
  SELECT row_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT row_id, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row_id
), m AS (
  SELECT doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         coalesce(n_top_word, 0) AS n_top_word, coalesce(n_bangs, 0) AS n_bangs,
         length(regexp_replace(t, '[^A-Za-z]+', '', 'g')) AS n_letters,
         length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS n_upper
  FROM d LEFT JOIN rep USING (row_id) LEFT JOIN tops USING (row_id) LEFT JOIN lines USING (row_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 25 * n_words
            OR 100 * n_dup_lines > 50 * n_lines OR 100 * n_top_word > 30 * n_words
            OR 100 * n_upper > 70 * greatest(n_letters, 1) OR 100 * n_bangs > 50 * n_words
            OR word_chars < 2 * n_words OR word_chars > 25 * n_words) AS kept
FROM m
"""
