"""Secret scans: pattern spans plus a token-efficiency test for random strings.

Pattern kinds (leftmost, non-overlapping per kind; matches that fail their
length test are dropped and still use up their characters):

* ``assign`` – ``password = value`` and the like, value of 12+ characters;
* ``access`` – ``AKIA...`` of 18+ characters;
* ``hex``    – ``[0-9a-f]`` runs of 16+ characters.

The method adds kind ``token``: runs of 16+ key characters with a letter that a
byte-pair vocabulary compresses badly (fewer than ``max_ratio`` characters a
token) — ordinary words and names merge into long tokens, random strings do
not.  Pattern spans and known values (UUIDs, hexadecimal strings of the usual
digest lengths) are cut out of a run; each piece left of 16+ characters is
judged as a whole, between ``=``, between ``/ + =`` (base64url), between
``_ - =`` (base64) and between all of them, so words joined to a secret do not
hide it.  Overlapping hits are one span.  Tokens are counted in blocks of
``_BLOCK`` characters, so very long runs take linear time.

Spans are code points ``[start, end)`` of the whole text, ordered by start,
then kind as listed above.  Defined cases: null or empty text has no span;
repeated rows get equal spans; an empty table gives an empty result; result
columns replace input columns of the same name.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from occuflow.llm.workers import lean_heap, prepare


KINDS = ["assign", "access", "hex", "token"]
_ORDER = {k: i for i, k in enumerate(KINDS)}
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
# Equal to taking every AKIA[A-Z0-9]+ / [0-9a-f]+ run and dropping the short ones:
# the runs are maximal, so a short one cannot hide a long one.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
# Lengths of common digests in hexadecimal.
DIGEST_LENGTHS = frozenset({32, 40, 56, 64, 96, 128})
_KNOWN = re.compile(r"(?<![A-Za-z0-9])(?:[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|"
                    + "|".join(f"[0-9a-fA-F]{{{n}}}" for n in sorted(DIGEST_LENGTHS)) + r")(?![A-Za-z0-9])")
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
# The parts of a run, coarse to fine; the first is the run itself.
_PARTS = [_RUN, *(re.compile(rf"[{c}]{{16,}}") for c in ("A-Za-z0-9+/_-", "A-Za-z0-9_-", "A-Za-z0-9+/", "A-Za-z0-9"))]
_LETTER = re.compile(r"[A-Za-z]")
_BLOCK = 4096
MIN_LENGTH, MAX_RATIO = 16, 2.2

_encoders: dict[tuple, object] = {}


def load_encoder(vocabulary: str, added: tuple[tuple[str, int], ...] = ()):
    """A byte-pair encoder over a ``.tiktoken`` rank file and (literal, id) of added tokens (kept per process)."""
    if (vocabulary, added) not in _encoders:
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(vocabulary), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoders[vocabulary, added] = tiktoken.Encoding(
            vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=dict(added))
    return _encoders[vocabulary, added]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Pattern spans in order."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], _ORDER[s[2]]))


def _is_random(run: str, encoder, max_ratio: float) -> bool:
    """Fewer than ``max_ratio`` characters a token; numbers are not judged."""
    if not _LETTER.search(run):
        return False
    tokens = sum(len(encoder.encode_ordinary(run[i:i + _BLOCK])) for i in range(0, len(run), _BLOCK))
    return len(run) < max_ratio * tokens


def _free_pieces(text: str, taken: list[tuple[int, int, str]]) -> Iterator[tuple[int, int]]:
    """The runs of a text without taken spans and known values, in order."""
    at = until = 0  # the next taken span; how far those before it reach
    for m in _RUN.finditer(text):
        holes = [(k.start() + m.start(), k.end() + m.start()) for k in _KNOWN.finditer(m.group())]
        if until > m.start():
            holes.append((m.start(), until))
        while at < len(taken) and taken[at][0] < m.end():
            holes.append(taken[at][:2])
            until = max(until, taken[at][1])
            at += 1
        start = m.start()
        for s, e in sorted(holes):
            if s > start:
                yield start, s
            start = max(start, e)
        if m.end() > start:
            yield start, m.end()


def random_spans(text: str, taken: list[tuple[int, int, str]], encoder, max_ratio: float) -> list[tuple[int, int, str]]:
    """Runs and parts of runs that the vocabulary compresses badly, outside the taken spans (sorted by start)."""
    out = []
    for begin, end in _free_pieces(text, taken):
        judged = {at: _is_random(text[slice(*at)], encoder, max_ratio)
                  for at in {m.span() for part in _PARTS for m in part.finditer(text, begin, end)}}
        until = begin
        for s, e in sorted(at for at, random in judged.items() if random):
            if s >= until:
                out.append((s, e, "token"))
            elif e > until:
                out[-1] = (out[-1][0], e, "token")
            until = max(until, e)
    return out


def scan_text(text: str, encoder, max_ratio: float = MAX_RATIO) -> tuple[list, list]:
    """(pattern spans, all spans) of one text."""
    base = base_spans(text)
    more = random_spans(text, base, encoder, max_ratio)
    return base, sorted(base + more, key=lambda s: (s[0], _ORDER[s[2]])) if more else base


def redact_text(text: str, spans: list[tuple[int, int, str]], mark: str = "[SECRET]") -> str:
    """The text with every span (overlapping ones merged) replaced by ``mark``."""
    out, at, until = [], 0, -1
    for s, e, _ in spans:
        if s >= until:
            out += [text[at:s], mark] if until < 0 else [text[until:s], mark]
            at = until = e
        else:
            until = max(until, e)
    return text if until < 0 else "".join([*out, text[until:]])


_SPANS = "array<struct<start:long,end:long,kind:string,method:boolean>>"


def scan_secrets(docs: DataFrame, text: str = "text", vocabulary: str = "byte_bpe_50k.tiktoken",
                 max_ratio: float = MAX_RATIO, redact: bool = False) -> DataFrame:
    """``docs`` plus ``secret_spans``; with ``redact`` the text has its spans replaced.

    Without ``redact`` the text column itself is left out of the result.
    """
    prepare(docs.sparkSession)
    carry = [c for c in docs.columns if c != text and c.lower() != "secret_spans"]
    source = docs.select(*[F.col(f"`{c}`") for c in carry], F.col(f"`{text}`").cast("string").alias("__text"))
    result = source.select(*[F.col(f"`{c}`") for c in carry],
                           *([F.col("__text").alias(text)] if redact else []),
                           F.lit(None).cast(_SPANS).alias("secret_spans"))
    names, span_type = result.columns, pa.list_(pa.struct([
        ("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("method", pa.bool_())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_heap()
        encoder = load_encoder(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                spans, texts = [], []
                for value in part.column(len(carry)).to_pylist():
                    _, found = scan_text(value or "", encoder, max_ratio)
                    spans.append([{"start": s, "end": e, "kind": k, "method": k == "token"} for s, e, k in found])
                    if redact:
                        texts.append(redact_text(value, found) if found else value)
                columns = [part.column(i) for i in range(len(carry))]
                columns += [pa.array(texts, pa.string())] if redact else []
                yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, span_type)], names=names)

    return source.mapInArrow(scan, result.schema)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def span_digest(scanned: DataFrame) -> DataFrame:
    """Counts per pattern kind, digest of the pattern spans, and all spans as text."""
    spans = F.col("secret_spans")
    base = F.filter(spans, lambda s: ~s["method"])
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return scanned.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"), F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(spans).alias("spans"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return span_digest(scan_secrets(docs))


def brute_base(text: str | None) -> list[tuple[int, int, str]]:
    """The contract's wording, literally; used by the tests."""
    text = text or ""
    found = [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    found += [(m.start(), m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    found += [(m.start(), m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 16]
    return sorted(found, key=lambda s: (s[0], _ORDER[s[2]]))


def brute_digest(text: str | None) -> str:
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, e, k in brute_base(text)).encode()).hexdigest()
