"""Vectorised text primitives used inside Arrow map tasks.

A *text batch* is a pair ``(data, offsets)``: the UTF-8 bytes of all texts of
a batch, end to end, and the ``n + 1`` byte offsets of the texts.  All hashes
are 64-bit and depend on content only, so they agree between tasks and runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
# Fixed pseudo-random odd value per byte (seeded, so equal in every process).
_BYTE_VALUE = (np.random.Generator(np.random.PCG64(20240607))
               .integers(0, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1))
# Work is done on slices of about this many bytes, whatever the Arrow batch size.
SLICE_BYTES = 1 << 20

WORD_SPACE = np.zeros(256, dtype=bool)
WORD_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: a bijection of 64-bit values that spreads every input bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    """``base ** (0 .. n-1)`` modulo 2**64, kept for the next batch unless large."""
    have = _powers.get(base)
    if have is not None and len(have) >= n:
        return have[:n]
    size = max(n, SLICE_BYTES + (1 << 16))
    out = np.empty(size, dtype=np.uint64)
    out[0] = 1
    k = 1
    while k < size:
        m = min(k, size - k)
        np.multiply(out[:m], U64(pow(base, k, 1 << 64)), out=out[k:k + m])
        k += m
    if size <= 4 * SLICE_BYTES:
        _powers[base] = out
    return out[:n]


class Rolling:
    """Prefix sums of a polynomial hash: any substring's hash in O(1)."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.prefix = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUE[data] * _power_table(_BASE, n), out=self.prefix[1:]) if n else None
        self.inverse = _power_table(_BASE_INV, n + 1)

    def at(self, start: np.ndarray, length) -> np.ndarray:
        """Hashes of ``data[start : start + length]`` (arrays or one length)."""
        return mix((self.prefix[start + length] - self.prefix[start]) * self.inverse[start]
                   + np.asarray(length).astype(np.uint64))

    def windows(self, length: int) -> np.ndarray:
        """Hashes of every ``length``-byte window, by start."""
        n = len(self.prefix) - length
        if n <= 0:
            return np.empty(0, dtype=np.uint64)
        return mix((self.prefix[length:] - self.prefix[:n]) * self.inverse[:n] + U64(length))


def text_batch(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32,
                            count=column.offset + len(column) + 1)[column.offset:].astype(np.int64) \
        if offsets is not None and len(column) else np.zeros(len(column) + 1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each; a longer text is alone in its range."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


def text_slices(batches, column: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Split Arrow batches into ``(batch, data, offsets)`` of bounded text size."""
    for batch in batches:
        data, offsets = text_batch(batch.column(batch.schema.get_field_index(column)))
        for i, j in slices(offsets):
            part = offsets[i:j + 1]
            yield batch.slice(i, j - i), data[part[0]:part[-1]], part - part[0]


def padded(data: np.ndarray, offsets: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """The same texts with ``pad`` zero bytes after each; returns data and starts."""
    n = len(offsets) - 1
    starts = offsets[:-1] + pad * np.arange(n, dtype=np.int64)
    out = np.zeros(len(data) + pad * n, dtype=np.uint8)
    lengths = np.diff(offsets)
    out[np.arange(len(data), dtype=np.int64) + np.repeat(pad * np.arange(n, dtype=np.int64), lengths)] = data
    return out, starts


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = WORD_SPACE
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text index of every maximal run of non-``space`` bytes."""
    inside = ~space[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each word."""
    return Rolling(data).at(start, end - start)


def sliding_min(values: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values, by start (length n - w + 1)."""
    have, out = 1, values
    while have < w:
        step = min(have, w - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def window_choices(laid: np.ndarray, starts: np.ndarray, n_grams: np.ndarray, n_windows: np.ndarray,
                   k: int, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, Rolling]:
    """The minimal k-gram, rightmost on ties, of the first ``n_windows`` windows of each text.

    ``laid`` holds the texts from ``starts``, each followed by at least
    ``k + w`` bytes of padding.  Returns (window starts, chosen places, k-gram
    hashes by place, rolling hash), places being offsets in ``laid``.
    """
    rolling = Rolling(laid)
    grams = rolling.windows(k)
    place = np.arange(len(grams), dtype=np.uint64)
    ranked = (grams & U64(0xFFFFFFFF00000000)) | (U64(0xFFFFFFFF) - place)
    has = n_grams > 0
    inside = np.zeros(len(grams) + 1, dtype=np.int8)
    inside[starts[has]] = 1
    np.add.at(inside, starts[has] + n_grams[has], -1)
    ranked[np.cumsum(inside[:-1]) == 0] = U64(_MASK)
    least = sliding_min(ranked, w) if len(ranked) >= w else np.empty(0, np.uint64)
    has = n_windows > 0
    mark = np.zeros(len(least) + 1, dtype=np.int8)
    mark[starts[has]] = 1
    np.add.at(mark, starts[has] + n_windows[has], -1)
    begin = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
    at = (U64(0xFFFFFFFF) - (least[begin] & U64(0xFFFFFFFF))).astype(np.int64)
    return begin, at, grams, rolling


def winnow(data: np.ndarray, offsets: np.ndarray, k: int, w: int
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray, Rolling, np.ndarray]:
    """Winnowing: the minimal k-gram of every window of ``w`` k-grams, rightmost on ties.

    Returns ``(text index, position in its text, k-gram hash)`` of the chosen
    k-grams in text order, and the rolling hash over the padded layout with
    the texts' starts in it.  A text with fewer than ``w`` k-grams has one
    window; one of fewer than ``k`` bytes has no k-gram.
    """
    laid, starts = padded(data, offsets, k + w)
    n_grams = np.maximum(np.diff(offsets) - k + 1, 0)
    n_windows = np.where(n_grams > 0, np.maximum(n_grams - w + 1, 1), 0)
    _, at, grams, rolling = window_choices(laid, starts, n_grams, n_windows, k, w)
    keep = np.ones(len(at), dtype=bool)
    keep[1:] = at[1:] != at[:-1]
    at = at[keep]
    owner = np.searchsorted(starts, at, side="right") - 1
    return owner, at - starts[owner], grams[at], rolling, starts
