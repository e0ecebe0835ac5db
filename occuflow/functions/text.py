"""Scalar helpers on names, numbers and coordinate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_half_away(x, digits: int) -> Column:
    """``round(x * 10^d) / 10^d`` on doubles (half away from zero).

    Spark's ``round`` rounds the *decimal rendering* of a double (1.005 →
    1.01) while the reference rounds the binary value (1.005 → 1.0).  Scaling
    first makes both agree; the scaled value's rendering only ends in .5 when
    the double is exactly .5.
    """
    m = float(10 ** digits)
    return F.round(_c(x) * F.lit(m), 0) / F.lit(m)


def rounded_text(x, digits: int = 2) -> Column:
    """Text of ``round_half_away(x, d)`` with the sign of zero preserved.

    A value in (−0.005, 0] rounds to −0.0, which the reference renders as
    ``-0.0``; Spark's rounding yields +0.0, so the sign is restored here.
    """
    x = _c(x)
    r = round_half_away(x, digits)
    return (F.when((r == 0) & x.cast("string").startswith("-"), F.lit("-0.0"))
             .otherwise(r.cast("string")))


def coordinate_key(lat, lon, mode: str = "concat") -> Column:
    """Key for counting distinct rounded coordinates.

    ``concat`` reproduces the reference exactly, including its lack of a
    separator ((1.1, 10.1) and (1.11, 0.1) collide).  ``pair`` keeps the two
    numbers apart.
    """
    if mode == "concat":
        return F.concat(rounded_text(lat), rounded_text(lon))
    if mode == "pair":
        return F.concat_ws("|", rounded_text(lat), rounded_text(lon))
    raise ValueError(f"unknown coordinate key mode {mode!r}")


def tip_to_species(tip) -> Column:
    """Tree tip label → species name: first underscore becomes a space."""
    return F.regexp_replace(_c(tip), r"^([^_]*)_", "$1 ")


def normalize_name(name, collapse: bool = True) -> Column:
    """File-safe species name.

    ``collapse=True`` collapses each run of non-alphanumerics to one ``_``;
    ``False`` replaces them one for one.
    """
    pattern = r"[^a-zA-Z0-9]+" if collapse else r"[^a-zA-Z0-9]"
    return F.regexp_replace(_c(name), pattern, "_")


def file_stem(path) -> Column:
    """Basename without directory and a trailing ``.txt``."""
    base = F.regexp_extract(_c(path), r"([^/]*)$", 1)
    return F.regexp_replace(base, r"\.txt$", "")


def percent(a, b, digits: int = 2) -> Column:
    """``round(a / b * 100, digits)``; NULL when ``b`` is 0 (C11)."""
    return round_half_away(F.try_divide(_c(a).cast("double"), _c(b).cast("double")) * F.lit(100.0),
                           digits)
