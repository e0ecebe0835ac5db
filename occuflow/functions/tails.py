"""Tail probabilities of the gamma and chi-square distributions as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lanczos coefficients (g = 7).
LANCZOS = (0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
           12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7)
STEPS = 200  # of a series or a continued fraction; enough for shapes up to 100
_TINY = 1e-300


def log_gamma(a: Column) -> Column:
    """ln Gamma(a) for a > 0, as ln Gamma(a + 1) - ln a."""
    series = F.lit(LANCZOS[0])
    for i, c in enumerate(LANCZOS[1:], start=1):
        series = series + F.lit(c) / (a + F.lit(float(i)))
    t = a + F.lit(7.5)
    return F.lit(0.5 * math.log(2 * math.pi)) + (a + F.lit(0.5)) * F.log(t) - t + F.log(series) - F.log(a)


def gamma_tail(shape: Column, x: Column) -> Column:
    """Q(shape, x): the share of a gamma distribution (scale 1) above ``x``.

    A power series below the shape, a continued fraction (modified Lentz)
    above; both inside an ``aggregate`` over a constant number of steps.
    """
    steps = F.sequence(F.lit(1), F.lit(STEPS))
    first = F.struct((1.0 / shape).alias("term"), (1.0 / shape).alias("sum"))

    def add(s, i):
        term = s["term"] * x / (shape + i)
        return F.struct(term.alias("term"), (s["sum"] + term).alias("sum"))

    low = F.aggregate(steps, first, add, lambda s: s["sum"])
    b0 = x + 1.0 - shape
    start = F.struct(F.lit(1.0 / _TINY).alias("c"), (1.0 / b0).alias("d"), (1.0 / b0).alias("h"))

    def lentz(s, i):
        an, b = -i * (i - shape), b0 + 2.0 * i
        d = 1.0 / (an * s["d"] + b)
        c = b + an / s["c"]
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * c * d).alias("h"))

    high = F.aggregate(steps, start, lentz, lambda s: s["h"])
    front = F.exp(-x + shape * F.log(x) - log_gamma(shape))
    return (F.when(x <= 0, F.lit(1.0)).when(x < shape + 1.0, F.greatest(1.0 - front * low, F.lit(0.0)))
             .otherwise(F.least(front * high, F.lit(1.0))))


def chi_square_tail(degrees: int, x: Column) -> Column:
    """Share of a chi-square distribution above ``x``."""
    if degrees == 2:
        return F.exp(-F.greatest(x, F.lit(0.0)) / 2.0)
    return gamma_tail(F.lit(degrees / 2.0), x / 2.0)


def gamma_tail_sql(shape: str, x: str) -> str:
    """The same for DuckDB."""
    low = (f"list_reduce(list_transform(range(0, {STEPS + 1}), lambda i: struct_pack(i := i::DOUBLE, term := 1.0 / {shape}, total := 1.0 / {shape})), "
           f"lambda s, e: struct_pack(i := e.i, term := s.term * {x} / ({shape} + e.i), total := s.total + s.term * {x} / ({shape} + e.i))).total")
    b0 = f"({x} + 1.0 - {shape})"
    d = f"(1.0 / (-e.i * (e.i - {shape}) * s.d + {b0} + 2.0 * e.i))"
    c = f"({b0} + 2.0 * e.i - e.i * (e.i - {shape}) / s.c)"
    high = (f"list_reduce(list_transform(range(0, {STEPS + 1}), lambda i: struct_pack(i := i::DOUBLE, c := {1 / _TINY!r}, d := 1.0 / {b0}, h := 1.0 / {b0})), "
            f"lambda s, e: struct_pack(i := e.i, c := {c}, d := {d}, h := s.h * {c} * {d})).h")
    front = f"exp(-{x} + {shape} * ln({x}) - lgamma({shape}))"
    return (f"CASE WHEN {x} <= 0 THEN 1.0 WHEN {x} < {shape} + 1.0 THEN greatest(1.0 - {front} * {low}, 0.0) "
            f"ELSE least({front} * {high}, 1.0) END")
