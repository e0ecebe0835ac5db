"""Geodesic helpers as Column expressions (C9, C10) and 3-D cube keys.

Everything here stays JVM-side (no Python UDF) except :func:`vincenty_m`,
which is an Arrow-batched pandas UDF used only on the narrow band of pairs
where sphere and spheroid can disagree.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Fixed value: mean Earth radius (metres).
EARTH_RADIUS_M = 6371008.8
# WGS84 ellipsoid.
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
# Sphere vs. spheroid distances differ by less than this relative amount.
SPHEROID_BAND = 0.007


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine_m(lat1, lon1, lat2, lon2, radius: float = EARTH_RADIUS_M) -> Column:
    """Great-circle distance in metres between two lat/lon points (degrees)."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dphi = F.radians(_c(lat2) - _c(lat1))
    dlmb = F.radians(_c(lon2) - _c(lon1))
    h = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2 * radius) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def haversine_sql(a: str, b: str, radius: float = EARTH_RADIUS_M) -> str:
    """Same formula as SQL text (prefixes ``a``/``b`` own LAT and LON columns).

    Written in the form both Spark SQL and DuckDB accept; used by oracles.
    """
    return (f"{2 * radius!r} * asin(sqrt(least(1.0, "
            f"power(sin(radians({b}.LAT - {a}.LAT) / 2), 2) + "
            f"cos(radians({a}.LAT)) * cos(radians({b}.LAT)) * "
            f"power(sin(radians({b}.LON - {a}.LON) / 2), 2))))")


def ecef(lat, lon, radius: float = EARTH_RADIUS_M) -> tuple[Column, Column, Column]:
    """Unit-sphere-times-radius Cartesian coordinates of a lat/lon point."""
    phi, lmb = F.radians(_c(lat)), F.radians(_c(lon))
    return (F.lit(radius) * F.cos(phi) * F.cos(lmb),
            F.lit(radius) * F.cos(phi) * F.sin(lmb),
            F.lit(radius) * F.sin(phi))


def chord_for_arc(eps_m: float, radius: float = EARTH_RADIUS_M) -> float:
    """Straight-line (chord) length of a great-circle arc of ``eps_m`` metres."""
    return 2 * radius * math.sin(min(eps_m / (2 * radius), math.pi / 2))


def cube_side_for(eps_m: float, radius: float = EARTH_RADIUS_M) -> float:
    """Cube edge so that two points in one cube are certainly within ``eps_m``."""
    return chord_for_arc(eps_m, radius) / math.sqrt(3) * (1 - 1e-9)


def cube_key(x: Column, side: float) -> Column:
    return F.floor(x / F.lit(side)).cast("long")


# --------------------------------------------------------------------------
# Vincenty (1975) inverse on the WGS84 ellipsoid, vectorised with numpy.


def vincenty_np(lat1, lon1, lat2, lon2, iters: int = 200) -> np.ndarray:
    a, f = WGS84_A, WGS84_F
    b = (1 - f) * a
    L = np.radians(lon2 - lon1)
    U1 = np.arctan((1 - f) * np.tan(np.radians(lat1)))
    U2 = np.arctan((1 - f) * np.tan(np.radians(lat2)))
    sinU1, cosU1, sinU2, cosU2 = np.sin(U1), np.cos(U1), np.sin(U2), np.cos(U2)
    lam = L.copy()
    sin_sigma = cos_sigma = sigma = cos2_alpha = cos2_sm = np.zeros_like(L)
    unsettled = np.ones(len(L), dtype=bool)
    for _ in range(iters):
        sin_lam, cos_lam = np.sin(lam), np.cos(lam)
        sin_sigma = np.sqrt((cosU2 * sin_lam) ** 2 + (cosU1 * sinU2 - sinU1 * cosU2 * cos_lam) ** 2)
        cos_sigma = sinU1 * sinU2 + cosU1 * cosU2 * cos_lam
        sigma = np.arctan2(sin_sigma, cos_sigma)
        with np.errstate(invalid="ignore", divide="ignore"):
            sin_alpha = np.where(sin_sigma == 0, 0.0, cosU1 * cosU2 * sin_lam / sin_sigma)
            cos2_alpha = 1 - sin_alpha ** 2
            cos2_sm = np.where(cos2_alpha == 0, 0.0, cos_sigma - 2 * sinU1 * sinU2 / cos2_alpha)
        C = f / 16 * cos2_alpha * (4 + f * (4 - 3 * cos2_alpha))
        step = L + (1 - C) * f * sin_alpha * (
            sigma + C * sin_sigma * (cos2_sm + C * cos_sigma * (-1 + 2 * cos2_sm ** 2)))
        # a settled pair stays: further rounds for others could drive it off again
        unsettled &= ~(np.abs(step - lam) < 1e-12)
        lam = np.where(unsettled, step, lam)
        if not unsettled.any():
            break
    u2 = cos2_alpha * (a * a - b * b) / (b * b)
    A = 1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2)))
    B = u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2)))
    dsig = B * sin_sigma * (cos2_sm + B / 4 * (cos_sigma * (-1 + 2 * cos2_sm ** 2)
                                               - B / 6 * cos2_sm * (-3 + 4 * sin_sigma ** 2)
                                               * (-3 + 4 * cos2_sm ** 2)))
    out = b * A * (sigma - dsig)
    if unsettled.any():  # nearly antipodal
        out[unsettled] = _antipodal(L[unsettled], U1[unsettled], U2[unsettled])
    return out


def _antipodal(L: np.ndarray, U1: np.ndarray, U2: np.ndarray) -> np.ndarray:
    """Distances of nearly antipodal pairs, where the fixed point of the longitude does not attract.

    The longitude on the auxiliary sphere is bracketed between L and pi and
    bisected in its distance from pi, which keeps its digits.  Points that are
    opposite each other there (pi itself) are joined by the great circle whose
    azimuth makes up the rest of the longitude.
    """
    a, f = WGS84_A, WGS84_F
    b = (1 - f) * a
    L = np.abs(np.remainder(L + np.pi, 2 * np.pi) - np.pi)
    s1, k1, s2, k2 = np.sin(U1), np.cos(U1), np.sin(U2), np.cos(U2)
    slant = np.sin(U1 + U2)

    def sphere(gap):
        across, along = k2 * np.sin(gap), slant - 2 * s1 * k2 * np.sin(gap / 2) ** 2
        ss, cs = np.hypot(across, along), s1 * s2 - k1 * k2 * np.cos(gap)
        with np.errstate(invalid="ignore", divide="ignore"):
            sa = np.where(ss > 0, k1 * k2 * np.sin(gap) / ss, 0.0)
            c2a = 1 - sa ** 2
            cm = np.where(c2a > 0, cs - 2 * s1 * s2 / c2a, 0.0)
        return ss, cs, np.arctan2(ss, cs), sa, c2a, cm

    def turn(sa, c2a, ss, cs, sg, cm):
        C = f / 16 * c2a * (4 + f * (4 - 3 * c2a))
        return (1 - C) * f * sa * (sg + C * ss * (cm + C * cs * (-1 + 2 * cm ** 2)))

    low, high = np.zeros_like(L), np.pi - L  # of the gap to pi
    for _ in range(90):
        mid = (low + high) / 2
        ss, cs, sg, sa, c2a, cm = sphere(mid)
        beyond = (np.pi - mid) - L - turn(sa, c2a, ss, cs, sg, cm) > 0
        low, high = np.where(beyond, mid, low), np.where(beyond, high, mid)
    ss, cs, sg, sa, c2a, cm = sphere((low + high) / 2)
    # opposite on the sphere: no longitude below pi is enough
    opposite = (high < 1e-12) & (np.abs(slant) < 1e-12)
    azimuth = np.clip((np.pi - L) / (f * np.pi), 0.0, 1.0)
    for _ in range(50):
        c = 1 - azimuth ** 2
        C = f / 16 * c * (4 + f * (4 - 3 * c))
        azimuth = np.clip((np.pi - L) / ((1 - C) * f * np.pi), 0.0, 1.0)
    c2a = np.where(opposite, 1 - azimuth ** 2, c2a)
    ss, cs, sg = np.where(opposite, 0.0, ss), np.where(opposite, -1.0, cs), np.where(opposite, np.pi, sg)
    u2 = c2a * (a * a - b * b) / (b * b)
    A = 1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2)))
    B = u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2)))
    dsig = B * ss * (cm + B / 4 * (cs * (-1 + 2 * cm ** 2) - B / 6 * cm * (-3 + 4 * ss ** 2) * (-3 + 4 * cm ** 2)))
    return b * A * (sg - dsig)


@F.pandas_udf(DoubleType())
def vincenty_m(lat1: pd.Series, lon1: pd.Series, lat2: pd.Series, lon2: pd.Series) -> pd.Series:
    """WGS84 ellipsoidal distance in metres (Arrow batches, numpy inside)."""
    return pd.Series(vincenty_np(lat1.to_numpy(float), lon1.to_numpy(float),
                                  lat2.to_numpy(float), lon2.to_numpy(float)))


def within_eps(lat1, lon1, lat2, lon2, eps_m: float, geomodel: str = "sphere") -> Column:
    """Distance predicate ``d <= eps``.

    ``sphere``: haversine.  ``wgs84``: decide by haversine outside the band
    where the two models can disagree and call Vincenty only inside it.
    """
    hv = haversine_m(lat1, lon1, lat2, lon2)
    if geomodel == "sphere":
        return hv <= F.lit(eps_m)
    if geomodel != "wgs84":
        raise ValueError(f"unknown geomodel {geomodel!r}")
    from pyspark.sql import SparkSession

    from occuflow.session import ship_package
    active = SparkSession.getActiveSession()
    if active is not None:
        ship_package(active)
    lo, hi = eps_m * (1 - SPHEROID_BAND), eps_m * (1 + SPHEROID_BAND)
    return (F.when(hv < F.lit(lo), F.lit(True))
             .when(hv > F.lit(hi), F.lit(False))
             .otherwise(vincenty_m(_c(lat1), _c(lon1), _c(lat2), _c(lon2)) <= F.lit(eps_m)))
