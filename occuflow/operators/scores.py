"""One entry point for the outlier scores, by the names users know them by.

``outlier_scores`` checks the method, its parameters and the Earth model, and
returns (H3Index, Species, OutlierScore).  Methods that are not built raise
``NotImplementedError`` with the reason.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from occuflow.operators import density, hierarchy, knn, models

# Earth model names and what they compute here.  The two
# spherical formulas give the same distance.
GEOMODELS = {
    "WGS84SpheroidEarthModel": "wgs84",
    "SphericalVincentyEarthModel": "sphere",
    "SphericalHaversineEarthModel": "sphere",
    "wgs84": "wgs84",
    "sphere": "sphere",
}


@dataclass(frozen=True)
class Method:
    """How to run a score and which of k, d and the attribute column it needs."""

    run: Callable[..., DataFrame]
    needs: tuple[str, ...] = ("k",)


def _on_neighbours(fn, **fixed) -> Method:
    return Method(lambda p, k, d, attr, geo: fn(p, k, geomodel=geo, **fixed))


def _on_attribute(fn) -> Method:
    return Method(lambda p, k, d, attr, geo: fn(p, k, attr, geomodel=geo), ("k", "attr"))


# Shifted box hierarchies of aLOCI.
ALOCI_GRIDS = 4

METHODS: dict[str, Method] = {
    "LOF": _on_neighbours(knn.lof),
    "SimplifiedLOF": _on_neighbours(knn.lof, simplified=True),
    "SimpleKernelDensityLOF": _on_neighbours(knn.kernel_density_lof),
    "COF": _on_neighbours(knn.cof),
    "INFLO": _on_neighbours(knn.inflo),
    "LDOF": _on_neighbours(knn.ldof),
    "LoOP": _on_neighbours(knn.loop),
    "VarianceOfVolume": _on_neighbours(knn.variance_of_volume),
    "KNNOutlier": _on_neighbours(knn.knn_outlier),
    "KNNWeightOutlier": _on_neighbours(knn.knn_weight),
    "KNNDD": _on_neighbours(knn.knndd),
    "KNNSOS": _on_neighbours(knn.knn_sos),
    "ODIN": _on_neighbours(knn.odin),
    "LocalIsolationCoefficient": _on_neighbours(knn.local_isolation),
    # the reference fixes five neighbours here
    "SimpleCOP": Method(lambda p, k, d, attr, geo: knn.simple_cop(p, 5, geomodel=geo), ()),
    "DBOutlierScore": Method(lambda p, k, d, attr, geo: density.db_outlier_score(p, d, geomodel=geo), ("d",)),
    "DBSCANOutlierDetection": Method(
        lambda p, k, d, attr, geo: density.dbscan_noise(p, d, k, geomodel=geo), ("k", "d")),
    "GLOSH": _on_neighbours(hierarchy.glosh),
    "COP": _on_neighbours(knn.cop),
    "DWOF": _on_neighbours(hierarchy.dwof),
    "EMOutlier": Method(lambda p, k, d, attr, geo: models.em_outlier(p, k)),
    "KMeansMinusMinusOutlierDetection": Method(
        lambda p, k, d, attr, geo: models.kmeans_minus_minus(p, k, k)),
    "ALOCI": Method(lambda p, k, d, attr, geo: models.aloci(p, grids=ALOCI_GRIDS), ()),
    "SLOM": _on_attribute(knn.slom),
    "SOF": _on_attribute(knn.sof),
    "CTLuScatterplotOutlier": _on_attribute(knn.scatterplot_outlier),
    "TrivialAverageCoordinateOutlier": Method(lambda p, k, d, attr, geo: knn.trivial_average(p), ()),
    "IsolationForest": Method(lambda p, k, d, attr, geo: models.isolation_forest(p), ()),
    "HySortOD": Method(lambda p, k, d, attr, geo: models.hysortod(p), ()),
}

NOT_BUILT = {
    "SOS": "needs every pair of a species; KNNSOS is the scalable form",
    "OPTICSOF": "the OPTICS order is sequential; the density sweep covers its cuts",
    "LOCI": "needs every pair of a species; ALOCI is the scalable form",
    "FlexibleLOF": "not run by the reference", "KDEOS": "not run by the reference",
    "LDF": "not run by the reference", "KMeansOutlierDetection": "not run by the reference",
}


def outlier_scores(cells: DataFrame, method: str, k: int | None = None, d: float | None = None,
                   geomodel: str = "wgs84", attr: str | None = None) -> DataFrame:
    """Score cells (LAT, LON, H3, Species) by a named method.

    Iterative methods also say whether a species' fit has ``converged``.

    ``k``: neighbours, components or minimum points; ``d``: distance in
    metres; ``attr``: the column the attribute scores compare.
    """
    if method in NOT_BUILT:
        raise NotImplementedError(f"{method}: {NOT_BUILT[method]}")
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}; known: {', '.join(sorted(METHODS))}")
    if geomodel not in GEOMODELS:
        raise ValueError(f"unknown Earth model {geomodel!r}; known: {', '.join(GEOMODELS)}")
    m = METHODS[method]
    given = {"k": k, "d": d, "attr": attr}
    for name in m.needs:
        if given[name] is None:
            raise ValueError(f"{method} needs {name}")
    if k is not None and (isinstance(k, bool) or int(k) != k or k < 1):
        raise ValueError("k must be a positive integer")
    if d is not None and not d > 0:
        raise ValueError("d must be a positive distance in metres")
    out = m.run(cells, k, d, attr, GEOMODELS[geomodel])
    told = [c for c in ("converged",) if c in out.columns]
    return out.select(F.col("H3").alias("H3Index"), "Species", "OutlierScore", *told)
