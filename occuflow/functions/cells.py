"""Spatial cell indexers.

``graticule``: regular lat/lon grid, pure Column expressions (stays in
whole-stage codegen) and expressible in plain SQL, so it is the indexer the
oracle checks use.

``hex``: hexagons on an icosahedron, resolutions 0-15 with H3's cell sizes but
ids of their own (``hexgrid``); vectorised numpy in Arrow UDFs.

``h3``: the H3 library's ids when the ``h3`` package is importable on the
executors.  Encoding runs as an Arrow pandas UDF over record batches;
decoding (centroids) runs on distinct cells only.

All indexers map NULL (or NaN) coordinates to a NULL cell.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType

from occuflow.session import ship_package


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _valid(lat: Column, lon: Column) -> Column:
    return lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)


def valid_coordinates(lat="decimallatitude", lon="decimallongitude") -> Column:
    """Rows whose cell is not NULL, tested on the raw columns.

    Filter with this *before* computing cells: a filter on the derived cell
    would be pushed below the projection by inlining the whole cell
    expression.  Each coordinate stands here once (NaN is the greatest double,
    and ``coalesce`` keeps Spark from adding ``IsNotNull``): where it is itself
    an expression, each further copy is inlined in the generated loop, which
    the JVM leaves uncompiled above 8,000 bytes.
    """
    valid = [F.coalesce(_c(x).cast("double") < F.lit(float("nan")), F.lit(False)) for x in (lat, lon)]
    return valid[0] & valid[1]


@dataclass(frozen=True)
class Graticule:
    """``cells_per_degree`` × ``cells_per_degree`` cells per square degree.

    Row ``i = floor((lat + 90) * n)`` (the north pole joins the last row),
    column ``j = floor((lon + 180) * n) mod 360n`` (+180° wraps to −180°),
    id ``i * 360n + j``.  Centroid = cell centre.
    """

    cells_per_degree: int = 4
    kind: str = "graticule"

    @property
    def _cols(self) -> int:
        return 360 * self.cells_per_degree

    def cell_id(self, lat, lon) -> Column:
        lat, lon = _c(lat), _c(lon)
        n = self.cells_per_degree
        i = F.least(F.floor((lat + F.lit(90.0)) * F.lit(n)), F.lit(180 * n - 1))
        j = F.pmod(F.floor((lon + F.lit(180.0)) * F.lit(n)), F.lit(self._cols))
        return F.when(_valid(lat, lon), (i * F.lit(self._cols) + j).cast("long"))

    def cell_string(self, cell) -> Column:
        return F.lower(F.hex(_c(cell)))

    def centroid(self, cell) -> tuple[Column, Column]:
        cell = _c(cell)
        n = self.cells_per_degree
        i = F.floor(cell / F.lit(self._cols))
        j = cell - i * F.lit(self._cols)
        return ((i + F.lit(0.5)) / F.lit(n) - F.lit(90.0),
                (j + F.lit(0.5)) / F.lit(n) - F.lit(180.0))

    # SQL text of the same mapping (oracle side, DuckDB dialect).
    def cell_id_sql(self, lat: str, lon: str) -> str:
        n, cols = self.cells_per_degree, self._cols
        return (f"CASE WHEN {lat} IS NULL OR {lon} IS NULL THEN NULL ELSE CAST("
                f"least(floor(({lat} + 90.0) * {n}), {180 * n - 1}) * {cols} + "
                f"((CAST(floor(({lon} + 180.0) * {n}) AS BIGINT) % {cols}) + {cols}) % {cols}"
                f" AS BIGINT) END")

    def centroid_sql(self, cell: str) -> tuple[str, str]:
        n, cols = self.cells_per_degree, self._cols
        i = f"floor({cell} / {cols})"
        return (f"(({i} + 0.5) / {n} - 90.0)",
                f"(({cell} - {i} * {cols} + 0.5) / {n} - 180.0)")

    def cell_string_sql(self, cell: str) -> str:
        return f"lower(hex({cell}))"


@dataclass(frozen=True)
class H3Cells:
    """H3 ids from the ``h3`` package (needed on the executors)."""

    resolution: int = 6
    kind: str = "h3"

    def __post_init__(self):
        check_resolution(self.resolution)
        try:
            import h3  # noqa: F401
        except ImportError as exc:  # pragma: no cover - depends on the image
            raise ImportError("the 'h3' package is required for H3 cells") from exc

    def cell_id(self, lat, lon) -> Column:
        res = self.resolution

        @F.pandas_udf(LongType())
        def encode(la: pd.Series, lo: pd.Series) -> pd.Series:
            import h3
            out = [None if (pd.isna(a) or pd.isna(b)) else
                   h3.str_to_int(h3.latlng_to_cell(float(a), float(b), res))
                   for a, b in zip(la, lo)]
            return pd.Series(out, dtype="Int64")

        return encode(_c(lat), _c(lon))

    def cell_string(self, cell) -> Column:
        return F.lower(F.hex(_c(cell)))

    def centroid(self, cell) -> tuple[Column, Column]:
        @F.pandas_udf(DoubleType())
        def lat_of(c: pd.Series) -> pd.Series:
            import h3
            return pd.Series([h3.cell_to_latlng(h3.int_to_str(int(v)))[0] for v in c])

        @F.pandas_udf(DoubleType())
        def lon_of(c: pd.Series) -> pd.Series:
            import h3
            return pd.Series([h3.cell_to_latlng(h3.int_to_str(int(v)))[1] for v in c])

        return lat_of(_c(cell)), lon_of(_c(cell))


@dataclass(frozen=True)
class HexCells:
    """Icosahedral hexagons (``hexgrid``); about the size of H3 cells of the resolution."""

    resolution: int = 6
    kind: str = "hex"

    def __post_init__(self):
        check_resolution(self.resolution)

    def cell_id(self, lat, lon) -> Column:
        res = self.resolution

        @F.pandas_udf(LongType())
        def encode(la: pd.Series, lo: pd.Series) -> pd.Series:
            from occuflow.functions import hexgrid

            ok = (la.notna() & lo.notna()).to_numpy()
            out = pd.array([None] * len(la), dtype="Int64")
            if ok.any():
                out[ok] = hexgrid.encode(la.to_numpy(float)[ok], lo.to_numpy(float)[ok], res)
            return pd.Series(out)

        lat, lon = _c(lat), _c(lon)
        return F.when(_valid(lat, lon), encode(lat, lon))

    def cell_string(self, cell) -> Column:
        return F.lower(F.hex(_c(cell)))

    def centroid(self, cell) -> tuple[Column, Column]:
        @F.pandas_udf("lat double, lon double")
        def centre(c: pd.Series) -> pd.DataFrame:
            from occuflow.functions import hexgrid

            lat, lon = hexgrid.decode(c.to_numpy())
            return pd.DataFrame({"lat": lat, "lon": lon})

        both = centre(_c(cell))
        return both["lat"], both["lon"]


def check_resolution(res) -> int:
    """H3 resolution must be an integer 0-15."""
    if isinstance(res, bool) or not isinstance(res, int) or not 0 <= res <= 15:
        raise ValueError("H3 resolution must be an integer between 0 and 15")
    return res


def make_indexer(kind: str = "graticule", resolution: int | None = None,
                 cells_per_degree: int | None = None):
    if kind == "graticule":
        return Graticule(cells_per_degree or 4)
    if kind == "hex":
        return HexCells(6 if resolution is None else resolution)
    if kind == "h3":
        return H3Cells(6 if resolution is None else resolution)
    raise ValueError(f"unknown cell kind {kind!r}")


def with_cells(df, indexer, lat: str = "decimallatitude", lon: str = "decimallongitude",
               out: str = "cell"):
    """Add ``out`` (cell id) to ``df``.  UDF-backed indexers need the package on the workers.

    Graticule cells are Column expressions inside codegen.  UDF-backed
    indexers run per record inside Arrow batches: joining ids back from the
    distinct coordinates would shuffle every record, which costs more than
    the encoding at scale.  Centroids are only computed after a dedupe.
    """
    if indexer.kind != "graticule":
        ship_package(df.sparkSession)
    return df.withColumn(out, indexer.cell_id(lat, lon))
