"""DuckDB text of the hexagons and the WGS84 distance, for the oracles of runs at their defaults.

Both state the arithmetic of ``functions.hexgrid`` and ``functions.geo`` row by
row: the faces of the icosahedron are a table, the geodesic iteration is a chain
of tables.
"""

from __future__ import annotations

from occuflow.functions import hexgrid
from occuflow.functions.geo import WGS84_A, WGS84_F, haversine_sql


def face_ctes() -> list[str]:
    """``face(face, c0.., u0.., v0..)``: centre and plane axes of the 20 faces."""
    rows = ", ".join("(" + ", ".join([str(i), *[f"CAST({x!r} AS DOUBLE)" for axis in (hexgrid._CENTRES, hexgrid._U, hexgrid._V)
                                                for x in map(float, axis[i])]]) + ")" for i in range(20))
    return [f"face AS (SELECT * FROM (VALUES {rows}) t(face, c0, c1, c2, u0, u1, u2, v0, v1, v2))"]


def hex_ctes(name: str, source: str, res: int, lat: str = "decimallatitude", lon: str = "decimallongitude") -> list[str]:
    """``<name>(lat, lon, cell, clat, clon)``: the cell of every coordinate of ``source``, its id and centre."""
    step = hexgrid._EDGE / hexgrid.edge_in_lattice(res)
    back = 1 / step
    w = hexgrid._W
    lit = lambda x: f"CAST({float(x)!r} AS DOUBLE)"
    ctes = [f"""{name}_p0 AS (SELECT lat, lon, cos(a) * cos(b) AS x, cos(a) * sin(b) AS y, sin(a) AS z FROM (
    SELECT DISTINCT {lat} AS lat, {lon} AS lon, radians({lat}) AS a, radians(CASE WHEN {lon} = -180.0 THEN 180.0 ELSE {lon} END) AS b
    FROM {source} WHERE {lat} IS NOT NULL AND {lon} IS NOT NULL))"""]
    for i in range(3):  # the point's face, that of its cell's centre, and the centre's name there
        ctes.append(f"""{name}_f{i} AS (SELECT lat, lon, x, y, z, min(face) AS face FROM (
    SELECT *, max(dot) OVER (PARTITION BY lat, lon) AS most FROM (
      SELECT p.lat, p.lon, p.x, p.y, p.z, f.face, x * c0 + y * c1 + z * c2 AS dot FROM {name}_p{i} p, face f))
  WHERE dot >= most - 1e-11 GROUP BY lat, lon, x, y, z)""")
        ctes.append(f"""{name}_l{i} AS (SELECT *, qi / {lit(w.imag)} AS b, qr - qi / {lit(w.imag)} * {lit(w.real)} AS a FROM (
    SELECT *, zr * {lit(back.real)} - zi * {lit(back.imag)} AS qr, zr * {lit(back.imag)} + zi * {lit(back.real)} AS qi FROM (
      SELECT p.*, f.* EXCLUDE (face), (x * u0 + y * u1 + z * u2) / (x * c0 + y * c1 + z * c2) - {lit(hexgrid._CORNER0.real)} AS zr,
        (x * v0 + y * v1 + z * v2) / (x * c0 + y * c1 + z * c2) AS zi FROM {name}_f{i} p JOIN face f USING (face))))""")
        ctes.append(f"""{name}_n{i} AS (SELECT *, CASE WHEN da > db AND da > dc THEN -rb - rc ELSE ra END AS na,
    CASE WHEN NOT (da > db AND da > dc) AND db > dc THEN -ra - rc ELSE rb END AS nb FROM (
      SELECT *, abs(ra - a) AS da, abs(rb - b) AS db, abs(rc + a + b) AS dc FROM (
        SELECT *, round_even(a, 0) AS ra, round_even(b, 0) AS rb, round_even(-a - b, 0) AS rc FROM {name}_l{i})))""")
        ctes.append(f"""{name}_p{i + 1} AS (SELECT lat, lon, face, na, nb, px / len AS x, py / len AS y, pz / len AS z FROM (
    SELECT *, sqrt(px * px + py * py + pz * pz) AS len FROM (
      SELECT *, c0 + mr * u0 + mi * v0 AS px, c1 + mr * u1 + mi * v1 AS py, c2 + mr * u2 + mi * v2 AS pz FROM (
        SELECT *, {lit(hexgrid._CORNER0.real)} + {lit(step.real)} * (na + nb * {lit(w.real)}) - {lit(step.imag)} * (nb * {lit(w.imag)}) AS mr,
          {lit(step.real)} * (nb * {lit(w.imag)}) + {lit(step.imag)} * (na + nb * {lit(w.real)}) AS mi FROM {name}_n{i}))))""")
    half = hexgrid._HALF
    bits = hexgrid._BITS
    ctes.append(f"""{name} AS (SELECT lat, lon, degrees(asin(z)) AS clat, degrees(atan2(y, x)) AS clon,
    ({res}::BIGINT << {5 + 2 * bits}) + (face::BIGINT << {2 * bits}) + ((na::BIGINT + {half}) << {bits}) + nb::BIGINT + {half} AS cell
  FROM {name}_p3)""")
    return ctes


def vincenty_ctes(name: str, pairs: str, rounds: int = 12) -> list[str]:
    """``<name>``: ``pairs`` (la1, lo1, la2, lo2 and what else) with ``metres`` on the spheroid.

    ``rounds`` settle every pair that is not close to antipodal.
    """
    f, b = WGS84_F, (1 - WGS84_F) * WGS84_A
    reduced = lambda c: f"atan({1 - f!r} * tan(radians({c})))"
    ctes = [f"""{name}_0 AS (SELECT *, radians(lo2 - lo1) AS dl, radians(lo2 - lo1) AS lam, sin({reduced('la1')}) AS s1,
    cos({reduced('la1')}) AS k1, sin({reduced('la2')}) AS s2, cos({reduced('la2')}) AS k2 FROM {pairs})"""]
    sphere = """SELECT *, sqrt(pow(k2 * sin(lam), 2) + pow(k1 * s2 - s1 * k2 * cos(lam), 2)) AS ss, s1 * s2 + k1 * k2 * cos(lam) AS cs FROM {src}"""
    angles = """SELECT *, atan2(ss, cs) AS sg, CASE WHEN ss = 0 THEN 0.0 ELSE k1 * k2 * sin(lam) / ss END AS sa FROM ({src})"""
    middle = """SELECT *, 1 - sa * sa AS c2a, CASE WHEN 1 - sa * sa = 0 THEN 0.0 ELSE cs - 2 * s1 * s2 / (1 - sa * sa) END AS cm FROM ({src})"""
    full = lambda src: middle.format(src=angles.format(src=sphere.format(src=src)))
    for i in range(rounds):
        ctes.append(f"""{name}_{i + 1} AS (SELECT * EXCLUDE (lam, ss, cs, sg, sa, c2a, cm, c),
    dl + (1 - c) * {f!r} * sa * (sg + c * ss * (cm + c * cs * (-1 + 2 * cm * cm))) AS lam
  FROM (SELECT *, {f / 16!r} * c2a * (4 + {f!r} * (4 - 3 * c2a)) AS c FROM ({full(f'{name}_{i}')})))""")
    a2, b2 = WGS84_A * WGS84_A, b * b
    ctes.append(f"""{name} AS (SELECT * EXCLUDE (dl, lam, s1, k1, s2, k2, ss, cs, sg, sa, c2a, cm, u2, big_a, big_b),
    {b!r} * big_a * (sg - big_b * ss * (cm + big_b / 4 * (cs * (-1 + 2 * cm * cm)
      - big_b / 6 * cm * (-3 + 4 * ss * ss) * (-3 + 4 * cm * cm)))) AS metres
  FROM (SELECT *, 1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2))) AS big_a,
      u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2))) AS big_b
    FROM (SELECT *, c2a * {(a2 - b2) / b2!r} AS u2 FROM ({full(f'{name}_{rounds}')}))))""")
    return ctes


def near_pairs_cte(name: str, points: str, most_m: float) -> str:
    """Pairs of a species' points that the sphere puts within ``most_m``, itself left out."""
    return f"""{name} AS (SELECT a.Species, a.H3 AS a, b.H3 AS b, a.LAT AS la1, a.LON AS lo1, b.LAT AS la2, b.LON AS lo2
  FROM {points} a JOIN {points} b ON a.Species = b.Species AND a.H3 <> b.H3 AND {haversine_sql('a', 'b')} <= {most_m!r})"""


def noise_ctes(points: str, eps_m: float, minpts: int, name: str = "scored") -> list[str]:
    """DBSCAN noise on the spheroid from literal pairs."""
    return [
        near_pairs_cte(f"{name}_near", points, eps_m * 1.01),
        *vincenty_ctes(f"{name}_geo", f"{name}_near"),
        f"{name}_pair AS (SELECT Species, a, b FROM {name}_geo WHERE metres <= {eps_m!r})",
        f"""{name}_core AS (SELECT p.Species, p.H3 FROM {points} p LEFT JOIN {name}_pair q ON q.Species = p.Species AND q.a = p.H3
  GROUP BY p.Species, p.H3 HAVING count(q.b) + 1 >= {minpts})""",
        f"""{name} AS (SELECT p.*, CAST(CASE WHEN k.H3 IS NULL AND r.a IS NULL THEN 1.0 ELSE 0.0 END AS DOUBLE) AS OutlierScore
  FROM {points} p LEFT JOIN {name}_core k ON k.Species = p.Species AND k.H3 = p.H3
  LEFT JOIN (SELECT DISTINCT q.Species, q.a FROM {name}_pair q JOIN {name}_core c ON c.Species = q.Species AND c.H3 = q.b) r
    ON r.Species = p.Species AND r.a = p.H3)""",
    ]
