"""Hexagonal cells on an icosahedron, resolutions 0-15 (after Sahr, White & Kimerling 2003).

Each icosahedron face carries, in its gnomonic plane, the hexagonal lattice in
which the face's edge is the Eisenstein integer ``E_r``: ``E_0 = 2 + 2w`` and
each resolution multiplies by an element of norm 7 (aperture 7; the two
conjugates alternate so the turn does not build up).  The vertices are lattice
points, so the lattice continues across every edge; there are
``2 + 10 * |E_r|^2 = 2 + 120 * 7^r`` cells, twelve of them pentagons around the
vertices.

A cell's name is its centre on the lowest-numbered face that is nearest to the
centre: 4 bits of resolution, 5 of face, and the two lattice coordinates.
These ids are not H3 ids.

Everything is vectorised numpy; ``HexCells`` in ``cells`` wraps it in Arrow
UDFs.
"""

from __future__ import annotations

import numpy as np

_W = complex(0.5, np.sqrt(3) / 2)  # 60 degrees: lattice basis is 1, w
_BITS = 27
_HALF = 1 << (_BITS - 1)


def _icosahedron() -> tuple[np.ndarray, np.ndarray]:
    """Unit vertices and the 20 faces, counter-clockwise from outside."""
    lat = np.arctan(0.5)
    ring = [(lat, 2 * np.pi * i / 5) for i in range(5)] + [(-lat, 2 * np.pi * (i + 0.5) / 5) for i in range(5)]
    v = [(0.0, 0.0, 1.0)] + [(np.cos(a) * np.cos(b), np.cos(a) * np.sin(b), np.sin(a)) for a, b in ring] + [(0.0, 0.0, -1.0)]
    f = []
    for i in range(5):
        j = (i + 1) % 5
        f += [(0, 1 + i, 1 + j), (1 + i, 6 + i, 1 + j), (1 + j, 6 + i, 6 + j), (11, 6 + j, 6 + i)]
    return np.array(v), np.array(f)


_VERTICES, _FACES = _icosahedron()
_CORNERS = _VERTICES[_FACES]  # face, corner, xyz
_CENTRES = _CORNERS.sum(axis=1)
_CENTRES /= np.linalg.norm(_CENTRES, axis=1, keepdims=True)
# Plane axes of a face: u towards its first corner, v a quarter turn to the left.
_U = _CORNERS[:, 0] - (_CORNERS[:, 0] * _CENTRES).sum(axis=1, keepdims=True) * _CENTRES
_U /= np.linalg.norm(_U, axis=1, keepdims=True)
_V = np.cross(_CENTRES, _U)
_RADIUS = float(np.tan(np.arccos((_CORNERS[0, 0] * _CENTRES[0]).sum())))
_CORNER0 = complex(_RADIUS, 0.0)
_EDGE = _RADIUS * (np.exp(2j * np.pi / 3) - 1)  # first corner to second, in every face


def edge_in_lattice(res: int) -> complex:
    """The face edge as a lattice vector: norm 12 * 7 ** res."""
    e = 2 + 2 * _W
    for r in range(res):
        e *= (2 + _W) if r % 2 == 0 else (3 - _W)
    return e


def _unit(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    a, b = np.radians(lat), np.radians(lon)
    return np.stack([np.cos(a) * np.cos(b), np.cos(a) * np.sin(b), np.sin(a)], axis=-1)


def _nearest_face(p: np.ndarray) -> np.ndarray:
    """Lowest-numbered of the nearest faces (points on an edge have several)."""
    dots = p @ _CENTRES.T
    return np.argmax(dots >= dots.max(axis=1, keepdims=True) - 1e-11, axis=1)


def _lattice(p: np.ndarray, face: np.ndarray, step: complex) -> tuple[np.ndarray, np.ndarray]:
    """Nearest lattice point (a, b) of unit vectors in a face's plane."""
    depth = (p * _CENTRES[face]).sum(axis=1)
    z = ((p * _U[face]).sum(axis=1) + 1j * (p * _V[face]).sum(axis=1)) / depth
    q = (z - _CORNER0) / step
    b = q.imag / _W.imag
    a = q.real - b * _W.real
    c = -a - b
    ra, rb, rc = np.rint(a), np.rint(b), np.rint(c)
    da, db, dc = abs(ra - a), abs(rb - b), abs(rc - c)
    fix_a = (da > db) & (da > dc)
    fix_b = ~fix_a & (db > dc)
    return (np.where(fix_a, -rb - rc, ra).astype(np.int64), np.where(fix_b, -ra - rc, rb).astype(np.int64))


def _centre(face: np.ndarray, a: np.ndarray, b: np.ndarray, step: complex) -> np.ndarray:
    z = _CORNER0 + step * (a + b * _W)
    p = _CENTRES[face] + z.real[:, None] * _U[face] + z.imag[:, None] * _V[face]
    return p / np.linalg.norm(p, axis=1, keepdims=True)


def encode(lat: np.ndarray, lon: np.ndarray, res: int) -> np.ndarray:
    """Cell ids of coordinates in degrees."""
    step = _EDGE / edge_in_lattice(res)
    lon = np.asarray(lon, dtype=float)
    p = _unit(np.asarray(lat, dtype=float), np.where(lon == -180.0, 180.0, lon))
    for _ in range(2):  # the point's face, then the face its cell's centre belongs to
        face = _nearest_face(p)
        a, b = _lattice(p, face, step)
        p = _centre(face, a, b, step)
    home = _nearest_face(p)
    moved = home != face
    if moved.any():
        face = home
        a2, b2 = _lattice(p, face, step)
        a, b = np.where(moved, a2, a), np.where(moved, b2, b)
    return ((np.int64(res) << np.int64(5 + 2 * _BITS)) | (face.astype(np.int64) << np.int64(2 * _BITS))
            | ((a + _HALF) << np.int64(_BITS)) | (b + _HALF))


def decode(cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centre (latitude, longitude in degrees) of cell ids."""
    cell = np.asarray(cell, dtype=np.int64)
    res = cell >> (5 + 2 * _BITS)
    face = (cell >> (2 * _BITS)) & 31
    mask = (1 << _BITS) - 1
    a, b = ((cell >> _BITS) & mask) - _HALF, (cell & mask) - _HALF
    p = np.zeros((len(cell), 3))
    for r in np.unique(res):
        at = res == r
        p[at] = _centre(face[at], a[at], b[at], _EDGE / edge_in_lattice(int(r)))
    return np.degrees(np.arcsin(np.clip(p[:, 2], -1, 1))), np.degrees(np.arctan2(p[:, 1], p[:, 0]))
