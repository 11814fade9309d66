"""Geodesy and planar geometry as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0

# GRS80 ellipsoid and the UTM zone 30N grid (EPSG:25830).
_A, _F = 6_378_137.0, 1 / 298.257222101
_K0, _E0, _LON0 = 0.9996, 500_000.0, -3.0
_N = _F / (2 - _F)
_RADIUS = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
)
_BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840,
    4397 * _N**4 / 161280,
)
_DELTA = (
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45,
    7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45,
    56 * _N**3 / 15 - 136 * _N**4 / 35,
    4279 * _N**4 / 630,
)
_E = 2 * math.sqrt(_N) / (1 + _N)


def _sum(terms: list[Column]) -> Column:
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def utm_forward(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Easting and northing in UTM 30N of WGS84 degrees (Krüger series to n^4)."""
    phi, lam = F.radians(lat), F.radians(lon - F.lit(_LON0))
    t = F.sinh(F.atanh(F.sin(phi)) - _E * F.atanh(_E * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    east = eta + _sum([a * F.cos(2 * j * xi) * F.sinh(2 * j * eta) for j, a in enumerate(_ALPHA, 1)])
    north = xi + _sum([a * F.sin(2 * j * xi) * F.cosh(2 * j * eta) for j, a in enumerate(_ALPHA, 1)])
    return _E0 + _K0 * _RADIUS * east, _K0 * _RADIUS * north


def utm_inverse(x: Column, y: Column) -> tuple[Column, Column]:
    """Longitude and latitude of UTM 30N coordinates."""
    xi, eta = y / (_K0 * _RADIUS), (x - _E0) / (_K0 * _RADIUS)
    a = xi - _sum([b * F.sin(2 * j * xi) * F.cosh(2 * j * eta) for j, b in enumerate(_BETA, 1)])
    b_ = eta - _sum([b * F.cos(2 * j * xi) * F.sinh(2 * j * eta) for j, b in enumerate(_BETA, 1)])
    chi = F.asin(F.sin(a) / F.cosh(b_))
    phi = chi + _sum([d * F.sin(2 * j * chi) for j, d in enumerate(_DELTA, 1)])
    return F.lit(_LON0) + F.degrees(F.atan2(F.sinh(b_), F.cos(a))), F.degrees(phi)


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    h = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2)
    return 2 * EARTH_M * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def bearing_deg(dx: Column, dy: Column) -> Column:
    """Clockwise from north, in [0, 360)."""
    return F.pmod(F.degrees(F.atan2(dx, dy)) + 360, F.lit(360.0))


def angular_diff(a: Column, b: Column) -> Column:
    d = F.pmod(F.abs(a - b), F.lit(360.0))
    return F.least(d, 360 - d)


def direction_score(diff: Column, moving: Column, segment_m: Column) -> Column:
    return F.when(moving & (segment_m > 0.1), F.least(F.lit(1.0), F.least(diff, F.lit(180.0)) / 90)).otherwise(F.lit(0.0))


def planar(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt(F.pow(x1 - x2, 2) + F.pow(y1 - y2, 2))


def project_on_segment(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> tuple[Column, Column, Column]:
    """Nearest point of a segment and its distance; a segment of squared length under 1e-12 is its start."""
    dx, dy = bx - ax, by - ay
    length = dx * dx + dy * dy
    t = F.when(length < 1e-12, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - ax) * dx + (py - ay) * dy) / length)))
    qx, qy = ax + t * dx, ay + t * dy
    return qx, qy, planar(px, py, qx, qy)
