"""Reprojection in closed forms, and bounds: geographic (4326), web mercator (3857) and UTM zones (326xx, 327xx)."""

from __future__ import annotations

from math import pi, sqrt

from pyspark.sql import Column
from pyspark.sql import functions as F

RADIUS, FLAT = 6378137.0, 1 / 298.257223563
N = FLAT / (2 - FLAT)
SCALE, EAST = 0.9996, 500000.0
MEAN_RADIUS = RADIUS / (1 + N) * (1 + N**2 / 4 + N**4 / 64)
ECC = 2 * sqrt(N) / (1 + N)
ALPHA = (N / 2 - 2 * N**2 / 3 + 5 * N**3 / 16, 13 * N**2 / 48 - 3 * N**3 / 5, 61 * N**3 / 240)
BETA = (N / 2 - 2 * N**2 / 3 + 37 * N**3 / 96, N**2 / 48 + N**3 / 15, 17 * N**3 / 480)
DELTA = (2 * N - 2 * N**2 / 3 - 2 * N**3, 7 * N**2 / 3 - 8 * N**3 / 5, 56 * N**3 / 15)


def _sum(parts: list[Column]) -> Column:
    out = parts[0]
    for p in parts[1:]:
        out = out + p
    return out


def to_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    return F.radians(lon) * RADIUS, F.log(F.tan(pi / 4 + F.radians(lat) / 2)) * RADIUS


def from_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    return F.degrees(x / RADIUS), F.degrees(2 * F.atan(F.exp(y / RADIUS)) - pi / 2)


def meridian(zone: int) -> float:
    return zone * 6 - 183.0


def to_utm(lon: Column, lat: Column, zone: int, south: bool = False) -> tuple[Column, Column]:
    """Transverse Mercator by the series in the third flattening."""
    s, d = F.sin(F.radians(lat)), F.radians(lon - meridian(zone))
    t = F.sinh(F.atanh(s) - ECC * F.atanh(ECC * s))
    xi, eta = F.atan2(t, F.cos(d)), F.atanh(F.sin(d) / F.sqrt(1 + t * t))
    x = eta + _sum([a * F.cos(2 * j * xi) * F.sinh(2 * j * eta) for j, a in enumerate(ALPHA, 1)])
    y = xi + _sum([a * F.sin(2 * j * xi) * F.cosh(2 * j * eta) for j, a in enumerate(ALPHA, 1)])
    return EAST + SCALE * MEAN_RADIUS * x, (1e7 if south else 0.0) + SCALE * MEAN_RADIUS * y


def from_utm(x: Column, y: Column, zone: int, south: bool = False) -> tuple[Column, Column]:
    xi0, eta0 = (y - (1e7 if south else 0.0)) / (SCALE * MEAN_RADIUS), (x - EAST) / (SCALE * MEAN_RADIUS)
    xi = xi0 - _sum([b * F.sin(2 * j * xi0) * F.cosh(2 * j * eta0) for j, b in enumerate(BETA, 1)])
    eta = eta0 - _sum([b * F.cos(2 * j * xi0) * F.sinh(2 * j * eta0) for j, b in enumerate(BETA, 1)])
    chi = F.asin(F.sin(xi) / F.cosh(eta))
    lat = chi + _sum([d * F.sin(2 * j * chi) for j, d in enumerate(DELTA, 1)])
    return meridian(zone) + F.degrees(F.atan2(F.sinh(eta), F.cos(xi))), F.degrees(lat)


def _zone(epsg: int) -> tuple[int, bool] | None:
    return (epsg % 100, epsg // 100 == 327) if epsg // 100 in (326, 327) and 1 <= epsg % 100 <= 60 else None


def reproject(x: Column, y: Column, source: int, target: int) -> tuple[Column, Column]:
    """Points from one reference system to another; an unknown one is an error."""
    for epsg in (source, target):
        if epsg not in (4326, 3857) and not _zone(epsg):
            raise ValueError(f"no closed form for EPSG:{epsg}")
    if source == target:
        return x, y
    lon, lat = (x, y) if source == 4326 else from_mercator(x, y) if source == 3857 else from_utm(x, y, *_zone(source))
    return (lon, lat) if target == 4326 else to_mercator(lon, lat) if target == 3857 else to_utm(lon, lat, *_zone(target))


def reproject_rings(rings: Column, source: int, target: int) -> Column:
    def point(p: Column) -> Column:
        x, y = reproject(p["x"], p["y"], source, target)
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(rings, lambda ring: F.transform(ring, point))


def bbox_of(rings: Column) -> Column:
    """Bounds of all points of a geometry."""
    points = F.flatten(rings)
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"), F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy"))
