"""Bounds, footprints, areas, overlaps and projections.

Boxes are columns l, b, r, t; rings are ``array<struct<lon,lat>>``.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# WGS84 (fixed values).
A, FLATTENING = 6378137.0, 1 / 298.257223563
E2 = FLATTENING * (2 - FLATTENING)
#: Standard parallel of the equal-area grid, in degrees.
PARALLEL = 30.0


def ring_bounds(ring: Column) -> Column:
    lon, lat = F.transform(ring, lambda p: p["lon"]), F.transform(ring, lambda p: p["lat"])
    l, b, r, t = F.array_min(lon), F.array_min(lat), F.array_max(lon), F.array_max(lat)
    return F.struct(l.alias("l"), b.alias("b"), r.alias("r"), t.alias("t"), ((l + r) / 2).alias("cx"), ((b + t) / 2).alias("cy"))


def box_ring(l: Column, b: Column, r: Column, t: Column) -> Column:
    p = lambda x, y: F.struct(x.alias("lon"), y.alias("lat"))
    return F.array(p(l, b), p(r, b), p(r, t), p(l, t), p(l, b))


def intersect(a: tuple, b: tuple) -> tuple[Column, Column, Column, Column, Column]:
    """(l, b, r, t, empty) of two boxes; touching boxes are empty."""
    l, lo = F.greatest(a[0], b[0]), F.greatest(a[1], b[1])
    r, hi = F.least(a[2], b[2]), F.least(a[3], b[3])
    return l, lo, r, hi, (r <= l) | (hi <= lo)


def box_overlap(a: tuple, b: tuple) -> Column:
    """Share of box a that box b covers, by equal-area size."""
    l, lo, r, hi, empty = intersect(a, b)
    size = lambda w, s, e, n: (equal_area(e, n)[0] - equal_area(w, s)[0]) * (equal_area(e, n)[1] - equal_area(w, s)[1])
    return F.when(empty, F.lit(0.0)).otherwise(size(l, lo, r, hi) / F.greatest(size(*a), F.lit(1e-9)))


def _k0() -> float:
    s = math.sin(math.radians(PARALLEL))
    return math.cos(math.radians(PARALLEL)) / math.sqrt(1 - E2 * s * s)


def _q(lat: Column) -> Column:
    e = math.sqrt(E2)
    s = F.sin(F.radians(lat))
    return (1 - E2) * (s / (1 - E2 * s * s) - F.log((1 - e * s) / (1 + e * s)) / (2 * e))


def equal_area(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Cylindrical equal-area coordinates in metres."""
    k0 = _k0()
    return F.radians(lon) * (A * k0), _q(lat) * (A / (2 * k0))


def ring_area(ring: Column) -> Column:
    """Equal-area size of a closed ring in square metres."""
    xy = F.transform(ring, lambda p: F.struct(equal_area(p["lon"], p["lat"])[0].alias("x"), equal_area(p["lon"], p["lat"])[1].alias("y")))
    n = F.size(ring)
    pairs = F.transform(F.array(xy), lambda own: F.zip_with(F.slice(own, F.lit(1), n - 1), F.slice(own, F.lit(2), n - 1), lambda p, q: p.x * q.y - q.x * p.y))
    return F.abs(F.aggregate(F.element_at(pairs, 1), F.lit(0.0), lambda s, v: s + v)) / 2


def inside_ring(x: Column, y: Column, ring: Column) -> Column:
    """Whether a point lies in a closed ring, by crossings."""
    n = F.size(ring)
    crossings = F.zip_with(
        F.slice(ring, F.lit(1), n - 1), F.slice(ring, F.lit(2), n - 1),
        lambda p, q: F.when(((p["lat"] > y) != (q["lat"] > y)) & (x < (q["lon"] - p["lon"]) * (y - p["lat"]) / (q["lat"] - p["lat"]) + p["lon"]), 1).otherwise(0),
    )
    return F.aggregate(crossings, F.lit(0), lambda s, v: s + v) % 2 == 1


def clip_convex(subject: list[tuple], clip: list[tuple]) -> list[tuple]:
    """A polygon cut to a convex counter-clockwise one, edge by edge; open rings."""
    out = list(subject)
    for (ax, ay), (bx, by) in zip(clip, clip[1:] + clip[:1], strict=True):
        side = lambda p: (bx - ax) * (p[1] - ay) - (by - ay) * (p[0] - ax)  # noqa: B023, E731
        old, out = out, []
        for p, q in zip(old[-1:] + old[:-1], old, strict=True):
            sp, sq = side(p), side(q)
            if (sp >= 0) != (sq >= 0):
                k = sp / (sp - sq)
                out.append((p[0] + k * (q[0] - p[0]), p[1] + k * (q[1] - p[1])))
            if sq >= 0:
                out.append(q)
        if not out:
            return []
    return out


def convex(ring: list[tuple]) -> bool:
    """Whether an open counter-clockwise ring turns left everywhere (straight corners are allowed)."""
    n = len(ring)
    size = max(1e-300, max(abs(c) for p in ring for c in p)) ** 2
    turns = [(ring[(i + 1) % n][0] - ring[i][0]) * (ring[(i + 2) % n][1] - ring[i][1]) - (ring[(i + 1) % n][1] - ring[i][1]) * (ring[(i + 2) % n][0] - ring[i][0]) for i in range(n)]
    return min(turns) >= -1e-9 * size


def shoelace(ring: list[tuple]) -> float:
    return sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, ring[1:] + ring[:1], strict=True)) / 2 if ring else 0.0


def polygon_overlap(df: DataFrame, a: str, b: str, name: str = "overlap") -> DataFrame:
    """``df`` with the share of ring ``a`` that the convex ring ``b`` covers, on the equal-area grid.

    A ring ``b`` that is not convex is refused: clipping by its edges would give a wrong area.
    """
    from pyspark.sql.types import DoubleType, StructType

    e, k0 = math.sqrt(E2), _k0()

    def flat(ring):
        out = []
        for p in ring:
            s = math.sin(math.radians(p["lat"]))
            q = (1 - E2) * (s / (1 - E2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))
            out.append((math.radians(p["lon"]) * A * k0, q * A / (2 * k0)))
        out = out[:-1] if len(out) > 1 and out[0] == out[-1] else out
        return out[::-1] if shoelace(out) < 0 else out

    def run(batches):
        for frame in batches:
            shares = []
            for x, y in zip(frame[a], frame[b], strict=True):
                if x is None or y is None or len(x) < 3 or len(y) < 3:
                    shares.append(0.0)
                    continue
                x, y = flat(x), flat(y)
                if not convex(y):
                    raise ValueError("the clipping ring is not convex")
                shares.append(abs(shoelace(clip_convex(x, y))) / max(abs(shoelace(x)), 1e-9))
            yield frame.assign(**{name: shares})

    return df.mapInPandas(run, StructType([*df.schema.fields]).add(name, DoubleType()))


def destination(lon: Column, lat: Column, azimuth: float, distance: float) -> tuple[Column, Column]:
    """The point at ``distance`` metres along a geodesic, by Vincenty's series with a fixed number of steps."""
    b = A * (1 - FLATTENING)
    az = math.radians(azimuth)
    u1 = F.atan(F.tan(F.radians(lat)) * (1 - FLATTENING))
    su, cu = F.sin(u1), F.cos(u1)
    sigma1 = F.atan2(F.tan(u1), F.lit(math.cos(az)))
    sin_alpha = cu * math.sin(az)
    cos2 = 1 - sin_alpha * sin_alpha
    usq = cos2 * ((A * A - b * b) / (b * b))
    ka = 1 + usq / 16384 * (4096 + usq * (-768 + usq * (320 - 175 * usq)))
    kb = usq / 1024 * (256 + usq * (-128 + usq * (74 - 47 * usq)))
    start = F.lit(distance / b) / ka

    def step(sigma: Column, _: Column) -> Column:
        m = F.cos(2 * sigma1 + sigma)
        s, c = F.sin(sigma), F.cos(sigma)
        return start + kb * s * (m + kb / 4 * (c * (2 * m * m - 1) - kb / 6 * m * (4 * s * s - 3) * (4 * m * m - 3)))

    sigma = F.aggregate(F.sequence(F.lit(1), F.lit(8)), start, step)
    s, c, m = F.sin(sigma), F.cos(sigma), F.cos(2 * sigma1 + sigma)
    back = su * s - cu * c * math.cos(az)
    lat2 = F.atan2(su * c + cu * s * math.cos(az), (1 - FLATTENING) * F.sqrt(sin_alpha * sin_alpha + back * back))
    lam = F.atan2(s * math.sin(az), cu * c - su * s * math.cos(az))
    k = cos2 * (FLATTENING / 16) * (4 + FLATTENING * (4 - 3 * cos2))
    diff = lam - (1 - k) * FLATTENING * sin_alpha * (sigma + k * s * (m + k * c * (2 * m * m - 1)))
    return lon + F.degrees(diff), F.degrees(lat2)


def point_buffer(points: DataFrame, radius: float) -> DataFrame:
    """``points`` (lon, lat) with the box corners at (+-r, +-r) metres as ring."""
    corners = [destination(F.col("lon"), F.col("lat"), az, radius * math.sqrt(2)) for az in (225, 135, 45, 315, 225)]
    return points.withColumn("ring", F.array(*[F.struct(x.alias("lon"), y.alias("lat")) for x, y in corners]))


# Krueger series coefficients of the third flattening (fixed values up to order 4).
_N = FLATTENING / (2 - FLATTENING)
_ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180, 13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140, 49561 * _N**4 / 161280,
)
_BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360, _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840, 4397 * _N**4 / 161280,
)
_DELTA = (
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45, 7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45,
    56 * _N**3 / 15 - 136 * _N**4 / 35, 4279 * _N**4 / 630,
)
_RADIUS = A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
SCALE, EASTING = 0.9996, 500_000.0


def to_utm(lon, lat, zone, south=False):
    """NumPy transverse Mercator coordinates of a UTM zone, one for all points or one for each."""
    lam, phi = np.radians(lon) - np.radians(zone * 6 - 183), np.radians(lat)
    k = 2 * math.sqrt(_N) / (1 + _N)
    t = np.sinh(np.arctanh(np.sin(phi)) - k * np.arctanh(k * np.sin(phi)))
    xi, eta = np.arctan2(t, np.cos(lam)), np.arctanh(np.sin(lam) / np.sqrt(1 + t * t))
    x, y = eta.copy() if hasattr(eta, "copy") else eta, xi.copy() if hasattr(xi, "copy") else xi
    for j, a in enumerate(_ALPHA, 1):
        x = x + a * np.cos(2 * j * xi) * np.sinh(2 * j * eta)
        y = y + a * np.sin(2 * j * xi) * np.cosh(2 * j * eta)
    return EASTING + SCALE * _RADIUS * x, SCALE * _RADIUS * y + np.where(south, 10_000_000.0, 0.0)


def from_utm(x, y, zone: int, south: bool = False):
    """NumPy longitude and latitude of UTM coordinates."""
    xi = (np.asarray(y, float) - (10_000_000.0 if south else 0.0)) / (SCALE * _RADIUS)
    eta = (np.asarray(x, float) - EASTING) / (SCALE * _RADIUS)
    u, v = xi, eta
    for j, b in enumerate(_BETA, 1):
        u = u - b * np.sin(2 * j * xi) * np.cosh(2 * j * eta)
        v = v - b * np.cos(2 * j * xi) * np.sinh(2 * j * eta)
    chi = np.arcsin(np.sin(u) / np.cosh(v))
    phi = chi + sum(d * np.sin(2 * j * chi) for j, d in enumerate(_DELTA, 1))
    return zone * 6 - 183 + np.degrees(np.arctan2(np.sinh(v), np.cos(u))), np.degrees(phi)


def from_utm_columns(x: Column, y: Column, zone: int, south: bool = False) -> tuple[Column, Column]:
    """Longitude and latitude of UTM coordinates as columns, by the same series as :func:`from_utm`."""
    xi = (y - (10_000_000.0 if south else 0.0)) / (SCALE * _RADIUS)
    eta = (x - EASTING) / (SCALE * _RADIUS)
    u, v = xi, eta
    for j, b in enumerate(_BETA, 1):
        u = u - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        v = v - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(u) / F.cosh(v))
    phi = chi
    for j, d in enumerate(_DELTA, 1):
        phi = phi + d * F.sin(2 * j * chi)
    return F.degrees(F.atan2(F.sinh(v), F.cos(u))) + (zone * 6 - 183), F.degrees(phi)


def closed_rings(rings: Column) -> Column:
    """Rings of three points or more, closed by their first point; the others are dropped."""
    kept = F.filter(rings, lambda r: F.size(r) >= 3)
    return F.transform(kept, lambda r: F.when(F.element_at(r, 1) == F.element_at(r, -1), r).otherwise(F.concat(r, F.array(F.element_at(r, 1)))))


def wgs84_summary(rasters: DataFrame, points: int = 21) -> DataFrame:
    """``rasters`` (epsg of a UTM zone, l, b, r, t) with west, south, east, north of the edges, densified, and the centre lon, lat."""
    from pyspark.sql.types import DoubleType, StructType

    names = ("west", "south", "east", "north", "lon", "lat")
    schema = StructType([*rasters.schema.fields])
    for name in names:
        schema = schema.add(name, DoubleType())
    k = np.linspace(0, 1, points + 2)

    def run(batches):
        for f in batches:
            l, b, r, t = (f[c].to_numpy(float)[:, None] for c in "lbrt")
            xs = np.concatenate([l + (r - l) * k, l + (r - l) * k, l + 0 * k, r + 0 * k], 1)
            ys = np.concatenate([b + 0 * k, t + 0 * k, b + (t - b) * k, b + (t - b) * k], 1)
            epsg = f["epsg"].to_numpy(int)
            out = np.full((len(f), 6), np.nan)
            for code in np.unique(epsg):
                own = epsg == code
                lon, lat = from_utm(xs[own], ys[own], code % 100, code >= 32700)
                out[own, :4] = np.stack([lon.min(1), lat.min(1), lon.max(1), lat.max(1)], 1)
            out[:, 4], out[:, 5] = (out[:, 0] + out[:, 2]) / 2, (out[:, 1] + out[:, 3]) / 2
            yield f.assign(**{n: out[:, i] for i, n in enumerate(names)})

    return rasters.mapInPandas(run, schema)


def utm_zone(lon, lat):
    """NumPy (zone, south) of points; longitudes wrap."""
    return np.floor((np.asarray(lon, float) + 180) / 6).astype(int) % 60 + 1, np.asarray(lat, float) < 0


def bounds_in_utm(df: DataFrame, zone: int | None = None, south: bool = False) -> DataFrame:
    """``df`` (l, b, r, t in degrees) with epsg, x0, y0, x1, y1: bounds of the projected corners.

    Without a ``zone`` every box has that of its centre.
    """
    from pyspark.sql.types import DoubleType, IntegerType, StructType

    def run(batches):
        for f in batches:
            l, b, r, t = (f[c].to_numpy(float) for c in "lbrt")
            z, s = utm_zone((l + r) / 2, (b + t) / 2) if zone is None else (np.full(len(f), zone), np.full(len(f), south))
            at = [to_utm(x, y, z, s) for x in (l, r) for y in (b, t)]
            xs, ys = np.array([p[0] for p in at]), np.array([p[1] for p in at])
            yield f.assign(epsg=(32600 + z + 100 * s).astype("int32"), x0=xs.min(0), y0=ys.min(0), x1=xs.max(0), y1=ys.max(0))

    schema = StructType([*df.schema.fields]).add("epsg", IntegerType())
    for name in ("x0", "y0", "x1", "y1"):
        schema = schema.add(name, DoubleType())
    return df.mapInPandas(run, schema)
