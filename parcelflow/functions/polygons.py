"""Polygons as arrays of rings of (lat, lng); only the first ring counts, and holes do not occur."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _edges(ring: Column) -> Column:
    """(a, b) of each side, the closing one included; a closed ring's last side has no length and does no harm."""
    n = F.size(ring)
    after = F.concat(F.slice(ring, 2, F.greatest(n - 1, F.lit(0))), F.slice(ring, 1, 1))
    return F.zip_with(ring, after, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def contains_point(rings: Column, lat: Column, lng: Column, touching: bool = True) -> Column:
    """Whether the point is inside, or on the border if touching, by counting crossings of a ray to the east."""
    edges = _edges(F.element_at(rings, 1))

    def crosses(e: Column) -> Column:
        a, b = e["a"], e["b"]
        spans = (a["lat"] > lat) != (b["lat"] > lat)
        at = a["lng"] + (lat - a["lat"]) * F.try_divide(b["lng"] - a["lng"], b["lat"] - a["lat"])
        return spans & F.coalesce(lng < at, F.lit(False))

    def on(e: Column) -> Column:
        a, b = e["a"], e["b"]
        cross = (b["lat"] - a["lat"]) * (lng - a["lng"]) - (b["lng"] - a["lng"]) * (lat - a["lat"])
        within = lat.between(F.least(a["lat"], b["lat"]), F.greatest(a["lat"], b["lat"])) & lng.between(F.least(a["lng"], b["lng"]), F.greatest(a["lng"], b["lng"]))
        return (F.abs(cross) <= 1e-12) & within

    inside = F.size(F.filter(edges, crosses)) % 2 == 1
    border = F.exists(edges, on)
    return F.coalesce((inside | border) if touching else (inside & ~border), F.lit(False))


def bounding_box(rings: Column) -> Column:
    ring = F.element_at(rings, 1)
    lats, lngs = F.transform(ring, lambda p: p["lat"]), F.transform(ring, lambda p: p["lng"])
    return F.struct(F.array_min(lats).alias("south"), F.array_max(lats).alias("north"), F.array_min(lngs).alias("west"), F.array_max(lngs).alias("east"))


def area(rings: Column) -> Column:
    """Planar area in square degrees."""
    twice = F.aggregate(_edges(F.element_at(rings, 1)), F.lit(0.0).cast("double"), lambda s, e: s + e["a"]["lng"] * e["b"]["lat"] - e["b"]["lng"] * e["a"]["lat"])
    return F.abs(twice) / 2


def perimeter(rings: Column) -> Column:
    sides = F.transform(_edges(F.element_at(rings, 1)), lambda e: F.sqrt(F.pow(e["a"]["lat"] - e["b"]["lat"], 2) + F.pow(e["a"]["lng"] - e["b"]["lng"], 2)))
    return F.aggregate(sides, F.lit(0.0).cast("double"), lambda s, x: s + x)


def centroid(rings: Column) -> Column:
    """The mean corner of the first ring."""
    ring = F.element_at(rings, 1)
    mean = lambda c: F.aggregate(ring, F.lit(0.0).cast("double"), lambda s, p: s + p[c]) / F.size(ring)
    return F.struct(mean("lat").alias("lat"), mean("lng").alias("lng"))


def random_point(geog_id: Column, rings: Column, seed: int = 0, tries: int = 1000) -> Column:
    """A point of the polygon: the first of `tries` hashed places in its box that is inside, else the centroid."""
    box = bounding_box(rings)
    unit = lambda *of: F.pmod(F.xxhash64(geog_id, F.lit(seed), *of), F.lit(1 << 30)) / float(1 << 30)

    def place(i: Column) -> Column:
        lat = box["south"] + unit(i, F.lit(0)) * (box["north"] - box["south"])
        lng = box["west"] + unit(i, F.lit(1)) * (box["east"] - box["west"])
        return F.struct(lat.alias("lat"), lng.alias("lng"))

    inside = F.filter(F.transform(F.sequence(F.lit(1), F.lit(tries)), place), lambda p: contains_point(rings, p["lat"], p["lng"]))
    return F.coalesce(F.get(inside, F.lit(0)), centroid(rings))


RINGS = "array<array<struct<lat:double,lng:double>>>"


def _thinned(ring: list, tolerance: float) -> list:
    """Douglas and Peucker's choice of corners; first and last stay."""
    p = np.array([(c["lat"], c["lng"]) for c in ring])
    keep, todo = np.zeros(len(p), bool), [(0, len(p) - 1)]
    keep[[0, -1]] = True
    while todo:
        a, z = todo.pop()
        if z - a < 2:
            continue
        way, off = p[z] - p[a], p[a + 1 : z] - p[a]
        long = np.hypot(*way)
        far = np.abs(way[0] * off[:, 1] - way[1] * off[:, 0]) / long if long else np.hypot(off[:, 0], off[:, 1])
        k = int(far.argmax())
        if far[k] > tolerance:
            keep[a + 1 + k] = True
            todo += [(a, a + 1 + k), (a + 1 + k, z)]
    return [c for c, k in zip(ring, keep) if k]


def simplify(rings: Column | str, tolerance: float = 0.01) -> Column:
    """Rings with fewer corners, none further than the tolerance (in degrees) from the old outline. A ring that would
    lose its area stays as it is; null stays null."""

    @F.pandas_udf(RINGS)
    def run(column: pd.Series) -> pd.Series:
        def one(found):
            if found is None:
                return None
            out = []
            for ring in found:
                thin = _thinned(list(ring), tolerance) if len(ring) else []
                out.append(thin if len(thin) >= 4 else list(ring))
            return out

        return column.map(one)

    return run(rings)


def _widths(ring: np.ndarray, lat: float) -> np.ndarray:
    """Sorted longitudes where the outline crosses a latitude that no corner has."""
    a, b = ring, np.roll(ring, -1, axis=0)
    hit = (a[:, 0] > lat) != (b[:, 0] > lat)
    a, b = a[hit], b[hit]
    return np.sort(a[:, 1] + (lat - a[:, 0]) * (b[:, 1] - a[:, 1]) / (b[:, 0] - a[:, 0]))


def shared_area(one: np.ndarray, other: np.ndarray) -> float:
    """Area that two simple polygons (rows of lat, lng) share. Between two neighbouring latitudes of corners or crossings
    all sides are straight and apart, so the width half-way times the height is exact."""
    a, b = one, np.roll(one, -1, axis=0)
    c, d = other, np.roll(other, -1, axis=0)
    r, s = (b - a)[:, None, :], (d - c)[None, :, :]
    q = c[None, :, :] - a[:, None, :]
    cross = r[..., 0] * s[..., 1] - r[..., 1] * s[..., 0]
    with np.errstate(divide="ignore", invalid="ignore"):
        t = (q[..., 0] * s[..., 1] - q[..., 1] * s[..., 0]) / cross
        u = (q[..., 0] * r[..., 1] - q[..., 1] * r[..., 0]) / cross
    i, j = np.nonzero((cross != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1))
    cuts = np.unique(np.concatenate([one[:, 0], other[:, 0], a[i, 0] + t[i, j] * (b - a)[i, 0]]))
    total = 0.0
    for low, high in zip(cuts, cuts[1:]):
        x, y = _widths(one, (low + high) / 2), _widths(other, (low + high) / 2)
        for x0, x1 in zip(x[::2], x[1::2]):
            total += (high - low) * np.clip(np.minimum(x1, y[1::2]) - np.maximum(x0, y[::2][: len(y) // 2]), 0, None).sum()
    return float(total)


def covered_share(rings: Column | str, by: Column | str) -> Column:
    """Which share of a polygon's area lies in another one."""

    @F.pandas_udf("double")
    def run(inner: pd.Series, outer: pd.Series) -> pd.Series:
        corners = lambda rs: np.array([(p["lat"], p["lng"]) for p in rs[0]])
        out = []
        for x, y in zip(inner, outer):
            a, b = corners(x), corners(y)
            whole = shared_area(a, a)
            out.append(shared_area(a, b) / whole if whole else None)
        return pd.Series(out, dtype="float64")

    return run(rings, by)


def lng_first(rings: Column, digits: int = 6) -> Column:
    """Rings of [lng, lat] pairs, rounded, as GeoJSON wants them."""
    return F.transform(rings, lambda ring: F.transform(ring, lambda p: F.array(F.round(p["lng"], digits), F.round(p["lat"], digits))))


def geojson_feature(geog_id: Column, properties: Column, rings: Column | None = None) -> Column:
    """A Feature as text; without rings its geometry is null."""
    geometry = F.struct(F.lit("MultiPolygon").alias("type"), F.transform(lng_first(rings), lambda r: F.array(r)).alias("coordinates")) if rings is not None else F.lit(None).cast("string")
    return F.to_json(F.struct(F.lit("Feature").alias("type"), geog_id.alias("id"), properties.alias("properties"), geometry.alias("geometry")), {"ignoreNullFields": "false"})
