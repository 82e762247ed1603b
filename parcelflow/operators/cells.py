"""Areas as cells of a quadtree: cells wholly inside an area, and cells that its border passes.

The plane is a square of 1024 degrees, halved both ways at each depth. An area is covered from the cells of its own size down;
only cells on the border are split, until the area has its number of cells, so a country is some large cells inside and
small ones along the border. A point looks up its cell at each depth that occurs. In a cell wholly inside, it is in the
area; on the border the exact test follows, with the outline joined by area, where it stands once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.polygons import bounding_box

#: Half the side of the square, in degrees; the greatest depth, of cells of a thousandth of a degree; depths from one
#: split to the next.
HALF, DEEPEST, STEP = 512.0, 20, 2
#: Cells of an area, about, at most four times as many; and as many more for each doubling of its points beyond CROWD.
CELLS, CROWD = 64, 10_000
#: An edge so near a cell counts as touching it: more than the rounding of a point's cell can move it.
MARGIN = 1e-9
BITS = 22


def _code(depth, y, x):
    return (depth * (1 << BITS) + y) * (1 << BITS) + x


def _inside(ring: np.ndarray, lat: np.ndarray, lng: np.ndarray) -> np.ndarray:
    """Whether points that no edge is near are inside, by crossings of a ray to the east."""
    a, b = ring, np.roll(ring, -1, 0)
    out = np.zeros(len(lat), bool)
    for k in range(len(lat)):
        spans = (a[:, 0] > lat[k]) != (b[:, 0] > lat[k])
        p, q = a[spans], b[spans]
        out[k] = np.count_nonzero(lng[k] < p[:, 1] + (lat[k] - p[:, 0]) * (q[:, 1] - p[:, 1]) / (q[:, 0] - p[:, 0])) % 2
    return out


def _touches(ring: np.ndarray, lat: np.ndarray, lng: np.ndarray, half: float) -> np.ndarray:
    """Whether any edge meets the cells with these centres."""
    a, half = ring, half + MARGIN
    way = np.roll(ring, -1, 0) - a
    middle, reach = a + way / 2, np.abs(way) / 2
    out = np.zeros(len(lat), bool)
    for k in range(len(lat)):
        off = middle - (lat[k], lng[k])
        near = (np.abs(off) <= reach + half).all(1)
        if near.any():
            # a line passes a square if it is no farther from the centre than the corner in its direction
            far = np.abs(way[near, 0] * off[near, 1] - way[near, 1] * off[near, 0])
            out[k] = (far <= np.abs(way[near]).sum(1) * half).any()
    return out


def covering_of(ring: np.ndarray, most: int = CELLS) -> list[tuple[int, bool]]:
    """(code, whether it is wholly inside) of the cells that cover a ring of (lat, lng)."""
    low, high = ring.min(0), ring.max(0)
    depth = 0
    while depth + STEP <= DEEPEST and 2 * HALF / 2 ** (depth + STEP) >= (high - low).max():
        depth += STEP
    side = 2 * HALF / 2**depth
    first, last = np.floor((low - MARGIN + HALF) / side).astype(int), np.floor((high + MARGIN + HALF) / side).astype(int)
    y, x = (g.ravel() for g in np.mgrid[first[0] : last[0] + 1, first[1] : last[1] + 1])
    done: list[tuple[int, bool]] = []
    while True:
        lat, lng = (y + 0.5) * side - HALF, (x + 0.5) * side - HALF
        border = _touches(ring, lat, lng, side / 2)
        inside = ~border
        inside[inside] = _inside(ring, lat[inside], lng[inside])
        done += [(int(c), True) for c in _code(depth, y[inside], x[inside])]
        y, x = y[border], x[border]
        if depth + STEP > DEEPEST or len(done) + 4**STEP * len(y) > 4 * most:
            return done + [(int(c), False) for c in _code(depth, y, x)]
        depth, side = depth + STEP, side / 2**STEP
        dy, dx = (g.ravel() for g in np.mgrid[0 : 2**STEP, 0 : 2**STEP])
        y, x = (y[:, None] * 2**STEP + dy).ravel(), (x[:, None] * 2**STEP + dx).ravel()


def _coverings(rings: pd.Series, most: pd.Series) -> pd.Series:
    def one(r, n):
        ring = np.array([(p["lat"], p["lng"]) for p in r[0]], float)
        return [{"code": c, "inside": i} for c, i in covering_of(ring, int(n))]

    return pd.Series([one(r, n) for r, n in zip(rings, most)])


def covering(geo: DataFrame, most: Column | int = CELLS) -> DataFrame:
    """(geog_id, level, code, inside) of every area with a polygon; no outlines. Areas off the square are an error of data."""
    areas = geo.where((F.size("rings") > 0) & (F.size(F.get("rings", F.lit(0))) > 0))
    most = F.lit(most) if isinstance(most, int) else most
    cells = F.pandas_udf(_coverings, "array<struct<code:bigint,inside:boolean>>")
    return areas.select("geog_id", "level", F.explode(cells("rings", most)).alias("cell")).select("geog_id", "level", "cell.code", "cell.inside")


def cell_code(depth: Column, lat: Column, lng: Column) -> Column:
    """The code of a point's cell at a depth."""
    at = lambda c: F.floor((c + HALF) / (2 * HALF) * F.pow(F.lit(2.0), depth)).cast("bigint")
    return _code(depth.cast("bigint"), at(lat), at(lng))


def crowding(points: DataFrame, geo: DataFrame, depth: int = 10) -> DataFrame:
    """geo with `cells`: more for areas whose boxes meet crowded cells of that depth, one degree as a rule."""
    crowd = points.where("lat IS NOT NULL AND lng IS NOT NULL").groupBy(cell_code(F.lit(depth), F.col("lat"), F.col("lng")).alias("__code")).agg(F.count(F.lit(1)).alias("__n"))
    box, side = bounding_box(F.col("rings")), 2 * HALF / 2**depth
    span = lambda low, high: F.explode(F.sequence(F.floor((low + HALF) / side), F.floor((high + HALF) / side)))
    met = geo.where(F.size("rings") > 0).select("geog_id", box.alias("b")).select("geog_id", "b", span(F.col("b.south"), F.col("b.north")).alias("y")).select("geog_id", "y", span(F.col("b.west"), F.col("b.east")).alias("x"))
    n = met.join(crowd, _code(F.lit(depth).cast("bigint"), F.col("y"), F.col("x")) == F.col("__code")).groupBy("geog_id").agg(F.sum("__n").alias("__n"))
    more = F.floor(F.log2(F.greatest(F.coalesce("__n", F.lit(0)) / CROWD, F.lit(1.0))))
    return geo.join(n, "geog_id", "left").withColumn("cells", (CELLS * (1 + more)).cast("int")).drop("__n")
