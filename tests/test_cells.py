import math
import random

import numpy as np
import pytest

from parcelflow.operators import areas, cells

GEO = "geog_id string, level int, rings array<array<struct<lat:double,lng:double>>>"


def star(rng, lat, lng, size, corners):
    turn = sorted(rng.uniform(0, 2 * math.pi) for _ in range(corners))
    return [(lat + size * rng.uniform(0.3, 1) * math.sin(t), lng + size * rng.uniform(0.3, 1) * math.cos(t)) for t in turn]


def catalogue():
    rng = random.Random(2)
    out = [("country", 40, star(rng, 55.0, -95.0, 30.0, 400)), ("square", 30, [(43.0, -80.0), (43.0, -79.0), (44.0, -79.0), (44.0, -80.0)])]
    out += [(f"city{k}", 20, star(rng, 43.7 + k * 0.02, -79.4, 0.3, 60)) for k in range(4)]
    out += [(f"block{k}", 10, star(rng, 43.7 + k * 0.01, -79.4 + k * 0.01, 0.01, 12)) for k in range(12)]
    return out + [("thin", 10, [(43.5, -79.5), (43.5, -79.2), (43.5001, -79.2)]), ("point", 10, [(43.6, -79.6)] * 3)]


def crowded_points():
    rng = random.Random(3)
    city = [(43.7 + rng.gauss(0, 0.1), -79.4 + rng.gauss(0, 0.1)) for _ in range(2500)]
    wide = [(rng.uniform(20, 90), rng.uniform(-140, -50)) for _ in range(500)]
    edge = [(43.0, -79.5), (44.0, -79.0), (43.25, -80.0), (43.5, -79.5), (43.5, -79.3), (43.6, -79.6), (43.0, -80.0)]
    return [(str(i), *p) for i, p in enumerate(city + wide + edge)]


def holds(ring, lat, lng):
    inside, n = False, len(ring)
    for (ay, ax), (by, bx) in zip(ring, ring[1:] + ring[:1]):
        if abs((by - ay) * (lng - ax) - (bx - ax) * (lat - ay)) <= 1e-12 and min(ay, by) <= lat <= max(ay, by) and min(ax, bx) <= lng <= max(ax, bx):
            return True
        if (ay > lat) != (by > lat) and lng < ax + (lat - ay) * (bx - ax) / (by - ay):
            inside = not inside
    return inside


@pytest.mark.parametrize("by_density", [False, True])
def test_points_of_a_country_and_a_crowded_city(spark, by_density, monkeypatch):
    monkeypatch.setattr(cells, "CROWD", 100)
    geo = spark.createDataFrame([(i, level, [[{"lat": y, "lng": x} for y, x in ring]]) for i, level, ring in catalogue()] + [("none", 10, None), ("empty", 10, [])], GEO)
    points = crowded_points()
    df = spark.createDataFrame(points + [("nowhere", None, 1.0)], "_id string, lat double, lng double")
    want = {(p, i, level) for p, lat, lng in points for i, level, ring in catalogue() if holds(ring, lat, lng)}
    got = [tuple(r) for r in areas.points_in_areas(df, geo, by_density=by_density).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert {"country", "square", "city0", "block0", "thin"} <= {w[1] for w in want}


def test_outlines_stand_once_and_coverings_are_bounded(spark):
    geo = spark.createDataFrame([(i, level, [[{"lat": y, "lng": x} for y, x in ring]]) for i, level, ring in catalogue()], GEO)
    index = cells.covering(geo)
    assert index.columns == ["geog_id", "level", "code", "inside"]
    counts = {r["geog_id"]: r["count"] for r in index.groupBy("geog_id").count().collect()}
    assert counts.keys() == {i for i, _, _ in catalogue()} and max(counts.values()) <= 4 * cells.CELLS
    plan = areas.points_in_areas(spark.createDataFrame([("a", 1.0, 1.0)], "_id string, lat double, lng double"), geo)
    assert "rings" not in plan.columns


def test_cells_inside_are_inside():
    rng = random.Random(5)
    for _ in range(20):
        ring = star(rng, rng.uniform(-60, 60), rng.uniform(-170, 170), 10 ** rng.uniform(-3, 1), rng.randint(3, 40))
        for code, inside in cells.covering_of(np.array(ring), 200):
            depth, y, x = code >> 2 * cells.BITS, code >> cells.BITS & (1 << cells.BITS) - 1, code & (1 << cells.BITS) - 1
            side = 2 * cells.HALF / 2**depth
            for _ in range(5 * inside):
                assert holds(ring, (y + rng.random()) * side - cells.HALF, (x + rng.random()) * side - cells.HALF)
