import math
import random
import re

from parcelflow.operators import nearby

SCHEMA = "_id string, propertyType string, bedsInt int, bathsInt int, lat double, lng double"


def _km(a, s):
    p, q = math.radians(a[4]), math.radians(s[4])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(s[5] - a[5]) / 2) ** 2
    return 2 * 6371.0 * math.atan2(math.sqrt(h), math.sqrt(1 - h))


def _nearest(active, sold):
    out = {}
    for a in active:
        for s in sold:
            if a[1:4] == s[1:4] and (km := _km(a, s)) < 1.0:
                out.setdefault(a[0], []).append((km, s[0]))
    return {k: sorted(v)[:12] for k, v in out.items()}


def test_dense_sales_make_few_pairs_and_lose_none(spark):
    """Sales on both sides of a band's edge, a town, a street in it that is far denser, a tower at one place, and lone ones."""
    rng = random.Random(5)
    row = lambda k, lat, lng: (f"{k:05d}", "CONDO", 1, 1, lat, lng)
    spots = [(43.995 + rng.random() * 0.01, -79.4 + rng.random() * 0.014) for _ in range(3000)]
    spots += [(43.9971 + rng.random() * 1e-4, -79.395 + rng.random() * 1e-4) for _ in range(600)] + [(43.999, -79.398)] * 200
    spots += [(43.97 + rng.random() * 0.06, -79.45 + rng.random() * 0.1) for _ in range(60)]
    sold = [row(k, *s) for k, s in enumerate(spots)]
    active = [row(k, s[0] + 1e-5, s[1]) for k, s in enumerate(spots) if k % 6 == 0]
    active.append(("00000", "CONDO", 1, 1, 44.02, -79.42))  # an id that stands at two places
    a, s = spark.createDataFrame(active, SCHEMA), spark.createDataFrame(sold, SCHEMA)
    want = _nearest(active, sold)
    found = {}
    for r in nearby.comparables(a, s).orderBy("listing_id", "rank").collect():
        found.setdefault(r["listing_id"], []).append((r["distance_km"], r["sold_id"]))
    assert {k: [i for _, i in v] for k, v in found.items()} == {k: [i for _, i in v] for k, v in want.items()}
    every = sum(x[1:4] == y[1:4] and _km(x, y) < 1.0 for x in active for y in sold)
    made = nearby.candidates(a, s).count()
    assert made * 3 < every, (made, every)


def _exchanges(df):
    """The shuffles of a plan, by what they are shuffled by, each counted once."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sorted(re.findall(r"(?<!Broadcast)Exchange ([a-z]+\([a-zA-Z_]*)", plan))


def _few(spark):
    rng = random.Random(8)
    spot = lambda: (43.99 + rng.random() * 0.03, -79.42 + rng.random() * 0.04)
    s = spark.createDataFrame([(f"s{k:04d}", "CONDO", 1, 1, *spot()) for k in range(900)], SCHEMA)
    a = [(f"a{k:03d}", "CONDO", 1, 1, *spot()) for k in range(80)]
    a += [(f"a{k:03d}", "CONDO", 1, 1, *spot()) for k in range(5)]  # ids that stand at two places
    a += [("a005", "CONDO", 1, 1, None, -79.4), ("u1", None, 1, 1, 44.0, -79.4), ("u2", "CONDO", 1, 1, 44.0, None), ("u2", "CONDO", 1, 1, None, -79.4)]
    a += [("far", "CONDO", 1, 1, 50.0, -79.4), (None, "CONDO", 1, 1, 44.0, -79.4), (None, "CONDO", 1, 1, 44.0, -79.4)]
    return spark.createDataFrame(a, SCHEMA), s


def test_lists_are_the_comparables_of_every_id(spark):
    """With ids at several places, some of them unplaced, and listings without a sale, a place or an id."""
    a, s = _few(spark)
    lists = lambda df: sorted(((r["listing_id"], [tuple(c) for c in r["comps"]]) for r in df.collect()), key=repr)
    found = lists(nearby.comparable_lists(a, s))
    assert found == lists(nearby.comparable_arrays(nearby.comparables(a, s), a))
    want = _nearest([r for r in a.collect() if r["_id"] and r["propertyType"] and r["lat"] and r["lng"]], s.collect())
    assert {k: [i for i, _ in v] for k, v in found if v} == {k: [i for _, i in v] for k, v in want.items()}
    assert [k for k, v in found if not v] == ["far", "u1", "u2", None]


def test_pairs_are_ranked_where_they_are_made(spark):
    """Listings and sales are shuffled by tile, and nothing after that, where ids stand once."""
    a, s = _few(spark)
    a = a.where("_id is not null").dropDuplicates(["_id"])
    assert _exchanges(nearby.comparables(a, s)) == ["hashpartitioning(tile"] * 2
    assert [x for x in _exchanges(nearby.comparable_lists(a, s)) if "tile" in x] == ["hashpartitioning(tile"] * 2
