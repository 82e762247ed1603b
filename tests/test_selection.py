import itertools
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from parcelflow.operators.selection import large_groups, medians, value_range, with_medians


def table():
    rng = random.Random(4)
    rows = []
    for g, n in [("one", 1), ("two", 2), ("odd", 101), ("even", 300), ("ties", 200), ("nothing", 3), ("hot", 2000)]:
        for i in range(n):
            a = {"ties": 7.0, "nothing": None}.get(g, rng.choice([rng.uniform(-1e6, 1e6), rng.uniform(-1, 1), 0.0, -0.0, None if n > 2 else 5.0, float(rng.randint(1, 9))]))
            rows.append((g, i % 2 if g == "even" else 0, a, rng.randint(0, 60) if i % 5 else None))
    return rows


def middle(values):
    values = [v for v in values if v is not None]
    return statistics.median(values) if values else None


def expected(rows):
    key = lambda r: r[:2]
    out = {}
    for k, group in itertools.groupby(sorted(rows, key=lambda r: (r[0] or "", r[1])), key):
        group = list(group)
        out[k] = (middle([r[2] for r in group]), middle([r[3] for r in group]), len(group))
    return out


def close(a, b):
    return a is None and b is None or a is not None and b is not None and math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)


@pytest.mark.parametrize("ranges", [0, 1, 16])
def test_split_groups(spark, ranges):
    rows = table() + [(None, 0, 3.0, 4), (None, 0, 5.0, None)]
    df = spark.createDataFrame(rows, "g string, k int, a double, b int").repartition(5)
    got = {(r["g"], r["k"]): (r["a"], r["b"]) for r in medians(df, ["g", "k"], ["a", "b"], ranges).collect()}
    want = {k: v[:2] for k, v in expected(rows).items() if v[:2] != (None, None)}
    assert got.keys() == want.keys()
    assert all(close(x, y) for k in want for x, y in zip(got[k], want[k]))


@pytest.mark.parametrize("share, small, large", [(1e-3, 100_000, 0), (0.05, 100, 4), (0.5, 10, 1), (0.0, 0, 8)])
def test_groups_are_the_same_split_or_sorted(spark, share, small, large):
    rows = table()
    df = spark.createDataFrame(rows, "g string, k int, a double, b int").repartition(5)
    assert large_groups(df, ["g", "k"], share, small).count() == large
    out = with_medians(df, ["g", "k"], {"middle_a": "a", "middle_b": "b"}, {"n": F.count(F.lit(1))}, share, small)
    assert out.columns == ["g", "k", "middle_a", "middle_b", "n"]
    got = {(r["g"], r["k"]): tuple(r)[2:] for r in out.collect()}
    want = expected(rows)
    assert got.keys() == want.keys()
    assert all(close(x, y) for k in want for x, y in zip(got[k], want[k]))


def test_ranges_follow_the_order_of_values(spark):
    values = sorted([-1e300, -5.0, -1e-9, 0.0, 1e-9, 0.5, 1.0, 3.0, 1e6, 1e300]) + [float("inf"), float("nan")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    places = [r[0] for r in df.select(value_range(F.col("v")).alias("place"), "i").orderBy("i").collect()]
    assert places[:-2] == sorted(places[:-2]) and places[-1] >= places[-3]


def test_empty(spark):
    df = spark.createDataFrame([], "g string, a double")
    assert medians(df, ["g"], ["a"]).count() == 0 and with_medians(df, ["g"], {"m": "a"}, {}).count() == 0
