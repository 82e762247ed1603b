import random
import re

import pytest

from parcelflow.llm.components import connected_components
from parcelflow.llm.minhash import band_plan, drop_near_copies, least_matches, near_components

from .cases import SCHEMA, documents


def sets(rows):
    out = []
    for r in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or "")) if x]
        out.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    return out


def brute(rows, percent):
    own = sets(rows)
    root = {r[0]: r[0] for r in rows if r[0] is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(own):
        for j in range(i):
            if a and own[j] and rows[i][0] is not None and rows[j][0] is not None:
                common = len(a & own[j])
                if 100 * common >= percent * (len(a) + len(own[j]) - common):
                    x, y = find(rows[i][0]), find(rows[j][0])
                    root[max(x, y)] = min(x, y)
    return sorted(repr((r[0], len(s), None if r[0] is None else find(r[0]), r[0] is None or find(r[0]) == r[0])) for r, s in zip(rows, own))


def chains(seed):
    rng = random.Random(seed)
    rows, i = [], 0
    for _ in range(12):
        words = [f"w{rng.randint(0, 5000)}" for _ in range(rng.randint(60, 300))]
        for _ in range(rng.randint(1, 9)):
            i += 1
            words = list(words)
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = f"e{rng.randint(0, 10**6)}"
            rows.append((i, " ".join(words)) + (None,) * 7)
    ids = [r[0] for r in rows]
    rng.shuffle(ids)
    return [(k, *r[1:]) for k, r in zip(ids, rows)]


@pytest.mark.parametrize("percent", [80, 85])
@pytest.mark.parametrize("make", [documents, lambda: chains(1), lambda: chains(2)])
def test_equals_brute_force(spark, percent, make):
    rows = make()
    got = near_components(spark.createDataFrame(rows, SCHEMA), percent).drop("class_id").collect()
    assert sorted(repr(tuple(r)) for r in got) == brute(rows, percent)


def test_empty_and_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert near_components(empty).count() == 0
    rows = documents()
    kept = drop_near_copies(spark.createDataFrame(rows, SCHEMA), 85)
    assert kept.columns == empty.columns


def test_plan_meets_the_miss_rate():
    for t in (0.8, 0.85, 0.9):
        rows, bands = band_plan(t)
        assert (1 - t**rows) ** bands <= 1e-5
        assert all(0 < m <= n for n, m in least_matches(t, rows * bands))


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(300)] + [(i, i + 1) for i in range(1000, 1200)]
    root = {x: x for ab in links for x in ab}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a long, b long").repartition(7)).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}


def family(seed, n=70):
    """Copies of one text with so many edits that most reach the threshold only with some others."""
    rng = random.Random(seed)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(n):
        words = list(base)
        for k in rng.sample(range(120), rng.randint(0, 6)):
            words[k] = f"e{rng.randint(0, 3)}"
        rows.append((i + 1, " ".join(words)) + (None,) * 7)
    return rows


@pytest.mark.parametrize("block", [2048, 16])
def test_dense_family(spark, block, monkeypatch):
    from parcelflow.llm import minhash

    monkeypatch.setattr(minhash.across, "__defaults__", (minhash.SHINGLE, block))
    rows = family(7)
    got = near_components(spark.createDataFrame(rows, SCHEMA), 85).drop("class_id").collect()
    assert sorted(repr(tuple(r)) for r in got) == brute(rows, 85)
