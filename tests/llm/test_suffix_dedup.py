import hashlib
from collections import Counter

import numpy as np
import pytest

from parcelflow.llm.suffix_dedup import cut_repeats, suffix_dedup
from parcelflow.llm.suffixes import common_prefixes, suffix_array

from .cases import SCHEMA, documents


def brute(rows, length):
    raw = [(r[1] or "").encode() for r in rows]
    seen = Counter(t[i : i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for r, t in zip(rows, raw):
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((gone[1:] < gone[:-1]).sum())
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((r[0], len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(map(repr, out))


@pytest.mark.parametrize("length, bounds", [(400, {}), (64, {}), (400, {"shard_bytes": 3000}), (64, {"shard_contexts": 1}), (400, {"shard_contexts": 2, "shard_bytes": 2000})])
def test_equals_brute_force(spark, length, bounds):
    rows = documents()
    got = suffix_dedup(spark.createDataFrame(rows, SCHEMA).repartition(5), length=length, **bounds).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute(rows, length)


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert suffix_dedup(empty).count() == 0
    assert cut_repeats(empty).columns == empty.columns


def test_cut_keeps_columns(spark):
    rows = documents()
    got = cut_repeats(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == [c.split()[0] for c in SCHEMA.split(", ")] and got.count() == len(rows)
    assert {r["text"] for r in got.collect() if r["text"] is None} == {None}


@pytest.mark.parametrize("seed", range(12))
def test_suffix_array_and_prefixes(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 400))
    text = rng.integers(0, int(rng.integers(1, 6)), n).astype(np.uint8)
    if seed % 3 == 0:
        text = np.tile(text[: max(1, n // 7)], 9)
    n = len(text)
    order = suffix_array(text)
    raw = text.tobytes()
    assert order.tolist() == sorted(range(n), key=lambda i: raw[i:])
    wall = 4 if seed % 2 else 255
    plcp, before = common_prefixes(text, order, wall)
    for k, i in enumerate(order.tolist()):
        j = int(order[k - 1]) if k else i
        assert before[i] == j
        length = 0
        while j != i and max(i, j) + length < n and raw[i + length] == raw[j + length] != wall:
            length += 1
        assert plcp[i] == length


def test_names_beyond_the_buckets():
    rng = np.random.default_rng(9)
    text = rng.integers(0, 5000, 3000)
    text = np.concatenate([text, text[100:900], text])
    assert suffix_array(text, 5000).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
