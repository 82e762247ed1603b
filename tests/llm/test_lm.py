import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from parcelflow.llm.lm import NONE, Model, bucket_of, score_documents

from .cases import SCHEMA, documents


def brute(rows, parts=7, held=2):
    """Every document's scores from plain counts, with the weights fitted on all deleted counts."""
    texts = []
    for r in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or "")
        texts.append([x for x in re.split(r"[\x20\x09-\x0D]+", low) if x] + ["</s>"])
    out = [r[0] is not None and zlib.crc32(str(r[0]).encode()) % parts == held for r in rows]
    uni, bi, docs = Counter(), Counter(), 0
    for t, h in zip(texts, out):
        if not h:
            docs += 1
            uni.update(t)
            bi.update(zip(["<s>", *t], t))
    n, v = sum(uni.values()), len(uni)
    model = Model(n, docs, v)
    context = lambda u: docs if u == "<s>" else uni[u]
    histogram = Counter()
    q = lambda x, over: round(4 * math.log2(x / over)) if x > 0 else NONE
    for t, h in zip(texts, out):
        if not h:
            for u, w in zip(["<s>", *t], t):
                p2, p1, p0 = (float(x) for x in model.estimates(np.array(bi[u, w]), np.array(context(u)), np.array(uni[w]), 1))
                histogram[int(bucket_of(np.array(context(u) - 1))), q(p2, p0), q(p1, p0)] += 1
    model.fit([(*k, c) for k, c in histogram.items()])
    want = []
    for r, t, h in zip(rows, texts, out):
        base = sum(math.log10((uni[w] + 1) / (n + v + 1)) for w in t)
        score = 0.0
        for u, w in zip(["<s>", *t], t):
            weights = model.weights[int(bucket_of(np.array(context(u))))]
            score += math.log10(sum(float(a) * float(b) for a, b in zip(weights, model.estimates(np.array(bi[u, w]), np.array(context(u)), np.array(uni[w])))))
        want.append((str(r[0]), None if r[0] is None else h, len(t), sum(uni[w] > 0 for w in t), n, round(base, 6), round(score, 3)))
    return sorted(map(repr, want))


@pytest.mark.parametrize("bounds", [{}, {"chunk_bytes": 3000, "bucket_keys": 500}])
def test_equals_brute_force(spark, bounds):
    rows = [r for r in documents() if len(r[1] or "") < 20_000]
    got = score_documents(spark.createDataFrame(rows, SCHEMA).repartition(3), **bounds).collect()
    assert sorted(repr((str(r[0]), *r[1:5], round(r[5], 6), round(r[6], 3))) for r in got) == brute(rows)


def test_probabilities_sum_to_one():
    model = Model(100, 5, 30)
    model.fit([(3, 12, 4, 10), (3, NONE, 2, 5), (0, NONE, 3, 2)])
    assert np.allclose(model.weights.sum(1), 1) and model.weights[0, 0] == 0


def test_better_than_base_on_held_out(spark):
    rows = [(i, " ".join(f"w{(i + k) % 9}" for k in range(40)), *[None] * 7) for i in range(1, 200)]
    got = [r for r in score_documents(spark.createDataFrame(rows, SCHEMA)).collect() if r["held_out"]]
    assert got and sum(r["score"] for r in got) > 0.5 * sum(r["base_score"] for r in got)


def test_empty(spark):
    assert score_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    only = spark.createDataFrame([(1, None, *[None] * 7), (2, "a b", *[None] * 7)], SCHEMA)
    assert score_documents(only, parts=1, held=0).count() == 2


def test_words_whose_mixed_keys_begin_alike_stay_apart(spark):
    from parcelflow.llm.textbytes import NOT_SPACE, U64, buffers, mix, words
    import pyarrow as pa

    names = [f"w{i}" for i in range(400_000)]
    data, offsets = buffers(pa.array([" ".join(names)]))
    top = mix(words(data, offsets, NOT_SPACE).key) >> U64(32)
    order = np.argsort(top, kind="stable")
    at = int(np.flatnonzero(np.diff(top[order]) == 0)[0])
    one, other = names[order[at]], names[order[at + 1]]
    out = [i for i in range(1, 100) if zlib.crc32(str(i).encode()) % 7 == 2][0]
    learned = [i for i in range(1, 100) if zlib.crc32(str(i).encode()) % 7 != 2][0]
    rows = [(learned, f"{one} a b", *[None] * 7), (out, f"{other} a", *[None] * 7)]
    got = {r["doc_id"]: r for r in score_documents(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[out]["n_known"] == 2 and got[learned]["n_known"] == 4
    assert sorted(repr((str(r[0]), *r[1:5], round(r[5], 6), round(r[6], 3))) for r in got.values()) == brute(rows)
