import hashlib
import re
from collections import defaultdict

import pytest

from parcelflow.llm.exact_dedup import drop_exact_copies, exact_dedup

from .cases import SCHEMA, documents


def brute(rows):
    digest = [hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "").encode()).hexdigest() for r in rows]
    ids = defaultdict(list)
    for r, d in zip(rows, digest):
        ids[d].append(r[0])
    keep = {d: min([x for x in v if x is not None], default=None) for d, v in ids.items()}
    return sorted(map(repr, ((r[0], keep[d], len(ids[d]), r[0] == keep[d], d) for r, d in zip(rows, digest))))


@pytest.mark.parametrize("support", [1e-3, 0.05, 0.5])
def test_equals_brute_force(spark, support):
    rows = documents()
    got = exact_dedup(spark.createDataFrame(rows, SCHEMA), support=support).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute(rows)


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_dedup(empty).count() == 0
    assert drop_exact_copies(empty).columns == empty.columns


def test_no_python_in_plan(spark):
    plan = exact_dedup(spark.createDataFrame(documents(), SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_drop_keeps_one_of_each(spark):
    rows = documents()
    kept = drop_exact_copies(spark.createDataFrame(rows, SCHEMA)).collect()
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    assert {norm(r["text"]) for r in kept} == {norm(r[1]) for r in rows}
