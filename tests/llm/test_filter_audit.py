import collections
import itertools
import re

import pytest

from parcelflow.llm import filter_audit
from parcelflow.llm.filter_audit import audit_filters, failures

from .cases import SCHEMA, documents

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def rows():
    more = [(9000 + k, t, lang, *[None] * 6) for k, (t, lang) in enumerate([("A B", "en"), ("A B", "de"), ("A C", ""), ("x" * 500, None), ("x" * 499 + "y", None), ("#", "en"), ("$" * 5000, "en")])]
    more += [(9001, "A B", "fr", *[None] * 6), (None, "A B", "fr", *[None] * 6), (9100, "x" * 500, None, *[None] * 6)]
    return documents(seed=4) + more


LABELS = [(d, q, t) for d, q, t in [(3, 1, 0), (4, 0, 1), (5, 1, 1), (5, 1, 1), (5, None, None), (9000, 1, 1), (9001, 1, 0), (None, 1, 1), (88, 0, 0)]]


def expected_fails(table):
    first = {}
    for r in table:
        if r[0] is not None:
            first[r[1] or ""] = min(r[0], first.get(r[1] or "", r[0]))
    out = []
    for r in table:
        t = r[1] or ""
        w = [x for x in SPACE.split(t) if x]
        f = "A" * (len(w) < 100) + "B" * (100 * len(set(w)) < 80 * len(w)) + "C" * (100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t))
        f += "D" * any(c in t for c in "#$%&*|") + "E" * (r[0] is not None and r[0] > first[t])
        out.append((r[0], r[2] or "", f))
    return out


@pytest.mark.parametrize("chance", [False, True])
def test_audit_equals_applying_each_order(spark, monkeypatch, chance):
    if chance:  # different texts of one length share a class
        from pyspark.sql import functions as F

        monkeypatch.setattr(filter_audit, "_blocks", lambda text: [F.lit(0), F.lit(0), F.lit(0)])
    table = rows()
    want_fails = expected_fails(table)
    docs = spark.createDataFrame(table, SCHEMA)
    assert sorted(map(repr, map(tuple, failures(docs).collect()))) == sorted(map(repr, want_fails))

    good, toxic = {d for d, q, _ in LABELS if q == 1} - {None}, {d for d, _, t in LABELS if t == 1} - {None}
    got = {tuple(r)[:3]: tuple(r)[3:] for r in audit_filters(docs, spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")).collect()}
    want, shapley = {}, collections.Counter()
    for part in {p for _, p, _ in want_fails}:
        for order in map("".join, itertools.permutations("ABCDE")):
            left = [(d, f) for d, p, f in want_fails if p == part]
            gone = []
            for step, letter in enumerate(order, 1):
                now = [x for x in left if letter in x[1]]
                redundant = sum(letter in f for _, f in gone)
                left = [x for x in left if letter not in x[1]]
                gone += now
                shapley[part, letter] += len(now)
                unique = sum(f == letter for _, p, f in want_fails if p == part)
                want[part, order, step] = (len(left), len(now), redundant, unique, sum(d in good for d, _ in now), sum(d in toxic for d, _ in now))
    assert got == {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in want.items()}


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit_filters(spark.createDataFrame([], SCHEMA), labels).count() == 0
    one = audit_filters(spark.createDataFrame([(1, None, None)], "doc_id long, text string, lang string"), labels)
    assert one.count() == 600 and one.agg({"removed": "sum"}).first()[0] == 120


def test_other_filters_and_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "x", 5, 6, 7), (2, "a b", "x", 5, 6, 7)], "`my id` long, `te.xt` string, part_of string, class int, `a.b` int, fails int")
    got = failures(docs, "my id", "`te.xt`", "part_of", filters={"S": lambda t: t.contains(" ")}, copies="C").collect()
    assert sorted(map(tuple, got)) == [(1, "x", "S"), (2, "x", "CS")]
