import datetime as dt

import pytest

from parcelflow.operators import diff, metrics
from parcelflow.operators.upsert import enough_succeeded

LONG = "geog_id string, propertyType string, month string, value double"


def long(spark, months, *series):
    rows = [(g, k, m, v) for g, k, values in series for m, v in zip(months, values)]
    return spark.createDataFrame(rows, LONG)


def keys(df):
    return sorted({r["geog_id"] for r in df.collect()})


MONTHS = ["2023-01", "2023-02", "2023-03", "2023-04"]
ABCD, EFGH, IJKL, MNOP = ("g10_abcd", "DETACHED"), ("g10_efgh", "CONDO"), ("g20_ijkl", "TOWNHOUSE"), ("g30_mnop", "DETACHED")


def test_new_month_returns_everything(spark):
    old = long(spark, MONTHS, (*ABCD, [100000.0, 105000.0, 110000.0]), (*EFGH, [80000.0, 82000.0, None]), (*IJKL, [None, 150000.0, 155000.0]))
    new = long(spark, MONTHS, (*ABCD, [100000.0, 105000.0, 110000.0, 115000.0]), (*EFGH, [80000.0, 83000.0, 85000.0, 87000.0]), (*IJKL, [None, 150000.0, 155000.0, 160000.0]), (*MNOP, [200000.0, 205000.0, 210000.0, 215000.0]))
    found = diff.series_delta(old, new)
    assert keys(found) == ["g10_abcd", "g10_efgh", "g20_ijkl", "g30_mnop"]
    wide = {r["geog_id"]: r for r in metrics.wide_series(found, MONTHS).collect()}
    assert wide["g10_efgh"]["2023-02"] == 83000.0 and wide["g20_ijkl"]["2023-01"] is None


def test_no_change_returns_nothing(spark):
    one = long(spark, MONTHS, (*ABCD, [100000.0]))
    assert diff.series_delta(one, one).count() == 0


def test_partial_change_returns_the_changed_key(spark):
    old = long(spark, MONTHS, (*ABCD, [100000.0, 105000.0, 110000.0]), (*EFGH, [80000.0, 82000.0, 84000.0]))
    new = long(spark, MONTHS, (*ABCD, [100000.0, 105000.0, 110000.0]), (*EFGH, [80000.0, 82000.0, 85000.0]))
    found = diff.series_delta(old, new)
    assert keys(found) == ["g10_efgh"] and found.where("month = '2023-03'").first()["value"] == 85000.0


def test_tolerant_delta(spark):
    old = long(spark, MONTHS, (*ABCD, [1.0, 2.0]), (*EFGH, [1.0, 2.0]), (*IJKL, [1.0, None]))
    new = long(spark, MONTHS, (*ABCD, [1.0 + 1e-9, 2.0]), (*EFGH, [1.0, 2.001]), (*MNOP, [1.0, 1.0]))
    assert keys(diff.tolerant_delta(old, new)) == ["g10_efgh", "g20_ijkl", "g30_mnop"]
    assert keys(diff.tolerant_delta(None, new)) == ["g10_abcd", "g10_efgh", "g30_mnop"]
    assert diff.tolerant_delta(old, new.limit(0)).count() == 0


def test_comparables_delta(spark):
    schema = "listing_id string, comps array<struct<sold_id:string,distance_km:double>>"
    old = spark.createDataFrame([("same", [("s1", 0.1)]), ("more", [("s1", 0.1)]), ("moved", [("s1", 0.1), ("s2", 0.2)]), ("gone", [("s1", 0.1)])], schema)
    new = spark.createDataFrame([("same", [("s1", 0.1 + 1e-12)]), ("more", [("s1", 0.1), ("s2", 0.2)]), ("moved", [("s1", 0.1), ("s2", 0.20000001)]), ("new", []), ("fresh", [("s9", 0.3)])], schema)
    ids = lambda df: sorted(r["listing_id"] for r in df.collect())
    assert ids(diff.comparables_delta(old, new)) == ["fresh", "more", "moved", "new"]
    assert ids(diff.comparables_delta(old, new, removals=True)) == ["fresh", "gone", "more", "moved", "new"]


def test_ids_of_comparables_are_compared_as_sets_without_being_shuffled(spark):
    schema = "listing_id string, comps array<struct<sold_id:string,distance_km:double>>"
    old = spark.createDataFrame([("swapped", [("s1", 0.1), ("s2", 0.1)]), ("other", [("s1", 0.1), ("s2", 0.1)]), ("twice", [("s1", 0.1), ("s1", 0.1)]), ("null", [("s1", 0.1), (None, 0.1)]), ("none", None), ("empty", [])], schema)
    new = spark.createDataFrame([("swapped", [("s2", 0.1), ("s1", 0.1)]), ("other", [("s1", 0.1), ("s3", 0.1)]), ("twice", [("s1", 0.1), ("s2", 0.1)]), ("null", [("s1", 0.1), ("s1", 0.1)]), ("none", None), ("empty", [])], schema)
    out = diff.comparables_delta(old, new)
    assert {r["listing_id"]: r["n"] for r in out.where("n is not null").collect()} == {"other": 2, "twice": 2, "null": 2}
    assert out.where("n is null").count() == 1
    plan = out.select("listing_id", "n")._jdf.queryExecution().optimizedPlan()
    joined = next(line for line in plan.toString().splitlines() if "Join" in line)
    assert "comps" not in joined and "comps" not in plan.toString().splitlines()[0]


def test_append_month_is_idempotent(spark):
    schema = "year_month date, geog_id string, propertyType string, current_count bigint"
    a = spark.createDataFrame([(dt.date(2024, 1, 31), "g", "CONDO", 1)], schema)
    b = spark.createDataFrame([(dt.date(2024, 1, 31), "g", "CONDO", 9), (dt.date(2024, 2, 29), "g", "CONDO", 2)], schema)
    assert sorted(r["current_count"] for r in diff.append_month(diff.append_month(a, b), b).collect()) == [1, 2]


@pytest.mark.parametrize("success, total, ok", [(0, 0, True), (1, 2, True), (1, 3, False)])
def test_load_threshold(success, total, ok):
    assert enough_succeeded(success, total) is ok
