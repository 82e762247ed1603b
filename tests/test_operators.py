import datetime as dt
import math

from pyspark.sql import functions as F

from parcelflow.functions import expressions as X
from parcelflow.functions.classifier import classify
from parcelflow.functions.polygons import area, contains_point, perimeter, simplify
from parcelflow.operators import areas, mapping, merge, metrics, nearby, upsert
from parcelflow.plans import absorption, asking, comparables, sold_series
from parcelflow.queries import TRIPLES
from parcelflow.schemas import MARKET_TRENDS

SOLD = "_id string, guid string, propertyType string, lastTransition timestamp_ntz, soldPrice double, price double, daysOnMarket double"


def at(*x):
    return dt.datetime(*x)


def test_window_flags_and_medians(spark):
    rows = [
        ("in", "g10_a,g30_b", "CONDO", at(2019, 8, 1), 110.0, 100.0, 3.0),  # first moment of the window
        ("out", "g10_a", "CONDO", at(2024, 8, 15), 9.0, 9.0, 9.0),  # today
        ("a", "g10_a", "CONDO", at(2024, 7, 2), 100.0, 100.0, None),
        ("b", "g10_a", "CONDO", at(2024, 7, 3), 200.0, 100.0, 5.0),
        ("c", "g10_a", None, at(2024, 7, 4), 90.0, 100.0, 7.0),
        ("d", "None", "CONDO", at(2024, 7, 4), 90.0, 100.0, 7.0),
        ("e", "", "CONDO", at(2024, 7, 4), None, 100.0, 7.0),
        ("f", "g10_a", "CONDO", at(2024, 7, 31, 23, 59), None, 100.0, None),
    ]
    got = {(r["geog_id"], r["propertyType"], r["month"]): r for r in sold_series.series(spark.createDataFrame(rows, SOLD), at(2024, 8, 15, 9)).collect()}
    assert set(got) == {("g10_a", "CONDO", "2019-08"), ("g10_a", "ALL", "2019-08"), ("g30_b", "CONDO", "2019-08"), ("g30_b", "ALL", "2019-08"), ("g10_a", "CONDO", "2024-07"), ("g10_a", "ALL", "2024-07")}
    condo, every = got["g10_a", "CONDO", "2024-07"], got["g10_a", "ALL", "2024-07"]
    assert (condo["median_sold_price"], condo["median_dom"], condo["sold_listing_count"]) == (150.0, 5.0, 3)
    assert math.isclose(condo["over_ask_percentage"], 100 / 3) and condo["below_ask_percentage"] == 0
    assert (every["median_sold_price"], every["sold_listing_count"], every["below_ask_percentage"]) == (100.0, 4, 25.0)
    assert sold_series.series(spark.createDataFrame([], SOLD), at(2024, 8, 15)).count() == 0


def test_sold_run_gives_changed_series(spark):
    rows = [("a", "g10_a", "CONDO", at(2024, 7, 2), 100.0, 100.0, 1.0), ("b", "g10_b", "CONDO", at(2024, 7, 3), 200.0, 100.0, 5.0)]
    first = sold_series.run(spark.createDataFrame(rows, SOLD), at(2024, 8, 15))
    rows[1] = ("b", "g10_b", "CONDO", at(2024, 7, 3), 300.0, 100.0, 5.0)
    second = sold_series.run(spark.createDataFrame(rows, SOLD), at(2024, 8, 15), previous=first["series"])
    assert {(r["geog_id"], r["metric"]) for r in second["changed"].collect()} == {("g10_b", "median_sold_price")}


def test_ratios(spark):
    month = "geog_id string, propertyType string, month string, {} bigint"
    sold = spark.createDataFrame([("g", "A", "2024-01", 4), ("g", "A", "2024-02", 6), ("h", "A", "2024-01", 1), ("k", "A", "2023-01", 1)], month.format("sold_count"))
    now = spark.createDataFrame([("g", "A", "2024-01", 2), ("g", "A", "2024-02", 0), ("m", "A", "2024-01", 5), ("h", "A", "2024-02", 3)], month.format("current_count"))
    got = {(r["geog_id"], r["month"]): (r["absorption_rate"], r["months_of_inventory"]) for r in metrics.absorption(sold, now).collect()}
    assert got == {("g", "2024-01"): (2.0, 0.5), ("g", "2024-02"): (None, 0.0), ("h", "2024-01"): (None, 0.0), ("h", "2024-02"): (0.0, None)}


def test_inventory_leaves_out_untyped_rows(spark):
    rows = spark.createDataFrame([("1", "g10_a", "CONDO"), ("2", "g10_a", None), ("3", "g10_a", "DETACHED")], "_id string, guid string, propertyType string")
    got = {r["propertyType"]: (r["current_count"], r["year_month"]) for r in absorption.snapshot(rows, at(2024, 3, 1)).collect()}
    assert got == {"CONDO": (1, dt.date(2024, 2, 29)), "DETACHED": (1, dt.date(2024, 2, 29)), "ALL": (2, dt.date(2024, 2, 29))}


TRACKED = "_id string, guid string, propertyType string, price double, addedOn timestamp_ntz, lastUpdate timestamp_ntz, is_deleted boolean"


def test_dense_keeps_every_month(spark):
    months = [f"{y:04d}-{m:02d}" for y in range(1900, 2030) for m in range(1, 13)]
    rows = [("g30_n1", "CONDO", m, 1) for m in months] + [("g40_r1", "ALL", "2029-12", 4), ("g40_r1", "ALL", "2029-12", 6), ("g40_r1", "ALL", None, 1)]
    out = metrics.dense(spark.createDataFrame(rows, "geog_id string, propertyType string, month string, n long"), "n").collect()
    assert len(out) == 2 * (len(months) + 1) and {r["month"] for r in out} == {*months, None}
    got = {(r["geog_id"], r["month"]): r["n"] for r in out}
    assert got["g30_n1", "2029-12"] == 1 and got["g40_r1", "2029-12"] == 5 and got["g40_r1", "1900-01"] == 0


def test_order_of_filter_and_latest(spark):
    rows = [("1", "g10_a", "CONDO", 100.0, at(2024, 6, 3), at(2024, 6, 3), False), ("1", "g10_a", "CONDO", 300.0, at(2024, 6, 3), at(2024, 6, 9), True), ("2", "g10_a", "CONDO", 500.0, at(2024, 5, 3), None, None)]
    df = spark.createDataFrame(rows, TRACKED)
    last = {r["propertyType"]: (r["median_price"], r["new_listings_count"]) for r in asking.last_month(df, at(2024, 7, 1)).collect()}
    assert last == {"CONDO": (300.0, 1), "ALL": (300.0, 1)}  # the older live row stands in
    geo = spark.createDataFrame([("g10_a",), ("g10_z",)], "geog_id string")
    now = {(r["geog_id"], r["propertyType"]): (r["median_price"], r["new_listings_count"]) for r in asking.current_month({"ON": df}, geo, at(2024, 6, 20)).collect()}
    assert len(now) == 10 and now["g10_a", "ALL"] == (500.0, 0) and now["g10_z", "ALL"] == (None, 0)


def test_merges(spark):
    a = spark.createDataFrame([("1", "old"), ("2", "old")], "_id string, v string")
    b = spark.createDataFrame([("2", "new"), ("3", "new")], "_id string, v string")
    rows = lambda df: sorted((r["_id"], r["v"]) for r in df.collect())
    assert rows(merge.keep_first(a, b)) == [("1", "old"), ("2", "old"), ("3", "new")]
    assert rows(merge.keep_last(a, b)) == [("1", "old"), ("2", "new"), ("3", "new")]
    times = spark.createDataFrame([("1", None), ("2", at(2024, 1, 1)), ("3", at(2024, 1, 2))], "_id string, lastTransition timestamp_ntz")
    assert sorted(r[0] for r in merge.not_expired(times, at(2024, 1, 2)).collect()) == ["1", "3"]
    seen = spark.createDataFrame([("added", at(2024, 1, 1), None), ("edge", None, at(2024, 1, 1)), ("within", None, at(2024, 1, 1, 0, 0, 1)), ("none", None, None)], "_id string, addedOn timestamp_ntz, lastUpdate timestamp_ntz")
    assert sorted(r[0] for r in seen.where(merge.changed_between(at(2024, 1, 1), at(2024, 1, 2))).collect()) == ["added", "within"]


def test_radius_join_equals_brute_force(spark):
    points = [(43.6 + i * 0.0009, -79.4 + (i * i % 17) * 0.001, i % 2) for i in range(80)] + [(60.999, 10.0, 0), (61.001, 10.0, 0), (61.001, 10.017, 0), (None, 1.0, 0), (43.6, None, 1)]
    schema = "_id string, propertyType string, bedsInt int, bathsInt int, lat double, lng double"
    sold = [(f"s{i}", "CONDO", k, 1, y, x) for i, (y, x, k) in enumerate(points)]
    active = [(f"a{i}", "CONDO", k, 1, None if y is None else y + 0.0005, x) for i, (y, x, k) in enumerate(points[::3])]
    active += [("same", "CONDO", 0, 1, 43.6, -79.4), ("other", "DETACHED", 0, 1, 43.6, -79.4)]

    def km(a, b):
        p, q = math.radians(a[4]), math.radians(b[4])
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[5] - a[5]) / 2) ** 2
        return 2 * 6371 * math.atan2(math.sqrt(h), math.sqrt(1 - h))

    want = {}
    for a in active:
        near = sorted((km(a, s), s[0]) for s in sold if None not in (a[4], s[4], s[5], a[5]) and a[1:4] == s[1:4])
        want[a[0]] = [i for d, i in near if d < 1.0][:12]
    a, s = spark.createDataFrame(active, schema), spark.createDataFrame(sold, schema)
    got = {r["listing_id"]: [c["sold_id"] for c in r["comps"]] for r in comparables.run(a, s)["comparables"].collect()}
    assert got == want and any(len(x) > 3 for x in want.values())
    assert nearby.comparables(a, s).count() == sum(map(len, want.values()))


def square(y, x, size=1.0):
    return [[(y, x), (y, x + size), (y + size, x + size), (y + size, x)]]


GEO = "geog_id string, name string, level int, province string, parent_id string, rings array<array<struct<lat:double,lng:double>>>"


def catalogue(spark):
    rows = [("g40_r", "R", 40, "ON", None, square(0.0, 0.0, 4.0)), ("g30_a", "A", 30, "ON", "g40_r", square(0.0, 0.0, 2.0)), ("g30_b", "B", 30, "ON", "g40_r", square(0.0, 1.5, 2.0)), ("g10_x", "X", 10, "ON", "g30_a", square(0.0, 0.0)), ("g10_none", "N", 10, "ON", "g30_a", None), ("g10_orphan", "O", 10, "QC", "g30_gone", square(9.0, 9.0))]
    return spark.createDataFrame(rows, GEO)


def test_points_edges_and_overlaps(spark):
    geo = catalogue(spark)
    points = spark.createDataFrame([("inside", 0.5, 0.5), ("edge", 1.0, 0.5), ("corner", 4.0, 4.0), ("both", 0.5, 1.7), ("out", 8.0, 8.0), ("null", None, 1.0)], "_id string, lat double, lng double")
    got = {}
    for r in areas.points_in_areas(points, geo).collect():
        got.setdefault(r["_id"], set()).add(r["geog_id"])
    assert got == {"inside": {"g40_r", "g30_a", "g10_x"}, "edge": {"g40_r", "g30_a", "g10_x"}, "corner": {"g40_r"}, "both": {"g40_r", "g30_a", "g30_b"}}
    overlaps = areas.overlapping(geo)
    assert {tuple(r) for r in overlaps.collect()} == {("g30_a", "g30_b"), ("g30_b", "g30_a")}
    listings = points.withColumn("guid", F.when(F.col("_id") == "edge", "g10_kept"))
    made = {r["_id"]: (r["guid"], r["computed_guid"]) for r in areas.assign_guids(listings, geo, overlaps).collect()}
    assert made["inside"] == ("g10_x,g30_a,g40_r",) * 2 and made["both"][0] == "g30_b,g30_a,g40_r"
    assert made["edge"] == ("g10_kept", None) and made["out"] == (None, None)
    again = areas.reset_computed_guids(areas.assign_guids(listings, geo))
    assert {r["guid"] for r in again.collect()} == {"g10_kept", None}


def test_parents_by_name_or_containment(spark):
    got = {(r["geog_id"], r["parent_id"]) for r in areas.find_parents(catalogue(spark).drop("parent_id")).collect()}
    assert ("g10_x", "g30_a") in got and ("g30_a", "g40_r") in got and not any(g == "g10_orphan" for g, _ in got)
    assert ("g30_b", "g40_r") in got


def test_hierarchy(spark):
    geo = catalogue(spark)
    assert {r["geog_id"]: r["children"] for r in areas.children(geo).collect()}["g30_a"] == ["g10_none", "g10_x"]
    up = {(r["geog_id"], r["ancestor_id"], r["depth"]) for r in areas.ancestors(geo).collect()}
    assert {("g10_x", "g30_a", 1), ("g10_x", "g40_r", 2), ("g10_orphan", "g30_gone", 1)} <= up


def test_polygon_functions(spark):
    df = spark.createDataFrame([(square(0.0, 0.0, 2.0),)], "rings array<array<struct<lat:double,lng:double>>>")
    r = df.select(area(F.col("rings")).alias("a"), perimeter(F.col("rings")).alias("p"), contains_point(F.col("rings"), F.lit(0.0), F.lit(1.0)).alias("on"), contains_point(F.col("rings"), F.lit(0.0), F.lit(1.0), touching=False).alias("off")).first()
    assert tuple(r) == (4.0, 8.0, True, False)
    ring = [(0.0, 0.0), (0.001, 1.0), (0.0, 2.0), (1.0, 2.0), (1.0, 0.0), (0.0, 0.0)]
    one = spark.createDataFrame([([ring],), (None,)], "rings array<array<struct<lat:double,lng:double>>>").select(simplify("rings", 0.01).alias("s")).collect()
    assert [tuple(p) for p in one[0]["s"][0]] == [(0.0, 0.0), (0.0, 2.0), (1.0, 2.0), (1.0, 0.0), (0.0, 0.0)] and one[1]["s"] is None


def test_months_in_arrays(spark):
    df = spark.createDataFrame([([("2024-01", 1.0), ("2024-02", 2.0)],), (None,)], "s array<struct<month:string,value:double>>")
    put = lambda m, v: [r[0] for r in df.select(F.transform(upsert.put_or_remove_month(F.col("s"), F.lit(m), F.lit(v).cast("double")), lambda x: F.concat_ws(":", x["month"], x["value"].cast("string")))).collect()]
    assert put("2024-01", 9.0)[0] == ["2024-01:9.0", "2024-02:2.0"] and put("2024-03", 3.0)[0][-1] == "2024-03:3.0"
    assert put("2024-03", 3.0)[1] == ["2024-03:3.0"] and put("2024-02", None)[0] == ["2024-01:1.0"]


def test_upserts_keep_other_metrics(spark):
    stamp = F.lit("2024-01-01").cast("timestamp_ntz")
    docs = spark.createDataFrame([], MARKET_TRENDS)
    series = spark.createDataFrame([("g30_a", "ALL", [("2024-01", 5.0)])], "geog_id string, propertyType string, series array<struct<month:string,value:double>>")
    docs = upsert.replace_series(docs, series, "median_sold_price", stamp)
    value = spark.createDataFrame([("g30_a", "ALL", 7.0), ("g30_b", "ALL", 8.0)], "geog_id string, propertyType string, value double")
    docs = upsert.upsert_month(docs, value, "last_mth_median_asking_price", F.lit("2024-02"), stamp)
    got = {r["geog_id"]: r["metrics"] for r in docs.collect()}
    assert got["g30_a"]["median_sold_price"][0]["value"] == 5.0 and got["g30_a"]["last_mth_median_asking_price"][0]["value"] == 7.0
    assert got["g30_b"]["median_sold_price"] is None
    cleared = upsert.remove_metrics(docs, ["median_sold_price"]).collect()
    assert all(r["metrics"]["median_sold_price"] is None for r in cleared)


def test_classifier_and_mapping(spark):
    rows = spark.createDataFrame([(t, s, y, e) for t, s, y, e in TRIPLES], "Type string, SubType string, Style string, want string")
    wrong = rows.withColumn("got", classify(F.col("Type"), F.col("SubType"), F.col("Style"))).where("not (got <=> want)").collect()
    assert not wrong
    found = mapping.merge_mapping(mapping.combinations(rows), None)
    assert mapping.refresh_unclear(found).exceptAll(found).count() == 0
    broken = found.withColumn("Inferred", F.when(F.col("Type") == "Condo Apt", "LAND_VACANT").otherwise(F.col("Inferred")))
    assert mapping.refresh_unclear(broken, strict=False).exceptAll(broken).count() == 0


def test_expressions(spark):
    df = spark.createDataFrame([("g10_a,g30_b,g30_c", "2024-01-05T10:11:12.5", "g10_a"), (None, "24-01-05:10:11:12", "x")], "guid string, t string, g string")
    rows = df.select(X.level_ids("guid").alias("m"), X.parsed_time("t").alias("t"), X.geo_level("g").alias("l")).collect()
    assert rows[0]["m"] == {10: "g10_a", 30: "g30_c"} and rows[0]["l"] == 10 and rows[1]["l"] is None
    assert rows[1]["t"] == at(2024, 1, 5, 10, 11, 12)
    assert X.window_start(at(2024, 3, 31)) == at(2019, 3, 1) and X.month_of(at(2024, 1, 31), 1) == "2023-12"


def test_hierarchies_of_any_depth_and_circles(spark):
    rows = [("a", None), ("b", "a"), ("c", "b"), ("d", "c"), ("e", "d"), ("f", "e"), ("g", "f"), ("x", "y"), ("y", "x"), ("self", "self"), ("lost", "gone")]
    got = {tuple(r) for r in areas.ancestors(spark.createDataFrame(rows, "geog_id string, parent_id string")).collect()}
    chain = "abcdefg"
    want = {(chain[i], chain[j], i - j) for i in range(7) for j in range(i)} | {("x", "y", 1), ("y", "x", 1), ("self", "self", 1), ("lost", "gone", 1)}
    assert got == want
    assert areas.ancestors(spark.createDataFrame([], "geog_id string, parent_id string")).count() == 0


def test_guids_by_parents_by_level_and_pushed(spark):
    geo = catalogue(spark)
    points = spark.createDataFrame([("inside", 0.5, 0.5), ("both", 0.5, 1.7), ("out", 8.0, 8.0), ("orphan", 9.5, 9.5)], "_id string, lat double, lng double")
    assert {tuple(r) for r in areas.chased_guids(points, geo).collect()} == {("inside", "g10_x,g30_a,g40_r"), ("both", "g30_a,g40_r"), ("orphan", "g10_orphan,g30_gone")}
    assert {tuple(r) for r in areas.first_per_level(points, geo).collect()} == {("inside", "g10_x,g30_a,g40_r"), ("both", "g30_a,g40_r"), ("orphan", "g10_orphan")}
    now = at(2024, 4, 10, 12)
    rows = [("new", None, at(2024, 4, 1), 1.0, 1.0), ("edge", "None", at(2024, 1, 11), 1.0, 1.0), ("old", None, at(2024, 1, 10), 1.0, 1.0), ("has", "g10_own", at(2024, 4, 1), 1.0, 1.0), ("nowhere", None, at(2024, 4, 1), 95.0, 1.0), ("unknown", None, at(2024, 4, 1), 1.0, 1.0), ("no day", None, None, 1.0, 1.0)]
    sold = spark.createDataFrame(rows, "_id string, guid string, lastTransition timestamp_ntz, lat double, lng double")
    known = spark.createDataFrame([(i, "g10_known") for i in ("new", "edge", "old", "has", "nowhere", "no day", "new")] + [("unknown", "None")], "_id string, guid string")
    got = {r["_id"]: r["guid"] for r in areas.push_guids(sold, known, now).collect()}
    assert got == {"new": "g10_known", "edge": "g10_known", "old": None, "has": "g10_own", "nowhere": None, "unknown": None, "no day": None}


def test_recovered_and_removed_series(spark):
    stamp, later = F.lit("2024-01-01").cast("timestamp_ntz"), F.lit("2024-01-02").cast("timestamp_ntz")
    old = spark.createDataFrame([("g30_a", "ALL", 7), ("g30_kept", "ALL", 8)], "geog_id string, propertyType string, value bigint")
    docs = upsert.upsert_month(spark.createDataFrame([], MARKET_TRENDS), old, "last_mth_new_listings", F.lit("1999-01"), stamp)
    docs = upsert.upsert_month(docs, old.withColumn("value", F.lit(5.0)), "absorption_rate", F.lit("1999-01"), stamp)
    archived = [("g30_a", "ALL", "2024-02", 2.0, 20), ("g30_a", "ALL", "2024-01", None, 10), ("g30_new", "CONDO", "2024-01", 3.0, None), ("bad", "ALL", "2024-01", 1.0, 1), ("g30_a", None, "2024-01", 1.0, 1), ("g30_a", "ALL", None, 1.0, 1)]
    rows = spark.createDataFrame(archived, "geog_id string, propertyType string, month string, median_price double, new_listings_count bigint")
    out = {r["geog_id"]: r for r in upsert.recover_last_month(docs, rows, later).collect()}
    series = lambda g, n: [tuple(x) for x in out[g]["metrics"][n]] if out[g]["metrics"][n] is not None else None
    assert out.keys() == {"g30_a", "g30_kept", "g30_new"}
    assert series("g30_a", "last_mth_new_listings") == [("2024-01", 10), ("2024-02", 20)] and series("g30_a", "last_mth_median_asking_price") == [("2024-02", 2.0)]
    assert series("g30_a", "absorption_rate") == [("1999-01", 5.0)] and series("g30_kept", "last_mth_new_listings") == [("1999-01", 8)]
    assert series("g30_new", "last_mth_new_listings") == [] and series("g30_new", "last_mth_median_asking_price") == [("2024-01", 3.0)]
    gone = upsert.remove_group(docs, "absorption", later).collect()
    assert all(r["metrics"]["absorption_rate"] is None and r["metrics"]["last_mth_new_listings"] and r["last_updated"] == at(2024, 1, 2) for r in gone)
    assert upsert.remove_comparables(docs).columns == docs.columns
