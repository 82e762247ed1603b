import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from parcelflow.operators import lookup, mapping
from parcelflow.plans.runner import Run
from parcelflow.schemas import IMS_RAW, MAPPING, SOLD_LISTING
from parcelflow.sources import archives, listings
from parcelflow.streaming import events as E


def test_archives_newest_wins(spark, tmp_path):
    files = {
        "current_listing_counts_2024-01_20240201_df.txt": "geog_id\tpropertyType\tcurrent_count\ng1\tCONDO\t5\n",
        "current_listing_counts_2024-01_20240203_df.txt": "geog_id\tpropertyType\tcurrent_count\ng1\tCONDO\t6\n",
        "bc_current_listing_counts_2024-01_20240201_df.txt": "geog_id\tpropertyType\tcurrent_count\ng1\tCONDO\tbad\n",
        "on_last_mth_metrics_results_20240301_df.txt": "geog_id\tpropertyType\tmedian_price\tnew_listings_count\ng1\tALL\t10.5\t3.0\n",
        "readme.txt": "x\ty\tz\n1\t2\t3\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    counts = {(r["prov"], r["current_count"], r["year_month"]) for r in archives.archived_counts(spark, str(tmp_path)).collect()}
    assert counts == {("ON", 6, dt.date(2024, 1, 31)), ("BC", None, dt.date(2024, 1, 31))}
    last = [tuple(r) for r in archives.archived_last_month(spark, str(tmp_path)).collect()]
    assert last == [("ON", "2024-02", "g1", "ALL", 10.5, 3)]


def test_entries_last_row_stays(spark, tmp_path):
    (tmp_path / "e.txt").write_text("MLS\tCITY\tPROV_STATE\tGEOGRAPHIES\n1\tc\tON\tg30_new\n2\tc\tON\tg30_b\n")
    known = spark.createDataFrame([("1", "c", "ON", "g30_old"), ("3", "c", "ON", "g30_c")], "MLS string, CITY string, PROV_STATE string, GEOGRAPHIES string")
    got = {r["MLS"]: r["GEOGRAPHIES"] for r in archives.geo_entries(spark, str(tmp_path), known).collect()}
    assert got == {"1": "g30_new", "2": "g30_b", "3": "g30_c"}


def test_state_versions_and_expiry(spark, tmp_path):
    store = archives.StateStore(spark, str(tmp_path))
    assert store.get("a", dt.datetime(2024, 1, 1)) is None
    store.set("a", spark.range(1), dt.datetime(2024, 1, 1))
    store.set("a", store.get("a", dt.datetime(2024, 1, 2)).union(spark.range(1)), dt.datetime(2024, 1, 2), dt.datetime(2024, 2, 1))
    assert store.get("a", dt.datetime(2024, 1, 3)).count() == 2
    assert store.get("a", dt.datetime(2024, 2, 1)) is None
    assert store.names() == ["a"] and store.latest_in_month("a", "202401").startswith("20240102")


def test_state_deleted_restored_and_compacted(spark, tmp_path):
    day = lambda k: dt.datetime(2024, 1, k)
    store = archives.StateStore(spark, str(tmp_path))
    one, two = spark.range(1), spark.range(2)
    assert store.set("m", one, day(1)) != archives.StateStore(spark, str(tmp_path)).set("m", two, day(1))
    store.set("m", two, day(2)), store.set("other", one, day(2)), store.set("older", one, day(2))
    assert not store.delete("nothing", day(3)) and store.delete("m", day(3))
    assert store.get("m", day(4)) is None and store.get("m", day(4), at=day(2)).count() == 2 and store.names() == ["older", "other"]
    assert not store.restore("m", dt.datetime(2023, 1, 1), day(4)) and store.restore("m", day(2), day(4))
    assert store.get("m", day(5)).count() == 2 and store.latest_in_month("m", "202401").startswith("20240104")
    assert store.clear(day(6), "o") == ["older", "other"] and store.names() == ["m"]
    assert store.compact(day(6)) == 4  # both of the first day, and what was cleared; what was restored stays
    assert store.get("m", day(7)).count() == 2 and store.get("m", day(7), at=day(2)) is None
    assert store.clear(day(8)) == ["m"] and store.names() == [] and store.clear(day(9)) == []


def test_mapping_versions(spark, tmp_path):
    store = archives.StateStore(spark, str(tmp_path))
    rows = lambda kind: spark.createDataFrame([("a", "b", "c", 3, kind)], MAPPING)
    assert archives.load_mapping(store, dt.datetime(2024, 1, 1)) is None
    archives.save_mapping(store, rows("CONDO"), dt.datetime(2024, 1, 1))
    archives.save_mapping(store, rows("OTHER"), dt.datetime(2024, 2, 1))
    now = dt.datetime(2024, 3, 1)
    assert archives.load_mapping(store, now).first()["Inferred"] == "OTHER" and archives.load_mapping(store, now, dt.datetime(2024, 1, 15)).first()["Inferred"] == "CONDO"
    assert store.restore(archives.MAPPING_NAME, dt.datetime(2024, 1, 15), now) and archives.load_mapping(store, now).first()["Inferred"] == "CONDO"


def test_bad_archives_cost_only_themselves(spark, tmp_path):
    head = "geog_id\tpropertyType\tcurrent_count\n"
    files = {
        "current_listing_counts_2024-01_20240201_df.txt": head + "g1\tCONDO\t5\ng2\tALL\tmany\n\tALL\t4\n",
        "current_listing_counts_2024-13_20240201_df.txt": head + "g1\tCONDO\t5\n",
        "bc_current_listing_counts_2024-02_20240301_df.txt": head + "g1\tCONDO\t7\n",
        "notes.txt": head + "x\ty\t1\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    good, aside = archives.recovered_snapshots(spark, str(tmp_path))
    assert {tuple(r) for r in good.collect()} == {("ON", dt.date(2024, 1, 31), "g1", "CONDO", 5), ("BC", dt.date(2024, 2, 29), "g1", "CONDO", 7)}
    assert {(r["file"][:30], r["reason"], r["rows"]) for r in aside.collect()} == {("current_listing_counts_2024-01", "no count", 1), ("current_listing_counts_2024-01", "no area or type", 1), ("current_listing_counts_2024-13", "no month", 1), ("notes.txt", "no archive of counts", 1)}


def test_stages_resume(spark, tmp_path):
    run, made = Run(spark, str(tmp_path), "job"), []

    def make():
        made.append(1)
        return spark.range(3)

    assert run.stage("extract", make).count() == run.stage("extract", make).count() == 3 and len(made) == 1


def test_sold_scan(spark):
    at = dt.datetime
    rows = [{"_id": str(i), "listingStatus": s, "searchCategoryType": c, "listingType": t, "lastTransition": when} for i, (s, c, t, when) in enumerate([("SOLD", 101, "CONDO", at(2024, 1, 1)), ("SOLD", 103, None, at(2024, 2, 1)), ("SOLD", 999, None, at(2024, 1, 5)), ("ACTIVE", 103, None, at(2024, 1, 5)), ("SOLD", 101, "HOUSE", at(2024, 1, 5)), ("SOLD", 104, None, at(2024, 2, 1, 0, 0, 1))])]
    df = spark.createDataFrame([tuple(r.get(c.split()[0]) for c in SOLD_LISTING.split(", ")) for r in rows], SOLD_LISTING)
    got = {r["_id"]: r["propertyType"] for r in listings.sold_listings(df, at(2024, 1, 1), at(2024, 2, 1), ["_id", "propertyType"]).collect()}
    assert got == {"0": "CONDO", "1": "DETACHED"}
    assert listings.search(df, {"listingStatus": ["SOLD", "ACTIVE"], "searchCategoryType": 103}, ["_id"]).count() == 2
    with pytest.raises(ValueError):
        listings.deleted_listings(df)


def test_raw_sales_become_listings(spark):
    row = (dt.datetime(2024, 1, 1), 10.0, 9.0, 43.0, -79.0, 3, "W12", 7, "Town", "Old", "AB", 3, 2, "House", "Duplex", "x")
    raw = spark.createDataFrame([row], IMS_RAW)
    table = spark.createDataFrame([("House", "Duplex", "x", 1, "OTHER")], MAPPING)
    got = listings.ims_sold_listings(raw, table).first()
    assert (got["_id"], got["propertyType"], got["soldPrice"], got["daysOnMarket"]) == ("ab-7-w12", "SEMI-DETACHED", 10.0, 3.0)
    with pytest.raises(ValueError):
        listings.ims_sold_listings(raw.drop("Style"), table)


def test_pushdown(spark, tmp_path):
    rows = [tuple(None for _ in SOLD_LISTING.split(", "))]
    spark.createDataFrame(rows, SOLD_LISTING).write.parquet(f"{tmp_path}/sold")
    df = listings.sold_listings(listings.read(spark, f"{tmp_path}/sold", SOLD_LISTING), dt.datetime(2024, 1, 1), columns=["_id", "soldPrice"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") : plan.index("ReadSchema")]
    assert "listingStatus" in pushed and "lastTransition" in pushed and "daysOnMarket" not in plan[plan.index("ReadSchema") :]


def test_stream_equals_batch(spark, tmp_path):
    source = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    source.repartition(2).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(source.schema).parquet(f"{tmp_path}/in")
    q = E.tumbling(stream).writeStream.outputMode("complete").format("memory").queryName("days").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination(120)
    show = lambda df: sorted((str(r["start"]), r["event_type"], r["n"], round(r["total"], 4)) for r in df.collect())
    assert show(spark.table("days")) == show(E.tumbling(source))
    merged = []
    E.upsert_each_batch(E.unique(stream), lambda df, _: merged.append(df.count()), f"{tmp_path}/cp2").awaitTermination(120)
    assert sum(merged) == source.count()


def test_lookups(spark):
    long = spark.createDataFrame([("g", "ALL", "2024-02", 2.0), ("g", "ALL", "2024-01", 1.0), ("g", "ALL", "2024-03", None), ("g", "CONDO", "2024-01", 9.0)], "geog_id string, propertyType string, month string, value double")
    assert [r["value"] for r in lookup.time_series(long, "g", "all").collect()] == [1.0, 2.0] == [r["value"] for r in lookup.time_series(long, "g").collect()]
    lines = spark.createDataFrame([("2024-01-01 10:00:00 x [MONITOR] job_a extract completed in 1.5 seconds",), ("2024-01-01 09:00:00 x [MONITOR] job_a extract started",), ("noise",)], "value string")
    one = lookup.job_times(lookup.job_stages(lines)).first()
    assert (one["job_id"], one["seconds"]) == ("job_a", 1.5) and one["started"] < one["ended"]
    triples = mapping.combinations(spark.createDataFrame([("b", None, "x"), ("a", "s", "x"), ("a", "s", "x")], "Type string, SubType string, Style string"))
    assert [r["Type"] for r in lookup.review_batch(triples, 0, 1).collect()] == ["a"]
    geo = spark.createDataFrame([("g1", [[(0.0, 0.0), (0.0, 2.0), (2.0, 0.0)]]), ("g2", None)], "geog_id string, rings array<array<struct<lat:double,lng:double>>>")
    point = lookup.sample_points(geo, 3).collect()
    assert len(point) == 1 and point[0]["lat"] + point[0]["lng"] <= 2.0 and lookup.sample_area(geo, 1).count() == 1


def test_every_query_has_an_oracle_or_is_known_not_to():
    without = set(__spark_entry__.queries()) - set(__spark_entry__.oracle_sql())
    assert {n for n in without if not n.startswith("op") and n != "pipeline"} <= {"c03_comparables_delta"}
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
