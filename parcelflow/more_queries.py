"""More queries: operators that queries.py leaves out, on the surrogate tables or on fixed rows, and the same in SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from . import surrogate as S
from .functions import expressions as X
from .functions import polygons
from .operators import areas, diff, lookup, mapping, merge, metrics, nearby, upsert
from .plans import absorption, asking, comparables, sold_series
from .plans.runner import Run, kept, scratch
from .queries import _CODED_SQL, _RATES_SQL, ACTIVE_AS_OF, AS_OF, _coded, _documents, _snapshots, _time, _triples, _TRIPLES_SQL, _values, query
from .schemas import MARKET_TRENDS
from .sources import listings

_CODES = "CASE propertyType WHEN 'CONDO' THEN 101 WHEN 'TOWNHOUSE' THEN 102 WHEN 'DETACHED' THEN 103 WHEN 'SEMI-DETACHED' THEN 104 ELSE 105 END"
_FOUR = "propertyType IN ('CONDO', 'TOWNHOUSE', 'DETACHED', 'SEMI-DETACHED')"


def _raw(rows):
    """Listings as the source has them: a category code and listing types instead of a property type."""
    return rows.withColumns({"searchCategoryType": F.expr(_CODES), "listingType": F.expr("CASE WHEN propertyType = 'CONDO' THEN 'REC, X' ELSE 'X' END"), "provState": F.lit("ON")}).drop("propertyType")


@query("s01_sold_listings", "sold", f"SELECT _id, soldPrice, propertyType FROM sold WHERE {_FOUR} AND lastTransition >= TIMESTAMP '2000-08-15' AND lastTransition <= TIMESTAMP '2001-08-15'")
def _(spark, d):
    rows = _raw(S.sold(spark, d)).withColumn("listingStatus", F.lit("SOLD"))
    return listings.sold_listings(rows, dt.datetime(2000, 8, 15), dt.datetime(2001, 8, 15), ["_id", "soldPrice", "propertyType"])


_CHANGED = "((addedOn >= TIMESTAMP '1997-01-01' AND addedOn <= TIMESTAMP '1997-02-01') OR (lastUpdate > TIMESTAMP '1997-01-01' AND lastUpdate < TIMESTAMP '1997-02-01'))"


@query("s02_current_listings", "active", f"SELECT _id, propertyType FROM active WHERE {_FOUR} AND listingStatus = 'ACTIVE' AND {_CHANGED}")
def _(spark, d):
    return listings.current_listings(_raw(S.active(spark, d)), True, "ON", dt.datetime(1997, 1, 1), dt.datetime(1997, 2, 1), ["_id", "propertyType"])


@query("s02_inactive_listings", "active", f"SELECT _id, propertyType FROM active WHERE {_FOUR} AND listingStatus <> 'ACTIVE' AND {_CHANGED}")
def _(spark, d):
    return listings.current_listings(_raw(S.active(spark, d)), False, None, dt.datetime(1997, 1, 1), dt.datetime(1997, 2, 1), ["_id", "propertyType"])


@query("s03_any_status", "active", f"SELECT _id, propertyType, listingStatus FROM active WHERE {_FOUR}")
def _(spark, d):
    return listings.current_listings(_raw(S.active(spark, d)), None, columns=["_id", "propertyType", "listingStatus"])


@query("s07_search", "active", "SELECT _id, price FROM active WHERE bedsInt = 2 AND listingStatus IN ('ACTIVE', 'SOLD') AND addedOn >= TIMESTAMP '1997-01-01' AND addedOn <= TIMESTAMP '1997-06-30' AND contains(lower(propertyType), 'detached')")
def _(spark, d):
    return listings.search(S.active(spark, d), {"bedsInt": 2, "listingStatus": ["ACTIVE", "SOLD"]}, ["_id", "price"], start=dt.datetime(1997, 1, 1), end=dt.datetime(1997, 6, 30), date="addedOn", text={"propertyType": "DETACHED"})


@query("s10_geo_catalogue", None, "SELECT n_nationkey::VARCHAR AS geog_id, CASE WHEN n_regionkey > 1 THEN r_name ELSE n_name END AS name, n_regionkey::INT AS level, 'of ' || r_name AS note FROM nation LEFT JOIN region ON r_regionkey = n_regionkey")
def _(spark, d):
    n, r = S.table(spark, d, "nation"), S.table(spark, d, "region")
    base = n.select(F.col("n_nationkey").cast("string").alias("geog_id"), F.col("n_name").alias("name"), F.col("n_regionkey").cast("int").alias("level"))
    details = n.join(r, n.n_regionkey == r.r_regionkey).select(F.col("n_nationkey").cast("string").alias("geog_id"), F.when(F.col("n_regionkey") > 1, F.col("r_name")).alias("name"), F.concat(F.lit("of "), "r_name").alias("note"))
    return listings.geo_catalogue(base, details)


@query("p04_standard_type", None, f"SELECT * FROM {_CODED_SQL} WHERE searchCategoryType IN (102, 103, 104) OR (searchCategoryType = 101 AND len(list_intersect(string_split(listingType, ', '), ['CONDO', 'REC'])) > 0)")
def _(spark, d):
    return _coded(spark, d).where(X.is_standard_type())


@query("p15_drop_all_null", None, "SELECT * FROM (SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_brand END AS a, CASE WHEN p_size % 5 = 0 THEN p_type END AS b FROM part) WHERE a IS NOT NULL OR b IS NOT NULL")
def _(spark, d):
    rows = S.table(spark, d, "part").select("p_partkey", F.when(F.col("p_size") % 3 == 0, F.col("p_brand")).alias("a"), F.when(F.col("p_size") % 5 == 0, F.col("p_type")).alias("b"))
    return merge.drop_all_null(rows, ["a", "b"])


@query("p12_search_names", None, "SELECT 'g' || p_partkey AS geog_id, p_name AS name FROM part WHERE contains(lower(p_name), 'an') AND p_size % 4 = 1")
def _(spark, d):
    geo = S.table(spark, d, "part").select(F.concat(F.lit("g"), "p_partkey").alias("geog_id"), F.col("p_name").alias("name"), (F.col("p_size") % 4).cast("int").alias("level"))
    return lookup.search_areas(geo, "AN", 1).select("geog_id", "name")


@query("p20_page", None, "SELECT o_orderkey AS id FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey DESC) AS r FROM orders) WHERE r BETWEEN 41 AND 60")
def _(spark, d):
    return lookup.page(S.table(spark, d, "orders").select(F.col("o_orderkey").alias("id")), "id", 3, 20)


_HALVES_SQL = "(SELECT 'g' || s_suppkey AS geog_id, CASE WHEN s_suppkey > 1 THEN 'g' || s_suppkey // 2 END AS parent_id FROM supplier)"


def _halves(spark, d):
    """A hierarchy as deep as the number of suppliers has binary digits: the parent of k is half of k."""
    k = F.col("s_suppkey")
    return S.table(spark, d, "supplier").select(F.concat(F.lit("g"), k).alias("geog_id"), F.when(k > 1, F.concat(F.lit("g"), F.floor(k / 2))).alias("parent_id"))


@query("j16_deep_ancestors", None, f"WITH RECURSIVE up AS (SELECT geog_id, parent_id AS ancestor_id, 1 AS depth FROM {_HALVES_SQL} WHERE parent_id IS NOT NULL UNION ALL SELECT up.geog_id, g.parent_id, depth + 1 FROM up JOIN {_HALVES_SQL} g ON g.geog_id = up.ancestor_id WHERE g.parent_id IS NOT NULL) SELECT * FROM up")
def _(spark, d):
    return areas.ancestors(_halves(spark, d))


@query("r8_area_path", None, f"WITH RECURSIVE up AS (SELECT parent_id AS geog_id FROM {_HALVES_SQL} WHERE geog_id = 'g77' UNION ALL SELECT g.parent_id FROM up JOIN {_HALVES_SQL} g ON g.geog_id = up.geog_id WHERE g.parent_id IS NOT NULL) SELECT * FROM up")
def _(spark, d):
    return lookup.area_path(_halves(spark, d), "g77").select("geog_id")


def _triangles(spark, d):
    """One slanted triangle for each nation: (0, k), (4, k + 1), (1, k + 3)."""
    corner = lambda y, x: F.struct(F.lit(float(y)).alias("lat"), (F.col("n_nationkey") + float(x)).cast("double").alias("lng"))
    ring = F.array(corner(0, 0), corner(4, 1), corner(1, 3), corner(0, 0))
    return S.table(spark, d, "nation").select(F.concat(F.lit("g"), "n_nationkey").alias("geog_id"), F.lit(30).alias("level"), F.array(ring).alias("rings"))


@query("j12_points_in_triangles", None, """SELECT s_suppkey::VARCHAR AS _id, 'g' || n_nationkey AS geog_id, 30 AS level FROM (SELECT s_suppkey, s_suppkey % 41 / 10.0 + 0.013 AS lat, s_suppkey % 271 / 10.0 + 0.017 AS lng FROM supplier) JOIN nation ON
    4 * (lng - n_nationkey) - lat >= 0 AND -3 * (lng - n_nationkey - 1) - 2 * (lat - 4) >= 0 AND -(lng - n_nationkey) + 3 * lat >= 0""")
def _(spark, d):
    k = F.col("s_suppkey")
    points = S.table(spark, d, "supplier").select(k.cast("string").alias("_id"), (k % 41 / 10 + 0.013).cast("double").alias("lat"), (k % 271 / 10 + 0.017).cast("double").alias("lng"))
    return areas.points_in_areas(points, _triangles(spark, d))


@query("j13_overlaps", None, "SELECT 'g' || a.n_nationkey AS geog_id, 'g' || b.n_nationkey AS other_id FROM nation a JOIN nation b ON abs(a.n_nationkey - b.n_nationkey) IN (1, 2)")
def _(spark, d):
    """Neighbouring triangles overlap up to a distance of two, and no further."""
    return areas.overlapping(_triangles(spark, d))


@query("a20_area_perimeter", None, "SELECT 'g' || n_nationkey AS geog_id, 5.5::DOUBLE AS area, round(sqrt(17) + sqrt(13) + sqrt(10), 6) AS perimeter FROM nation")
def _(spark, d):
    return _triangles(spark, d).select("geog_id", F.round(polygons.area(F.col("rings")), 6).alias("area"), F.round(polygons.perimeter(F.col("rings")), 6).alias("perimeter"))


@query("f15_planar", "sold", "SELECT _id, round(sqrt(pow(lat - 43.7, 2) + pow(lng + 79.4, 2)), 9) AS degrees FROM sold")
def _(spark, d):
    return S.sold(spark, d).select("_id", F.round(X.planar_degrees(F.col("lat"), F.col("lng"), F.lit(43.7), F.lit(-79.4)), 9).alias("degrees"))


@query("f16_lng_first", None, "SELECT 'g' || n_nationkey AS geog_id, '[[' || n_nationkey || '.0,0.0],[' || n_nationkey + 1 || '.0,4.0],[' || n_nationkey + 3 || '.0,1.0],[' || n_nationkey || '.0,0.0]]' AS ring FROM nation")
def _(spark, d):
    return _triangles(spark, d).select("geog_id", F.to_json(polygons.lng_first(F.col("rings"))[0]).alias("ring"))


@query("f18_geometry", None, """SELECT 'g' || n_nationkey AS geog_id, '{"type":"Feature","id":"g' || n_nationkey || '","properties":{"name":null,"level":30,"parent_id":null},"geometry":{"type":"MultiPolygon","coordinates":[[[[' || n_nationkey || '.0,0.0],[' || n_nationkey + 1 || '.0,4.0],[' || n_nationkey + 3 || '.0,1.0],[' || n_nationkey || '.0,0.0]]]]}}' AS feature FROM nation""")
def _(spark, d):
    geo = _triangles(spark, d).withColumns({"name": F.lit(None).cast("string"), "parent_id": F.lit(None).cast("string")})
    return lookup.features(geo, geometry=True)


@query("f02_listing_type", None, "SELECT p_partkey AS _id, CASE WHEN p_size % 7 > 0 THEN replace(p_type, ' ', ', ') || CASE WHEN p_size % 3 = 1 THEN ', listingType' ELSE '' END END AS text FROM part")
def _(spark, d):
    """Type words as arrays, with the element that names the field in front, behind, or not at all."""
    words, name = F.split("p_type", " "), F.array(F.lit("listingType"))
    a = F.when(F.col("p_size") % 3 == 0, F.concat(name, words)).when(F.col("p_size") % 3 == 1, F.concat(words, name)).otherwise(words)
    return S.table(spark, d, "part").select(F.col("p_partkey").alias("_id"), X.joined_listing_type(F.when(F.col("p_size") % 7 > 0, a)).alias("text"))


@query("f03_parsed_time", "active", "SELECT _id, addedOn AS a, date_trunc('second', lastUpdate) AS b FROM active")
def _(spark, d):
    """Written in either form and parsed again."""
    rows = S.active(spark, d).select("_id", F.date_format("addedOn", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("a"), F.date_format("lastUpdate", "yyyy-MM-dd'T'HH:mm:ss").alias("b"))
    return rows.select("_id", X.parsed_time("a").alias("a"), X.parsed_time("b").alias("b"))


@query("f10_trend_id", "areas", "SELECT geog_id || '_' || coalesce(t, 'ALL') AS id FROM areas CROSS JOIN (VALUES ('CONDO'), (NULL)) v(t)")
def _(spark, d):
    kinds = F.explode(F.array(F.lit("CONDO"), F.lit(None).cast("string")))
    return S.geo(spark, d).select("geog_id", kinds.alias("propertyType")).select(X.trend_id().alias("id"))


@query("f12_json_ids", "sold exploded", "SELECT geog_id, '[\"' || string_agg(DISTINCT propertyType, '\",\"' ORDER BY propertyType) || '\"]' AS ids FROM exploded WHERE propertyType IS NOT NULL GROUP BY 1")
def _(spark, d):
    """Lists of ids as JSON and back."""
    rows = areas.explode_areas(S.sold(spark, d)).where("propertyType is not null").groupBy("geog_id").agg(F.sort_array(F.collect_set("propertyType")).alias("ids"))
    return X.ids_from_json(rows.withColumn("ids", X.ids_to_json("ids")), "ids").withColumn("ids", X.ids_to_json("ids"))


@query("f13_clean_name", None, "SELECT p_partkey, lower(trim(p_name)) AS low, 'New York' AS title FROM part")
def _(spark, d):
    return S.table(spark, d, "part").select("p_partkey", X.clean_name(F.concat(F.lit("  "), F.upper("p_name"), F.lit(" "))).alias("low"), X.title_name(F.lit(" nEW YORK ")).alias("title"))


@query("f22_combination_key", None, f"SELECT Type || ' | ' || SubType || ' | ' || Style AS key FROM {_TRIPLES_SQL}")
def _(spark, d):
    return mapping.combinations(_triples(spark, d)).select(mapping.combination_key().alias("key"))


@query("a14_value_counts", "sold", "SELECT propertyType, count(*) AS n FROM sold GROUP BY 1")
def _(spark, d):
    return metrics.value_counts(S.sold(spark, d), "propertyType")


@query("w04_month_bounds", "sold exploded", "SELECT geog_id, min(strftime(lastTransition, '%Y-%m')) AS first, max(strftime(lastTransition, '%Y-%m')) AS last, count(DISTINCT strftime(lastTransition, '%Y-%m')) AS months FROM exploded GROUP BY 1")
def _(spark, d):
    return metrics.month_bounds(areas.explode_areas(S.sold(spark, d)).withColumn("month", X.month_key("lastTransition")), "geog_id")


@query("d04_highest_count", None, "SELECT o_custkey AS k, o_orderkey AS id FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r = 1")
def _(spark, d):
    rows = S.table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("Count"))
    return merge.highest_count(rows, ["k"], "Count", F.col("id")).select("k", "id")


@query("d10_review_batch", None, f"SELECT Type, SubType, Style FROM (SELECT *, row_number() OVER (ORDER BY Type, SubType, Style) AS r FROM {_TRIPLES_SQL}) WHERE r BETWEEN 51 AND 100")
def _(spark, d):
    return lookup.review_batch(mapping.combinations(_triples(spark, d)), 1).select("Type", "SubType", "Style")


@query("u03_without", None, "SELECT c_custkey::VARCHAR AS _id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def _(spark, d):
    gone = S.table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").cast("string").alias("listingId"))
    return merge.without_deleted(S.table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("_id")), gone)


@query("u04_union_of_ids", None, "SELECT o_custkey AS id FROM orders WHERE o_orderstatus = 'P' UNION SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0")
def _(spark, d):
    return S.table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("id")).union(S.table(spark, d, "customer").where("c_custkey % 3 = 0").select("c_custkey")).distinct()


@query("u06_same_set", "active", "SELECT _id, string_split(guid, ',')[1] = 'g30_n' || (_id::BIGINT % 25) AS same FROM active")
def _(spark, d):
    rows = S.active(spark, d)
    ids = F.split("guid", ",")
    other = F.array(ids[1], F.concat(F.lit("g30_n"), (F.col("_id").cast("long") % 25).cast("string")), ids[1])
    return rows.select("_id", X.same_set(ids, other).alias("same"))


@query("u07_guid_covers", "active", "SELECT _id, string_split(guid, ',')[1] = 'g30_n' || (_id::BIGINT % 25) AS covers FROM active")
def _(spark, d):
    rows = S.active(spark, d).withColumn("other", F.concat_ws(",", F.concat(F.lit("g30_n"), (F.col("_id").cast("long") % 25).cast("string")), F.split("guid", ",")[1]))
    return rows.select("_id", areas.guid_covers("guid", "other").alias("covers"))


@query("g08_reset_guids", "active", "SELECT _id, CASE WHEN bedsInt <> 1 THEN guid END AS guid, NULL::VARCHAR AS computed_guid FROM active")
def _(spark, d):
    rows = S.active(spark, d).withColumn("computed_guid", F.when(F.col("bedsInt") == 1, F.col("guid")))
    return areas.reset_computed_guids(rows).select("_id", "guid", "computed_guid")


@query("k08_upsert_rows", None, "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN -1 ELSE o_custkey END AS v FROM orders WHERE o_orderkey % 5 <> 0 OR o_orderkey % 2 = 0")
def _(spark, d):
    o = S.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("v"))
    return upsert.upsert_rows(o.where("id % 5 <> 0"), o.where("id % 2 = 0").withColumn("v", F.lit(-1).cast("long")), ["id"])


@query("k09_delete_rows", None, "SELECT o_orderkey AS _id FROM orders WHERE o_orderstatus <> 'F'")
def _(spark, d):
    o = S.table(spark, d, "orders").select(F.col("o_orderkey").alias("_id"), "o_orderstatus")
    return upsert.delete_rows(o, o.where("o_orderstatus = 'F'")).select("_id")


@query("k21_failures", None, "SELECT o_orderpriority AS error, count(*) AS n FROM orders GROUP BY 1")
def _(spark, d):
    return upsert.failure_histogram(S.table(spark, d, "orders").select(F.col("o_orderpriority").alias("error")))


@query("k23_unclear", None, f"SELECT Type, SubType, Style, max(n) AS Count FROM (SELECT Type, SubType, Style, n FROM {_TRIPLES_SQL} WHERE Style = 's1' UNION ALL SELECT Type, SubType, Style, 7 FROM {_TRIPLES_SQL} WHERE Style <> 's0') GROUP BY ALL")
def _(spark, d):
    found = mapping.combinations(_triples(spark, d))
    now = found.withColumn("Inferred", F.when(F.col("Style") == "s1", "UNCLEAR").otherwise("CONDO"))
    return mapping.unclear_rows(found.where("Style <> 's0'").withColumn("Count", F.lit(7).cast("long")), now)


_LAST = "(SELECT geog_id, t AS propertyType, median(price) AS m, count(*) FILTER (WHERE strftime(addedOn, '%Y-%m') = '1998-07') AS v FROM (SELECT *, unnest(list_filter(['ALL', propertyType], lambda x: x IS NOT NULL)) AS t FROM live WHERE NOT is_deleted) GROUP BY 1, 2)"


def _last(spark, d):
    return asking.last_month(S.active(spark, d), ACTIVE_AS_OF)


@query("k03_remove_month", "active live", f"SELECT geog_id, propertyType, CASE WHEN v % 2 = 0 THEN '1998-06:1' ELSE '1998-06:1,1998-07:' || v END AS series FROM {_LAST}")
def _(spark, d):
    value, docs = _last(spark, d).select("geog_id", "propertyType", F.col("new_listings_count").alias("value")), spark.createDataFrame([], MARKET_TRENDS)
    for month, v in (("1998-06", F.lit(1).cast("long")), ("1998-07", F.lit(5).cast("long")), ("1998-07", F.when(F.col("value") % 2 == 1, F.col("value")))):
        docs = upsert.upsert_month(docs, value.withColumn("value", v), "last_mth_new_listings", F.lit(month), _time("1998-08-01"), remove_null=True)
    text = F.array_join(F.transform("metrics.last_mth_new_listings", lambda x: F.concat_ws(":", x["month"], x["value"].cast("string"))), ",")
    return docs.select("geog_id", "propertyType", text.alias("series"))


@query("k06_current_values", "active live", f"SELECT geog_id, propertyType, round(m, 6) AS median, v AS new_listings, geog_id LIKE 'g30%' AS removed FROM {_LAST}")
def _(spark, d):
    docs = upsert.put_current(spark.createDataFrame([], MARKET_TRENDS), _last(spark, d), _time("1998-08-01"))
    gone = upsert.remove_metrics(docs.where("geo_level = 30"), ["current_metrics"]).where("metrics.current_metrics is null").select("geog_id", "propertyType", F.lit(True).alias("removed"))
    out = docs.join(gone, ["geog_id", "propertyType"], "left")
    return out.select("geog_id", "propertyType", F.round("metrics.current_metrics.median_asking_price", 6).alias("median"), F.col("metrics.current_metrics.new_listings").alias("new_listings"), F.coalesce("removed", F.lit(False)).alias("removed"))


_NEAR = """(SELECT a._id AS listing_id, s._id AS sold_id, s.lastTransition AS sold_on, 2 * 6371.0 * atan2(sqrt(h), sqrt(greatest(1 - h, 0))) AS km FROM (SELECT a, s, pow(sin((radians(s.lat) - radians(a.lat)) / 2), 2) + cos(radians(a.lat)) * cos(radians(s.lat)) * pow(sin(radians(s.lng - a.lng) / 2), 2) AS h
    FROM active a JOIN sold s ON a.propertyType = s.propertyType AND a.bedsInt = s.bedsInt AND a.bathsInt = s.bathsInt AND abs(a.lat - s.lat) < 0.01 AND abs(a.lng - s.lng) < 0.014))"""


@query("k07_comparable_values", "sold active", f"SELECT a._id, coalesce(n, 0)::INT AS n, far FROM active a LEFT JOIN (SELECT listing_id, count(*) AS n, round(max(km), 6) AS far FROM (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY km, sold_id) AS r FROM {_NEAR} WHERE km < 1.0) WHERE r <= 12 GROUP BY 1) ON listing_id = a._id")
def _(spark, d):
    a = S.active(spark, d)
    docs = upsert.put_comparables(a, comparables.run(a, S.sold(spark, d))["comparables"], digits=6)
    return docs.select("_id", F.size("comparable_sold_listings.sold_listing_ids").alias("n"), F.array_max("comparable_sold_listings.distances_km").alias("far"))


def _twelve(where: str) -> str:
    return f"(SELECT listing_id, count(*) AS n, string_agg(sold_id, ',' ORDER BY sold_id) AS ids, max(km) AS far FROM (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY km, sold_id) AS r FROM {_NEAR} WHERE {where}) WHERE r <= 12 GROUP BY 1)"


_NOW, _THEN = _twelve("km < 1.0"), _twelve("km < 1.0 AND sold_on < TIMESTAMP '2001-01-01'")
_CHANGED_SQL = f"SELECT coalesce(b.listing_id, a.listing_id) AS listing_id, coalesce(b.n, 0)::INT AS n FROM {_NOW} b FULL JOIN {_THEN} a USING (listing_id) WHERE a.ids IS DISTINCT FROM b.ids"


@query("c03_comparables_delta", "sold active", _CHANGED_SQL)
def _(spark, d):
    """Comparables of all sales against those of the earlier ones, which a run before has written."""
    a, s = S.active(spark, d), S.sold(spark, d)
    run = Run(spark, scratch(spark, "comparables"), "earlier")
    before = run.stage("comparables", lambda: comparables.run(a, s.where(F.col("lastTransition") < _time("2001-01-01")))["comparables"])
    return comparables.run(a, s, before)["changed"].select("listing_id", "n")


@query("c03_comparables_changed", "sold active", _CHANGED_SQL + f" UNION SELECT listing_id, n::INT FROM {_NOW} WHERE listing_id LIKE '%7' AND far > 0.3")
def _(spark, d):
    """The same, where one listing in ten has kept its sales but for a distance beyond 300 metres that was measured anew; a
    distance that differs by rounding alone is no change."""
    a, s = S.active(spark, d), S.sold(spark, d)
    now, before = nearby.comparable_lists(a, s), nearby.comparable_lists(a, s.where(F.col("lastTransition") < _time("2001-01-01")))
    moved = lambda x: F.when(F.col("listing_id").endswith("7") & (x["distance_km"] > 0.3), x["distance_km"] * 1.01).otherwise(x["distance_km"] * (1 + 1e-12))
    before = before.withColumn("comps", F.transform("comps", lambda x: F.struct(x["sold_id"].alias("sold_id"), moved(x).alias("distance_km"))))
    return diff.comparables_delta(before, now).select("listing_id", "n")


@query("k05_rates_replaced", "sold exploded windowed leveled active live snapshots", f"""SELECT d.geog_id, d.propertyType, coalesce(n, 0)::INT AS months, first FROM (SELECT DISTINCT geog_id, propertyType FROM leveled) d
    LEFT JOIN (SELECT geog_id, propertyType, count(absorption_rate) AS n, arg_min(absorption_rate, month) FILTER (WHERE absorption_rate IS NOT NULL) AS first FROM (WITH unused AS (SELECT 1) {_RATES_SQL}) GROUP BY ALL) r USING (geog_id, propertyType)""")
def _(spark, d):
    rates = kept(metrics.series_arrays(absorption.rates(S.sold(spark, d), kept(_snapshots(spark, d), "snapshots")), "absorption_rate", "absorption_rate"), "rates")
    made = rates.union(rates.select(F.lit("g40_none"), "propertyType", "absorption_rate"))
    docs = upsert.replace_existing(_documents(spark, d), made, ["absorption_rate"], _time("2001-08-16"))
    series = F.col("metrics.absorption_rate")
    return docs.select("geog_id", "propertyType", F.greatest(F.size(series), F.lit(0)).alias("months"), F.round(F.get(series, F.lit(0))["value"], 6).alias("first"))


@query("c01_other_months", "sold exploded windowed leveled", "SELECT geog_id, propertyType, strftime(lastTransition, '%Y-%m') AS month, count(_id) AS value FROM leveled GROUP BY ALL")
def _(spark, d):
    """The earlier run lacks a month, so all of the later one counts as changed."""
    long = kept(sold_series.series(S.sold(spark, d), AS_OF, wanted=["sold_listing_count"]), "series").withColumnRenamed("sold_listing_count", "value")
    return diff.series_delta(long.where("month <> '1999-03'"), long)


_RATES_OF_ONE = _RATES_SQL.replace("SELECT geog_id, propertyType, month, sold_count", "SELECT month, sold_count").replace(", round(current_count / nullif(sold_count, 0), 6) AS months_of_inventory", "")


@query("r4_absorption_rates", "sold exploded active live snapshots", _RATES_OF_ONE + " WHERE geog_id = 'g40_r1' AND propertyType = 'CONDO'")
def _(spark, d):
    rates = absorption.rates(S.sold(spark, d), kept(_snapshots(spark, d), "snapshots"))
    return lookup.absorption_rates(rates, "g40_r1", "CONDO").withColumn("absorption_rate", F.round("absorption_rate", 6))


@query("r2_last_month", "active live", f"SELECT '1998-07' AS month, geog_id, propertyType, round(m, 6) AS median_price, v AS new_listings_count FROM {_LAST} WHERE geog_id = 'g40_r1' AND propertyType = 'ALL'")
def _(spark, d):
    now = _last(spark, d).select(F.lit("1998-07").alias("month"), "geog_id", "propertyType", F.round("median_price", 6).alias("median_price"), "new_listings_count")
    earlier = now.withColumns({"month": F.lit("1998-06"), "new_listings_count": F.col("new_listings_count") + 1})
    return lookup.last_month(earlier.union(now), "g40_r1")


@query("k12_backfill", "active live snapshots", """SELECT geog_id, propertyType, string_agg(month || ':' || n, ',' ORDER BY month) AS series FROM (SELECT geog_id, t AS propertyType, strftime(year_month, '%Y-%m') AS month, sum(current_count)::BIGINT AS n
    FROM (SELECT *, unnest(['ALL', propertyType]) AS t FROM snapshots) GROUP BY ALL) GROUP BY ALL UNION ALL SELECT 'g40_kept', 'ALL', '1998-06:3'""")
def _(spark, d):
    """Documents of all areas with an old series, which goes, and of one area without snapshots, which keeps its own."""
    long = _snapshots(spark, d).select("geog_id", "propertyType", F.date_format("year_month", "yyyy-MM").alias("month"), F.col("current_count").alias("value"))
    keys = _values(spark, [("g40_kept", "ALL")], "geog_id string, propertyType string").union(long.select("geog_id", "propertyType").distinct())
    docs = upsert.upsert_month(spark.createDataFrame([], MARKET_TRENDS), keys.withColumn("value", F.lit(3).cast("long")), "last_mth_new_listings", F.lit("1998-06"), _time("1998-08-01"))
    docs = upsert.backfill(docs, long, "last_mth_new_listings", _time("1998-08-02"))
    return docs.select("geog_id", "propertyType", F.array_join(F.transform("metrics.last_mth_new_listings", lambda x: F.concat_ws(":", x["month"], x["value"].cast("string"))), ",").alias("series"))


@query("g02_containing_guid", None, """SELECT _id, string_agg(geog_id, ',' ORDER BY geog_id) AS guid FROM (SELECT s_suppkey::VARCHAR AS _id, 'g' || n_nationkey AS geog_id FROM (SELECT s_suppkey, s_suppkey % 41 / 10.0 + 0.013 AS lat, s_suppkey % 271 / 10.0 + 0.017 AS lng FROM supplier) JOIN nation ON
    4 * (lng - n_nationkey) - lat >= 0 AND -3 * (lng - n_nationkey - 1) - 2 * (lat - 4) >= 0 AND -(lng - n_nationkey) + 3 * lat >= 0) GROUP BY 1""")
def _(spark, d):
    k = F.col("s_suppkey")
    points = S.table(spark, d, "supplier").select(k.cast("string").alias("_id"), (k % 41 / 10 + 0.013).cast("double").alias("lat"), (k % 271 / 10 + 0.017).cast("double").alias("lng"))
    return areas.containing_guid(points, _triangles(spark, d))


_AT_SQL = "(SELECT s_suppkey::VARCHAR AS _id, s_suppkey % 50 / 10.0 + 0.05 AS lat, s_suppkey % 250 / 10.0 + 0.05 AS lng FROM supplier)"
_IN_SQL = "lat BETWEEN south AND south + 1 AND lng BETWEEN west AND west + wide"


def _at(spark, d):
    k = F.col("s_suppkey")
    return S.table(spark, d, "supplier").select(k.cast("string").alias("_id"), (k % 50 / 10 + 0.05).cast("double").alias("lat"), (k % 250 / 10 + 0.05).cast("double").alias("lng"))


@query("g03_first_per_level", "areas", f"SELECT _id, string_agg(geog_id, ',' ORDER BY level) AS guid FROM (SELECT _id, level, min(geog_id) AS geog_id FROM {_AT_SQL} JOIN areas ON {_IN_SQL} GROUP BY ALL) GROUP BY 1")
def _(spark, d):
    return areas.first_per_level(_at(spark, d), S.geo(spark, d))


@query("g04_chased_guids", "areas", f"SELECT _id, a.geog_id || CASE WHEN parent_id IS NULL THEN '' ELSE ',' || parent_id END AS guid FROM (SELECT _id, min((level, geog_id))[2] AS geog_id FROM {_AT_SQL} JOIN areas ON {_IN_SQL} GROUP BY 1) f JOIN areas a ON a.geog_id = f.geog_id")
def _(spark, d):
    """The finest area of each point and those above it; a parent of another region shows that parents are not looked for by
    place."""
    return areas.chased_guids(_at(spark, d), S.geo(spark, d))


@query("g09_pushed_guids", "sold", """SELECT _id, CASE WHEN coalesce(nullif(guid, 'None'), '') = '' AND lastTransition >= TIMESTAMP '1998-05-03' AND lastTransition <= TIMESTAMP '1998-08-01' AND bedsInt <> 3 THEN 'g30_n' || bedsInt ELSE guid END AS guid FROM sold""")
def _(spark, d):
    """Sales of the last ninety days without area ids get those that an earlier table knows of them."""
    rows = S.sold(spark, d)
    known = rows.where("bedsInt <> 3").select("_id", F.concat(F.lit("g30_n"), "bedsInt").alias("guid")).union(rows.where("bedsInt = 3").select("_id", F.lit("None")))
    return areas.push_guids(rows, known, ACTIVE_AS_OF).select("_id", "guid")


@query("k10_removed_groups", "active live", f"SELECT g AS gone, geog_id, propertyType, CASE WHEN g = 'last_month' THEN NULL ELSE v END AS last_new, CASE WHEN g = 'current' THEN NULL ELSE v END AS current_new, CASE WHEN g IN ('last_month', 'current') THEN 2 ELSE 1 END AS day FROM {_LAST} CROSS JOIN (VALUES ('last_month'), ('current'), ('sold'), ('absorption')) w(g)")
def _(spark, d):
    """Each group of fields removed from all documents; others stay, and only documents that had any are stamped."""
    docs = upsert.put_current(spark.createDataFrame([], MARKET_TRENDS), _last(spark, d), _time("1998-08-01"))
    month = _last(spark, d).select("geog_id", "propertyType", F.col("new_listings_count").cast("long").alias("value"))
    docs, out = upsert.upsert_month(docs, month, "last_mth_new_listings", F.lit("1998-07"), _time("1998-08-01")), None
    for group in ("last_month", "current", "sold", "absorption"):
        left = upsert.remove_group(docs, group, _time("1998-08-02"))
        left = left.select(F.lit(group).alias("gone"), "geog_id", "propertyType", F.get("metrics.last_mth_new_listings.value", F.lit(0)).alias("last_new"), F.col("metrics.current_metrics.new_listings").alias("current_new"), F.dayofmonth("last_updated").alias("day"))
        out = left if out is None else out.union(left)
    return out


def _details(spark, d):
    """A JSON text for each part, of various forms: numbers as text, fields that are missing or of another type, text that is
    no JSON."""
    k, size, lit = F.col("p_partkey"), F.col("p_size"), F.lit
    address = F.when(size % 3 > 0, F.struct(lit("ON").alias("province"), F.when(size % 4 > 0, F.col("p_brand")).alias("city")))
    level = F.when(size % 5 == 0, F.concat(lit('"'), size % 7, lit('"'))).when(size % 5 == 1, lit('"none"')).otherwise((size % 7).cast("string"))
    centre = F.when(k % 2 == 0, F.array((k % 90).cast("double") + 0.5, (k % 180).cast("double") - 0.5)).otherwise(F.array((k % 90).cast("double")))
    text = F.concat(lit('{"name":'), F.to_json(F.array("p_name")), lit(',"level":'), level, lit(',"address":'), F.coalesce(F.to_json(address), lit("null")), lit(',"centre":'), F.to_json(centre), F.when(k % 6 == 0, lit(',"notes":{"a":1}')).otherwise(""), F.when(k % 10 > 0, lit("}")).otherwise(""))
    text = F.replace(F.replace(text, lit('"name":['), lit('"name":')), lit('],"level"'), lit(',"level"'))
    return S.table(spark, d, "part").select(F.concat(lit("g"), k).alias("geog_id"), text.alias("data"))


@query("s09_geo_details", None, """SELECT geog_id, CASE WHEN ok THEN p_name END AS name, NULL::VARCHAR AS long_name, CASE WHEN ok AND p_size % 5 <> 1 THEN CAST(p_size % 7 AS INT) END AS level, CASE WHEN ok AND p_size % 3 > 0 THEN 'ON' END AS province,
    CASE WHEN ok AND p_size % 3 > 0 AND p_size % 4 > 0 THEN p_brand END AS city, CASE WHEN ok THEN p_partkey % 90 + CASE WHEN p_partkey % 2 = 0 THEN 0.5::DOUBLE ELSE 0 END END AS lat, CASE WHEN ok AND p_partkey % 2 = 0 THEN p_partkey % 180 - 0.5::DOUBLE END AS lng, NULL::VARCHAR AS parent_id
    FROM (SELECT *, 'g' || p_partkey AS geog_id, p_partkey % 10 > 0 AS ok FROM part)""")
def _(spark, d):
    return listings.geo_details(_details(spark, d))


@query("s09_undescribed", None, "SELECT 'notes' AS field, 'OBJECT<a: BIGINT>' AS kind, count(*) AS n FROM part WHERE p_partkey % 6 = 0 AND p_partkey % 10 > 0 UNION ALL SELECT NULL, NULL, count(*) FROM part WHERE p_partkey % 10 = 0")
def _(spark, d):
    return listings.undescribed(_details(spark, d))
