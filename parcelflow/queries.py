"""A query for each operator, on the surrogate tables, and the same in SQL."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import surrogate as S
from .functions import classifier
from .functions import expressions as X
from .functions.classifier import classify
from .operators import areas, diff, lookup, mapping, merge, metrics, nearby, upsert
from .plans import absorption, asking, comparables, sold_series
from .plans.runner import kept
from .streaming import events as E

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

AS_OF, ACTIVE_AS_OF = S.AS_OF, S.ACTIVE_AS_OF

_CTES = {
    "sold": """SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS _id, l_shipdate AS lastTransition, l_extendedprice AS soldPrice, l_quantity * 1500.0 AS price,
        CAST(date_diff('day', o_orderdate, l_shipdate) AS DOUBLE) AS daysOnMarket,
        CASE split_part(p_type, ' ', 1) WHEN 'ECONOMY' THEN 'CONDO' WHEN 'SMALL' THEN 'TOWNHOUSE' WHEN 'MEDIUM' THEN 'SEMI-DETACHED' WHEN 'LARGE' THEN 'DETACHED' WHEN 'STANDARD' THEN 'OTHER' END AS propertyType,
        CAST(p_size % 4 + 1 AS INT) AS bedsInt, CAST(l_linenumber % 3 + 1 AS INT) AS bathsInt,
        CASE l_orderkey % 50 WHEN 0 THEN NULL WHEN 1 THEN 'None' ELSE concat_ws(',', 'g10_s' || l_suppkey, 'g30_n' || s_nationkey, 'g40_r' || n_regionkey) END AS guid,
        43.6 + l_orderkey % 997 / 997.0::DOUBLE * 0.2 AS lat, -79.5 + l_partkey % 991 / 991.0::DOUBLE * 0.3 AS lng, concat_ws('-', l_orderkey, l_linenumber) AS line_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
    "active": """SELECT CAST(o_orderkey AS VARCHAR) AS _id, o_orderdate AS addedOn, o_orderdate + to_days(CAST(o_orderkey % 30 AS INT)) AS lastUpdate, o_totalprice AS price,
        CASE o_orderkey % 6 WHEN 0 THEN 'CONDO' WHEN 1 THEN 'TOWNHOUSE' WHEN 2 THEN 'SEMI-DETACHED' WHEN 3 THEN 'DETACHED' WHEN 4 THEN 'OTHER' END AS propertyType,
        CAST(o_orderkey % 4 + 1 AS INT) AS bedsInt, CAST(o_custkey % 3 + 1 AS INT) AS bathsInt, CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' WHEN 'F' THEN 'SOLD' ELSE 'PENDING' END AS listingStatus,
        concat_ws(',', 'g30_n' || c_nationkey, 'g40_r' || n_regionkey) AS guid, o_orderkey % 11 = 0 AS is_deleted,
        43.6 + o_orderkey % 887 / 887.0::DOUBLE * 0.2 AS lat, -79.5 + o_custkey % 881 / 881.0::DOUBLE * 0.3 AS lng, CAST(n_regionkey AS INT) AS region
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "areas": """SELECT 'g30_n' || n_nationkey AS geog_id, n_name AS name, 30 AS level, 'g40_r' || n_regionkey AS parent_id, n_regionkey::DOUBLE AS south, n_nationkey::DOUBLE AS west, 1.0::DOUBLE AS wide FROM nation
        UNION ALL SELECT 'g40_r' || r_regionkey, r_name, 40, NULL, r_regionkey::DOUBLE, 0.0, 25.0 FROM region""",
    "exploded": "SELECT * FROM (SELECT *, unnest(string_split(guid, ',')) AS geog_id FROM sold WHERE guid <> 'None') WHERE geog_id <> ''",
    "live": "SELECT *, unnest(string_split(guid, ',')) AS geog_id FROM active",
    "windowed": "SELECT * FROM exploded WHERE lastTransition >= TIMESTAMP '1996-08-01' AND lastTransition < TIMESTAMP '2001-08-15'",
    "leveled": "SELECT * EXCLUDE (propertyType), unnest(list_filter(['ALL', propertyType], lambda k: k IS NOT NULL)) AS propertyType FROM windowed",
    "snapshots": "SELECT last_day(addedOn::DATE) AS year_month, geog_id, propertyType, count(*) AS current_count FROM live WHERE propertyType IS NOT NULL GROUP BY ALL",
}


def _with(names: str, sql: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({_CTES[n]})" for n in names.split()) + " " + sql


def query(name: str, ctes: str | None = None, sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = _with(ctes, sql) if ctes else sql
        return f

    return add


def _time(text: str) -> F.Column:
    return F.lit(text).cast("timestamp_ntz")


def _values(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def _exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return areas.explode_areas(S.sold(spark, sf_dir))


def _live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return areas.explode_areas(S.active(spark, sf_dir))


# scans and predicates


@query("s01_sold_scan", "sold", "SELECT _id, soldPrice, propertyType FROM sold WHERE lastTransition >= TIMESTAMP '2000-08-15' AND lastTransition <= TIMESTAMP '2001-08-15'")
def _(spark, d):
    rows = S.sold(spark, d)
    return rows.where(F.col("lastTransition").between(_time("2000-08-15"), _time("2001-08-15"))).select("_id", "soldPrice", "propertyType")


@query("s02_current_scan", "active", "SELECT _id, price FROM active WHERE listingStatus = 'ACTIVE' AND ((addedOn >= TIMESTAMP '1997-01-01' AND addedOn <= TIMESTAMP '1997-02-01') OR (lastUpdate > TIMESTAMP '1997-01-01' AND lastUpdate < TIMESTAMP '1997-02-01'))")
def _(spark, d):
    rows = S.active(spark, d).where("listingStatus = 'ACTIVE'")
    return rows.where(merge.changed_between(dt.datetime(1997, 1, 1), dt.datetime(1997, 2, 1))).select("_id", "price")


@query("s05_deleted_scan", None, "SELECT CAST(o_orderkey AS VARCHAR) AS listingId FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 7 = 0 AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'")
def _(spark, d):
    from .sources.listings import deleted_listings

    feed = S.table(spark, d, "orders").where("o_orderstatus = 'F' and o_orderkey % 7 = 0").select(F.col("o_orderdate").alias("timestamp"), F.col("o_orderkey").cast("string").alias("listingId"))
    return deleted_listings(feed, dt.datetime(1996, 1, 1), dt.datetime(1997, 1, 1)).select("listingId")


@query("p02_window_filter", "sold", "SELECT count(*) AS n, min(lastTransition) AS first, max(lastTransition) AS last FROM sold WHERE lastTransition >= TIMESTAMP '1996-08-01' AND lastTransition < TIMESTAMP '2001-08-15'")
def _(spark, d):
    return metrics.diagnostics(merge.in_window(S.sold(spark, d), X.window_start(AS_OF), AS_OF), "lastTransition")


_CODED_SQL = "(SELECT p_partkey AS _id, CASE WHEN p_size % 9 > 0 THEN CASE WHEN p_size % 2 = 0 THEN 'CONDO, ' ELSE '' END || replace(replace(p_type, 'SMALL', 'REC'), ' ', ', ') END AS listingType, CASE WHEN p_partkey % 11 > 0 THEN CAST(101 + p_partkey % 6 AS INT) END AS searchCategoryType FROM part)"


def _coded(spark, d):
    """Listing types and category codes, some missing, from parts."""
    types = F.concat(F.when(F.col("p_size") % 2 == 0, "CONDO, ").otherwise(""), F.replace(F.replace("p_type", F.lit("SMALL"), F.lit("REC")), F.lit(" "), F.lit(", ")))
    return S.table(spark, d, "part").select(F.col("p_partkey").alias("_id"), F.when(F.col("p_size") % 9 > 0, types).alias("listingType"), F.when(F.col("p_partkey") % 11 > 0, (101 + F.col("p_partkey") % 6).cast("int")).alias("searchCategoryType"))


_IS_CONDO_SQL = "(list_contains(string_split(listingType, ', '), 'CONDO') OR list_contains(string_split(listingType, ', '), 'REC'))"


@query("p04_f01_property_type", None, f"SELECT *, CASE WHEN searchCategoryType = 101 AND {_IS_CONDO_SQL} THEN 'CONDO' WHEN searchCategoryType = 104 THEN 'SEMI-DETACHED' WHEN searchCategoryType = 102 THEN 'TOWNHOUSE' WHEN searchCategoryType = 103 THEN 'DETACHED' ELSE 'OTHER' END AS propertyType FROM {_CODED_SQL}")
def _(spark, d):
    return _coded(spark, d).withColumn("propertyType", X.property_type())


@query("p05_expiry", "sold", "SELECT _id FROM sold WHERE lastTransition >= TIMESTAMP '2000-08-15' OR lastTransition IS NULL")
def _(spark, d):
    return merge.not_expired(S.sold(spark, d), AS_OF - dt.timedelta(days=365)).select("_id")


@query("p16_from_first_snapshot", "active live snapshots sold", "SELECT _id FROM sold WHERE strftime(lastTransition, '%Y-%m') >= (SELECT strftime(min(year_month), '%Y-%m') FROM snapshots WHERE year_month >= DATE '1997-01-01')")
def _(spark, d):
    """A history of snapshots that begins in 1997."""
    return metrics.from_first_snapshot(S.sold(spark, d), _snapshots(spark, d).where("year_month >= date '1997-01-01'")).select("_id")


@query("n15_guid_clean", "sold", "SELECT count(*) AS n, count(nullif(nullif(guid, 'None'), '')) AS with_guid FROM sold")
def _(spark, d):
    return S.sold(spark, d).agg(F.count(F.lit(1)).alias("n"), F.count(X.clean_guid()).alias("with_guid"))


@query("f04_haversine", "sold active", "SELECT s._id, round(2 * 6371.0 * atan2(sqrt(h), sqrt(greatest(1 - h, 0))), 6) AS km FROM (SELECT s._id, pow(sin((radians(43.7) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians(43.7)) * pow(sin(radians(-79.4 - lng) / 2), 2) AS h FROM sold s) s")
def _(spark, d):
    km = X.haversine_km(F.col("lat"), F.col("lng"), F.lit(43.7), F.lit(-79.4))
    return S.sold(spark, d).select("_id", F.round(km, 6).alias("km"))


@query("f05_geo_level", "sold exploded", "SELECT geog_id, try_cast(nullif(regexp_extract(geog_id, '^g([0-9]+)_', 1), '') AS INT) AS level, count(*) AS n FROM exploded GROUP BY ALL")
def _(spark, d):
    return _exploded(spark, d).groupBy("geog_id", X.geo_level().alias("level")).agg(F.count(F.lit(1)).alias("n"))


@query("f07_level_ids", "active", "SELECT _id, string_split(guid, ',')[1] AS level_30, string_split(guid, ',')[2] AS level_40 FROM active")
def _(spark, d):
    m = X.level_ids()
    return S.active(spark, d).select("_id", F.try_element_at(m, F.lit(30)).alias("level_30"), F.try_element_at(m, F.lit(40)).alias("level_40"))


@query("f08_month_keys", "active", "SELECT _id, strftime(addedOn, '%Y-%m') AS month, strftime(date_trunc('month', addedOn) - INTERVAL 1 MONTH, '%Y-%m') AS previous, last_day(addedOn::DATE) AS month_end FROM active")
def _(spark, d):
    return S.active(spark, d).select("_id", X.month_key("addedOn").alias("month"), X.previous_month("addedOn").alias("previous"), X.month_end(X.month_key("addedOn")).alias("month_end"))


# joins


@query("j02_valid_areas", "sold exploded areas", "SELECT geog_id, count(*) AS n FROM exploded WHERE geog_id IN (SELECT geog_id FROM areas) GROUP BY 1")
def _(spark, d):
    valid = areas.valid_areas(S.geo(spark, d), "ON")
    return areas.explode_areas(S.sold(spark, d), valid).groupBy("geog_id").agg(F.count(F.lit(1)).alias("n"))


@query("a16_contamination", "sold exploded areas", "SELECT count(*) AS before, count(a.geog_id) AS after, round((count(*) - count(a.geog_id)) / count(*)::DOUBLE * 100, 6) AS percent_unknown FROM exploded e LEFT JOIN areas a ON e.geog_id = a.geog_id")
def _(spark, d):
    return areas.contamination(S.sold(spark, d), S.geo(spark, d)).withColumn("percent_unknown", F.round("percent_unknown", 6))


def _deleted(spark, d):
    return S.table(spark, d, "orders").where("o_orderstatus = 'F' and o_orderkey % 7 = 0").select(F.col("o_orderkey").cast("string").alias("listingId"))


@query("j03_without_deleted", "active", "SELECT _id FROM active WHERE _id NOT IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 7 = 0)")
def _(spark, d):
    return merge.without_deleted(S.active(spark, d), _deleted(spark, d)).select("_id")


@query("j04_mark_deleted", "active", "SELECT a._id, a.is_deleted OR b._id IS NULL AS is_deleted FROM active a LEFT JOIN (SELECT _id FROM active WHERE listingStatus = 'ACTIVE') b USING (_id)")
def _(spark, d):
    rows = S.active(spark, d)
    return merge.mark_deleted(rows, rows.where("listingStatus = 'ACTIVE'")).select("_id", "is_deleted")


@query("j06_full_join_of_series", "sold exploded windowed leveled", "SELECT geog_id, propertyType, strftime(lastTransition, '%Y-%m') AS month, count(_id) AS sold_listing_count FROM leveled GROUP BY ALL")
def _(spark, d):
    """Batches of twelve months give the series that one pass gives."""
    out, start = None, X.window_start(AS_OF)
    while start < AS_OF:
        end = min(X.window_start(start, -12), AS_OF)
        part = metrics.sold_series(areas.explode_areas(merge.in_window(S.sold(spark, d), start, end)), ["sold_listing_count"])
        out, start = (part if out is None else out.unionByName(part)), end
    return out


@query("j07_current_month_matrix", "active live areas", """SELECT g.geog_id, k.propertyType, round(m.median_price, 6) AS median_price, coalesce(m.n, 0) AS new_listings_count
    FROM areas g CROSS JOIN (VALUES ('CONDO'), ('SEMI-DETACHED'), ('TOWNHOUSE'), ('DETACHED'), ('ALL')) k(propertyType)
    LEFT JOIN (SELECT geog_id, t AS propertyType, median(price) AS median_price, count(*) FILTER (WHERE strftime(addedOn, '%Y-%m') = '1998-08') AS n
        FROM (SELECT *, unnest(list_filter(['ALL', propertyType], lambda x: x IS NOT NULL)) AS t FROM live WHERE NOT is_deleted) GROUP BY 1, 2) m ON g.geog_id = m.geog_id AND k.propertyType = m.propertyType""")
def _(spark, d):
    rows = S.active(spark, d)
    tables = {p: rows.where(F.col("region") == i) for i, p in enumerate(("AB", "BC", "ON", "QC", "SK"))}
    return asking.current_month(tables, S.geo(spark, d), ACTIVE_AS_OF).withColumn("median_price", F.round("median_price", 6))


@query("j09_entry_fill", "sold", "SELECT s._id, coalesce(nullif(s.guid, 'None'), 'g30_n' || s.bedsInt) AS guid FROM sold s")
def _(spark, d):
    rows = S.sold(spark, d).withColumns({"mls": F.col("bedsInt").cast("string"), "city": F.lit("c"), "provState": F.lit("ON")})
    entries = _values(spark, [(str(i), "c", "ON", f"g30_n{i}") for i in range(1, 5)] + [("1", "c", "ON", "g30_n0")], "MLS string, CITY string, PROV_STATE string, GEOGRAPHIES string")
    return areas.fill_from_entries(rows, entries).select("_id", "guid")


def _triples(spark, d):
    return S.table(spark, d, "part").select(F.split("p_type", " ")[0].alias("Type"), F.when(F.col("p_size") % 5 > 0, F.col("p_brand")).alias("SubType"), F.concat(F.lit("s"), F.col("p_size") % 3).alias("Style"))


_TRIPLES_SQL = "(SELECT split_part(p_type, ' ', 1) AS Type, coalesce(CASE WHEN p_size % 5 > 0 THEN p_brand END, 'N/A') AS SubType, 's' || p_size % 3 AS Style, count(*) AS n FROM part GROUP BY ALL)"


@query("j10_merge_mapping", None, f"SELECT Type, SubType, Style, max(n) AS Count, max(Inferred) AS Inferred FROM (SELECT Type, SubType, Style, n, CASE WHEN Style = 's0' THEN 'DETACHED' ELSE 'UNCLEAR' END AS Inferred FROM {_TRIPLES_SQL} UNION ALL SELECT 'Gone', 'N/A', 's0', 0, 'CONDO') GROUP BY ALL")
def _(spark, d):
    found = mapping.combinations(_triples(spark, d))
    cached = found.where("Style = 's0'").select("Type", "SubType", "Style", "Count", F.lit("DETACHED").alias("Inferred")).union(_values(spark, [("Gone", "N/A", "s0", 9, "CONDO")], "Type string, SubType string, Style string, Count long, Inferred string"))
    return mapping.merge_mapping(found, cached)


@query("j11_mapping_lookup", None, f"SELECT propertyType, CAST(sum(n) AS BIGINT) AS n FROM (SELECT CASE WHEN Style = 's0' THEN 'DETACHED' WHEN Style = 's1' THEN NULL ELSE 'UNCLEAR' END AS propertyType, n FROM {_TRIPLES_SQL}) GROUP BY 1")
def _(spark, d):
    rows = _triples(spark, d)
    table = mapping.combinations(rows).where("Style <> 's1'").withColumn("Inferred", F.when(F.col("Style") == "s0", "DETACHED").otherwise("UNCLEAR"))
    return mapping.lookup(rows, table).groupBy("propertyType").agg(F.count(F.lit(1)).alias("n"))


@query("j12_points_in_areas", "areas", "SELECT CAST(s_suppkey AS VARCHAR) AS _id, geog_id, level FROM (SELECT s_suppkey, s_suppkey % 60 / 10.0 AS lat, s_suppkey % 260 / 10.0 AS lng FROM supplier) JOIN areas ON lat BETWEEN south AND south + 1 AND lng BETWEEN west AND west + wide")
def _(spark, d):
    points = S.table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("_id"), (F.col("s_suppkey") % 60 / 10).cast("double").alias("lat"), (F.col("s_suppkey") % 260 / 10).cast("double").alias("lng"))
    return areas.points_in_areas(points, S.geo(spark, d))


@query("j15_children", "areas", "SELECT parent_id AS geog_id, string_agg(geog_id, ',' ORDER BY geog_id) AS children FROM areas WHERE parent_id IS NOT NULL GROUP BY 1")
def _(spark, d):
    return areas.children(S.geo(spark, d)).select("geog_id", F.array_join("children", ",").alias("children"))


@query("j16_ancestors", "areas", "SELECT geog_id, parent_id AS ancestor_id, 1 AS depth FROM areas WHERE parent_id IS NOT NULL")
def _(spark, d):
    return areas.ancestors(S.geo(spark, d))


@query("g01_assign_guids", "areas", """SELECT _id, CASE WHEN n.geog_id IS NOT NULL THEN n.geog_id || ',' || r.geog_id ELSE r.geog_id END AS guid FROM (SELECT CAST(s_suppkey AS VARCHAR) AS _id, s_suppkey % 50 / 10.0 + 0.05 AS lat, s_suppkey % 250 / 10.0 + 0.05 AS lng FROM supplier)
    LEFT JOIN areas r ON r.level = 40 AND lat BETWEEN r.south AND r.south + 1 LEFT JOIN areas n ON n.level = 30 AND n.parent_id = r.geog_id AND lat BETWEEN n.south AND n.south + 1 AND lng BETWEEN n.west AND n.west + 1""")
def _(spark, d):
    points = S.table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("_id"), (F.col("s_suppkey") % 50 / 10 + 0.05).cast("double").alias("lat"), (F.col("s_suppkey") % 250 / 10 + 0.05).cast("double").alias("lng"), F.lit(None).cast("string").alias("guid"))
    return areas.assign_guids(points, S.geo(spark, d)).select("_id", "guid")


@query("j17_best_entry", None, "SELECT n_regionkey::VARCHAR AS CITY, 'ON' AS PROV_STATE, string_agg('g30_n' || n_nationkey, ',' ORDER BY n_nationkey) AS GEOGRAPHIES FROM nation GROUP BY 1")
def _(spark, d):
    n = S.table(spark, d, "nation")
    one = n.select(F.col("n_regionkey").cast("string").alias("CITY"), F.lit("ON").alias("PROV_STATE"), F.concat(F.lit("g30_n"), "n_nationkey").alias("GEOGRAPHIES"))
    every = n.groupBy(F.col("n_regionkey").cast("string").alias("CITY")).agg(F.array_join(F.transform(F.sort_array(F.collect_list("n_nationkey")), lambda k: F.concat(F.lit("g30_n"), k)), ",").alias("GEOGRAPHIES"))
    return areas.best_entry_by_city(one.unionByName(every.withColumn("PROV_STATE", F.lit("ON"))))


# aggregations


@query("a02_a03_median_price_series", "sold exploded windowed leveled", "SELECT geog_id, propertyType, strftime(lastTransition, '%Y-%m') AS month, round(median(soldPrice), 6) AS value FROM leveled GROUP BY ALL")
def median_price_series(spark, d):
    out = sold_series.series(S.sold(spark, d), AS_OF, wanted=["median_sold_price"])
    return out.select("geog_id", "propertyType", "month", F.round("median_sold_price", 6).alias("value"))


@query("a03_a05_sold_metrics", "sold exploded windowed leveled", """SELECT geog_id, propertyType, strftime(lastTransition, '%Y-%m') AS month, round(median(soldPrice), 6) AS median_sold_price, round(median(daysOnMarket), 6) AS median_dom,
    round(avg(CASE WHEN soldPrice > price THEN 1.0::DOUBLE ELSE 0 END) * 100, 6) AS over_ask_percentage, round(avg(CASE WHEN soldPrice < price THEN 1.0::DOUBLE ELSE 0 END) * 100, 6) AS below_ask_percentage, count(_id) AS sold_listing_count FROM leveled GROUP BY ALL""")
def _(spark, d):
    out = sold_series.series(S.sold(spark, d), AS_OF)
    return out.select("geog_id", "propertyType", "month", *(F.round(m, 6).alias(m) for m in metrics.SOLD_METRICS[:4]), "sold_listing_count")


@query("f19_long_series", "sold exploded windowed leveled", """SELECT geog_id, propertyType, strftime(lastTransition, '%Y-%m') AS month, 'sold_listing_count' AS metric, count(_id)::DOUBLE AS value, CAST(regexp_extract(geog_id, '^g([0-9]+)_', 1) AS INT) AS geo_level FROM leveled GROUP BY geog_id, propertyType, month""")
def _(spark, d):
    return metrics.long_series(sold_series.series(S.sold(spark, d), AS_OF, wanted=["sold_listing_count"]))


@query("a06_a07_last_month", "active live", """SELECT geog_id, t AS propertyType, round(median(price), 6) AS median_price, count(*) FILTER (WHERE strftime(addedOn, '%Y-%m') = '1998-07') AS new_listings_count
    FROM (SELECT *, unnest(list_filter(['ALL', propertyType], lambda x: x IS NOT NULL)) AS t FROM live WHERE NOT is_deleted) GROUP BY 1, 2""")
def _(spark, d):
    return asking.last_month(S.active(spark, d), ACTIVE_AS_OF).withColumn("median_price", F.round("median_price", 6))


@query("a08_inventory_snapshot", "active live", """SELECT DATE '1998-07-31' AS year_month, geog_id, t AS propertyType, count(*) AS current_count
    FROM (SELECT *, unnest(['ALL', propertyType]) AS t FROM live WHERE propertyType IS NOT NULL AND listingStatus = 'ACTIVE') GROUP BY 2, 3""")
def _(spark, d):
    return absorption.snapshot(merge.only_active(S.active(spark, d)), ACTIVE_AS_OF)


@query("a09_sold_counts", "sold exploded", "SELECT geog_id, t AS propertyType, strftime(lastTransition, '%Y-%m') AS month, count(*) AS sold_count FROM (SELECT *, unnest(list_filter(['ALL', propertyType], lambda x: x IS NOT NULL)) AS t FROM exploded) GROUP BY ALL")
def _(spark, d):
    return metrics.sold_counts(_exploded(spark, d))


def _snapshots(spark, d):
    rows = _live(spark, d).where("propertyType is not null")
    return rows.groupBy(F.last_day("addedOn").alias("year_month"), "geog_id", "propertyType").agg(F.count(F.lit(1)).alias("current_count"))


@query("a10_dense_counts", "active live snapshots", """SELECT k.geog_id, k.propertyType, m.month, coalesce(avg(s.current_count), 0)::DOUBLE AS current_count FROM (SELECT DISTINCT geog_id, propertyType FROM snapshots) k CROSS JOIN (SELECT DISTINCT strftime(year_month, '%Y-%m') AS month FROM snapshots) m
    LEFT JOIN snapshots s ON s.geog_id = k.geog_id AND s.propertyType = k.propertyType AND strftime(s.year_month, '%Y-%m') = m.month GROUP BY ALL""")
def _(spark, d):
    return metrics.dense(_snapshots(spark, d).select("geog_id", "propertyType", F.date_format("year_month", "yyyy-MM").alias("month"), "current_count"), "current_count")


_RATES_SQL = """, counts AS (SELECT geog_id, t AS propertyType, strftime(lastTransition, '%Y-%m') AS month, count(*) AS n FROM (SELECT *, unnest(list_filter(['ALL', propertyType], lambda x: x IS NOT NULL)) AS t FROM exploded WHERE strftime(lastTransition, '%Y-%m') >= (SELECT strftime(min(year_month), '%Y-%m') FROM snapshots)) GROUP BY ALL),
    s AS (SELECT k.*, m.month, coalesce(c.n, 0)::DOUBLE AS sold_count FROM (SELECT DISTINCT geog_id, propertyType FROM counts) k CROSS JOIN (SELECT DISTINCT month FROM counts) m LEFT JOIN counts c USING (geog_id, propertyType, month)),
    p AS (SELECT geog_id, propertyType, strftime(year_month, '%Y-%m') AS month, current_count AS n FROM snapshots),
    c AS (SELECT k.*, m.month, coalesce(p.n, 0)::DOUBLE AS current_count FROM (SELECT DISTINCT geog_id, propertyType FROM p) k CROSS JOIN (SELECT DISTINCT month FROM p) m LEFT JOIN p USING (geog_id, propertyType, month))
    SELECT geog_id, propertyType, month, sold_count, current_count, round(sold_count / nullif(current_count, 0), 6) AS absorption_rate, round(current_count / nullif(sold_count, 0), 6) AS months_of_inventory FROM s JOIN c USING (geog_id, propertyType, month)"""


@query("a11_absorption", "sold exploded active live snapshots", _RATES_SQL)
def _(spark, d):
    out = absorption.rates(S.sold(spark, d), kept(_snapshots(spark, d), "snapshots"))
    return out.withColumns({m: F.round(m, 6) for m in ("absorption_rate", "months_of_inventory")})


@query("a12_profile_population", "sold", "SELECT propertyType, bedsInt, bathsInt, count(*) AS n FROM sold GROUP BY ALL")
def _(spark, d):
    return metrics.profile_population(S.sold(spark, d))


@query("a13_combinations", None, f"SELECT Type, SubType, Style, n AS Count FROM {_TRIPLES_SQL}")
def _(spark, d):
    return mapping.combinations(_triples(spark, d))


@query("a17_series_arrays", "sold exploded windowed leveled", "SELECT geog_id, propertyType, string_agg(month || ':' || n, ' ' ORDER BY month) AS series FROM (SELECT geog_id, propertyType, strftime(lastTransition, '%Y-%m') AS month, count(_id) AS n FROM leveled GROUP BY ALL) GROUP BY ALL")
def _(spark, d):
    long = sold_series.series(S.sold(spark, d), AS_OF, wanted=["sold_listing_count"]).withColumnRenamed("sold_listing_count", "value")
    text = F.array_join(F.transform("series", lambda x: F.concat_ws(":", x["month"], x["value"].cast("string"))), " ")
    return metrics.series_arrays(long).select("geog_id", "propertyType", text.alias("series"))


# merges, duplicates and sets


def _halves(spark, d):
    rows = S.sold(spark, d).select(F.col("line_id").alias("_id"), F.col("_id").alias("full_id"), "soldPrice", "lastTransition")
    return rows.where("lastTransition < timestamp_ntz '1999-01-01'"), rows.where("lastTransition >= timestamp_ntz '1999-01-01'")


_HALVES_SQL = "FROM (SELECT line_id AS _id, _id AS full_id, row_number() OVER (PARTITION BY line_id ORDER BY lastTransition >= TIMESTAMP '1999-01-01' {order}, _id) AS r FROM sold) WHERE r = 1"


@query("d01_keep_first", "sold", "SELECT _id, full_id " + _HALVES_SQL.format(order="ASC"))
def _(spark, d):
    return merge.keep_first(*_halves(spark, d), ["_id"], F.col("full_id")).select("_id", "full_id")


@query("d02_keep_last", "sold", "SELECT _id, full_id " + _HALVES_SQL.format(order="DESC"))
def _(spark, d):
    return merge.keep_last(*_halves(spark, d), ["_id"], F.col("full_id")).select("_id", "full_id")


@query("d03_latest", "active", "SELECT key, _id FROM (SELECT bedsInt * 10 + bathsInt AS key, _id, row_number() OVER (PARTITION BY bedsInt * 10 + bathsInt ORDER BY CASE WHEN _id::BIGINT % 997 = 0 THEN NULL ELSE lastUpdate END DESC NULLS FIRST, _id) AS r FROM active) WHERE r = 1")
def _(spark, d):
    rows = S.active(spark, d).select((F.col("bedsInt") * 10 + F.col("bathsInt")).alias("key"), "_id", F.when(F.col("_id").cast("long") % 997 != 0, F.col("lastUpdate")).alias("lastUpdate"))
    return merge.latest(rows, ["key"], "lastUpdate", F.col("_id")).select("key", "_id")


_TRACKED = "(SELECT o_custkey AS k, _id, is_deleted, lastUpdate FROM active JOIN orders ON _id = CAST(o_orderkey AS VARCHAR))"


def _tracked(spark, d):
    return S.active(spark, d).join(S.table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("_id"), F.col("o_custkey").alias("k")), "_id").select("k", "_id", "is_deleted", "lastUpdate")


@query("d05_filter_then_latest", "active", f"SELECT k, _id FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY lastUpdate DESC, _id) AS r FROM {_TRACKED} WHERE NOT is_deleted) WHERE r = 1")
def _(spark, d):
    return merge.latest(merge.live(_tracked(spark, d)), ["k"], "lastUpdate", F.col("_id")).select("k", "_id")


@query("d05_latest_then_filter", "active", f"SELECT k, _id FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY lastUpdate DESC, _id) AS r FROM {_TRACKED}) WHERE r = 1 AND NOT is_deleted")
def _(spark, d):
    return merge.live(merge.latest(_tracked(spark, d), ["k"], "lastUpdate", F.col("_id"))).select("k", "_id")


@query("u02_intersect", None, "SELECT DISTINCT o_custkey AS id FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'")
def _(spark, d):
    o = S.table(spark, d, "orders")
    return o.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("id")).intersect(o.where("o_orderstatus = 'O'").select("o_custkey"))


@query("u03_difference", None, "SELECT c_custkey AS id FROM customer EXCEPT SELECT o_custkey FROM orders")
def _(spark, d):
    return S.table(spark, d, "customer").select(F.col("c_custkey").alias("id")).subtract(S.table(spark, d, "orders").select("o_custkey"))


@query("w03_newest_archive", None, "SELECT nation, month, key FROM (SELECT c_nationkey AS nation, strftime(o_orderdate, '%Y-%m') AS month, o_orderkey AS key, row_number() OVER (PARTITION BY c_nationkey, strftime(o_orderdate, '%Y-%m') ORDER BY o_orderkey DESC) AS r FROM orders JOIN customer ON o_custkey = c_custkey) WHERE r = 1")
def _(spark, d):
    rows = S.table(spark, d, "orders").join(S.table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return metrics.newest(rows.select(F.col("c_nationkey").alias("nation"), X.month_key("o_orderdate").alias("month"), F.col("o_orderkey").alias("key")), ["nation", "month"], "key")


# the radius join


@query("j01_comparables", "sold active", """SELECT listing_id, sold_id, round(km, 6) AS distance_km, CAST(r AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY km, sold_id) AS r FROM (
    SELECT a._id AS listing_id, s._id AS sold_id, 2 * 6371.0 * atan2(sqrt(h), sqrt(greatest(1 - h, 0))) AS km FROM (SELECT a._id, s._id, pow(sin((radians(s.lat) - radians(a.lat)) / 2), 2) + cos(radians(a.lat)) * cos(radians(s.lat)) * pow(sin(radians(s.lng - a.lng) / 2), 2) AS h, a, s
        FROM active a JOIN sold s ON a.propertyType = s.propertyType AND a.bedsInt = s.bedsInt AND a.bathsInt = s.bathsInt AND abs(a.lat - s.lat) < 0.01 AND abs(a.lng - s.lng) < 0.014) t) WHERE km < 1.0) WHERE r <= 12""")
def _(spark, d):
    return nearby.comparables(S.active(spark, d), S.sold(spark, d)).withColumn("distance_km", F.round("distance_km", 6))


# change detection


def _two_runs(spark, d):
    long = sold_series.series(S.sold(spark, d), AS_OF, wanted=["sold_listing_count"]).withColumnRenamed("sold_listing_count", "value")
    old = long.withColumn("value", F.when(F.crc32("geog_id") % 5 == 0, F.col("value") + 1).otherwise(F.col("value"))).where(~F.col("geog_id").endswith("7"))
    return old, long


@query("c01_series_delta", "sold exploded windowed leveled", "SELECT geog_id, propertyType, strftime(lastTransition, '%Y-%m') AS month, count(_id) AS value FROM leveled WHERE geog_id LIKE '%7' OR geog_id IN ('g40_r1', 'g30_n2') GROUP BY ALL")
def _(spark, d):
    long = kept(sold_series.series(S.sold(spark, d), AS_OF, wanted=["sold_listing_count"]), "series").withColumnRenamed("sold_listing_count", "value")
    old = long.withColumn("value", F.when(F.col("geog_id").isin("g40_r1", "g30_n2"), F.col("value") + 1).otherwise(F.col("value"))).where(~F.col("geog_id").endswith("7"))
    return diff.series_delta(old, long)


@query("c02_tolerant_delta", "sold exploded windowed leveled", "SELECT DISTINCT geog_id, propertyType FROM leveled WHERE geog_id LIKE '%7' OR geog_id LIKE '%8' OR geog_id = 'g40_r1'")
def _(spark, d):
    series = kept(sold_series.series(S.sold(spark, d), AS_OF, wanted=["sold_listing_count"]), "series")
    long = series.select("geog_id", "propertyType", "month", F.col("sold_listing_count").cast("double").alias("value"))
    old = long.withColumn("value", F.when(F.col("geog_id") == "g40_r1", F.col("value") * 1.1).otherwise(F.col("value") * 1.000001)).where(~F.col("geog_id").endswith("7"))
    return diff.tolerant_delta(old, long.where(~F.col("geog_id").endswith("8")))


@query("c04_append_month", "active live snapshots", "SELECT year_month, count(*) AS n FROM snapshots GROUP BY 1")
def _(spark, d):
    rows = _snapshots(spark, d)
    half = rows.where("year_month < date '1997-09-01'")
    return diff.append_month(diff.append_month(half, rows), rows).groupBy("year_month").agg(F.count(F.lit(1)).alias("n"))


# upserts


def _documents(spark, d):
    from .schemas import MARKET_TRENDS

    empty = spark.createDataFrame([], MARKET_TRENDS)
    long = sold_series.series(S.sold(spark, d), AS_OF, wanted=["sold_listing_count"]).withColumnRenamed("sold_listing_count", "value")
    return upsert.replace_series(empty, metrics.series_arrays(long), "sold_listing_count", _time("2001-08-15"))


@query("k01_replace_series", "sold exploded windowed leveled", "SELECT geog_id, propertyType, CAST(geog_id[2:3] AS INT) AS geo_level, count(DISTINCT strftime(lastTransition, '%Y-%m')) AS months FROM leveled GROUP BY ALL")
def _(spark, d):
    return _documents(spark, d).select("geog_id", "propertyType", "geo_level", F.size("metrics.sold_listing_count").cast("long").alias("months"))


@query("k02_month_upsert", "active live sold exploded windowed leveled", """SELECT geog_id, propertyType, coalesce(s.n, 0) AS sold_months, CASE WHEN m.v IS NULL THEN '' ELSE '1998-06:7,1998-07:' || m.v END AS listings FROM
    (SELECT geog_id, propertyType, count(DISTINCT strftime(lastTransition, '%Y-%m')) AS n FROM leveled GROUP BY ALL) s FULL JOIN
    (SELECT geog_id, t AS propertyType, count(*) FILTER (WHERE strftime(addedOn, '%Y-%m') = '1998-07') AS v FROM (SELECT *, unnest(list_filter(['ALL', propertyType], lambda x: x IS NOT NULL)) AS t FROM live WHERE NOT is_deleted) GROUP BY 1, 2) m USING (geog_id, propertyType)""")
def _(spark, d):
    value = kept(asking.last_month(S.active(spark, d), ACTIVE_AS_OF).select("geog_id", "propertyType", F.col("new_listings_count").alias("value")), "last-month")
    docs, stamp = _documents(spark, d), _time("1998-08-01")
    for month, v in (("1998-06", F.lit(7).cast("long")), ("1998-07", F.lit(-1).cast("long")), ("1998-07", F.col("value"))):
        docs = upsert.upsert_month(docs, value.withColumn("value", v), "last_mth_new_listings", F.lit(month), stamp)
    text = F.array_join(F.transform("metrics.last_mth_new_listings", lambda x: F.concat_ws(":", x["month"], x["value"].cast("string"))), ",")
    return docs.select("geog_id", "propertyType", F.greatest(F.size("metrics.sold_listing_count"), F.lit(0)).cast("long").alias("sold_months"), F.coalesce(text, F.lit("")).alias("listings"))


@query("k05_replace_existing", "sold exploded windowed leveled active live snapshots", "SELECT geog_id, propertyType, count(DISTINCT strftime(lastTransition, '%Y-%m')) AS months FROM leveled GROUP BY ALL")
def _(spark, d):
    rates = kept(metrics.series_arrays(absorption.rates(S.sold(spark, d), kept(_snapshots(spark, d), "snapshots")), "absorption_rate", "absorption_rate"), "rates")
    made = rates.union(rates.select(F.lit("g40_none"), "propertyType", "absorption_rate"))
    docs = upsert.replace_existing(_documents(spark, d), made, ["absorption_rate"], _time("2001-08-16"))
    return docs.select("geog_id", "propertyType", F.size("metrics.sold_listing_count").cast("long").alias("months"))


@query("k06_put_current", "active live areas", "SELECT geog_id, k.propertyType, 1 AS has_count FROM areas CROSS JOIN (VALUES ('CONDO'), ('SEMI-DETACHED'), ('TOWNHOUSE'), ('DETACHED'), ('ALL')) k(propertyType)")
def _(spark, d):
    from .schemas import MARKET_TRENDS

    matrix = asking.current_month({"ON": S.active(spark, d)}, S.geo(spark, d), ACTIVE_AS_OF)
    docs = upsert.put_current(spark.createDataFrame([], MARKET_TRENDS), matrix, _time("1998-08-01"))
    return docs.select("geog_id", "propertyType", F.col("metrics.current_metrics.new_listings").isNotNull().cast("int").alias("has_count"))


@query("k07_put_comparables", "sold active", "SELECT _id, 1 AS has FROM active")
def _(spark, d):
    a = S.active(spark, d)
    found = comparables.run(a, S.sold(spark, d))["comparables"]
    return upsert.put_comparables(a, found).select("_id", F.col("comparable_sold_listings").isNotNull().cast("int").alias("has"))


# classifier and lookups

TRIPLES = [
    ("16-unit", "x", "y", "COMMERCIAL"), ("Mobile", None, None, "MOBILE_MINI"), ("Single Family", "House", "Park Model", "MOBILE_MINI"), ("Duplex", "House", "N/R", "OTHER"), ("House", "12-plex", "x", "OTHER"),
    ("Multi-Family", "x", "y", "OTHER"), ("Lots/Acreage", "x", "y", "LAND_VACANT"), ("House", "Office", "y", "COMMERCIAL"), ("Att/Row/Twnhouse", "x", "y", "TOWNHOUSE"), ("Condo Apt", "x", "y", "CONDO"),
    ("Locker", "x", "y", "OTHER"), ("Commercial Sale", "x", "y", "COMMERCIAL"), ("House", "x", "Semi", "SEMI-DETACHED"), ("House", "x", "Stacked", "TOWNHOUSE"), ("House", "x", "Floating", "OTHER"),
    ("House", "Semi Detached", "x", "SEMI-DETACHED"), ("Residential", "Detached", "Bungalow", "DETACHED"), ("House", "Apartment", "x", "CONDO"), ("Single Family", "Bungalow", "2-Storey", "DETACHED"), ("Residential", "Store", "Studio", "CONDO"),
    ("Residential", "Recreational", "Float Home", "UNCLEAR"), ("Residential", "Recreational", "A-Frame", "DETACHED"), ("Residential", "n/r", "N/R", "OTHER"), ("Residential", "See Remarks", "Villa", "UNCLEAR"), ("Resort Property", "x", "Loft", "DETACHED"),
    ("Farm", "x", "y", "OTHER"), ("24", "x", "y", "OTHER"), ("six", "x", "y", "OTHER"), ("N/R", "x", "y", "OTHER"), ("Zzz", "x", "y", "UNCLEAR"), (None, None, None, "UNCLEAR"), ("Residential", "n/r", "End Unit", "TOWNHOUSE"),
]


def _phrases(field: str, extra: list[str]) -> list[str]:
    """For each rule that reads a field, a phrase that meets it, some in other case, in order of the rules."""
    found = [words[k % len(words)] for k, (_, conditions) in enumerate(classifier.FIRST_RULES + classifier.LAST_RULES) for names, _, words in conditions if field in names or names == "all"]
    found = list(dict.fromkeys([*extra, *found]))
    return [w.title() if k % 3 == 0 else w for k, w in enumerate(found)]


_PHRASES = {
    "Type": _phrases("t", ["residential", "house", "other", "single family", ""]),
    "SubType": _phrases("s", ["other", "n/r", "recreational", "bungalow", "residential", ""]),
    "Style": _phrases("y", ["n/r", "2-storey", "end unit", "stacked", "loft", ""]),
}
#: How line items choose a phrase of each field; together they meet every rule.
_CHOSEN = {"Type": "l_partkey + l_linenumber", "SubType": "l_suppkey * 7 + l_orderkey", "Style": "l_orderkey // 3 + l_partkey * 5"}


def _rules_sql() -> str:
    """The rules in order as SQL, in plain CASE and contains()."""
    text = lambda w: "'" + w.replace("'", "''") + "'"

    def condition(names, how, words, fields):
        cols = [fields["all"]] if names == "all" else [fields[n] for n in names]
        test = lambda c: f"{c} IN ({', '.join(map(text, words))})" if how == classifier.IS else " OR ".join(f"contains({c}, {text(w)})" for w in words)
        return ("NOT " if how == classifier.LACKS else "") + "(" + " OR ".join(map(test, cols)) + ")"

    def chain(rules, fields, otherwise):
        whens = " ".join(f"WHEN {' AND '.join(condition(*c, fields) for c in conditions)} THEN {text(category)}" for category, conditions in rules)
        return f"CASE {whens} ELSE {otherwise} END"

    raw, trimmed = {"t": "t", "s": "s", "y": "y", "all": "a"}, {"t": "trim(t)", "s": "trim(s)", "y": "trim(y)", "all": "(trim(t) || ' ' || trim(s) || ' ' || trim(y))"}
    count = lambda c, words: "(" + " + ".join(f"contains({c}, {text(w)})::INT" for w in words) + ")"
    points = {c: " + ".join(f"{weight} * {count(n, words)}" for n, weight in classifier.FIELD_WEIGHTS.items()) for c, words in classifier.KEYWORDS.items()}
    scores = ", ".join(f"({points[c]})::DOUBLE AS {c.replace('-', '_')}" for c in classifier.CATEGORIES)
    large = f"2.0 * {count('a', classifier.LARGE_BUILDINGS)}"
    value = {c: c.replace("-", "_") for c in classifier.CATEGORIES}
    final = {c: f"{v} + large" if c == "CONDO" else f"CASE WHEN t = 'residential' THEN 0.0 ELSE {v} END" if c == "COMMERCIAL" else v for c, v in value.items()}
    rank = {c: "CASE WHEN CONDO = 0 THEN 99 ELSE 0 END" if c == "CONDO" else str(k) for k, c in enumerate(classifier.CATEGORIES)}
    best = " UNION ALL ".join(f"SELECT {text(c)} AS category, {final[c]} AS score, {rank[c]} AS rank" for c in classifier.CATEGORIES)
    end_unit = "contains(a, 'end unit') AND s IN ('other', 'n/r') AND NOT (contains(a, 'apartment') OR contains(a, 'condo') OR contains(a, 'townhouse') OR contains(a, 'row'))"
    lists = {k: "[" + ", ".join(map(text, v)) + "]" for k, v in _PHRASES.items()}
    chosen = ", ".join(f"nullif({lists[k]}[CAST(({v}) % {len(_PHRASES[k])} AS INT) + 1], '') AS {k}" for k, v in _CHOSEN.items())
    return f"""WITH triples AS (SELECT DISTINCT {chosen} FROM lineitem),
        low AS (SELECT *, coalesce(lower(Type), '') AS t, coalesce(lower(SubType), '') AS s, coalesce(lower(Style), '') AS y FROM triples),
        whole AS (SELECT *, t || ' ' || s || ' ' || y AS a FROM low), scored AS (SELECT *, {large} AS large, {scores} FROM whole),
        top AS (SELECT *, (SELECT struct_pack(category := category, score := score) FROM ({best}) ORDER BY score DESC, rank LIMIT 1) AS best FROM scored)
        SELECT Type, SubType, Style, {chain(classifier.FIRST_RULES, raw, f"CASE WHEN ({end_unit}) OR best.score <= 0 THEN {chain(classifier.LAST_RULES, trimmed, text(classifier.UNCLEAR))} ELSE best.category END")} AS Inferred FROM top"""


@query("x_classify", None, _rules_sql())
def _(spark, d):
    """Triples that line items put together from phrases of all rules: some tens of thousands of different ones."""
    pick = lambda k: F.nullif(F.get(F.array(*map(F.lit, _PHRASES[k])), F.expr(f"CAST(({_CHOSEN[k].replace('//', 'DIV')}) % {len(_PHRASES[k])} AS INT)")), F.lit(""))
    rows = S.table(spark, d, "lineitem").select(*(pick(k).alias(k) for k in _PHRASES)).distinct()
    return rows.withColumn("Inferred", classify(F.col("Type"), F.col("SubType"), F.col("Style")))


@query("p11_time_series", "sold exploded windowed leveled", "SELECT strftime(lastTransition, '%Y-%m') AS month, round(median(soldPrice), 6) AS value FROM leveled WHERE geog_id = 'g40_r1' AND propertyType = 'ALL' GROUP BY 1")
def _(spark, d):
    return lookup.time_series(median_price_series(spark, d), "g40_r1", "all")


@query("p12_search_areas", "areas", "SELECT geog_id, name FROM areas WHERE contains(lower(name), 'an')")
def _(spark, d):
    return lookup.search_areas(S.geo(spark, d), "AN").select("geog_id", "name")


@query("p14_areas_of_level", "areas", "SELECT geog_id, name FROM areas WHERE level = 40")
def _(spark, d):
    return lookup.areas(S.geo(spark, d)).select("geog_id", "name")


@query("f18_features", "areas", """SELECT geog_id, '{"type":"Feature","id":"' || geog_id || '","properties":{"name":"' || name || '","level":' || level || ',"parent_id":' || coalesce('"' || parent_id || '"', 'null') || '},"geometry":null}' AS feature FROM areas""")
def _(spark, d):
    return lookup.features(S.geo(spark, d))


# events: the batch forms of the streaming operators


def _events(spark, d):
    return S.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@query("t08_tumbling", None, "SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def _(spark, d):
    return E.tumbling(_events(spark, d)).select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("t08_sliding", None, "SELECT start, event_type, count(*) AS n FROM (SELECT event_type, unnest([time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2000-01-01') - INTERVAL 6 HOUR * k FOR k IN [0, 1, 2, 3]]) AS start FROM events) GROUP BY 1, 2")
def _(spark, d):
    return E.sliding(_events(spark, d)).select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("t08_sessions", None, """SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 2 HOUR AS "end", count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 2 HOUR THEN 0 ELSE 1 END AS new FROM events)) GROUP BY user_id, s""")
def _(spark, d):
    return E.sessions(_events(spark, d)).select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "n")
