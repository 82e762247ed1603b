"""Queries of jobs that keep state between runs, on the surrogate tables, and the same in SQL over the whole tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from . import surrogate as S
from .functions import expressions as X
from .operators import areas, merge, metrics, upsert
from .plans import checks, comparables
from .plans.increments import Increments, due, follow
from .plans.runner import scratch
from .queries import _time, query
from .schemas import MARKET_TRENDS
from .sources import archives
from .streaming.events import EVENTS

PROVINCES = {"AB": 0, "BC": 1, "ON": 2, "QC": 3, "SK": 4}
RUNS = [dt.datetime(2000, 9, 1), dt.datetime(2000, 12, 15), dt.datetime(2001, 6, 1)]
FIRST = RUNS[0] - dt.timedelta(days=comparables.SOLD_DAYS)

#: One sale in seven is told of up to 20 days late.
_ARRIVAL = "lastTransition + make_interval(0, 0, 0, if(bedsInt = 1, bathsInt * 6 + 2, 0))"
_ARRIVED_SQL = "lastTransition + to_days(CASE WHEN bedsInt = 1 THEN bathsInt * 6 + 2 ELSE 0 END)"


def _arriving(spark, d):
    rows = S.sold(spark, d).select("_id", "lastTransition", "soldPrice", "guid", "bedsInt", "bathsInt")
    return rows.withColumns({"arrived": F.expr(_ARRIVAL), "region": F.regexp_extract("guid", "g40_r([0-9])", 1)})


def _three_runs(spark, d, checked=()):
    # written once by region, as a source has it, so that a load does not join the whole tables again
    arriving, source = merge.in_window(_arriving(spark, d), FIRST, RUNS[-1]), scratch(spark, "arriving")
    arriving.hint("rebalance", "region").write.partitionBy("region").parquet(source)
    rows, store = spark.read.schema(arriving.schema).parquet(source), Increments(spark, scratch(spark, "sold"), "comparables")
    seen = []
    for now in RUNS:
        for prov, region in PROVINCES.items():
            here = rows.where(F.col("region") == str(region))

            def read(start, end, here=here):
                return merge.in_window(here, start, end).where(F.col("arrived") < F.lit(end).cast("timestamp_ntz"))

            found = store.run(prov, read, lambda cached, delta, now=now: comparables.merge_sold(cached, delta, now), now, FIRST, dt.timedelta(days=comparables.SOLD_LOOKBACK), list(checked))
            seen.append((prov, now, found))
    return store, seen


_IN_TIME = f"lastTransition >= TIMESTAMP '2000-06-01' AND lastTransition < TIMESTAMP '2001-06-01' AND {_ARRIVED_SQL} < TIMESTAMP '2001-06-01'"


@query("t01_three_runs", "sold", f"SELECT CASE regexp_extract(guid, 'g40_r([0-9])', 1) WHEN '0' THEN 'AB' WHEN '1' THEN 'BC' WHEN '2' THEN 'ON' WHEN '3' THEN 'QC' ELSE 'SK' END AS part, _id, soldPrice FROM sold WHERE guid <> 'None' AND {_IN_TIME}")
def _(spark, d):
    """Three runs for each province, each from its last mark less the lookback, leave what one look at the whole table does."""
    store, _ = _three_runs(spark, d)
    return store.states(list(PROVINCES)).select("part", "_id", "soldPrice")


@query("t07_observed_loads", "sold", """SELECT p.part, r.now, count(s._id) AS n_rows, count(s.soldPrice) AS n_sales, coalesce(round(count(*) FILTER (s.region IS NOT NULL AND s.guid IS NULL) / nullif(count(s._id), 0)::DOUBLE, 6), 0.0) AS share_without_area
    FROM (VALUES ('AB', '0'), ('BC', '1'), ('ON', '2'), ('QC', '3'), ('SK', '4')) p(part, region) CROSS JOIN (VALUES (TIMESTAMP '2000-09-01'), (TIMESTAMP '2000-12-15'), (TIMESTAMP '2001-06-01')) r(now)
    LEFT JOIN (SELECT *, regexp_extract(guid, 'g40_r([0-9])', 1) AS region, """ + _ARRIVED_SQL + """ AS arrived FROM sold WHERE guid <> 'None') s ON s.region = p.region AND s.arrived < r.now AND s.lastTransition < r.now AND s.lastTransition >= r.now - INTERVAL 365 DAY GROUP BY ALL""")
def _(spark, d):
    """What the checks of each load saw in the pass that wrote it, against counts of the whole table as of that run."""
    _, seen = _three_runs(spark, d, [checks.not_empty(), checks.some_sales(), checks.known_areas(), checks.all_named()])
    rows = [(prov, now, s["n_rows"], s["n_sales"], round(float(s["share_without_area"]), 6)) for prov, now, s in seen]  # one a load
    return spark.createDataFrame(rows, "part string, now timestamp_ntz, n_rows bigint, n_sales bigint, share_without_area double")


@query("s16_provinces_due", "sold", """SELECT part FROM (SELECT unnest(['AB', 'BC', 'ON', 'QC', 'SK', 'MB']) AS part) WHERE part NOT IN (SELECT CASE WHEN x < 2 THEN 'AB' ELSE 'SK' END FROM (SELECT l_orderkey % 4 AS x FROM lineitem))""")
def _(spark, d):
    """Provinces with a run within the last day are not due."""
    log = S.table(spark, d, "lineitem").select(F.when(F.col("l_orderkey") % 4 < 2, "AB").otherwise("SK").alias("part"), _time("2001-08-14 12:00:00").alias("mark"))
    found = due(log.unionByName(log.limit(1).withColumns({"part": F.lit("ON"), "mark": _time("2001-08-13")})), [*PROVINCES, "MB"], S.AS_OF, dt.timedelta(days=1))
    return spark.createDataFrame([(p,) for p in found], "part string")


@query("t01_followed_files", None, "SELECT CASE user_id % 2 WHEN 1 THEN 'odd' ELSE 'even' END AS part, event_id, user_id, value FROM events WHERE user_id % 2 IN (0, 1) QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY event_id) = 1")
def _(spark, d):
    """The events come as files in three lots, the last of which repeats part of the first; each run of the stream merges what
    is new and stops. The offsets are the stream's, the states' versions the log's."""
    root = scratch(spark, "followed")
    events = spark.read.parquet(f"{d}/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", F.col("value").cast("double").alias("value"), F.col("props").cast("string").alias("props"))
    store = Increments(spark, root, "events")
    parts = {"odd": F.col("user_id") % 2 == 1, "even": F.col("user_id") % 2 == 0}
    lots = [F.col("event_id") % 3 == 0, F.col("event_id") % 3 == 1, (F.col("event_id") % 3 == 2) | (F.col("event_id") % 6 == 0)]
    for lot in lots:
        events.where(lot).write.mode("append").parquet(f"{root}/files")
        stream = spark.readStream.schema(EVENTS).parquet(f"{root}/files")
        follow(stream, parts, store, lambda state, rows: rows.dropDuplicates(["event_id"]) if state is None else merge.keep_first(state, rows, ["event_id"]), f"{root}/checkpoint").awaitTermination()
    return store.states(list(parts)).select("part", "event_id", "user_id", "value")


_MONTHS_SQL = """SELECT geog_id, t AS propertyType, strftime(addedOn, '%Y-%m') AS month, median(price) AS m, count(*) AS n
    FROM (SELECT *, unnest(list_filter(['ALL', propertyType], lambda x: x IS NOT NULL)) AS t FROM live) GROUP BY ALL"""


def _by_month(spark, d):
    rows = metrics.with_all_types(areas.explode_areas(S.active(spark, d))).withColumn("month", X.month_key("addedOn"))
    return rows.groupBy("geog_id", "propertyType", "month").agg(F.median("price").alias("median_price"), F.count(F.lit(1)).alias("new_listings_count"))


@query("k13_recovered_series", "active live", f"""SELECT geog_id, propertyType, string_agg(month || ':' || n, ',' ORDER BY month) AS new_listings, round(sum(m), 4) AS sum_of_medians, count(*)::INT AS months FROM ({_MONTHS_SQL}) GROUP BY ALL
    UNION ALL SELECT 'g40_kept', 'ALL', '1901-01:7', NULL, 1""")
def _(spark, d):
    """Every month's figures are archived on the first day of the next one, read back, and set in new documents, and in one
    that held another series, which goes; a document that no archive names keeps its own."""
    folder, rows = scratch(spark, "archives"), _by_month(spark, d)
    day = F.date_format(F.add_months(F.to_date(F.concat("month", F.lit("-01"))), 1), "yyyyMMdd")
    name = F.concat(F.lit("on_last_mth_metrics_results_"), day, F.lit("_df.txt"))
    archives.write_archives(rows.withColumn("__to", name).drop("month"), folder, F.col("__to"))
    found = archives.archived_last_month(spark, folder)
    old = spark.createDataFrame([("g40_kept", "ALL", 7), ("g40_r1", "ALL", 9)], "geog_id string, propertyType string, value bigint")
    docs = upsert.upsert_month(spark.createDataFrame([], MARKET_TRENDS), old, "last_mth_new_listings", F.lit("1901-01"), _time("2001-01-01"))
    docs = upsert.recover_last_month(docs, found, _time("2001-01-02"))
    total = F.aggregate("metrics.last_mth_median_asking_price", F.lit(0.0).cast("double"), lambda s, x: s + x["value"])
    text = F.array_join(F.transform("metrics.last_mth_new_listings", lambda x: F.concat_ws(":", x["month"], x["value"].cast("string"))), ",")
    n = F.size("metrics.last_mth_new_listings")
    return docs.select("geog_id", "propertyType", text.alias("new_listings"), F.round(total, 4).alias("sum_of_medians"), n.alias("months"))
