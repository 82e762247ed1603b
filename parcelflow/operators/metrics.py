"""Grouped metrics of areas: every grouping has a row per property type and one for all types together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.expressions import below_ask, geo_level, month_key, month_start, over_ask, percent_true
from ..schemas import ALL_TYPES, STANDARD_TYPES
from .selection import with_medians

SOLD_METRICS = ["median_sold_price", "median_dom", "over_ask_percentage", "below_ask_percentage", "sold_listing_count"]


def with_all_types(rows: DataFrame, kind: str = "propertyType") -> DataFrame:
    """Each row twice: for its own type and for ALL. Rows without a type count for ALL only. So one shuffle serves both
    levels."""
    kinds = F.when(F.col(kind).isNull(), F.array(F.lit(ALL_TYPES))).otherwise(F.array(F.lit(ALL_TYPES), F.col(kind)))
    return rows.withColumn(kind, F.explode(kinds))


def sold_series(exploded: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """Monthly metrics of sold listings: geog_id, propertyType, month, and the chosen metrics. Months without a sale are
    absent. Medians skip nulls and are exact; shares are of all rows."""
    names = metrics or SOLD_METRICS
    middle = {"median_sold_price": "soldPrice", "median_dom": "daysOnMarket"}
    every: dict[str, Column] = {"over_ask_percentage": percent_true(over_ask()), "below_ask_percentage": percent_true(below_ask()), "sold_listing_count": F.count("_id")}
    if names == ["sold_listing_count"]:
        return _monthly_counts(exploded, F.count("_id"), "sold_listing_count")
    rows = with_all_types(exploded.withColumn("month", month_start("lastTransition")).where("month is not null"))
    keys, others = ["geog_id", "propertyType", "month"], {m: every[m] for m in names if m in every}
    wanted = {m: middle[m] for m in names if m in middle}
    out = with_medians(rows, keys, wanted, others) if wanted else rows.groupBy(*keys).agg(*(a.alias(m) for m, a in others.items()))
    return out.withColumn("month", month_key("month")).select(*keys, *names)


def _monthly_counts(exploded: DataFrame, count: Column, name: str) -> DataFrame:
    """A count by area, type and month of lastTransition. Rows are counted by their own type, or none, and only those counts
    are doubled for ALL; months are dates until then."""
    keys = ["geog_id", "propertyType", "month"]
    own = exploded.withColumn("month", month_start("lastTransition")).where("month is not null").groupBy(*keys).agg(count.alias(name))
    out = with_all_types(own).groupBy(*keys).agg(F.coalesce(F.sum(name), F.lit(0)).alias(name))
    return out.withColumn("month", month_key("month"))


def long_series(wide: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """geog_id, propertyType, month, metric, value, geo_level; null values are left out."""
    names = metrics or [m for m in SOLD_METRICS if m in wide.columns]
    out = wide.select("geog_id", "propertyType", "month", *(F.col(m).cast("double").alias(m) for m in names))
    return out.unpivot(["geog_id", "propertyType", "month"], names, "metric", "value").where("value is not null").withColumn("geo_level", geo_level())


def asking_metrics(exploded: DataFrame, month: str) -> DataFrame:
    """Median asking price of all live listings, and how many of them were added in a month."""
    added = F.count_if(F.coalesce(month_key("addedOn") == month, F.lit(False)))
    return with_medians(with_all_types(exploded), ["geog_id", "propertyType"], {"median_price": "price"}, {"new_listings_count": added})


def inventory(exploded: DataFrame) -> DataFrame:
    """current_count by area and type; ALL sums the types, so listings without a type are in neither."""
    typed = exploded.where("propertyType is not null").groupBy("geog_id", "propertyType").agg(F.count(F.lit(1)).alias("current_count"))
    return with_all_types(typed).groupBy("geog_id", "propertyType").agg(F.sum("current_count").alias("current_count"))


def sold_counts(exploded: DataFrame) -> DataFrame:
    """sold_count by area, type and month; ALL counts listings without a type too."""
    return _monthly_counts(exploded, F.count(F.lit(1)), "sold_count")


def _cells_by_key(counts: DataFrame, value: str) -> DataFrame:
    """(geog_id, propertyType, <value>): each key's months as a map; repeated cells are averaged. A key has as many entries as
    there are months."""
    cells = counts.groupBy("geog_id", "propertyType", "month").agg(F.avg(value).alias("__v"))
    entry = F.when(F.col("month").isNotNull(), F.struct("month", "__v"))
    return cells.groupBy("geog_id", "propertyType").agg(F.map_from_entries(F.collect_list(entry)).alias(value))


def _months(*tables: DataFrame) -> DataFrame:
    """One row: the months that all of the tables have, a few hundred as a rule."""
    rows = [t.agg(F.array_sort(F.collect_set("month")).alias(f"__{k}")) for k, t in enumerate(tables)]
    out = rows[0].withColumnRenamed("__0", "__months")
    for k, row in enumerate(rows[1:], 1):
        out = out.join(F.broadcast(row)).select(F.array_intersect("__months", f"__{k}").alias("__months"))
    return out


def dense(counts: DataFrame, value: str, months: DataFrame | None = None) -> DataFrame:
    """Every (geog_id, propertyType) with every month of the table, or of `months`, missing ones as 0; repeated cells are
    averaged. Keys without a type or area stay, and a missing month is one more month, without values. Nothing is counted to
    plan it: the months come as one row."""
    months = counts if months is None else months
    none = F.when(F.count_if(F.col("month").isNull()) > 0, F.array(F.lit(None).cast("string"))).otherwise(F.array().cast("array<string>"))
    row = months.agg(F.concat(F.collect_set(F.col("month").cast("string")), none).alias("__months"))
    rows = _cells_by_key(counts, value).join(F.broadcast(row))
    rows = rows.select("geog_id", "propertyType", value, F.explode("__months").alias("month"))
    return rows.select("geog_id", "propertyType", "month", F.coalesce(F.try_element_at(value, F.col("month")), F.lit(0.0)).alias(value))


def absorption(sold: DataFrame, current: DataFrame) -> DataFrame:
    """absorption_rate = sold / current and months_of_inventory = current / sold, over keys and months that both sides
    have; a division by nought gives null. Keys are joined with all their months, which are unfolded last. Each side is read
    twice; keys that the other one lacks are left out before their months are gathered."""
    held = sold.join(current.select("geog_id", "propertyType").distinct(), ["geog_id", "propertyType"], "left_semi")
    both = _cells_by_key(held, "sold_count").join(_cells_by_key(current, "current_count"), ["geog_id", "propertyType"])
    both = both.join(F.broadcast(_months(sold, current))).select("*", F.explode("__months").alias("month"))
    of = lambda name: F.coalesce(F.try_element_at(name, F.col("month")), F.lit(0.0)).alias(name)
    both = both.select("geog_id", "propertyType", "month", of("sold_count"), of("current_count"))
    rate, stock = F.try_divide("sold_count", "current_count"), F.try_divide("current_count", "sold_count")
    return both.withColumns({"absorption_rate": rate, "months_of_inventory": stock})


def from_first_snapshot(sold: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Sold rows (with lastTransition) from the first snapshot's month on; none without snapshots."""
    first = snapshots.agg(month_start(F.min("year_month")).alias("__first"))
    return sold.join(F.broadcast(first), month_start("lastTransition") >= F.col("__first")).drop("__first")


def complete_matrix(areas: DataFrame, metrics: DataFrame, types: list[str] | None = None) -> DataFrame:
    """Every area with every standard type and ALL; missing medians stay null, missing counts become 0."""
    kinds = types or [*STANDARD_TYPES, ALL_TYPES]
    grid = areas.select("geog_id").distinct().withColumn("propertyType", F.explode(F.array(*(F.lit(k) for k in kinds))))
    out = grid.join(metrics, ["geog_id", "propertyType"], "left")
    return out.select("geog_id", "propertyType", "median_price", F.coalesce("new_listings_count", F.lit(0)).alias("new_listings_count"))


def profile_population(listings: DataFrame) -> DataFrame:
    return listings.groupBy("propertyType", "bedsInt", "bathsInt").agg(F.count(F.lit(1)).alias("n"))


def series_arrays(long: DataFrame, value: str = "value", name: str = "series") -> DataFrame:
    """(geog_id, propertyType, series): ascending (month, value) structs without nulls."""
    pairs = F.sort_array(F.collect_list(F.when(F.col(value).isNotNull(), F.struct("month", F.col(value).alias("value")))))
    return long.groupBy("geog_id", "propertyType").agg(pairs.alias(name))


def wide_series(long: DataFrame, months: list[str], value: str = "value") -> DataFrame:
    """One column per month; for presentation."""
    return long.groupBy("geog_id", "propertyType").pivot("month", months).agg(F.first(value))


def value_counts(rows: DataFrame, *cols: str) -> DataFrame:
    return rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def month_bounds(rows: DataFrame, *keys: str, month: str = "month") -> DataFrame:
    """The first and last month of each key, and how many different ones it has."""
    return rows.groupBy(*keys).agg(F.min(month).alias("first"), F.max(month).alias("last"), F.count_distinct(month).alias("months"))


def diagnostics(rows: DataFrame, date: str) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("n"), F.min(date).alias("first"), F.max(date).alias("last"))


def newest(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row with the greatest `order` of each key."""
    w = W.partitionBy(*keys).orderBy(F.desc(order), *(F.col(c) for c in rows.columns if c not in keys and c != order))
    return rows.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")
