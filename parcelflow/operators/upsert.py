"""Upserts of market-trends documents, as joins and expressions. Documents are keyed by area and type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import ALL_TYPES, DOUBLE_SERIES, LONG_SERIES
from .metrics import series_arrays

KEYS = ["geog_id", "propertyType"]


def put_month(series: Column, month: Column, value: Column) -> Column:
    """The array with the month's value replaced where it stands, or appended; a null array counts as empty."""
    entry = F.struct(month.alias("month"), value.alias("value"))
    held = F.coalesce(F.exists(series, lambda x: x["month"] == month), F.lit(False))
    return F.when(held, F.transform(series, lambda x: F.when(x["month"] == month, entry).otherwise(x))).when(series.isNull(), F.array(entry)).otherwise(F.array_append(series, entry))


def put_or_remove_month(series: Column, month: Column, value: Column) -> Column:
    """As put_month, but a null value removes the month."""
    return F.when(value.isNull(), F.filter(series, lambda x: x["month"] != month)).otherwise(put_month(series, month, value))


def put_field(struct: Column, name: str, value: Column) -> Column:
    return struct.withField(name, value)


def _metrics(changes: dict[str, Column], old: Column) -> Column:
    names = [*DOUBLE_SERIES, *LONG_SERIES, "current_metrics"]
    return F.struct(*(changes.get(n, old[n]).alias(n) for n in names))


def _joined(target: DataFrame, updates: DataFrame, how: str) -> DataFrame:
    u = updates.select(*(F.col(c).alias(f"__{c}") for c in updates.columns))
    return target.join(u, (F.col("geog_id") == F.col("__geog_id")) & (F.col("propertyType") == F.col("__propertyType")), how)


def _finish(joined: DataFrame, updates: DataFrame, metrics: Column, stamp: Column) -> DataFrame:
    hit = F.col("__geog_id").isNotNull()
    level = F.coalesce(F.col("__geo_level"), F.col("geo_level")) if "geo_level" in updates.columns else F.coalesce(F.col("geo_level"), F.regexp_extract("__geog_id", r"^g(\d+)_", 1).try_cast("int"))
    return joined.select(
        F.coalesce("geog_id", "__geog_id").alias("geog_id"), F.coalesce("propertyType", "__propertyType").alias("propertyType"),
        level.alias("geo_level"), F.when(hit, metrics).otherwise(F.col("metrics")).alias("metrics"), F.when(hit, stamp).otherwise(F.col("last_updated")).alias("last_updated"),
    )


def replace_series(target: DataFrame, updates: DataFrame, name: str, stamp: Column) -> DataFrame:
    """One series replaced by updates(geog_id, propertyType, series); new documents are made, other metrics stay."""
    j = _joined(target, updates, "full")
    return _finish(j, updates, _metrics({name: F.col("__series")}, F.col("metrics")), stamp)


def backfill(target: DataFrame, long: DataFrame, name: str, stamp: Column) -> DataFrame:
    """One series replaced by long(geog_id, propertyType, month, value), with the sum over the types as ALL. Repeated
    cells are added up, and rows of ALL in long are not read; areas outside long keep what they have."""
    cells = long.where(F.col("propertyType") != ALL_TYPES).withColumn("propertyType", F.explode(F.array("propertyType", F.lit(ALL_TYPES))))
    cells = cells.groupBy("geog_id", "propertyType", "month").agg(F.sum("value").alias("value"))
    return replace_series(target, series_arrays(cells), name, stamp)


def recover_last_month(target: DataFrame, archived: DataFrame, stamp: Column) -> DataFrame:
    """The two last-month series wiped and set again from archived(geog_id, propertyType, month, median_price,
    new_listings_count), in the documents it names; they are made where there are none, and others stay. Months without a
    value are left out of that series; other metrics stay. Archived rows without a month, or with an id of another form,
    and repeated ones but the least, are not used."""
    names = ["last_mth_median_asking_price", "last_mth_new_listings"]
    rows = archived.where(F.col("geog_id").rlike(r"^.[0-9]+_") & F.col("propertyType").isNotNull() & F.col("month").isNotNull())
    rows = rows.groupBy(*KEYS, "month").agg(F.min(F.struct("median_price", "new_listings_count")).alias("v"))
    entries = lambda c, kind: F.sort_array(F.collect_list(F.when(F.col(f"v.{c}").isNotNull(), F.struct("month", F.col(f"v.{c}").cast(kind).alias("value")))))
    updates = rows.groupBy(*KEYS).agg(entries("median_price", "double").alias(names[0]), entries("new_listings_count", "bigint").alias(names[1]))
    j = _joined(target, updates, "full")
    return _finish(j, updates, _metrics({n: F.col(f"__{n}") for n in names}, F.col("metrics")), stamp)


def upsert_month(target: DataFrame, updates: DataFrame, name: str, month: Column, stamp: Column, remove_null: bool = False) -> DataFrame:
    """One month's value of a series from updates(geog_id, propertyType, value)."""
    j = _joined(target, updates, "full")
    put = put_or_remove_month if remove_null else put_month
    return _finish(j, updates, _metrics({name: put(F.col("metrics")[name], month, F.col("__value"))}, F.col("metrics")), stamp)


def replace_existing(target: DataFrame, updates: DataFrame, names: list[str], stamp: Column) -> DataFrame:
    """Series replaced in documents that exist; updates has one column for each name, and none makes a document."""
    j = _joined(target, updates, "left")
    empty = {n: F.coalesce(F.col(f"__{n}"), F.slice(F.col("metrics")[n], 1, 0)) for n in names}
    return _finish(j, updates, _metrics(empty, F.col("metrics")), stamp)


def put_current(target: DataFrame, updates: DataFrame, stamp: Column) -> DataFrame:
    """Current-month fields from updates(geog_id, propertyType, median_price, new_listings_count); a missing median is
    removed."""
    j = _joined(target, updates, "full")
    value = F.struct(F.col("__median_price").alias("median_asking_price"), F.col("__new_listings_count").alias("new_listings"))
    return _finish(j, updates, _metrics({"current_metrics": value}, F.col("metrics")), stamp)


def remove_metrics(target: DataFrame, names: list[str]) -> DataFrame:
    cleared = {n: F.lit(None).cast(target.schema["metrics"].dataType[n].dataType) for n in names}
    return target.withColumn("metrics", _metrics(cleared, F.col("metrics")))


#: The groups of fields that can be removed from all documents at once, by what wrote them.
REMOVABLE = {
    "sold": ["median_sold_price", "median_dom", "over_ask_percentage", "below_ask_percentage", "sold_listing_count"],
    "absorption": ["absorption_rate", "months_of_inventory"],
    "last_month": ["last_mth_median_asking_price", "last_mth_new_listings"],
    "current": ["current_metrics"],
}


def remove_group(target: DataFrame, group: str, stamp: Column | None = None) -> DataFrame:
    """Documents without the fields of one group; a stamp marks those that had any."""
    out = remove_metrics(target, REMOVABLE[group])
    if stamp is None:
        return out
    had = F.coalesce(*(F.when(F.col("metrics")[n].isNotNull(), True) for n in REMOVABLE[group]), F.lit(False))
    return remove_metrics(target.withColumn("last_updated", F.when(had, stamp).otherwise(F.col("last_updated"))), REMOVABLE[group])


def remove_comparables(listings: DataFrame) -> DataFrame:
    """Listings without comparable sales, where they have any."""
    if "comparable_sold_listings" not in listings.columns:
        return listings
    kind = listings.schema["comparable_sold_listings"].dataType
    return listings.withColumn("comparable_sold_listings", F.lit(None).cast(kind))


def put_comparables(listings: DataFrame, comps: DataFrame, digits: int = 1) -> DataFrame:
    """Listings with comparable_sold_listings {sold_listing_ids, distances_km} replaced where comps has the listing."""
    c = comps.select(F.col("listing_id").alias("__id"), F.struct(F.transform("comps", lambda x: x["sold_id"]).alias("sold_listing_ids"), F.transform("comps", lambda x: F.round(x["distance_km"], digits)).alias("distances_km")).alias("__new"))
    out = listings.join(c, F.col("_id") == F.col("__id"), "left")
    old = F.col("comparable_sold_listings") if "comparable_sold_listings" in listings.columns else F.lit(None)
    return out.withColumn("comparable_sold_listings", F.coalesce("__new", old)).drop("__id", "__new")


def upsert_rows(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Whole rows by key: updates win."""
    return target.join(updates.select(*keys).distinct(), keys, "left_anti").unionByName(updates, allowMissingColumns=True)


def delete_rows(target: DataFrame, ids: DataFrame, key: str = "_id") -> DataFrame:
    return target.join(ids.select(key).distinct(), key, "left_anti")


def failure_histogram(failures: DataFrame) -> DataFrame:
    return failures.groupBy("error").agg(F.count(F.lit(1)).alias("n"))


def enough_succeeded(success: int, total: int, least: float = 0.5) -> bool:
    """Whether a load counts as done; nothing attempted is not a failure."""
    return total == 0 or success / total >= least
