"""Scans of the listing tables; predicates and columns reach the files."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import is_standard_type, property_type, time_literal
from ..operators import mapping
from ..operators.merge import changed_between
from ..schemas import ACTIVE_LISTING, DELETED_LISTING, IMS_RAW, SOLD_LISTING


def read(spark: SparkSession, path: str, schema: str, form: str = "parquet", **options) -> DataFrame:
    return spark.read.schema(schema).format(form).options(**options).load(path)


def _chosen(rows: DataFrame, columns: list[str] | None) -> DataFrame:
    return rows.select(*columns) if columns else rows


def sold_listings(rows: DataFrame, start: dt.datetime | None = None, end: dt.datetime | None = None, columns: list[str] | None = None, date: str = "lastTransition", as_of: dt.datetime | None = None) -> DataFrame:
    """Sold listings of the standard types, both bounds included; without a start, the last 365 days."""
    if start is None and as_of is not None:
        start = as_of - dt.timedelta(days=365)
    out = rows.where((F.col("listingStatus") == "SOLD") & is_standard_type())
    if start is not None:
        out = out.where(F.col(date) >= time_literal(start))
    if end is not None:
        out = out.where(F.col(date) <= time_literal(end))
    return _chosen(out.withColumn("propertyType", property_type()), columns)


def current_listings(rows: DataFrame, active: bool | None = True, province: str | None = None, start: dt.datetime | None = None, end: dt.datetime | None = None, columns: list[str] | None = None) -> DataFrame:
    """Listings of the standard types that are active, that are not, or any (None); with bounds, those added or updated
    between them."""
    out = rows.where(is_standard_type())
    if active is not None:
        status = F.coalesce(F.col("listingStatus") == "ACTIVE", F.lit(False))
        out = out.where(status if active else ~status)
    if province is not None:
        out = out.where(F.col("provState") == province)
    if start is not None and end is not None:
        out = out.where(changed_between(start, end))
    return _chosen(out.withColumn("propertyType", property_type()), columns)


def deleted_listings(rows: DataFrame, start: dt.datetime | None = None, end: dt.datetime | None = None) -> DataFrame:
    """Deletions from start on and before end; at least one is needed."""
    if start is None and end is None:
        raise ValueError("a start or an end is needed")
    if start is not None:
        rows = rows.where(F.col("timestamp") >= time_literal(start))
    return rows.where(F.col("timestamp") < time_literal(end)) if end is not None else rows


def search(rows: DataFrame, filters: dict | None = None, columns: list[str] | None = None, size: int | None = None, _id: str | None = None, start: dt.datetime | None = None, end: dt.datetime | None = None, date: str = "lastTransition", text: dict[str, str] | None = None) -> DataFrame:
    """Ad-hoc search: an id alone; or equal values of all filters (a list: any of them), a date within both bounds, and
    columns that hold a text, whatever its case; at most `size` rows."""
    if _id is not None:
        return _chosen(rows.where(F.col("_id") == _id), columns)
    tests: list[Column] = [F.col(k).isin(v) if isinstance(v, list) else F.col(k) == v for k, v in (filters or {}).items()]
    tests += [F.contains(F.lower(k), F.lower(F.lit(v))) for k, v in (text or {}).items()]
    tests += [F.col(date) >= time_literal(start)] if start is not None else []
    tests += [F.col(date) <= time_literal(end)] if end is not None else []
    out = _chosen(rows.where(reduce(Column.__and__, tests)) if tests else rows, columns)
    return out if size is None else out.limit(size)


IMS_NAMES = {"WrittenDate": "lastTransition", "SoldPrice": "soldPrice", "ListPrice": "price", "Latitude": "lat", "Longitude": "lng", "DaysOnMarket": "daysOnMarket", "MLSNumber": "mls", "City": "city", "Community": "neighbourhood", "Province": "provState", "Bedrooms": "bedsInt", "Baths": "bathsInt"}


def missing_columns(rows: DataFrame, schema: str = IMS_RAW) -> list[str]:
    return [c.split()[0] for c in schema.split(", ") if c.split()[0] not in rows.columns]


def ims_sold_listings(raw: DataFrame, table: DataFrame, start: dt.datetime | None = None, end: dt.datetime | None = None, province: str | None = None) -> DataFrame:
    """Raw sales as canonical sold listings: checked, mapped to property types, with the provincial exception, renamed,
    and with an id of province, board and number."""
    if missing := missing_columns(raw):
        raise ValueError(f"columns are missing: {missing}")
    rows = raw if province is None else raw.where(F.col("Province") == province)
    if start is not None:
        rows = rows.where(F.col("WrittenDate") >= time_literal(start))
    if end is not None:
        rows = rows.where(F.col("WrittenDate") <= time_literal(end))
    rows = mapping.duplex_override(mapping.lookup(rows, table))
    key = F.concat_ws("-", F.lower("Province"), F.col("MLSID").cast("string"), F.lower("MLSNumber"))
    rows = rows.withColumns({"_id": key, "listingStatus": F.lit("SOLD"), "guid": F.lit(None).cast("string")})
    rows = rows.withColumnsRenamed(IMS_NAMES).withColumn("daysOnMarket", F.col("daysOnMarket").cast("double"))
    beds, baths = F.col("bedsInt").cast("string").alias("beds"), F.col("bathsInt").cast("string").alias("baths")
    return rows.select("_id", "mls", "lastTransition", "listingStatus", beds, "bedsInt", baths, "bathsInt", "price", "soldPrice", "daysOnMarket", "lat", "lng", "city", "neighbourhood", "provState", "guid", "propertyType")


TABLES = {"sold": SOLD_LISTING, "active": ACTIVE_LISTING, "deleted": DELETED_LISTING, "ims": IMS_RAW}


def geo_catalogue(base: DataFrame, details: DataFrame) -> DataFrame:
    """Base rows joined with details by id; a detail's value wins."""
    shared = [c for c in details.columns if c in base.columns and c != "geog_id"]
    d = details.select("geog_id", *(F.col(c).alias(f"__{c}") for c in details.columns if c != "geog_id"))
    joined = base.join(d, "geog_id", "left")
    cols = [F.coalesce(F.col(f"__{c}"), F.col(c)).alias(c) if c in shared else F.col(c) for c in base.columns]
    more = [F.col(f"__{c}").alias(c) for c in details.columns if c not in base.columns]
    return joined.select(*cols, *more)


#: Details of an area: a column's name, its place in the details, and its type.
GEO_DETAILS = {
    "name": ("$.name", "string"), "long_name": ("$.longName", "string"), "level": ("$.level", "int"), "province": ("$.address.province", "string"),
    "city": ("$.address.city", "string"), "lat": ("$.centre[0]", "double"), "lng": ("$.centre[1]", "double"), "parent_id": ("$.parent.id", "string"),
}


def geo_details(rows: DataFrame, fields: dict[str, tuple[str, str]] | None = None, key: str = "geog_id", data: str = "data") -> DataFrame:
    """key and one column for each field of the details, which are JSON text of any form: what a document lacks, or has in a
    type that cannot be read as the field's, is null, and so is everything of text that is no JSON. Nothing is inferred, so
    one odd document changes nothing for the others."""
    details = F.try_parse_json(data)
    return rows.select(key, details.alias("__v")).select(key, *(F.try_variant_get("__v", path, kind).alias(name) for name, (path, kind) in (fields or GEO_DETAILS).items()))


def undescribed(rows: DataFrame, fields: dict[str, tuple[str, str]] | None = None, data: str = "data") -> DataFrame:
    """(field, kind, n): top-level fields of the details that no column is made of, with the type they have and how many
    documents have them; and (null, null, n) for text that is no JSON object."""
    known = [path[2:].split(".")[0].split("[")[0] for path, _ in (fields or GEO_DETAILS).values()]
    details = rows.select(F.try_parse_json(data).alias("v"))
    found = details.lateralJoin(details.sparkSession.tvf.variant_explode_outer(F.col("v").outer()))
    found = found.where(F.col("key").isNull() | ~F.col("key").isin(known))
    return found.groupBy(F.col("key").alias("field"), F.schema_of_variant("value").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
