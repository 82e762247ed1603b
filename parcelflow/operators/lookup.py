"""Read access: single series, current values, areas and job history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.polygons import geojson_feature, random_point
from ..schemas import ALL_TYPES
from .areas import ancestors


def _type(kind: str | None) -> str:
    return ALL_TYPES if kind is None or kind.upper() == ALL_TYPES else kind


def time_series(long: DataFrame, geog_id: str, kind: str | None = None, value: str = "value") -> DataFrame:
    """(month, value) of one area and type, ascending, nulls left out; no type means all together."""
    rows = long.where((F.col("geog_id") == geog_id) & (F.col("propertyType") == _type(kind)) & F.col(value).isNotNull())
    return rows.select("month", F.col(value).alias("value")).orderBy("month")


def trend(documents: DataFrame, name: str, geog_id: str, kind: str | None = None) -> DataFrame:
    """(month, value) of one series of the market-trends documents."""
    name = {"under_ask_percentage": "below_ask_percentage"}.get(name, name)
    rows = documents.where((F.col("geog_id") == geog_id) & (F.col("propertyType") == _type(kind)))
    return rows.select(F.explode(F.col("metrics")[name]).alias("x")).select("x.month", "x.value").orderBy("month")


def absorption_rates(rates: DataFrame, geog_id: str, kind: str | None = None) -> DataFrame:
    """(month, sold_count, current_count, absorption_rate) of one area and type, ascending."""
    rows = rates.where((F.col("geog_id") == geog_id) & (F.col("propertyType") == _type(kind)))
    return rows.select("month", "sold_count", "current_count", "absorption_rate").orderBy("month")


def last_month(archived: DataFrame, geog_id: str, kind: str | None = None) -> DataFrame:
    """The row of the newest month of archived(month, geog_id, propertyType, ...) for one area and type; none if there is
    no such row."""
    rows = archived.where((F.col("geog_id") == geog_id) & (F.col("propertyType") == _type(kind)))
    return rows.orderBy(F.desc("month"), *(c for c in archived.columns if c != "month")).limit(1)


def current_metrics(documents: DataFrame, geog_id: str, kind: str | None = None) -> DataFrame:
    rows = documents.where((F.col("geog_id") == geog_id) & (F.col("propertyType") == _type(kind)))
    return rows.select("metrics.current_metrics.median_asking_price", "metrics.current_metrics.new_listings")


def areas(geo: DataFrame, level: int | None = 40, parent_id: str | None = None) -> DataFrame:
    rows = geo.where(F.col("parent_id") == parent_id) if parent_id else geo
    return (rows.where(F.col("level") == level) if level is not None else rows).orderBy("name")


def search_areas(geo: DataFrame, text: str, level: int | None = None) -> DataFrame:
    rows = geo.where(F.contains(F.lower("name"), F.lower(F.lit(text))))
    return (rows.where(F.col("level") == level) if level is not None else rows).orderBy("name")


def sample_area(geo: DataFrame, seed: int = 0) -> DataFrame:
    """One area at random."""
    return geo.orderBy(F.xxhash64(F.lit(seed), "geog_id"), "geog_id").limit(1)


def sample_points(geo: DataFrame, seed: int = 0) -> DataFrame:
    """(geog_id, lat, lng): a random point of each area with a polygon."""
    rows = geo.where(F.size("rings") > 0).select("geog_id", random_point(F.col("geog_id"), F.col("rings"), seed).alias("p"))
    return rows.select("geog_id", "p.lat", "p.lng")


def review_batch(mapping: DataFrame, number: int, size: int = 50) -> DataFrame:
    """One batch, from 0, of the property-type triples in alphabetical order."""
    return mapping.orderBy("Type", "SubType", "Style").offset(number * size).limit(size)


def area_path(geo: DataFrame, geog_id: str) -> DataFrame:
    """Ancestors of one area, from the root down."""
    up = ancestors(geo).where(F.col("geog_id") == geog_id).select("ancestor_id", "depth")
    return up.join(geo, F.col("ancestor_id") == F.col("geog_id")).orderBy(F.desc("depth")).select(*geo.columns)


def features(geo: DataFrame, geometry: bool = False) -> DataFrame:
    """(geog_id, feature): GeoJSON of each area."""
    properties = F.struct("name", "level", "parent_id")
    return geo.select("geog_id", geojson_feature(F.col("geog_id"), properties, F.col("rings") if geometry else None).alias("feature"))


def feature_collection(found: DataFrame) -> DataFrame:
    """One row: a FeatureCollection of features(), in order of id; for the few areas of one answer."""
    items = F.transform(F.sort_array(F.collect_list(F.struct("geog_id", "feature"))), lambda x: x["feature"])
    return found.agg(F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(items, ","), F.lit("]}")).alias("collection"))


MONITOR = r"\[MONITOR\] (\w+) (\w+) (started|completed)(?: in ([\d.]+) seconds)?"


def job_stages(lines: DataFrame) -> DataFrame:
    """(job_id, stage, status, seconds, at) of the monitoring lines of log files: '<time> ... [MONITOR] job stage completed
    in 1.23 seconds'."""
    part = lambda k: F.regexp_extract("value", MONITOR, k)
    rows = lines.where(F.col("value").rlike(MONITOR))
    at = F.try_to_timestamp(F.substring("value", 1, 19), F.lit("yyyy-MM-dd HH:mm:ss"))
    return rows.select(part(1).alias("job_id"), part(2).alias("stage"), part(3).alias("status"), part(4).try_cast("double").alias("seconds"), at.alias("at"))


def job_times(stages: DataFrame) -> DataFrame:
    return stages.groupBy("job_id").agg(F.min("at").alias("started"), F.max("at").alias("ended"), F.sum("seconds").alias("seconds"))


def page(rows: DataFrame, order: str, number: int, size: int) -> DataFrame:
    return rows.orderBy(F.desc(order)).offset((number - 1) * size).limit(size)
