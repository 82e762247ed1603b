"""Column expressions; all run inside code generation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_KM = 6371.0


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def property_type(listing_type: Column | str = "listingType", category: Column | str = "searchCategoryType") -> Column:
    """The type of a listing by its category code; a condominium also needs CONDO or REC among its listing types."""
    tokens, code = F.split(_col(listing_type), ", "), _col(category)
    condo = F.coalesce(F.arrays_overlap(tokens, F.array(F.lit("CONDO"), F.lit("REC"))), F.lit(False))
    return F.when((code == 101) & condo, "CONDO").when(code == 104, "SEMI-DETACHED").when(code == 102, "TOWNHOUSE").when(code == 103, "DETACHED").otherwise("OTHER")


def is_standard_type(listing_type: Column | str = "listingType", category: Column | str = "searchCategoryType") -> Column:
    """The scan predicate that goes with property_type()."""
    return property_type(listing_type, category) != "OTHER"


def joined_listing_type(values: Column | str) -> Column:
    """An array of listing types as text, without a leading 'listingType' element."""
    a = _col(values)
    return F.array_join(F.when(F.get(a, F.lit(0)) == "listingType", F.slice(a, 2, F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(a), ", ")


def parsed_time(text: Column | str) -> Column:
    """A timestamp in either ISO form (with or without fraction) or the short yy-MM-dd:HH:mm:ss form; else null."""
    formats = ["yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss.SSS", "yyyy-MM-dd'T'HH:mm:ss", "yy-MM-dd:HH:mm:ss"]
    return F.coalesce(*(F.try_to_timestamp(_col(text), F.lit(f)) for f in formats)).cast("timestamp_ntz")


def clean_guid(guid: Column | str = "guid") -> Column:
    """Null for null, '' and the text 'None'."""
    return F.nullif(F.nullif(_col(guid), F.lit("None")), F.lit(""))


def geo_level(geog_id: Column | str = "geog_id") -> Column:
    return F.regexp_extract(_col(geog_id), r"^g(\d+)_", 1).try_cast("int")


def level_ids(guid: Column | str = "guid") -> Column:
    """A map from level to area id; the last id of a level wins."""
    pairs = F.transform(F.split(_col(guid), ","), lambda g: F.struct(geo_level(g).alias("k"), g.alias("v")))
    pairs = F.filter(pairs, lambda p: p["k"].isNotNull())
    keys = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.filter(pairs, lambda p: p["k"] == k), -1)["v"]))


def trend_id(geog_id: Column | str = "geog_id", kind: Column | str = "propertyType") -> Column:
    return F.concat_ws("_", _col(geog_id), F.coalesce(_col(kind), F.lit("ALL")))


def clean_name(name: Column | str) -> Column:
    return F.lower(F.trim(_col(name)))


def title_name(name: Column | str) -> Column:
    return F.initcap(F.trim(_col(name)))


def ids_to_json(ids: Column | str) -> Column:
    return F.to_json(_col(ids))


def ids_from_json(rows: DataFrame, column: str) -> DataFrame:
    """rows with a column of JSON lists as arrays of text; what is no list becomes null."""
    return rows.withColumn(column, F.from_json(column, "array<string>"))


def month_key(time: Column | str) -> Column:
    return F.date_format(_col(time), "yyyy-MM")


def month_start(time: Column | str) -> Column:
    """The first day of the month, as a date: four bytes to group by, with the month_key of the time."""
    return F.trunc(_col(time), "month")


def previous_month(time: Column | str) -> Column:
    return F.date_format(F.add_months(F.trunc(_col(time), "month"), -1), "yyyy-MM")


def month_end(month: Column | str) -> Column:
    """The last day of a 'yyyy-MM' month."""
    return F.last_day(F.to_date(F.concat(_col(month), F.lit("-01"))))


def window_start(as_of: dt.datetime, months: int = 60) -> dt.datetime:
    """The first of as_of's month, some months earlier."""
    at = as_of.year * 12 + as_of.month - 1 - months
    return dt.datetime(at // 12, at % 12 + 1, 1)


def month_of(as_of: dt.datetime, back: int = 0) -> str:
    return window_start(as_of, back).strftime("%Y-%m")


def time_literal(at: dt.datetime) -> Column:
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(lng2 - lng1) / 2), 2)
    return 2 * EARTH_KM * F.atan2(F.sqrt(h), F.sqrt(F.greatest(1 - h, F.lit(0.0))))


def planar_degrees(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    return F.sqrt(F.pow(lat1 - lat2, 2) + F.pow(lng1 - lng2, 2))


def close_to(old: Column, new: Column, relative: float = 1e-5, absolute: float = 1e-8) -> Column:
    """Within a tolerance of the second value; false if just one is null, true if both are."""
    near = F.abs(old - new) <= absolute + relative * F.abs(new)
    return F.coalesce(near, old.isNull() & new.isNull())


def close_both(a: Column, b: Column, relative: float = 1e-9, absolute: float = 1e-12) -> Column:
    """Within a tolerance of the larger value."""
    return F.coalesce(F.abs(a - b) <= F.greatest(relative * F.greatest(F.abs(a), F.abs(b)), F.lit(absolute)), a.isNull() & b.isNull())


def same_set(a: Column, b: Column) -> Column:
    return F.sort_array(F.array_distinct(a)).eqNullSafe(F.sort_array(F.array_distinct(b)))


def over_ask(sold: Column | str = "soldPrice", asked: Column | str = "price") -> Column:
    """False, not null, where a price is missing."""
    return F.coalesce(_col(sold) > _col(asked), F.lit(False))


def below_ask(sold: Column | str = "soldPrice", asked: Column | str = "price") -> Column:
    return F.coalesce(_col(sold) < _col(asked), F.lit(False))


def percent_true(flag: Column) -> Column:
    """Share of all rows, in per cent."""
    return F.avg(F.when(flag, F.lit(1.0).cast("double")).otherwise(F.lit(0.0).cast("double"))) * 100
