"""Merging state with new rows, removal, and latest versions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.expressions import time_literal
from ..plans.runner import spread


def _one_of_each(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    spread(rows.sparkSession)
    w = W.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def keep_first(cached: DataFrame, delta: DataFrame, keys: list[str] | None = None, *ties: Column) -> DataFrame:
    """Union in which a cached row beats a new one of its key; `ties` order rows of the same side."""
    rows = cached.withColumn("__side", F.lit(0)).unionByName(delta.withColumn("__side", F.lit(1)), allowMissingColumns=True)
    return _one_of_each(rows, keys or ["_id"], F.col("__side"), *ties).drop("__side")


def keep_last(cached: DataFrame, delta: DataFrame, keys: list[str] | None = None, *ties: Column) -> DataFrame:
    """Union in which a new row beats a cached one of its key."""
    rows = cached.withColumn("__side", F.lit(0)).unionByName(delta.withColumn("__side", F.lit(1)), allowMissingColumns=True)
    return _one_of_each(rows, keys or ["_id"], F.desc("__side"), *ties).drop("__side")


def latest(rows: DataFrame, keys: list[str] | None = None, time: str = "lastUpdate", *ties: Column) -> DataFrame:
    """The newest row of each key; a missing time is the newest of all."""
    return _one_of_each(rows, keys or ["_id"], F.col(time).desc_nulls_first(), *ties)


def highest_count(rows: DataFrame, keys: list[str], count: str = "Count", *ties: Column) -> DataFrame:
    return _one_of_each(rows, keys, F.col(count).desc_nulls_last(), *ties)


def not_expired(rows: DataFrame, cutoff: dt.datetime, time: str = "lastTransition") -> DataFrame:
    """Rows from the cutoff on; rows without a time stay."""
    return rows.where(F.coalesce(F.col(time) >= time_literal(cutoff), F.lit(True)))


def only_active(rows: DataFrame) -> DataFrame:
    return rows.where("listingStatus = 'ACTIVE'")


def live(rows: DataFrame) -> DataFrame:
    return rows.where(~F.coalesce(F.col("is_deleted"), F.lit(False)))


def without_deleted(rows: DataFrame, deleted: DataFrame) -> DataFrame:
    """Rows whose _id is not in deleted(listingId)."""
    return rows.join(deleted.select("listingId").distinct(), F.col("_id") == F.col("listingId"), "left_anti")


def mark_deleted(rows: DataFrame, active_ids: DataFrame) -> DataFrame:
    """rows with is_deleted set where _id is not among active_ids(_id)."""
    known = active_ids.select(F.col("_id").alias("__id")).distinct()
    out = rows.join(known, F.col("_id") == F.col("__id"), "left")
    gone = F.coalesce(F.col("is_deleted"), F.lit(False)) | F.col("__id").isNull()
    return out.withColumn("is_deleted", gone).drop("__id")


def in_window(rows: DataFrame, start: dt.datetime, end: dt.datetime, time: str = "lastTransition") -> DataFrame:
    return rows.where((F.col(time) >= time_literal(start)) & (F.col(time) < time_literal(end)))


def changed_between(start: dt.datetime, end: dt.datetime, added: str = "addedOn", updated: str = "lastUpdate") -> Column:
    """Added within the bounds, or updated strictly between them, both by whole seconds."""
    lo, hi = time_literal(start.replace(microsecond=0)), time_literal(end.replace(microsecond=0))
    second = lambda c: F.date_trunc("second", F.col(c))
    return F.coalesce(F.col(added).between(lo, hi), F.lit(False)) | F.coalesce((second(updated) > lo) & (second(updated) < hi), F.lit(False))


def drop_all_null(rows: DataFrame, columns: list[str]) -> DataFrame:
    """rows without those that have a null in all of the columns."""
    return rows.na.drop("all", subset=columns)


def union_provinces(tables: dict[str, DataFrame], keys: list[str] | None = None) -> DataFrame:
    """The latest rows of every province's table, with the province; at least one table is needed."""
    if not tables:
        raise ValueError("no province has a table")
    out = None
    for province, table in sorted(tables.items()):
        rows = table.withColumn("prov", F.lit(province))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return latest(out, ["prov", *(keys or ["_id"])])
