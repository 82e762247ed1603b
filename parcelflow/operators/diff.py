"""Change detection between the results of two runs, on long tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .areas import small
from ..functions.expressions import close_both, close_to

KEYS = ["geog_id", "propertyType"]


def _cells(previous: DataFrame, current: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Both runs side by side, in one full join: by, KEYS, month, __new, __old, and whether each run has the cell."""
    keys = [*by, *KEYS, "month"]
    new = current.select(*keys, F.col(value).alias("__new"), F.lit(True).alias("__has"))
    old = previous.select(*keys, F.col(value).alias("__old"), F.lit(True).alias("__had"))
    return new.join(old, keys, "full")


def series_delta(previous: DataFrame, current: DataFrame, value: str = "value", by: list[str] | None = None) -> DataFrame:
    """current's rows of the keys that are new or differ in any month. If the two runs do not have the same months, all
    of current. Values are compared exactly, and two nulls are equal. Keys that vanished are not reported. With `by`, say
    a metric, each of its values is compared as a table of its own.

    The runs are joined once: what differs is a window over a key's months. The months, few as they are, are compared in an
    aggregate of their own, which comes back by broadcast, so runs that are costly to make should be written before.
    """
    by = by or []
    cells = _cells(previous, current, value, by)
    has, none = F.col(value).isNotNull(), F.lit(False)
    months = current.select(*by, "month", has.alias("n"), none.alias("o")).unionByName(previous.select(*by, "month", none.alias("n"), has.alias("o")))
    months = months.groupBy(*by, "month").agg(F.max("n").alias("n"), F.max("o").alias("o"))
    other = months.groupBy(*by).agg(F.max(F.col("n") != F.col("o")).alias("__other"))
    cells = cells.join(F.broadcast(other), by) if by else cells.crossJoin(F.broadcast(other))
    w = W.partitionBy(*by, *KEYS)
    changed = F.max(~F.col("__old").eqNullSafe(F.col("__new"))).over(w) | F.max(F.col("__had")).over(w).isNull()
    out = cells.withColumn("__changed", changed).where(F.col("__has") & (F.col("__other") | F.col("__changed")))
    return out.select(*by, *KEYS, "month", F.col("__new").alias(value))


def tolerant_delta(previous: DataFrame | None, current: DataFrame, value: str = "value") -> DataFrame:
    """(geog_id, propertyType) that are new, gone, or differ in a month by more than a tolerance. Without a previous run,
    all; without current rows, none. The runs are joined once."""
    if previous is None:
        return current.select(*KEYS).distinct()
    cells = _cells(previous, current, value, [])
    some = F.broadcast(current.limit(1).agg((F.count(F.lit(1)) > 0).alias("__some")))
    of_key = cells.groupBy(*KEYS).agg(F.max(~close_to(F.col("__old"), F.col("__new"))).alias("__differs"), F.max("__has").alias("__has"), F.max("__had").alias("__had"))
    out = of_key.crossJoin(some).where(F.col("__some") & (F.col("__differs") | F.col("__has").isNull() | F.col("__had").isNull()))
    return out.select(*KEYS)


def comparables_delta(previous: DataFrame, current: DataFrame, removals: bool = False) -> DataFrame:
    """current's rows (listing_id, comps, and n, the size of comps) that are new, or whose ids, length or distances by place
    differ. With removals, listings that vanished come with an empty array. Sets of ids are told apart by 128 bits of hashes,
    so that ids are not shuffled, unless the caller reads comps."""

    def compared(rows: DataFrame, prefix: str) -> DataFrame:
        ids = F.sort_array(F.array_distinct(F.transform("comps", lambda x: x["sold_id"])))
        told = F.struct(F.size("comps").alias("n"), F.size(ids).alias("ids"), F.xxhash64(ids).alias("one"), F.xxhash64(F.lit(1), ids).alias("two"))
        return rows.withColumns({f"{prefix}ids": told, f"{prefix}km": F.transform("comps", lambda x: x["distance_km"])})

    old = compared(previous.where(F.col("comps").isNotNull()), "__old_").select("listing_id", "__old_ids", "__old_km")
    both = compared(current.withColumn("n", F.size("comps")), "__").join(old, "listing_id", "left")
    same_distances = F.forall(F.zip_with("__km", "__old_km", lambda a, b: close_both(a, b)), lambda x: x)
    same = (F.col("__ids") == F.col("__old_ids")) & same_distances
    out = both.where(~F.coalesce(same, F.lit(False))).drop("__ids", "__km", "__old_ids", "__old_km")
    if removals:
        gone = previous.join(current.select("listing_id"), "listing_id", "left_anti").select("listing_id", F.slice("comps", 1, 0).alias("comps"), F.lit(0).alias("n"))
        out = out.unionByName(gone)
    return out


def append_month(snapshots: DataFrame, new: DataFrame) -> DataFrame:
    """snapshots with the rows of new whose month they do not have yet."""
    return snapshots.unionByName(new.join(small(snapshots.select("year_month").distinct()), "year_month", "left_anti"))
