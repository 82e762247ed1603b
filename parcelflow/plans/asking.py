"""Asking prices and new listings: of the last month, on its first day after, and of the current one, complete."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from ..functions.expressions import month_of
from ..operators import merge, metrics
from ..operators.areas import explode_areas


def due(as_of: dt.date) -> bool:
    return as_of.day == 1


def last_month(tracked: DataFrame, as_of: dt.datetime, valid: DataFrame | None = None) -> DataFrame:
    """Live rows first, then the newest of each id: an older live row can stand in for a newer deleted one."""
    rows = merge.latest(merge.live(tracked))
    return metrics.asking_metrics(explode_areas(rows, valid), month_of(as_of, 1))


def after_last_month(tracked: DataFrame, deleted: DataFrame, active_ids: DataFrame) -> DataFrame:
    """tracked with deleted and no longer active listings marked."""
    gone = tracked.join(deleted.select("listingId").distinct(), tracked["_id"] == deleted["listingId"], "left_semi").select("_id")
    return merge.mark_deleted(tracked, active_ids.select("_id").join(gone, "_id", "left_anti"))


def current_month(tables: dict[str, DataFrame], areas: DataFrame, as_of: dt.datetime) -> DataFrame:
    """The newest row of each id first, then the live ones, over all provinces; every area has every type."""
    rows = merge.live(merge.union_provinces(tables))
    return metrics.complete_matrix(areas, metrics.asking_metrics(explode_areas(rows), month_of(as_of)))
