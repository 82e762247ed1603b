"""Comparable sales of active listings, from merged caches, and what changed since the last run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from ..operators import diff, merge, nearby

SOLD_DAYS, SOLD_LOOKBACK, ACTIVE_LOOKBACK = 365, 21, 3


def merge_sold(cached: DataFrame | None, delta: DataFrame, as_of: dt.datetime) -> DataFrame:
    rows = delta if cached is None else merge.keep_first(cached, delta)
    return merge.not_expired(rows, as_of - dt.timedelta(days=SOLD_DAYS))


def merge_active(cached: DataFrame | None, delta: DataFrame, inactive: DataFrame | None = None, deleted: DataFrame | None = None) -> DataFrame:
    """Newer rows win, then inactive ones; what is not active, and what was deleted, goes."""
    rows = delta if cached is None else merge.keep_last(cached, delta)
    if inactive is not None:
        rows = merge.keep_last(rows, inactive)
    rows = merge.only_active(rows)
    return rows if deleted is None else merge.without_deleted(rows, deleted)


def checks_deletions(as_of: dt.date, last: dt.date | None) -> bool:
    """Deletions are read once a week, and on the first and last day of a month."""
    return last is None or (as_of - last).days >= 7 or as_of.day == 1 or (as_of + dt.timedelta(days=1)).day == 1


def run(active: DataFrame, sold: DataFrame, previous: DataFrame | None = None, removals: bool = False) -> dict[str, DataFrame]:
    found = nearby.comparable_lists(active, sold)
    return {"comparables": found, "changed": found if previous is None else diff.comparables_delta(previous, found, removals)}
