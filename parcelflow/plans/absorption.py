"""Absorption rates, months of inventory, and month-end inventory snapshots."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import month_end, month_of
from ..operators import diff, metrics
from ..operators.areas import explode_areas
from .runner import kept, spread


def snapshot(active: DataFrame, as_of: dt.datetime, valid: DataFrame | None = None) -> DataFrame:
    """Today's inventory as the snapshot of the month before, dated its last day."""
    day = month_end(F.lit(month_of(as_of, 1)))
    return metrics.inventory(explode_areas(active, valid)).select(day.alias("year_month"), "geog_id", "propertyType", "current_count")


def rates(sold: DataFrame, snapshots: DataFrame, valid: DataFrame | None = None) -> DataFrame:
    """Dense monthly rates from sold listings, from the first snapshot's month on. The counts are made once, and written."""
    spread(sold.sparkSession)
    counts = kept(metrics.sold_counts(explode_areas(metrics.from_first_snapshot(sold, snapshots), valid)), "sold-counts")
    current = snapshots.select("geog_id", "propertyType", F.date_format("year_month", "yyyy-MM").alias("month"), "current_count")
    return metrics.absorption(counts, current)


def run(sold: DataFrame, active: DataFrame, snapshots: DataFrame, as_of: dt.datetime, previous: DataFrame | None = None, valid: DataFrame | None = None) -> dict[str, DataFrame]:
    """'rates', the keys 'changed' since previous(geog_id, propertyType, month, value), and 'snapshots': on the first of
    a month the one just ended is added, after the rates, so it counts from the next run on."""
    found = rates(sold, snapshots, valid)
    changed = diff.tolerant_delta(previous, found.select("geog_id", "propertyType", "month", F.col("absorption_rate").alias("value")))
    if as_of.day == 1:
        snapshots = diff.append_month(snapshots, snapshot(active, as_of, valid))
    return {"rates": found, "changed": changed, "snapshots": snapshots}
