"""Monthly series of sold listings over a five-year window, and what changed since the last run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import geo_level, month_start, window_start
from ..operators import diff, merge, metrics
from ..operators.areas import explode_areas
from .runner import kept, spread

LOOKBACK_DAYS = 365


def extract(cached: DataFrame | None, delta: DataFrame, as_of: dt.datetime) -> DataFrame:
    """The listings of the window: cached ones first, one row an id, older ones dropped."""
    rows = delta if cached is None else merge.keep_first(cached, delta)
    return merge.not_expired(rows, window_start(as_of))


def series(sold: DataFrame, as_of: dt.datetime, valid: DataFrame | None = None, months: int = 60, wanted: list[str] | None = None) -> DataFrame:
    """Metrics by area, type and month from the first of the month `months` ago up to, and without, the day of as_of. Medians
    read the rows of the window several times, so these are written."""
    spread(sold.sparkSession)
    day = as_of.replace(hour=0, minute=0, second=0, microsecond=0)
    rows = merge.in_window(sold, window_start(as_of, months), day)
    rows = rows.select("_id", "guid", "propertyType", "lastTransition", "soldPrice", "price", "daysOnMarket")
    if wanted is None or any(m.startswith("median") for m in wanted):
        named = F.when(F.col("_id").isNotNull(), F.lit(1)).alias("_id")
        rows = kept(rows.select(named, "guid", "propertyType", month_start("lastTransition").alias("lastTransition"), "soldPrice", "price", "daysOnMarket"), "window")
    return metrics.sold_series(explode_areas(rows, valid), wanted)


def run(sold: DataFrame, as_of: dt.datetime, valid: DataFrame | None = None, previous: DataFrame | None = None) -> dict[str, DataFrame]:
    """'series' (long) and 'changed': for each metric, the keys with a change come with their whole series."""
    long = metrics.long_series(series(sold, as_of, valid))
    if previous is None:
        return {"series": long, "changed": long}
    long = kept(long, "series")
    return {"series": long, "changed": diff.series_delta(previous, long, by=["metric"]).withColumn("geo_level", geo_level())}
