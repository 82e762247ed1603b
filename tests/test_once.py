"""Tables that are costly to make are made once, and tasks do not grow with the input."""

import glob
import tempfile
import time

import pytest

from parcelflow import more_queries, queries, surrogate  # noqa: F401
from parcelflow.operators import merge
from parcelflow.plans import absorption, sold_series
from parcelflow.plans.runner import kept

DATA = "/root/testdata/sf0.001"


def counted(spark, rows):
    """The same rows, and a counter of how many were read."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return rows.mapInArrow(run, rows.schema), seen


def test_medians_read_the_sales_once(spark):
    sold = surrogate.sold(spark, DATA)
    rows, seen = counted(spark, sold)
    assert sold_series.series(rows, queries.AS_OF).count() > 0
    assert seen.value == sold.count()


def test_rates_read_the_sales_once(spark):
    sold = surrogate.sold(spark, DATA)
    rows, seen = counted(spark, sold)
    assert len(absorption.rates(rows, queries._snapshots(spark, DATA)).collect()) > 0
    assert seen.value == sold.count()


@pytest.mark.parametrize("name, times", [("c01_series_delta", 1), ("c01_other_months", 1), ("c02_tolerant_delta", 1), ("k05_rates_replaced", 2), ("k05_replace_existing", 2)])
def test_queries_make_each_series_once(spark, monkeypatch, name, times):
    """The sales of the rates and of the documents are two series."""
    sold = surrogate.sold(spark, DATA)
    rows, seen = counted(spark, sold)
    monkeypatch.setattr(surrogate, "sold", lambda *_: rows)
    assert len(queries.QUERIES[name](spark, DATA).collect()) > 0
    assert seen.value == times * sold.count()


def test_months_are_put_from_one_table(spark, monkeypatch):
    """The sizes of areas and the values read the listings, each once, whatever the number of months put."""
    listings = surrogate.active(spark, DATA)
    rows, seen = counted(spark, listings)
    monkeypatch.setattr(surrogate, "active", lambda *_: rows)
    assert len(queries.QUERIES["k02_month_upsert"](spark, DATA).collect()) > 0
    assert seen.value <= 2 * listings.count()


def test_tasks_follow_the_input(spark):
    """One of each id, with more tasks than the session's shuffle partitions where the rows ask for them."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(name, "1m")
    try:
        rows = spark.range(1_600_000).selectExpr("cast(id % 1200000 as string) as _id", "id as v")
        out = merge.keep_first(rows.where("v < 1200000"), rows.where("v >= 1200000"))
        assert out.rdd.getNumPartitions() > int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert out.count() == 1_200_000
    finally:
        spark.conf.unset(name)


@pytest.mark.parametrize("name, times", [("j01_comparables", 1), ("k07_comparable_values", 1), ("k07_put_comparables", 1), ("c03_comparables_delta", 2), ("c03_comparables_changed", 2)])
def test_comparables_read_the_sales_once_a_run(spark, monkeypatch, name, times):
    sold = surrogate.sold(spark, DATA)
    rows, seen = counted(spark, sold)
    monkeypatch.setattr(surrogate, "sold", lambda *_: rows)
    assert len(queries.QUERIES[name](spark, DATA).collect()) > 0
    assert seen.value == times * sold.count()


def test_shuffles_of_what_is_kept_are_deleted(spark):
    files = lambda: set(glob.glob(f"{spark.conf.get('spark.local.dir', tempfile.gettempdir())}/blockmgr-*/*/shuffle_*.data"))
    before, rows = files(), spark.range(1000).selectExpr("id % 10 as k").repartition(4, "k")
    assert rows.count() == 1000 and files() - before
    before = files()
    table = kept(rows.groupBy("k").count(), "kept")
    for _ in range(50):  # they are deleted in the background
        if not (left := files() - before):
            break
        time.sleep(0.1)
    assert not left and table.count() == 10
