import datetime as dt

import pytest
from pyspark.sql import functions as F

from parcelflow.operators import merge
from parcelflow.plans import checks
from parcelflow.plans.increments import Increments, due, follow

D = dt.datetime
SCHEMA = "_id string, lastTransition timestamp_ntz, soldPrice double, guid string, arrived timestamp_ntz"
ROWS = [
    ("a", D(2020, 1, 2), 1.0, "g10_1", D(2020, 1, 2)),
    ("late", D(2020, 1, 30), 2.0, "g10_1", D(2020, 2, 10)),
    ("b", D(2020, 2, 5), 3.0, "None", D(2020, 2, 5)),
    ("too late", D(2020, 1, 2), 4.0, "g10_1", D(2020, 2, 20)),
]


def reader(rows):
    return lambda start, end: merge.in_window(rows, start, end).where(F.col("arrived") < F.lit(end).cast("timestamp_ntz"))


def keep(cached, delta):
    return delta if cached is None else merge.keep_first(cached, delta)


def ids(df):
    return sorted(r["_id"] for r in df.collect())


def test_marks_move_with_states_only(spark, tmp_path):
    rows, store = spark.createDataFrame(ROWS, SCHEMA), Increments(spark, str(tmp_path), "job")
    first, back = D(2019, 1, 1), dt.timedelta(days=21)
    assert store.mark("ON") is None and store.state("ON") is None
    store.run("ON", reader(rows), keep, D(2020, 2, 1), first, back)
    assert store.mark("ON") == D(2020, 2, 1) and ids(store.state("ON")) == ["a"] and store.mark("BC") is None

    def broken(cached, delta):
        return keep(cached, delta).withColumn("x", F.raise_error(F.lit("lost")))

    with pytest.raises(Exception, match="lost"):
        store.run("ON", reader(rows), broken, D(2020, 3, 1), first, back)
    assert store.mark("ON") == D(2020, 2, 1) and ids(store.state("ON")) == ["a"]
    store.run("ON", reader(rows), keep, D(2020, 3, 1), first, back)
    # what comes within the lookback is found, what comes later than that is not
    assert store.mark("ON") == D(2020, 3, 1) and ids(store.state("ON")) == ["a", "b", "late"]
    store.run("ON", reader(rows), keep, D(2020, 3, 1), first, back)
    assert ids(store.state("ON")) == ["a", "b", "late"] and store.log().count() == 3
    with pytest.raises(ValueError):
        store.states(["BC"])


def test_loads_are_refused_or_warned_of(spark, tmp_path):
    rows, store = spark.createDataFrame(ROWS, SCHEMA), Increments(spark, str(tmp_path), "job")
    first, back = D(2019, 1, 1), dt.timedelta(days=21)
    run = lambda part, rows, checked, now=D(2020, 2, 1): store.run(part, reader(rows), keep, now, first, back, checked)
    assert run("ON", rows, [checks.not_empty(), checks.some_sales(), checks.known_areas(), checks.all_named()]) == {"n_rows": 1, "n_sales": 1, "share_without_area": 0.0, "n_without_key": 0}
    with pytest.raises(checks.LoadRefused, match="no rows") as refused:
        run("BC", rows.where("false"), [checks.not_empty()])
    assert refused.value.seen == {"n_rows": 0} and store.mark("BC") is None
    run("NU", rows.where("false"), [checks.not_empty(), checks.some_sales()])
    assert store.mark("NU") == D(2020, 2, 1)
    with pytest.warns(UserWarning, match="no sales"):
        run("SK", rows.withColumn("soldPrice", F.lit(None).cast("double")), [checks.some_sales()])
    unknown = rows.withColumn("guid", F.lit("None"))
    with pytest.raises(checks.LoadRefused, match="without an area"):
        run("QC", unknown, [checks.known_areas()])
    half = rows.withColumn("loaded", F.col("soldPrice") < 2)
    with pytest.raises(checks.LoadRefused, match="too few"):
        run("PE", half, [checks.loaded_enough()], D(2020, 3, 1))
    assert run("MB", half, [checks.loaded_enough(0.25)], D(2020, 3, 1)) == {"share_loaded": 0.25}
    assert due(store.log(), ["ON", "BC", "NU", "MB"], D(2020, 2, 1, 6), dt.timedelta(hours=12)) == ["BC"]


def test_streams_are_followed_and_batches_merged_once(spark, tmp_path):
    store, parts = Increments(spark, str(tmp_path), "events"), {"odd": F.col("k") % 2 == 1, "even": F.col("k") % 2 == 0}
    merged = lambda state, rows: rows if state is None else merge.keep_last(state, rows, ["k"])
    for lot in ([(1, "a"), (2, "b")], [(3, "c"), (1, "newer")], []):
        spark.createDataFrame(lot, "k int, v string").write.mode("append").parquet(f"{tmp_path}/files")
        stream = spark.readStream.schema("k int, v string").parquet(f"{tmp_path}/files")
        follow(stream, parts, store, merged, f"{tmp_path}/checkpoint").awaitTermination()
    assert sorted(map(tuple, store.states(list(parts)).collect())) == [(1, "newer", "odd"), (2, "b", "even"), (3, "c", "odd")]
    last = store.last("odd")["batch"]
    assert not store.batch("odd", last, spark.createDataFrame([(9, "again")], "k int, v string"), merged)
    assert store.batch("odd", last + 1, spark.createDataFrame([(9, "more")], "k int, v string"), merged)
    assert store.state("odd").count() == 3
