"""Exact medians of groups of any size, whose values no state ever holds together.

Most groups are put in order by a task's sort, which spills. Those of the few areas, or whatever the first key is, that hold
more than a share of all rows are split: the values of a group are cut into ranges whose bounds depend on the values alone; how
many stand before each range, which is added up before the shuffle, says in which ones the middle lies; and only the rows of
those are shuffled and put in order, equal values as one. So a group that holds a third of all rows moves few of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.runner import kept

#: Ranges for each doubling of a value. Prices of a group that lie between 20,000 and 2,000,000 have about a hundred.
RANGES = 16
#: Groups with more than this share of all rows, fewer than 1/SHARE by definition, are split, unless they are small anyway.
SHARE, SMALL = 1e-3, 100_000


def value_range(value: Column, ranges: int = RANGES) -> Column:
    """The range of a number: greater values have greater or equal ranges, NaN the greatest."""
    size = F.floor(F.log2(F.lit(1.0) + F.abs(value)) * ranges)
    return F.coalesce(F.when(F.isnan(value), F.lit(1 << 40)).otherwise(F.when(value < 0, -size - 1).otherwise(size)).cast("long"), F.lit(0).cast("long"))


def large_groups(rows: DataFrame, keys: list[str], share: float = SHARE, small: int = SMALL) -> DataFrame:
    """The keys of groups with more than `small` rows and more than `share` of all: at most 1/share, whatever the input."""
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    total = sizes.agg(F.sum("__n").alias("__all"))
    return sizes.where(F.col("__n") > small).join(F.broadcast(total), F.col("__n") > F.col("__all") * share).select(*keys)


def sorted_medians(rows: DataFrame, keys: list[str], columns: list[str], others: dict[str, Column]) -> DataFrame:
    """keys, the exact median of each column and the other aggregates, by one shuffle of the rows and a sort a column. A hash of
    the keys leads the order, so that rows of different groups are told apart by one number; the keys themselves follow."""
    rows = rows.withColumn("__hash", F.xxhash64(*keys))
    group = W.partitionBy("__hash", *keys)
    for k, c in enumerate(columns):
        rows = rows.withColumns({f"__rank{k}": F.row_number().over(group.orderBy(F.col(c).asc_nulls_last())), f"__held{k}": F.count(c).over(group)})
    middle = lambda k: F.col(f"__rank{k}").between(F.floor((F.col(f"__held{k}") + 1) / 2), F.floor(F.col(f"__held{k}") / 2) + 1)
    return rows.groupBy("__hash", *keys).agg(*(F.avg(F.when(middle(k), F.col(c).cast("double"))).alias(f"__median{k}") for k, c in enumerate(columns)), *(a.alias(n) for n, a in others.items()))


def with_medians(rows: DataFrame, keys: list[str], wanted: dict[str, str], others: dict[str, Column], share: float = SHARE, small: int = SMALL) -> DataFrame:
    """keys; an exact median for each name in wanted, of the column that it is given; and other aggregates by name.

    Keys are not null. A group without values has a null median. The large values of the first key, which are counted once
    and written, are broadcast, at most 1/SHARE of them; without any, which is seen at run time, only the sort is left.
    """
    columns, k = list(dict.fromkeys(wanted.values())), len(keys)
    large = F.broadcast(kept(large_groups(rows, keys[:1], share, small), "large"))
    few = sorted_medians(rows.join(large, keys[:1], "left_anti"), keys, columns, others)
    few = few.select(*keys, *(F.col(f"__median{columns.index(c)}").alias(name) for name, c in wanted.items()), *others)
    many = rows.join(large, keys[:1], "left_semi")
    plain = many.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *(a.alias(n) for n, a in others.items()))
    found = medians(many, keys, columns).toDF(*(f"__key{i}" for i in range(k)), *(f"__median{i}" for i in range(len(columns))))
    same = [F.col(key) == F.col(f"__key{i}") for i, key in enumerate(keys)]
    split = plain.join(found, same, "left").select(*keys, *(F.col(f"__median{columns.index(c)}").alias(name) for name, c in wanted.items()), *others)
    return few.unionByName(split)


def medians(rows: DataFrame, keys: list[str], columns: list[str], ranges: int = RANGES) -> DataFrame:
    """keys and the exact median of each column, as a double; that of an even number of values is the mean of the middle two.

    Nulls are left out; a group without values in a column has null there, and groups without any value are not in the
    result. Null keys form a group. NaN is greater than any number. Empty tables give empty ones.
    """
    # one row a value, for all columns at once; keys go in a struct, which is not null and has names of its own
    one = F.explode(F.array(*(F.struct(F.lit(k).alias("which"), F.col(c).cast("double").alias("value")) for k, c in enumerate(columns))))
    long = rows.select(F.struct(*keys).alias("key"), one.alias("one")).select("key", "one.which", "one.value").where("value IS NOT NULL")
    long = long.withColumn("place", value_range(F.col("value"), ranges))
    sums = long.groupBy("key", "which", "place").agg(F.count(F.lit(1)).alias("m"))
    group = W.partitionBy("key", "which")
    total, before = F.sum("m").over(group), F.sum("m").over(group.orderBy("place")) - F.col("m")
    # where the two middle values are within a range, from 1; of an odd number both are the same
    middle = sums.select("key", "which", "place", "m", (F.floor((total + 1) / 2) - before).alias("low"), (F.floor(total / 2) + 1 - before).alias("high"))
    middle = middle.where("low BETWEEN 1 AND m OR high BETWEEN 1 AND m").drop("m")
    # written, so that its size is known and Spark broadcasts it if that is small; then other rows are not shuffled
    middle = kept(middle, "middle")
    cells = long.join(middle, ["key", "which", "place"])
    found = cells.groupBy("key", "which", "place", "value").agg(F.count(F.lit(1)).alias("n"), F.first("low").alias("low"), F.first("high").alias("high"))
    upto = F.sum("n").over(W.partitionBy("key", "which", "place").orderBy("value"))
    found = found.withColumn("upto", upto).withColumn("hits", F.expr("int(low > upto - n AND low <= upto) + int(high > upto - n AND high <= upto)"))
    half = lambda k: F.sum(F.when(F.col("which") == k, F.col("value") / 2 * F.col("hits")))
    out = found.where("hits > 0").groupBy("key").agg(*(half(k).alias(f"median{k}") for k in range(len(columns))))
    return out.select("key.*", *(F.col(f"median{k}").alias(c) for k, c in enumerate(columns)))
