"""Listing tables made from the order tables of the test data, so that every operator runs on data of any size.

The same mapping as SQL stands in queries.py; both must agree.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = dt.datetime(2001, 8, 15)
ACTIVE_AS_OF = dt.datetime(1998, 8, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales from line items. A small dimension joins by broadcast; orders give the date of listing."""
    line, part, orders = (table(spark, sf_dir, t) for t in ("lineitem", "part", "orders"))
    supplier, nation = (table(spark, sf_dir, t) for t in ("supplier", "nation"))
    rows = line.join(orders.select("o_orderkey", "o_orderdate"), line.l_orderkey == F.col("o_orderkey"))
    rows = rows.join(part.select("p_partkey", "p_type", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.join(supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "s_nationkey", "n_regionkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    first = F.split("p_type", " ")[0]
    kind = F.when(first == "ECONOMY", "CONDO").when(first == "SMALL", "TOWNHOUSE").when(first == "MEDIUM", "SEMI-DETACHED").when(first == "LARGE", "DETACHED").when(first == "STANDARD", "OTHER")
    guid = F.concat_ws(",", F.concat(F.lit("g10_s"), "l_suppkey"), F.concat(F.lit("g30_n"), "s_nationkey"), F.concat(F.lit("g40_r"), "n_regionkey"))
    odd = F.col("l_orderkey") % 50
    return rows.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("_id"), F.col("l_shipdate").alias("lastTransition"), F.col("l_extendedprice").alias("soldPrice"), (F.col("l_quantity") * 1500.0).alias("price"),
        F.datediff("l_shipdate", "o_orderdate").cast("double").alias("daysOnMarket"), kind.alias("propertyType"), (F.col("p_size") % 4 + 1).cast("int").alias("bedsInt"), (F.col("l_linenumber") % 3 + 1).cast("int").alias("bathsInt"),
        F.when(odd == 0, F.lit(None)).when(odd == 1, F.lit("None")).otherwise(guid).alias("guid"),
        (43.6 + F.col("l_orderkey") % 997 / F.lit(997.0) * 0.2).cast("double").alias("lat"), (-79.5 + F.col("l_partkey") % 991 / F.lit(991.0) * 0.3).cast("double").alias("lng"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_id"),
    )


def active(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings from orders, with a status, an update time and a deletion flag; repeated rows of an id are in tracked()."""
    orders, customer, nation = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    rows = orders.join(customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_nationkey", "n_regionkey"), F.col("o_custkey") == F.col("c_custkey"))
    rank = F.col("o_orderkey") % 6
    kind = F.when(rank == 0, "CONDO").when(rank == 1, "TOWNHOUSE").when(rank == 2, "SEMI-DETACHED").when(rank == 3, "DETACHED").when(rank == 4, "OTHER")
    return rows.select(
        F.col("o_orderkey").cast("string").alias("_id"), F.col("o_orderdate").alias("addedOn"), (F.col("o_orderdate") + F.make_interval(days=(F.col("o_orderkey") % 30).cast("int"))).alias("lastUpdate"), F.col("o_totalprice").alias("price"),
        kind.alias("propertyType"), (F.col("o_orderkey") % 4 + 1).cast("int").alias("bedsInt"), (F.col("o_custkey") % 3 + 1).cast("int").alias("bathsInt"), F.when(F.col("o_orderstatus") == "O", "ACTIVE").when(F.col("o_orderstatus") == "F", "SOLD").otherwise("PENDING").alias("listingStatus"),
        F.concat_ws(",", F.concat(F.lit("g30_n"), "c_nationkey"), F.concat(F.lit("g40_r"), "n_regionkey")).alias("guid"), (F.col("o_orderkey") % 11 == 0).alias("is_deleted"),
        (43.6 + F.col("o_orderkey") % 887 / F.lit(887.0) * 0.2).cast("double").alias("lat"), (-79.5 + F.col("o_custkey") % 881 / F.lit(881.0) * 0.3).cast("double").alias("lng"), F.col("n_regionkey").cast("int").alias("region"),
    )


def geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas: nations are squares of one degree in a row, regions the bands around them."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    n = nation.select(F.concat(F.lit("g30_n"), "n_nationkey").alias("geog_id"), F.col("n_name").alias("name"), F.lit(30).alias("level"), F.concat(F.lit("g40_r"), "n_regionkey").alias("parent_id"), F.col("n_regionkey").cast("double").alias("south"), F.col("n_nationkey").cast("double").alias("west"), F.lit(1.0).cast("double").alias("wide"))
    r = region.select(F.concat(F.lit("g40_r"), "r_regionkey").alias("geog_id"), F.col("r_name").alias("name"), F.lit(40).alias("level"), F.lit(None).cast("string").alias("parent_id"), F.col("r_regionkey").cast("double").alias("south"), F.lit(0.0).cast("double").alias("west"), F.lit(25.0).cast("double").alias("wide"))
    both = n.union(r)
    corner = lambda dy, dx: F.struct((F.col("south") + dy).alias("lat"), (F.col("west") + F.col("wide") * dx).alias("lng"))
    ring = F.array(corner(0.0, 0.0), corner(0.0, 1.0), corner(1.0, 1.0), corner(1.0, 0.0), corner(0.0, 0.0))
    return both.select("geog_id", "name", "level", F.lit("ON").alias("province"), "parent_id", F.array(ring).alias("rings"), "south", "west", "wide")
