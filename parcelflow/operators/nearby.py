"""Comparable sales: the nearest sold listings of the same profile within a radius."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .areas import small
from ..functions.expressions import EARTH_KM, haversine_km
from ..plans.runner import join_in_place, kept, spread

RADIUS_KM, MOST = 1.0, 12
PROFILE = ["propertyType", "bedsInt", "bathsInt"]
COMPS = "array<struct<sold_id:string,distance_km:double>>"
#: Listings of a task that ranks them, about; each makes some hundred pairs.
LISTINGS = 10_000
#: Sales aimed at in a listing's cell, at least; the cells tried after that: levels above it, and whether halved.
AIM, TRIED = 8, ((0, 0), (1, 1), (1, 0), (2, 1), (2, 0), (4, 0))
#: Cells along the sides of a tile, which is shuffled, and of a block, whose listings meet sales; halvings of a cell at most.
TILE, BLOCK, FINEST = 16, 4, 20


def _levels(places: DataFrame, keys: list[str], most: int) -> DataFrame:
    """The rows with a listing_id of places(keys, qy, qx, listing_id, sale), where qy and qx are the place in a cell of the
    radius, halved FINEST times, with the level whose cells, halved that often, are the smallest in which they have `most`
    sales, and `high`, 0.5 if half such a cell, of full width, has as many already; it is null, at level 0, if they have
    fewer even there. Four levels are tried, from `depth`, the one that the sales of a cell of the radius lead to."""
    # sorted by a hash of the cell first, which tells cells apart before any column need be compared
    of = lambda *columns: W.partitionBy(F.xxhash64(*columns), *columns)
    held = F.sum("sale").over(W.partitionBy(*keys))
    depth = F.least(F.greatest(F.coalesce(F.floor(F.log2(held / AIM) / 2), F.lit(0)), F.lit(0)), F.lit(FINEST)).cast("int")
    rows = places.withColumn("depth", depth).withColumn("__up", FINEST - F.col("depth"))
    level, high = F.lit(None).cast("int"), F.lit(None).cast("double")
    for up, double in TRIED:
        of_cell = of(*keys, F.call_function("shiftright", F.col("qy"), F.col("__up") + (up - double)), F.call_function("shiftright", F.col("qx"), F.col("__up") + up))
        rows = rows.withColumn(f"__n{up}{double}", F.sum("sale").over(of_cell))
        enough = level.isNull() & (F.col(f"__n{up}{double}") >= most) & (F.col("depth") >= up)
        level, high = F.when(enough, F.col("depth") - up).otherwise(level), F.when(enough, F.lit(0.5 if double else 1.0)).otherwise(high)
        rows = rows.withColumns({f"__l{up}{double}": level, f"__h{up}{double}": high})
        level, high = F.col(f"__l{up}{double}"), F.col(f"__h{up}{double}")
    return rows.where(F.col("listing_id").isNotNull()).withColumns({"level": F.coalesce(level, F.lit(0)), "high": high})


def _usable(rows: DataFrame) -> DataFrame:
    for c in ["lat", "lng", "_id", *PROFILE]:
        rows = rows.where(F.col(c).isNotNull())
    return rows


def candidates(active: DataFrame, sold: DataFrame, radius_km: float = RADIUS_KM, most: int = MOST, band_degrees: float = 1.0, how: str = "inner") -> DataFrame:
    """(listing_id, tile, distance_km, sold_id): pairs within the radius, among them the `most` nearest of each listing;
    with how="left", usable listings without any have one row without a sale.

    The plane is cut into cells a little larger than the radius, and those into quarters again and again. Longitudes shrink
    towards the poles, so cells are cut within bands of latitude by the width that the band's poleward edge needs; sales near
    a band's edge stand in both bands. The smallest cell around a listing that holds `most` sales says how far it need
    look: to that cell's farthest corner. So where sales are dense, few pairs are made, whatever the number of sales within
    the radius. Listings and sales are shuffled once, by tiles of TILE cells a side of a level that all listings of a dense
    place share, and a sale goes to the few tiles that look so far. In the tile's task listings then meet sales in blocks of
    BLOCK cells of their own level, into which sales are only there repeated. Of sales at one place only the first by id
    count. The sales near listings and the levels are written once; what was shuffled for them is deleted.
    """
    spark = active.sparkSession
    spread(spark)
    join_in_place(spark)
    step = math.degrees(radius_km / EARTH_KM) * 1.01
    band = lambda lat: F.floor(lat / band_degrees).cast("int")
    edges = lambda b: (F.abs(b) * band_degrees, F.abs(b + 1) * band_degrees)
    poleward = lambda b: F.cos(F.radians(F.least(F.greatest(*edges(b)), F.lit(89.0))))
    width = lambda b: F.lit(step) / poleward(b)
    # how much wider a cell is at the band's other edge than at the poleward one
    wider = lambda b: F.cos(F.radians(F.least(*edges(b)))) / poleward(b) * 1.01
    two = lambda level: F.call_function("shiftleft", F.lit(1), level)

    keys, b = [*PROFILE, "band", "cy", "cx"], F.col("band")
    fy, fx = F.col("lat") / step, F.col("lng") / width(b)
    in_cell = lambda f, c: F.least(F.floor((f - F.col(c)) * 2**FINEST), F.lit(2**FINEST - 1)).cast("int")
    placed = lambda rows: rows.withColumns({"cy": F.floor(fy).cast("int"), "cx": F.floor(fx).cast("int")})

    def around(rows: DataFrame) -> DataFrame:
        for c in ("cy", "cx"):
            rows = rows.withColumn(c, F.explode(F.array(*(F.col(c) + d for d in (-1, 0, 1)))))
        return kept(rows.distinct(), "nearby-cells")

    a = placed(_usable(active).select(*PROFILE, F.col("_id").alias("listing_id"), "lat", "lng", band(F.col("lat")).alias("band")))
    cells = kept(a.select(*keys).distinct(), "nearby-cells")
    s = _usable(sold).select(*PROFILE, F.col("_id").alias("sold_id"), "lat", "lng", F.explode(F.array_distinct(F.array(band(F.col("lat") - step), band(F.col("lat")), band(F.col("lat") + step)))).alias("band"))
    s = kept(placed(s).join(small(around(cells)), keys, "left_semi"), "nearby-sales")
    counted = s.join(small(cells), keys, "left_semi").select(*keys, in_cell(fy, "cy").alias("qy"), in_cell(fx, "cx").alias("qx"), F.lit(1).alias("sale"))
    a = kept(_levels(counted.unionByName(a.withColumns({"qy": in_cell(fy, "cy"), "qx": in_cell(fx, "cx"), "sale": F.lit(0)}), allowMissingColumns=True), keys, most).select(*keys, "listing_id", "lat", "lng", "level", "high", "depth"), "nearby-levels")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), a.count() // LISTINGS)

    # the tile's level: one above the depth, where listings of the depth look too (deep); what looks farther has its own
    deep = (F.col("depth") > 0) & (F.col("level") >= F.col("depth") - 1)
    a = a.withColumn("deep", deep).withColumn("top", F.when(deep, F.col("depth") - 1).otherwise(F.col("level")))
    s = s.join(small(around(a.select(*keys, "top", "deep"))), keys)
    at = lambda f, level, side: F.floor(f * two(level) / side).cast("int")
    look = F.least(two(F.col("top")), F.sqrt(1 + F.pow(wider(b), 2)) * 1.01) / two(F.col("top"))
    name = lambda y, x: F.concat_ws(" ", x, y, "top", F.col("deep").cast("int"), "band", *PROFILE).alias("tile")
    top, level = F.col("top"), F.col("level")
    for f, t in ((fy, "ty"), (fx, "tx")):
        s = s.withColumn(t, F.explode(F.sequence(at(f - look, top, TILE), at(f + look, top, TILE))))
    s = s.select(name("ty", "tx"), "sold_id", "lat", "lng", "band", "top", "deep", "ty", "tx").repartition(tasks, "tile")
    first = F.row_number().over(W.partitionBy("lat", "lng", "tile").orderBy("sold_id"))
    s = s.withColumn("__r", first).where(F.col("__r") <= most).withColumns({"fy": fy, "fx": fx, "reach": F.sqrt(1 + F.pow(wider(b), 2)) * 1.01})

    # the blocks of the tile that look as far as the sale, of the tile's level and, if it is deep, of the next
    def blocks(level: Column, side: int) -> Column:
        ends = {"level": level}
        far = F.least(two(level), F.col("reach")) / two(level)
        for f, t, c in ((F.col("fy"), "ty", "y"), (F.col("fx"), "tx", "x")):
            ends |= {f"{c}0": F.greatest(at(f - far, level, BLOCK), F.col(t) * side), f"{c}1": F.least(at(f + far, level, BLOCK), F.col(t) * side + side - 1)}
        return F.struct(*(v.alias(k) for k, v in ends.items()))

    own, next_ = blocks(top, TILE // BLOCK), blocks(top + 1, 2 * TILE // BLOCK)
    s = s.select("tile", "sold_id", "lat", "lng", F.explode(F.when(F.col("deep"), F.array(own, next_)).otherwise(F.array(own))).alias("__of"))
    s = s.where((F.col("__of.y0") <= F.col("__of.y1")) & (F.col("__of.x0") <= F.col("__of.x1")))
    s = s.select("*", F.explode(F.sequence("__of.y0", "__of.y1")).alias("by")).select("*", F.explode(F.sequence("__of.x0", "__of.x1")).alias("bx"))
    s = s.select(*(F.col(c).alias(f"{c}_s") for c in ("bx", "by", "tile", "lat", "lng")), F.col("__of.level").alias("level_s"), "sold_id")
    block = ["bx", "by", "level", "tile"]
    s = s.withColumn("block_s", F.xxhash64(*(f"{c}_s" for c in block)))

    within = lambda f, n: f * n - F.floor(f * n)
    corner = lambda f, n: F.greatest(within(f, n), 1 - within(f, n)) / n
    far = F.sqrt(F.pow(corner(fy, two(level) / F.col("high")), 2) + F.pow(corner(fx, two(level)) * wider(b), 2)) * radius_km * 1.0101
    far = F.least(far, F.lit(radius_km)).alias("far")  # least() skips a null
    a = a.select("listing_id", name(at(fy, top, TILE), at(fx, top, TILE)), "lat", "lng", far, "level", at(fy, level, BLOCK).alias("by"), at(fx, level, BLOCK).alias("bx")).repartition(tasks, "tile")
    degrees = F.col("far") * (1.001 * math.degrees(1 / EARTH_KM))
    a = a.withColumn("block", F.xxhash64(*block)).withColumn("dlat", degrees).withColumn("dlng", degrees * 1.01 / F.cos(F.radians(F.least(F.abs(F.col("lat")) + degrees, F.lit(89.0)))))
    met = F.lit(True)
    for c in ["block", *block]:  # sorted by the hash first
        met = met & (F.col(c) == F.col(f"{c}_s"))
    distance = haversine_km(F.col("lat"), F.col("lng"), F.col("lat_s"), F.col("lng_s"))
    box = (F.abs(F.col("lat_s") - F.col("lat")) <= F.col("dlat")) & (F.abs(F.col("lng_s") - F.col("lng")) <= F.col("dlng"))
    return a.join(s, met & box & (distance < F.col("far")), how).select("listing_id", "tile", distance.alias("distance_km"), "sold_id")


def _by_repeats(active: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """The listings, written once: all of them, those whose id stands once, and those of other ids, if there are any."""
    rows = kept(active.select("_id", *PROFILE, "lat", "lng"), "nearby-active")
    ids = kept(rows.groupBy("_id").count().where(F.col("count") > 1).select("_id"), "nearby-repeated")
    if ids.isEmpty():
        return rows, rows, None
    ids = small(ids)
    return rows, rows.join(ids, "_id", "left_anti"), rows.join(ids, "_id", "left_semi")


def _nearest(pairs: DataFrame, most: int, *by: str) -> DataFrame:
    rank = F.row_number().over(W.partitionBy(*by).orderBy("distance_km", "sold_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= most)


def _in_order() -> Column:
    comps = F.sort_array(F.collect_list(F.when(F.col("sold_id").isNotNull(), F.struct("distance_km", "sold_id"))))
    return F.transform(comps, lambda x: F.struct(x["sold_id"].alias("sold_id"), x["distance_km"].alias("distance_km")))


def _of_repeated(again: DataFrame, sold: DataFrame, radius_km: float, most: int, band_degrees: float) -> DataFrame:
    pairs = candidates(again, sold, radius_km, most, band_degrees)
    return _nearest(_nearest(pairs, most, "listing_id", "tile"), most, "listing_id").select("listing_id", "sold_id", "distance_km", "rank")


def comparables(active: DataFrame, sold: DataFrame, radius_km: float = RADIUS_KM, most: int = MOST, band_degrees: float = 1.0) -> DataFrame:
    """(listing_id, sold_id, distance_km, rank): at most `most` sold listings strictly within the radius, nearest first,
    ties by id. Pairs are ranked in their tile's task, where all of an id that stands once are; only those of ids that stand
    in several rows are shuffled to be ranked again."""
    _, once, again = _by_repeats(active)
    found = _nearest(candidates(once, sold, radius_km, most, band_degrees), most, "listing_id", "tile").select("listing_id", "sold_id", "distance_km", "rank")
    return found if again is None else found.unionByName(_of_repeated(again, sold, radius_km, most, band_degrees))


def comparable_lists(active: DataFrame, sold: DataFrame, radius_km: float = RADIUS_KM, most: int = MOST, band_degrees: float = 1.0) -> DataFrame:
    """(listing_id, comps) of each id in active, as comparable_arrays() makes them of comparables(), but in the tiles' tasks,
    so that no pair is shuffled, unless its listing's id stands in several rows."""
    rows, once, again = _by_repeats(active)
    pairs = _nearest(candidates(once, sold, radius_km, most, band_degrees, "left"), most, "listing_id", "tile")
    found = pairs.groupBy("listing_id", "tile").agg(_in_order().alias("comps")).drop("tile")
    unplaced = F.lit(False)
    for c in ["_id", *PROFILE, "lat", "lng"]:
        unplaced = unplaced | F.col(c).isNull()
    others = rows.where(unplaced)
    if again is None:
        return found.unionByName(others.select(F.col("_id").alias("listing_id")).distinct().withColumn("comps", F.array().cast(COMPS)))
    return found.unionByName(comparable_arrays(_of_repeated(again, sold, radius_km, most, band_degrees), others.unionByName(again)))


def comparable_arrays(found: DataFrame, active: DataFrame | None = None) -> DataFrame:
    """(listing_id, comps): arrays in order of distance; with active, listings without any have an empty one."""
    out = found.groupBy("listing_id").agg(_in_order().alias("comps"))
    if active is not None:
        out = active.select(F.col("_id").alias("listing_id")).distinct().join(out, "listing_id", "left")
        out = out.withColumn("comps", F.coalesce("comps", F.array().cast(COMPS)))
    return out
