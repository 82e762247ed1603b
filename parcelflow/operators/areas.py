"""From listings to areas: cleaning, exploding and validating area ids; assigning areas to points."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import clean_guid, geo_level
from ..functions.polygons import bounding_box, contains_point, covered_share
from .cells import BITS, CELLS, cell_code, covering, crowding

#: Areas of a catalogue that may be broadcast; beyond, the same joins shuffle.
MOST_BROADCAST_AREAS = 200_000


def small(df: DataFrame, rows: int = MOST_BROADCAST_AREAS) -> DataFrame:
    """df with a broadcast hint if it has few rows, counted up to the limit."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def explode_areas(listings: DataFrame, valid: DataFrame | None = None, guid: str = "guid") -> DataFrame:
    """One row per listing and area id. Listings without ids go; with valid(geog_id), so do unknown ids."""
    ids = F.split(clean_guid(guid), ",")
    out = listings.withColumn("geog_id", F.explode(ids)).where(F.col("geog_id") != "")
    return out if valid is None else out.join(small(valid.select("geog_id").distinct()), "geog_id", "left_semi")


def valid_areas(geo: DataFrame, province: str) -> DataFrame:
    return geo.where(F.col("province") == province).select("geog_id").distinct()


def contamination(listings: DataFrame, valid: DataFrame) -> DataFrame:
    """One row: area ids before and after validation, and the share of unknown ones in per cent."""
    known = small(valid.select(F.col("geog_id").alias("__id")).distinct())
    rows = explode_areas(listings).join(known, F.col("geog_id") == F.col("__id"), "left")
    n, ok = F.count(F.lit(1)), F.count("__id")
    return rows.agg(n.alias("before"), ok.alias("after"), (F.try_divide(n - ok, n) * 100).alias("percent_unknown"))


#: Areas whose cells may be broadcast, some 64 of 40 bytes each.
MOST_BROADCAST_COVERINGS = 20_000


def points_in_areas(points: DataFrame, geo: DataFrame, key: str = "_id", touching: bool = True, by_density: bool = False) -> DataFrame:
    """(key, geog_id, level) for every area that contains a point, over the areas' cells of a quadtree: in cells wholly inside
    an area there is nothing left to test, elsewhere outlines are joined by area. by_density covers areas with crowded
    surroundings more finely, for another pass over the points. Repeated points give repeated rows."""
    most: Column | int = CELLS
    if by_density:
        geo = crowding(points, geo)
        most = F.col("cells")
    few = geo.limit(MOST_BROADCAST_COVERINGS + 1).count() <= MOST_BROADCAST_COVERINGS
    hint = F.broadcast if few else lambda df: df
    index = covering(geo, most)
    depths = index.select(F.shiftright("code", 2 * BITS).cast("int").alias("__depth")).agg(F.collect_set("__depth").alias("__depths"))  # ten at most
    places = points.where(F.col("lat").isNotNull() & F.col("lng").isNotNull()).select(F.col(key), F.col("lat").alias("__lat"), F.col("lng").alias("__lng"))
    places = places.join(F.broadcast(depths)).select(key, "__lat", "__lng", F.explode("__depths").alias("__depth"))
    places = places.withColumn("code", cell_code(F.col("__depth"), F.col("__lat"), F.col("__lng")))
    met = places.join(hint(index), "code")
    inside = met.where("inside").select(key, "geog_id", "level")
    outlines = geo.where(F.size("rings") > 0).select("geog_id", "rings")
    border = met.where("NOT inside").join(hint(outlines), "geog_id").where(contains_point(F.col("rings"), F.col("__lat"), F.col("__lng"), touching))
    return inside.union(border.select(key, "geog_id", "level"))


def containing_guid(points: DataFrame, geo: DataFrame, key: str = "_id") -> DataFrame:
    """(key, guid): the ids of all areas that contain a point, fine to coarse and by id within a level, joined by commas.
    Points in no area are absent."""
    found = points_in_areas(points, geo, key).groupBy(key).agg(F.array_sort(F.collect_set(F.struct("level", "geog_id"))).alias("holds"))
    return found.select(key, F.array_join(F.col("holds.geog_id"), ",").alias("guid"))


def assign_guids(listings: DataFrame, geo: DataFrame, overlaps: DataFrame | None = None, key: str = "_id", cutoff=None) -> DataFrame:
    """listings with guid filled where it was null: area ids, fine to coarse, of the first area by id on each level that
    holds the point. Under a level that matched, only children of the match count; overlapping areas of a match that
    hold the point too are added. computed_guid tells what was filled."""
    need = listings.where(clean_guid("guid").isNull() & F.col("lat").isNotNull() & F.col("lng").isNotNull())
    if cutoff is not None:
        need = need.where(F.col("lastTransition") < F.lit(cutoff))
    holds = points_in_areas(need, geo, key).join(small(geo.select("geog_id", "parent_id")), "geog_id")
    per = holds.groupBy(key).agg(F.collect_list(F.struct("level", "geog_id", "parent_id")).alias("holds"))
    start = F.struct(F.lit(None).cast("string").alias("parent"), F.array().cast("array<string>").alias("ids"))

    def level(state, n):
        here = F.filter("holds", lambda a: (a["level"] == n) & (state["parent"].isNull() | (a["parent_id"] == state["parent"])))
        first = F.array_min(F.transform(here, lambda a: a["geog_id"]))
        return F.struct(F.coalesce(first, state["parent"]).alias("parent"), F.when(first.isNotNull(), F.array_append(state["ids"], first)).otherwise(state["ids"]).alias("ids"))

    chosen = per.select(key, "holds", F.aggregate(F.array(*(F.lit(x) for x in (40, 35, 30, 20, 10))), start, level)["ids"].alias("ids"))
    if overlaps is not None:
        picked = chosen.select(key, F.posexplode("ids").alias("pos", "geog_id"))
        extra = picked.join(overlaps.select("geog_id", "other_id"), "geog_id").join(holds.select(key, F.col("geog_id").alias("other_id")), [key, "other_id"], "left_semi")
        every = picked.select(key, "pos", F.col("geog_id").alias("id")).union(extra.select(key, F.col("pos") + F.lit(0), F.col("other_id"))).groupBy(key, "id").agg(F.min("pos").alias("pos"))
        chosen = every.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "id"))), lambda x: x["id"]).alias("ids"))
    filled = chosen.where(F.size("ids") > 0).select(F.col(key).alias("__key"), F.concat_ws(",", F.reverse("ids")).alias("__guid"))
    out = listings.join(filled, F.col(key) == F.col("__key"), "left")
    fill = F.when(clean_guid("guid").isNull(), F.col("__guid"))
    return out.withColumns({"computed_guid": fill, "guid": F.coalesce(clean_guid("guid"), fill)}).drop("__key", "__guid")


def reset_computed_guids(listings: DataFrame) -> DataFrame:
    return listings.withColumns({"guid": F.when(F.col("computed_guid").isNull(), F.col("guid")), "computed_guid": F.lit(None).cast("string")})


def fill_from_entries(listings: DataFrame, entries: DataFrame) -> DataFrame:
    """listings with an empty guid filled by (mls, city, provState) from the entry table; of repeated entries the largest
    area list is taken. The number of rows stays."""
    one = entries.groupBy(F.col("MLS").alias("__mls"), F.col("CITY").alias("__city"), F.col("PROV_STATE").alias("__prov")).agg(F.max("GEOGRAPHIES").alias("__found"))
    on = (F.col("mls") == F.col("__mls")) & (F.col("city") == F.col("__city")) & (F.col("provState") == F.col("__prov"))
    return listings.join(one, on, "left").withColumn("guid", F.coalesce(clean_guid("guid"), F.col("__found"))).drop("__mls", "__city", "__prov", "__found")


def children(geo: DataFrame) -> DataFrame:
    """(geog_id, children) of every area that has some, ascending."""
    return geo.where(F.col("parent_id").isNotNull()).groupBy(F.col("parent_id").alias("geog_id")).agg(F.sort_array(F.collect_list("geog_id")).alias("children"))


def ancestors(geo: DataFrame) -> DataFrame:
    """(geog_id, ancestor_id, depth): every area with those above it, depth 1 for the parent, however deep the hierarchy.

    A recursive query, so nothing is counted or collected to plan it. Where parents go in a circle, a path ends at the area
    that it meets again.
    """
    step = geo.select(F.col("geog_id").alias("of"), F.col("parent_id").alias("up")).where("of IS NOT NULL AND up IS NOT NULL").distinct()
    walk = """
        WITH RECURSIVE walk(geog_id, ancestor_id, depth, met) AS (
            SELECT of, up, 1, array(of, up) FROM {step}
            UNION ALL
            SELECT walk.geog_id, next.up, walk.depth + 1, array_append(walk.met, next.up)
            FROM walk JOIN {step} next ON walk.ancestor_id = next.of WHERE NOT array_contains(walk.met, next.up)
        ) SELECT geog_id, ancestor_id, depth FROM walk
    """
    return geo.sparkSession.sql(walk, step=step)


def chased_guids(points: DataFrame, geo: DataFrame, key: str = "_id") -> DataFrame:
    """(key, guid): the finest area that holds a point, the first by id of several, and all areas above it by their parents,
    whether or not these hold the point too. Points in no area are absent."""
    finest = points_in_areas(points, geo, key).groupBy(key).agg(F.min(F.struct("level", "geog_id"))["geog_id"].alias("geog_id"))
    above = ancestors(geo).groupBy("geog_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("depth", "ancestor_id"))), lambda x: x["ancestor_id"]).alias("above"))
    return finest.join(above, "geog_id", "left").select(key, F.concat_ws(",", "geog_id", "above").alias("guid"))


def first_per_level(points: DataFrame, geo: DataFrame, key: str = "_id") -> DataFrame:
    """(key, guid): on each level the first area by id that holds a point, fine to coarse, whatever their parents."""
    one = points_in_areas(points, geo, key).groupBy(key, "level").agg(F.min("geog_id").alias("geog_id"))
    ordered = one.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("level", "geog_id"))).alias("ids"))
    return ordered.select(key, F.array_join("ids.geog_id", ",").alias("guid"))


def push_guids(sold: DataFrame, known: DataFrame, now, days: int = 90) -> DataFrame:
    """sold with guid filled from known(_id, guid) where it is missing, for sales of the last days, from the start of a day,
    with coordinates that can be. Of several guids of an id the first is taken; other rows stay as they are."""
    one = known.where(clean_guid("guid").isNotNull()).groupBy(F.col("_id").alias("__id")).agg(F.min("guid").alias("__guid"))
    recent = F.col("lastTransition").between(F.date_trunc("day", F.lit(now - dt.timedelta(days=days))).cast("timestamp_ntz"), F.lit(now).cast("timestamp_ntz"))
    fill = clean_guid("guid").isNull() & recent & F.col("lat").between(-90, 90) & F.col("lng").between(-180, 180)
    out = sold.join(one, F.col("_id") == F.col("__id"), "left")
    return out.withColumn("guid", F.when(F.coalesce(fill, F.lit(False)), F.coalesce("__guid", "guid")).otherwise(F.col("guid"))).drop("__id", "__guid")


def overlapping(geo: DataFrame, cell: float = 0.25) -> DataFrame:
    """(geog_id, other_id), both ways: areas of a level whose boxes meet and of which one has a corner in, or a side
    across, the other."""
    from ..functions.polygons import _edges

    box = bounding_box(F.col("rings"))
    at = lambda c: F.floor(c / cell).cast("int")
    a = geo.where(F.size("rings") > 0).select("geog_id", "level", F.element_at("rings", 1).alias("ring"), "rings", box.alias("box"))
    a = a.withColumn("cy", F.explode(F.sequence(at(F.col("box.south")), at(F.col("box.north"))))).withColumn("cx", F.explode(F.sequence(at(F.col("box.west")), at(F.col("box.east")))))
    b = a.select(F.col("geog_id").alias("other_id"), F.col("level").alias("level_b"), F.col("ring").alias("ring_b"), F.col("rings").alias("rings_b"), F.col("box").alias("box_b"), "cy", "cx")
    meets = (F.col("box.south") <= F.col("box_b.north")) & (F.col("box_b.south") <= F.col("box.north")) & (F.col("box.west") <= F.col("box_b.east")) & (F.col("box_b.west") <= F.col("box.east"))
    pairs = a.join(b, ["cy", "cx"]).where((F.col("level") == F.col("level_b")) & (F.col("geog_id") < F.col("other_id")) & meets)
    corner = F.exists("ring", lambda p: contains_point(F.col("rings_b"), p["lat"], p["lng"])) | F.exists("ring_b", lambda p: contains_point(F.col("rings"), p["lat"], p["lng"]))

    def side(o, p, q):
        return F.signum((p["lng"] - o["lng"]) * (q["lat"] - o["lat"]) - (p["lat"] - o["lat"]) * (q["lng"] - o["lng"]))

    crossing = F.exists(_edges(F.col("ring")), lambda e: F.exists(_edges(F.col("ring_b")), lambda f: (side(e["a"], e["b"], f["a"]) * side(e["a"], e["b"], f["b"]) < 0) & (side(f["a"], f["b"], e["a"]) * side(f["a"], f["b"], e["b"]) < 0)))
    found = pairs.where(corner | crossing).select("geog_id", "other_id").distinct()
    return found.union(found.select("other_id", "geog_id"))


#: Levels that can be a parent, the nearest first.
PARENT_LEVELS = (20, 30, 35, 40)


def find_parents(geo: DataFrame, least_share: float = 0.99, cell: float = 0.25) -> DataFrame:
    """(geog_id, parent_id) for areas without a parent: on the lowest higher level that has one, the area that the
    level_<n>_en column names, else the first by id that holds nearly all of the polygon. Areas without either are absent.

    Names are an equi-join. Polygons meet in the cell of the child's first corner or its neighbours, where a parent that
    holds the child must have its box, so only a few candidates come to the exact area."""
    need = geo.where(F.col("parent_id").isNull()) if "parent_id" in geo.columns else geo
    above = geo.where(F.col("level").isin(*PARENT_LEVELS))
    named = None
    for n in PARENT_LEVELS:
        if f"level_{n}_en" in geo.columns:
            child = need.where(F.col("level") < n).select("geog_id", F.col(f"level_{n}_en").alias("name"))
            hit = child.join(above.where(F.col("level") == n).select(F.col("geog_id").alias("parent_id"), "name"), "name").select("geog_id", F.lit(n).alias("at"), F.lit(0).alias("how"), "parent_id")
            named = hit if named is None else named.union(hit)

    at = lambda c: F.floor(c / cell).cast("int")
    corner = F.element_at(F.element_at("rings", 1), 1)
    child = need.where(F.size("rings") > 0).select("geog_id", F.col("level").alias("own"), "rings", at(corner["lat"]).alias("cy"), at(corner["lng"]).alias("cx"))
    outer = above.where(F.size("rings") > 0).select(F.col("geog_id").alias("parent_id"), F.col("level").alias("at"), F.col("rings").alias("outer"), bounding_box(F.col("rings")).alias("box"))
    spread = lambda low, high: F.explode(F.sequence(at(F.col(low)) - 1, at(F.col(high)) + 1))
    outer = outer.withColumn("cy", spread("box.south", "box.north")).withColumn("cx", spread("box.west", "box.east")).drop("box")
    held = child.join(outer, ["cy", "cx"]).where(F.col("at") > F.col("own")).withColumn("share", covered_share("rings", "outer"))
    found = held.where(F.col("share") >= least_share).select("geog_id", "at", F.lit(1).alias("how"), "parent_id")
    found = found if named is None else found.union(named)
    return found.groupBy("geog_id").agg(F.min(F.struct("at", "how", "parent_id"))["parent_id"].alias("parent_id"))


def best_entry_by_city(entries: DataFrame) -> DataFrame:
    """(CITY, PROV_STATE, GEOGRAPHIES): the entry with most area ids of each city; of equal ones the first by text."""
    best = F.min_by("GEOGRAPHIES", F.struct(-F.size(F.split("GEOGRAPHIES", ",")), "GEOGRAPHIES"))
    return entries.where("GEOGRAPHIES is not null").groupBy("CITY", "PROV_STATE").agg(best.alias("GEOGRAPHIES"))


def guid_covers(guid: str, other: str):
    """Whether every id of the second list is in the first."""
    return F.size(F.array_except(F.split(F.col(other), ","), F.split(F.col(guid), ","))) == 0


def finest_level(guid: str = "guid"):
    return F.array_min(F.transform(F.split(F.col(guid), ","), lambda g: geo_level(g)))
