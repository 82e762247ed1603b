"""Property types of (Type, SubType, Style) triples: an ordered table of rules, then keyword scores, as one expression.

A rule is a list of conditions that must all hold; a condition is (fields, how, words): one of the fields equals, or
contains, one of the words. Fields: t type, s subtype, y style, all the three joined by blanks.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

UNCLEAR = "UNCLEAR"
IS, HAS, LACKS = "is", "has", "lacks"
#: Categories in the order that decides between equal scores.
CATEGORIES = ["CONDO", "SEMI-DETACHED", "TOWNHOUSE", "DETACHED", "MOBILE_MINI", "LAND_VACANT", "COMMERCIAL", "OTHER"]

# The first rules, in order. Which words mark a type is domain knowledge that results depend on.
FIRST_RULES = [
    ("COMMERCIAL", [("t", IS, ["16-unit", "5-8 units", "9-12 units", "over 12 units"])]),
    ("MOBILE_MINI", [("t", HAS, ["mobile home"])]),
    ("MOBILE_MINI", [("t", IS, ["mobile"])]),
    ("MOBILE_MINI", [("y", HAS, ["mobile", "mobile home", "manufactured", "double wide", "single wide", "park model", "mini home"])]),
    ("OTHER", [("all", HAS, ["triplex", "fourplex", "4 plex", "multiplex", "4plex", "5plex", "6plex", "7plex", "8plex", "duplex", "dixplex", "huitplex", "cinqplex"])]),
    ("OTHER", [("all", HAS, ["12plex", "uplex", " plex", "iplex", "-plex", "doublex", "quintplex", "quadrex", "fiveplex", "sixplex", "sevenplex", "eightplex", "tenplex"])]),
    ("OTHER", [("t", HAS, ["multifamily", "multi-family", "multi-residential"])]),
    ("LAND_VACANT", [("t", HAS, ["vacant land", "land only", "lots/acreage"])]),
    ("COMMERCIAL", [("ys", HAS, ["live/work", "warehouse", "industrial", "retail", "office"])]),
    ("TOWNHOUSE", [("t", HAS, ["twnhouse", "townhouse", "row house", "row unit", "attached"])]),
    ("CONDO", [("t", HAS, ["apartment", "condo", "co-op", "cooperative"])]),
    ("OTHER", [("t", HAS, ["modular", "parking space", "locker", "other"])]),
    ("OTHER", [("t", HAS, ["multi family"])]),
    ("COMMERCIAL", [("t", HAS, ["commercial", "office"])]),
    ("SEMI-DETACHED", [("y", HAS, ["semi"])]),
    ("TOWNHOUSE", [("y", HAS, ["attached", "townhouse", "row house", "row unit", "stacked"])]),
    ("LAND_VACANT", [("y", HAS, ["vacant", "land"])]),
    ("CONDO", [("y", HAS, ["apartment", "condo"])]),
    ("OTHER", [("y", HAS, ["modular", "manufactured", "floating"])]),
    ("MOBILE_MINI", [("s", HAS, ["mobile"])]),
    ("SEMI-DETACHED", [("s", HAS, ["semi"])]),
    ("TOWNHOUSE", [("s", HAS, ["townhouse", "attached", "row house", "row unit"])]),
    ("DETACHED", [("s", HAS, ["detached"])]),
    ("CONDO", [("s", HAS, ["condo", "apartment"])]),
    ("OTHER", [("s", HAS, ["modular", "manufactured", "other"])]),
]

# Words that count for a category: 2 in the type, 1.5 in the subtype, 1 in the style.
KEYWORDS = {
    "CONDO": ["condo", "apartment", "unit", "co-op", "cooperative", "comm element", "bachelor", "studio", "multi-level", "leasehold", "stacked townhse", "apt"],
    "SEMI-DETACHED": ["semi", "half duplex", "1/2 duplex", "semi detached", "semi-detached", "over-under", "side by side"],
    "TOWNHOUSE": ["townhouse", "row", "row/townhouse", "town house", "condo townhouse", "link"],
    "DETACHED": ["detached", "single family", "house", "bungalow", "bungaloft", "cottage", "2-storey", "storey", "rancher", "backsplit", "sidesplit"],
    "MOBILE_MINI": ["mobile", "mini", "mobile / mini"],
    "LAND_VACANT": ["land only", "vacant land"],
    "COMMERCIAL": ["store", "office", "commercial", "store w/apt/office", "5-8 units", "9-12 units", "over 12 units"],
    "OTHER": ["locker", "parking space", "triplex", "fourplex", "4 plex", "multiplex", "duplex", "full duplex", "modular home", "manufactured", "modular"],
}
FIELD_WEIGHTS = {"t": 2.0, "s": 1.5, "y": 1.0}
#: Each adds two to CONDO, anywhere.
LARGE_BUILDINGS = ["multifamily", "multi-family", "multi-residential", "multi-6-9 unit"]

_TOWN = ["residential", "other", "split-level"]
_HOUSE = ["residential", "other", "resort property", "pre-fab modular", "split-level", "maison de chambre"]

# Rules for triples without any score, in order.
LAST_RULES = [
    (UNCLEAR, [("s", HAS, ["see remarks"])]),
    ("LAND_VACANT", [("t", IS, ["lots/acreage"])]),
    ("LAND_VACANT", [("s", IS, ["vacant lot/land", "land"])]),
    ("OTHER", [("t", IS, ["modular home"])]),
    ("TOWNHOUSE", [("t", IS, ["multi family"]), ("s", IS, ["n/r"]), ("y", IS, ["attached, multi level"])]),
    ("TOWNHOUSE", [("t", IS, _TOWN), ("sy", HAS, ["attached"])]),
    ("TOWNHOUSE", [("t", IS, _TOWN), ("y", HAS, ["townhome", "end unit"])]),
    ("TOWNHOUSE", [("t", IS, ["residential"]), ("s", IS, ["one level", "other"]), ("y", IS, ["stacked"])]),
    ("TOWNHOUSE", [("t", IS, ["residential"]), ("s", IS, ["recreational"]), ("y", IS, ["multi/split"])]),
    ("DETACHED", [("t", IS, ["maison de chambre"])]),
    ("DETACHED", [("t", IS, _HOUSE), ("ts", HAS, ["carriage"])]),
    (UNCLEAR, [("t", IS, ["residential"]), ("s", IS, ["recreational"]), ("y", IS, ["park model", "float home", "hunt camp", "bi-level"])]),
    ("DETACHED", [("t", IS, ["residential"]), ("s", IS, ["recreational", "modular home"])]),
    ("DETACHED", [("t", IS, _HOUSE), ("s", IS, ["residential"])]),
    ("DETACHED", [("t", IS, _HOUSE), ("all", HAS, ["ranch", "raised ranch", "back split", "side split", "split level", "split-level", "split entry", "bi-level", "blevl", "bng", "bngr", "bung", "bungr", "a-frame", "a frame", "chalet", "cabin", "camp", "log home", "log", "villa", "patio home", "acreage", "summer home", "west coast", "westcoast", "contemporary", "cape cod", "cbovr", "character", "main lev ent", "grd lev ent"])]),
    ("DETACHED", [("t", IS, ["residential", "resort property", "pre-fab modular", "split-level"]), ("y", HAS, ["sp2s", "sp3l", "sp4l", "spml", "split", "split 3 level", "split 4 level", "two", "two level", "one level", "multi level", "1+1/2", "1+3/4", "2+1/2", "loft", "arts and crafts", "arts  and  crafts"])]),
    ("OTHER", [("tsy", HAS, ["plex", "logements", "logis", "dwellings", "housing", "rooms", "appartments", "appts", "commerces", "multi family", "multi-family", "multi-plex", "multiplez", "quadrex", "farm", "farm/ranch", "hobby farm", "float home", "floating home", "commercail", "commercial", "mixed use", "timeshare", "timeshares", "tourisme residence", "tourism residence", "seniors residence", "shared owner", "prk. stall", "prk stall", "b and b", "b  and  b", "alberta"])]),
    ("OTHER", [("t", HAS, list("0123456789"))]),
    ("OTHER", [("t", IS, ["six"])]),
    ("OTHER", [("t", IS, ["residential", "other"]), ("s", IS, ["n/r"]), ("y", IS, ["n/r", "other", "0"])]),
    ("OTHER", [("t", IS, ["other"]), ("s", IS, ["n/r"]), ("y", IS, ["one level", "two level"])]),
    ("OTHER", [("t", IS, ["residential"]), ("s", IS, ["other"]), ("y", IS, ["other", "n/r"])]),
    ("OTHER", [("t", IS, ["n/r"])]),
]


def _condition(fields: dict[str, Column], names: str, how: str, words: list[str]) -> Column:
    cols = [fields["all"]] if names == "all" else [fields[n] for n in names]
    any_word = "|".join(re.escape(w) for w in words)
    found = reduce(Column.__or__, (c.isin(words) if how == IS else c.rlike(any_word) for c in cols))
    return ~found if how == LACKS else found


def _chain(fields: dict[str, Column], rules: list, otherwise: Column) -> Column:
    out = None
    for category, conditions in rules:
        test = reduce(Column.__and__, (_condition(fields, *c) for c in conditions))
        out = F.when(test, category) if out is None else out.when(test, category)
    return out.otherwise(otherwise)


def _fields(type_: Column, subtype: Column, style: Column, strip: bool) -> dict[str, Column]:
    t, s, y = ((F.trim(c) if strip else c) for c in (F.lower(F.coalesce(x.cast("string"), F.lit(""))) for x in (type_, subtype, style)))
    return {"t": t, "s": s, "y": y, "all": F.concat_ws(" ", t, s, y)}


def classify(type_: Column, subtype: Column, style: Column) -> Column:
    """The category of a triple; a null part counts as empty. Meant for distinct triples, which are few."""
    f = _fields(type_, subtype, style, strip=False)
    last = _chain(_fields(type_, subtype, style, strip=True), LAST_RULES, F.lit(UNCLEAR))
    hits = lambda c, words: F.size(F.filter(F.array(*map(F.lit, words)), lambda w: F.contains(c, w)))
    scores = {c: reduce(Column.__add__, (hits(f[n], words) * weight for n, weight in FIELD_WEIGHTS.items())) for c, words in KEYWORDS.items()}
    large = hits(f["all"], LARGE_BUILDINGS) * 2.0
    # a large building alone makes CONDO the last of equal scores
    order = [F.struct(F.when((f["t"] == "residential") & F.lit(c == "COMMERCIAL"), 0.0).otherwise(scores[c] + (large if c == "CONDO" else 0.0)).cast("double").alias("score"), F.when(F.lit(c == "CONDO") & (scores["CONDO"] == 0), -99).otherwise(-i).alias("rank"), F.lit(c).alias("category")) for i, c in enumerate(CATEGORIES)]
    best = F.array_max(F.array(*order))
    end_unit = F.contains(f["all"], F.lit("end unit")) & f["s"].isin("other", "n/r") & _condition(f, "all", LACKS, ["apartment", "condo", "townhouse", "row"])
    scored = F.when(end_unit | (best["score"] <= 0), last).otherwise(best["category"])
    return _chain(f, FIRST_RULES, scored)
