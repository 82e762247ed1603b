"""Explicit schemas of the tables; nothing is inferred."""

SOLD_LISTING = (
    "_id string, mls string, lastTransition timestamp_ntz, transitions string, lastUpdate string, listingType string, searchCategoryType int, "
    "listingStatus string, beds string, bedsInt int, baths string, bathsInt int, price double, soldPrice double, daysOnMarket double, lat double, "
    "lng double, city string, neighbourhood string, provState string, guid string, propertyType string, computed_guid string"
)
ACTIVE_LISTING = (
    "_id string, listingType string, searchCategoryType int, guid string, beds string, bedsInt int, baths string, bathsInt int, lat double, "
    "lng double, price double, addedOn timestamp_ntz, lastUpdate timestamp_ntz, listingStatus string, propertyType string"
)
TRACKED_LISTING = ACTIVE_LISTING.replace("listingStatus string, ", "") + ", is_deleted boolean"
DELETED_LISTING = "timestamp timestamp_ntz, listingId string"
IMS_RAW = (
    "WrittenDate timestamp_ntz, SoldPrice double, ListPrice double, Latitude double, Longitude double, DaysOnMarket int, MLSNumber string, MLSID int, "
    "City string, Community string, Province string, Bedrooms int, Baths int, Type string, SubType string, Style string"
)
MAPPING = "Type string, SubType string, Style string, Count bigint, Inferred string"
GEO = (
    "geog_id string, name string, level int, province string, lat double, lng double, city string, parent_id string, "
    "rings array<array<struct<lat:double,lng:double>>>"
)
GEO_OVERLAP = "geog_id string, other_id string"
GEO_ENTRY = "MLS string, CITY string, PROV_STATE string, GEOGRAPHIES string"
SERIES = "geog_id string, propertyType string, month string, metric string, value double"
SNAPSHOT = "year_month date, geog_id string, propertyType string, current_count bigint"
LAST_MONTH = "geog_id string, propertyType string, median_price double, new_listings_count bigint"
COMPARABLES = "listing_id string, comps array<struct<sold_id:string,distance_km:double>>"

#: Series of a market-trends document; each is an array of (month, value), ascending.
DOUBLE_SERIES = ["median_sold_price", "median_dom", "over_ask_percentage", "below_ask_percentage", "absorption_rate", "months_of_inventory", "last_mth_median_asking_price"]
LONG_SERIES = ["sold_listing_count", "last_mth_new_listings", "mth_end_snapshot_listing_count"]
MARKET_TRENDS = (
    "geog_id string, propertyType string, geo_level int, metrics struct<"
    + ",".join([f"{m}:array<struct<month:string,value:double>>" for m in DOUBLE_SERIES] + [f"{m}:array<struct<month:string,value:bigint>>" for m in LONG_SERIES])
    + ",current_metrics:struct<median_asking_price:double,new_listings:bigint>>, last_updated timestamp_ntz"
)

# The property types, provinces and area levels of the data model.
STANDARD_TYPES = ["CONDO", "SEMI-DETACHED", "TOWNHOUSE", "DETACHED"]
ALL_TYPES = "ALL"
PROVINCES = ["AB", "BC", "MB", "NB", "NL", "NS", "NT", "NU", "ON", "PE", "QC", "SK", "YT"]
GEO_LEVELS = [10, 20, 30, 35, 40]
MAY_BE_EMPTY = ["NT", "NU", "YT"]
