"""Archive files (tab-separated, dated names) and run state (versioned Parquet folders)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.metrics import newest

# The name patterns of archived files.
COUNTS_NAME = r"(?:([a-z]{2})_)?current_listing_counts_(\d{4}-\d{2})_(\d{8})_df\.txt$"
LAST_MONTH_NAME = r"(?:([a-z]{2})_)?last_mth_metrics_results_(\d{8})_df\.txt$"


def _files(spark: SparkSession, paths: str | list[str], schema: str, pattern: str) -> DataFrame:
    """Rows of the files whose names match, with the file name; every column is read as text."""
    text = ", ".join(f"{c.split()[0]} string" for c in schema.split(", "))
    rows = spark.read.schema(text).csv(paths, sep="\t", header=True).select("*", F.col("_metadata.file_name").alias("__file"))
    return rows.where(F.col("__file").rlike(pattern))


def archived_counts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Month-end snapshots: prov (ON without a prefix), year_month, geog_id, propertyType, current_count, newest archive
    of each."""
    rows = _files(spark, paths, "geog_id string, propertyType string, current_count bigint", COUNTS_NAME)
    part = lambda k: F.regexp_extract("__file", COUNTS_NAME, k)
    rows = rows.select(
        F.upper(F.coalesce(F.nullif(part(1), F.lit("")), F.lit("on"))).alias("prov"), F.last_day(F.to_date(F.concat(part(2), F.lit("-01")))).alias("year_month"),
        "geog_id", "propertyType", F.col("current_count").try_cast("bigint").alias("current_count"), part(3).alias("archived"),
    )
    return newest(rows, ["prov", "year_month", "geog_id", "propertyType"], "archived").drop("archived")


def archived_last_month(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Last-month metrics: prov (null without a prefix), month (the one before the archive's), geog_id, propertyType,
    median_price, new_listings_count, newest archive of each. Values that are no numbers become null."""
    rows = _files(spark, paths, "geog_id string, propertyType string, median_price double, new_listings_count bigint", LAST_MONTH_NAME)
    part = lambda k: F.regexp_extract("__file", LAST_MONTH_NAME, k)
    archived = F.to_date(part(2), "yyyyMMdd")
    rows = rows.select(
        F.upper(F.nullif(part(1), F.lit(""))).alias("prov"), F.date_format(F.add_months(F.trunc(archived, "month"), -1), "yyyy-MM").alias("month"),
        "geog_id", "propertyType", F.col("median_price").try_cast("double").alias("median_price"), F.col("new_listings_count").try_cast("double").try_cast("bigint").alias("new_listings_count"), part(2).alias("archived"),
    )
    return newest(rows, ["prov", "month", "geog_id", "propertyType"], "archived").drop("archived")


def write_archive(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, sep="\t", header=True)


def write_archives(df: DataFrame, folder: str, name: Column) -> int:
    """Write each row to the archive file that `name` gives it, one file a name, by one job; how many files were written. An
    archive is a month's figures of all areas, so a file is small whatever the number of listings."""
    spark = df.sparkSession
    parts = f"{folder.rstrip('/')}/_writing-{uuid.uuid4().hex}"
    df.withColumn("__name", name).repartition("__name").write.partitionBy("__name").csv(parts, sep="\t", header=True)
    where = spark._jvm.org.apache.hadoop.fs.Path(parts)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{parts}/__name=*/part-*"))
    for status in found:
        path = status.getPath()
        fs.rename(path, spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{path.getParent().getName().split('=', 1)[1]}"))
    fs.delete(where, True)
    return len(found)


def geo_entries(spark: SparkSession, paths: str | list[str], known: DataFrame | None = None) -> DataFrame:
    """The area-entry table from tab-separated files, added to a known one; the last row of a key stays."""
    from ..operators.merge import keep_last

    new = spark.read.schema("MLS string, CITY string, PROV_STATE string, GEOGRAPHIES string").csv(paths, sep="\t", header=True)
    known = new.limit(0) if known is None else known
    return keep_last(known, new, ["MLS", "CITY", "PROV_STATE"], F.desc("GEOGRAPHIES"))


POINTERS = "name string, version string, expires timestamp_ntz, folder string"
#: Ends the version of an entry that says that a name is deleted.
GONE = "#gone"


class StateStore:
    """Named tables, each written to a new version folder; a small table of pointers says which one holds, and until when.

    Reading and writing a name in one job is safe, as a version is never overwritten. Deleting a name, and going back to an
    earlier version, are entries of their own, so every state of a name can be had again until compact() removes it. All
    access goes through Spark, so the root may be in any store.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _files(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _pointers(self) -> DataFrame:
        empty = self.spark.createDataFrame([], POINTERS)
        try:
            found = self.spark.read.schema(empty.schema).parquet(f"{self.root}/_pointers")
            found.limit(1).count()
            return found
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" in str(e):
                return empty
            raise

    def _point(self, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, POINTERS).coalesce(1).write.mode("append").parquet(f"{self.root}/_pointers")

    @staticmethod
    def _version(now: dt.datetime) -> str:
        # by time, and apart even if two writers meet in a microsecond
        return f"{now.strftime('%Y%m%dT%H%M%S%f')}-{uuid.uuid4().hex[:12]}"

    def set(self, name: str, df: DataFrame, now: dt.datetime, expires: dt.datetime | None = None) -> str:
        version = self._version(now)
        df.write.parquet(f"{self.root}/{name}/{version}")
        self._point([(name, version, expires, version)])
        return version

    def _current(self, names: DataFrame | None = None, at: dt.datetime | None = None) -> DataFrame:
        """The newest pointer of each name, deletions included, or the one that held at a time."""
        rows = self._pointers()
        if at is not None:
            rows = rows.where(F.col("version") < (at + dt.timedelta(microseconds=1)).strftime("%Y%m%dT%H%M%S%f"))
        return rows.groupBy("name").agg(F.max_by(F.struct("version", "expires", "folder"), "version").alias("p")).select("name", "p.*")

    def get(self, name: str, now: dt.datetime, at: dt.datetime | None = None) -> DataFrame | None:
        """The newest version, or the one that held `at` an earlier time; None if there is none, or it was deleted or has
        expired."""
        row = self._current(at=at).where(F.col("name") == name).first()
        if row is None or row["version"].endswith(GONE) or (row["expires"] and row["expires"] <= now):
            return None
        return self.spark.read.parquet(f"{self.root}/{name}/{row['folder'] or row['version']}")

    def names(self) -> list[str]:
        """The names that hold a table."""
        return sorted(r["name"] for r in self._current().where(~F.col("version").endswith(GONE)).collect())

    def delete(self, name: str, now: dt.datetime) -> bool:
        """Delete a name; whether it held a table."""
        if name not in self.names():
            return False
        self._point([(name, self._version(now) + GONE, None, None)])
        return True

    def clear(self, now: dt.datetime, prefix: str = "") -> list[str]:
        """Delete all names, or those that begin with a prefix, by one entry each; returns them."""
        gone = [n for n in self.names() if n.startswith(prefix)]
        if gone:
            self._point([(n, self._version(now) + GONE, None, None) for n in gone])
        return gone

    def restore(self, name: str, at: dt.datetime, now: dt.datetime) -> bool:
        """Let what held at an earlier time hold again, without copying it; False if nothing did."""
        row = self._current(at=at).where(F.col("name") == name).first()
        if row is None or row["version"].endswith(GONE):
            return False
        self._point([(name, self._version(now), row["expires"], row["folder"] or row["version"])])
        return True

    def compact(self, before: dt.datetime) -> int:
        """Remove pointers from before a time that hold no more, and folders that no pointer names; how many folders went.
        Nothing else may write meanwhile."""
        rows = self._pointers()
        last = self._current().select("name", F.col("version").alias("__last"))
        held = rows.join(last, "name").where((F.col("version") == F.col("__last")) & ~F.col("version").endswith(GONE) | (F.col("version") >= before.strftime("%Y%m%dT%H%M%S%f"))).drop("__last").select(rows.columns)
        folder = F.coalesce("folder", "version")
        gone = rows.where(~F.col("version").endswith(GONE)).select("name", folder.alias("folder")).distinct().exceptAll(held.select("name", folder).distinct()).collect()  # a pointer each
        held.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/_pointers.new")
        fs, old = self._files(f"{self.root}/_pointers")
        fs.delete(old, True)
        fs.rename(self._files(f"{self.root}/_pointers.new")[1], old)
        for row in gone:
            fs.delete(self._files(f"{self.root}/{row['name']}/{row['folder']}")[1], True)
        return len(gone)

    def latest_in_month(self, name: str, month: str) -> str | None:
        """The newest version of a 'yyyyMM' month."""
        rows = self._pointers().where((F.col("name") == name) & F.col("version").startswith(month) & ~F.col("version").endswith(GONE)).agg(F.max("version")).first()
        return rows[0]


#: The name below which the table of property types by triples is kept.
MAPPING_NAME = "property_type_mapping"


def save_mapping(store: StateStore, mapping: DataFrame, now: dt.datetime) -> str:
    """The mapping's new version; earlier ones stay, for load_mapping(at=...) and StateStore.restore()."""
    return store.set(MAPPING_NAME, mapping.select("Type", "SubType", "Style", "Count", "Inferred"), now)


def load_mapping(store: StateStore, now: dt.datetime, at: dt.datetime | None = None) -> DataFrame | None:
    return store.get(MAPPING_NAME, now, at)


def _dated(name: str) -> Column:
    return F.col("__file").rlike(name)


def recovered_snapshots(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, set aside) of archived inventory counts: good rows as archived_counts() gives them, and (file, reason, rows) of
    what was left out, and why: a name of another kind, a month that is none, a row without ids, or a count that is no
    number. A bad file or row costs nothing but itself."""
    kinds = "geog_id string, propertyType string, current_count string, __bad string"
    raw = spark.read.schema(kinds).option("columnNameOfCorruptRecord", "__bad").csv(paths, sep="\t", header=True, mode="PERMISSIVE", enforceSchema=True).select("*", F.col("_metadata.file_name").alias("__file"))
    part = lambda k: F.regexp_extract("__file", COUNTS_NAME, k)
    day = F.try_to_timestamp(F.concat(part(2), F.lit("-01")), F.lit("yyyy-MM-dd")).cast("date")
    reason = (
        F.when(~_dated(COUNTS_NAME), "no archive of counts").when(day.isNull(), "no month").when(F.col("__bad").isNotNull(), "columns that do not fit")
        .when(F.col("geog_id").isNull() | F.col("propertyType").isNull(), "no area or type").when(F.col("current_count").try_cast("bigint").isNull(), "no count")
    )
    rows = raw.withColumn("__reason", reason)
    good = rows.where("__reason IS NULL").select(
        F.upper(F.coalesce(F.nullif(part(1), F.lit("")), F.lit("on"))).alias("prov"), F.last_day(day).alias("year_month"), "geog_id", "propertyType",
        F.col("current_count").cast("bigint").alias("current_count"), part(3).alias("archived"),
    )
    aside = rows.where("__reason IS NOT NULL").groupBy(F.col("__file").alias("file"), F.col("__reason").alias("reason")).agg(F.count(F.lit(1)).alias("rows"))
    return newest(good, ["prov", "year_month", "geog_id", "propertyType"], "archived").drop("archived"), aside
