"""The table of property-type mappings: one row per (Type, SubType, Style), kept over runs and never shrinking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.classifier import UNCLEAR, classify
from .areas import small

TRIPLE = ["Type", "SubType", "Style"]


def _named(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.coalesce(F.col(c), F.lit("N/A")) for c in TRIPLE})


def combinations(ims: DataFrame) -> DataFrame:
    """Distinct triples with how often they occur; a missing part is 'N/A'."""
    return _named(ims).groupBy(*TRIPLE).agg(F.count(F.lit(1)).alias("Count"))


def combination_key() -> F.Column:
    return F.concat_ws(" | ", *TRIPLE)


def inferred() -> F.Column:
    """The classifier on a triple, 'N/A' being no value."""
    return classify(*(F.nullif(F.col(c), F.lit("N/A")) for c in TRIPLE))


def merge_mapping(found: DataFrame, cached: DataFrame | None = None) -> DataFrame:
    """The new mapping: counts of today, cached categories where known, the classifier's elsewhere. Triples that only
    the cache has stay, with count 0. Only new triples are classified."""
    if cached is None:
        return found.withColumn("Inferred", inferred())
    c = cached.select(*TRIPLE, F.col("Inferred").alias("__known"))
    both = found.join(c, TRIPLE, "full").withColumn("Count", F.coalesce("Count", F.lit(0)))
    return both.select(*TRIPLE, "Count", F.coalesce("__known", inferred()).alias("Inferred"))


def lookup(listings: DataFrame, mapping: DataFrame) -> DataFrame:
    """listings with propertyType from the mapping; null where the triple is unknown."""
    m = small(mapping.select(*(F.col(c).alias(f"__{c}") for c in TRIPLE), F.col("Inferred").alias("propertyType")))
    on = [F.coalesce(F.col(c), F.lit("N/A")) == F.col(f"__{c}") for c in TRIPLE]
    return listings.join(m, on, "left").drop(*(f"__{c}" for c in TRIPLE))


def duplex_override(listings: DataFrame) -> DataFrame:
    """In Alberta a duplex is semi-detached."""
    duplex = (F.col("Province") == "AB") & F.col("SubType").isin("Duplex", "Full Duplex")
    return listings.withColumn("propertyType", F.when(duplex, "SEMI-DETACHED").otherwise(F.col("propertyType")))


def refresh_unclear(mapping: DataFrame, strict: bool = True) -> DataFrame:
    """The mapping with UNCLEAR rows classified again. If the classifier would change any other row, nothing is: that is
    an error, or with strict=False the old mapping."""
    again = mapping.withColumn("__new", inferred())
    changed = again.where((F.col("Inferred") != UNCLEAR) & (F.col("Inferred") != F.col("__new")))
    if changed.take(1):
        if strict:
            raise RuntimeError(f"{changed.count()} mappings that were clear would change")
        return mapping
    return again.withColumn("Inferred", F.when(F.col("Inferred") == UNCLEAR, F.col("__new")).otherwise(F.col("Inferred"))).drop("__new")


def apply_corrections(mapping: DataFrame, corrections: DataFrame) -> DataFrame:
    """The mapping with corrected categories: the classifier must give what corrections(Type, SubType, Style, Expected)
    say, and must leave all other clear rows as they are."""
    c = corrections.select(*TRIPLE, F.col("Expected").alias("__expected"))
    again = mapping.join(small(c), TRIPLE, "left").withColumn("__new", inferred())
    wrong = again.where((F.col("__expected").isNotNull() & (F.col("__new") != F.col("__expected"))) | (F.col("__expected").isNull() & (F.col("Inferred") != UNCLEAR) & (F.col("__new") != F.col("Inferred"))))
    if wrong.take(1):
        raise RuntimeError(f"{wrong.count()} mappings disagree with the classifier")
    return again.withColumn("Inferred", F.coalesce("__expected", "Inferred")).drop("__expected", "__new")


def unclear_rows(old: DataFrame | None, mapping: DataFrame) -> DataFrame:
    """The unclear triples of both, each with its highest count."""
    rows = mapping.where(F.col("Inferred") == UNCLEAR).select(*TRIPLE, "Count")
    rows = rows if old is None else rows.unionByName(old.select(*TRIPLE, "Count"))
    return rows.groupBy(*TRIPLE).agg(F.max("Count").alias("Count"))
