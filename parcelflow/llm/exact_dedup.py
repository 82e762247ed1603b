"""Exact deduplication with a heavy-hitter split, in DataFrame functions only.

A text's digest is the SHA-256 of its normalised form. Misra-Gries counters (Spark's freqItems, the scheme of Karp,
Schenker and Papadimitriou: 1/support counters a partition, then merged) name the digests that may hold more than
`support` of the rows. Their exact counts are taken, and those that really are that frequent, fewer than 1/support rows
by definition, are broadcast: rows of a frequent digest are resolved where they stand. All other digests have small
groups, which ordinary shuffling counts; rows join their groups back, so no task holds a whole group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_table

SPACE_RUN = r"[\x20\x09-\x0D]+"
#: At most 1/SUPPORT counters are kept and at most 1/SUPPORT digests broadcast, whatever the input's size.
SUPPORT = 1e-3
#: Groups of copies that are broadcast (some 10 MB); beyond, a bitmap of BITMAP_BITS (8 MB) is.
BROADCAST_GROUPS, BITMAP_BITS = 100_000, 1 << 26


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_sha256): digests of the texts with each run of white space as one space; null is empty."""
    text = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), SPACE_RUN, " ")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.sha2(text, 256).alias("text_sha256"))


def _groups(docs: DataFrame, id_col: str, text_col: str, support: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(digests of all rows, frequent groups, other groups of several rows); groups are (text_sha256, keep_id, group_size)."""
    rows = shared_table(digests(docs, id_col, text_col), "digests")
    n = rows.count()
    found = rows.freqItems(["text_sha256"], support).select(F.explode("text_sha256_freqItems").alias("text_sha256")).distinct()
    of_group = (F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    frequent = rows.join(F.broadcast(found), "text_sha256", "left_semi").groupBy("text_sha256").agg(*of_group)
    frequent = shared_table(frequent.where(F.col("group_size") > max(1, int(n * support))), "frequent")
    rest = rows.join(F.broadcast(frequent.select("text_sha256")), "text_sha256", "left_anti")
    return rows, frequent, rest.groupBy("text_sha256").agg(*of_group).where("group_size > 1")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the smallest id stays. Null and empty texts are equal to each other; very long texts are read whole.
    Rows of one id and one text share their flag, rows of one id with different texts are judged apart. A row with a null
    id yields to any row with an id; where a whole group has null ids, all of it stays. Only the two named columns are
    read, so others may have any name. An empty table gives an empty result.
    """
    rows, frequent, groups = _groups(docs, id_col, text_col, support)
    hot = rows.join(F.broadcast(frequent), "text_sha256")
    rest = rows.join(F.broadcast(frequent.select("text_sha256")), "text_sha256", "left_anti").join(groups, "text_sha256", "left")
    alone = F.col("group_size").isNull()
    rest = rest.withColumns({"keep_id": F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")), "group_size": F.coalesce("group_size", F.lit(1).cast("long"))})
    cols = ["doc_id", "keep_id", "group_size", "text_sha256"]
    out = hot.select(cols).union(rest.select(cols))
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def _maybe_grouped(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """rows with maybe: false where text_sha256 is surely in no group, by a broadcast bitmap of hashed digests."""
    place = lambda: F.pmod(F.xxhash64("text_sha256"), F.lit(BITMAP_BITS)) + 1
    at = groups.select(place().alias("place"))
    bitmap = at.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bitmap"))
    rows = rows.withColumn("place", place()).withColumn("bucket", F.bitmap_bucket_number("place"))
    bit = F.bitmap_bit_position("place")
    byte = F.conv(F.hex(F.substr("bitmap", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return rows.join(F.broadcast(bitmap), "bucket", "left").withColumn("maybe", F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))).drop("place", "bucket", "bitmap")


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT, broadcast_groups: int = BROADCAST_GROUPS) -> DataFrame:
    """docs without the rows that exact_dedup drops; same columns, which may have any name; all else as stated there.

    A row is judged by its own id and text, so one id with several texts loses only those that others hold. Frequent texts
    are dropped where they stand. So are others if their groups are few enough to broadcast; else a bitmap lets the rows
    whose text is in no group pass, and only what is left is shuffled.
    """
    _, frequent, groups = _groups(docs, id_col, text_col, support)
    groups = shared_table(groups.select("text_sha256", "keep_id"), "groups")
    whole = F.struct(*(F.col("`" + c.replace("`", "``") + "`") for c in docs.columns)).alias("whole")
    text = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), SPACE_RUN, " ")
    rows = docs.select(whole, F.col(id_col).cast("long").alias("doc_id"), F.sha2(text, 256).alias("text_sha256"))
    frequent = frequent.select("text_sha256", F.lit(True).alias("frequent"), F.col("keep_id").alias("hot_id"))
    rows = rows.join(F.broadcast(frequent), "text_sha256", "left").where(F.col("frequent").isNull() | F.col("doc_id").eqNullSafe(F.col("hot_id")))
    grouped = groups.select("text_sha256", "keep_id", F.lit(True).alias("grouped"))
    stays = F.col("grouped").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))
    if groups.count() <= broadcast_groups:
        return rows.join(F.broadcast(grouped), "text_sha256", "left").where(stays).select("whole.*")
    marked = _maybe_grouped(rows, groups)
    return marked.where("not maybe").select("whole.*").union(marked.where("maybe").join(grouped, "text_sha256", "left").where(stays).select("whole.*"))
