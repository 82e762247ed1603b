"""The corpus pipeline: filter, deduplicate and pack the documents table.

Each stage applies one operator of parcelflow.llm to all that the stage before it kept. Stages are written to the shared
folder and read again, so a lost executor costs at most the stage that runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm.common import documents, shared_table
from parcelflow.llm.exact_dedup import drop_exact_copies
from parcelflow.llm.langid import keep_identified
from parcelflow.llm.minhash import drop_near_copies
from parcelflow.llm.packing import pack
from parcelflow.llm.suffix_dedup import cut_repeats

#: Near copies share at least so many per cent of their five-word shingles.
NEAR_PERCENT = 80
#: Strings of so many bytes that stand more than once are cut out. A passage of over 50 words has at least 4 bytes a word
#: with its blanks, unless its words are shorter than 3 letters on average, so none is left standing twice.
REPEAT_BYTES = 200


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a language go: null and empty ones, ones without a letter, and ones that the network cannot place.
    Very long texts are read whole; equal texts are judged alike, whatever their ids, null ones too. Other columns stay and
    may have any name. Of an empty table nothing is left."""
    return keep_identified(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the smallest id stays; null and empty texts are equal. Rows are judged by their own id
    and text, so an id that is repeated with other texts keeps those; wholly equal rows all stay, as do copies whose ids
    are all null. Other columns stay and may have any name. Of an empty table nothing is left."""
    return drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies, the one with the smallest id stays. Texts without words, and rows with a null id,
    are in no component and stay. Rows are judged by their own id and text. Very long texts are read whole. Other columns
    stay and may have any name. Of an empty table nothing is left."""
    return drop_near_copies(docs, NEAR_PERCENT)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes in REPEAT_BYTES-byte strings that start more than once are cut out; n_chars follows the text. All rows stay,
    also those of which nothing is left. Null, empty and short texts stay as they are, very long ones are read whole; rows
    of one id are judged apart, and wholly equal rows repeat each other. Other columns stay and may have any name."""
    cut = cut_repeats(docs, length=REPEAT_BYTES)
    if "n_chars" not in cut.columns:
        return cut
    return cut.withColumn("n_chars", F.coalesce(F.length("text").cast(cut.schema["n_chars"].dataType), F.col("n_chars")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining texts in sequences of at most 1024 ids. Null and empty texts are the end id alone; rows with
    null or repeated ids are packed like others; only doc_id and text are read. An empty table has no pieces."""
    return pack(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_copies),
    ("minhash_near_dedup", near_copies),
    ("suffix_dedup", repeated_strings),
    ("best_fit_packing", packed),
]

#: Predictions of a network, set links, byte spans and token ids have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
