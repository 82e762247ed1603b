"""What several filters of a corpus have to do with each other, in every order in which they can be applied.

Each document gets the letters of the filters that it fails; everything else is counted from how many documents of a part
have which letters, so the corpus is read once, whatever the number of orders. One filter is for exact copies. They are
found by partition refinement: rows are split by their texts' length in code points, then by hashes of successive blocks;
what is alone in its class drops out of each round, and whole texts are compared at the end, in the classes that are left.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, maybe_among, shared_table

SPACE_RUN = r"[\x20\x09-\x0D]+"
#: Where the blocks end that are hashed one after the other; the last goes to the end of the text.
BLOCK_ENDS = (256, 4096)
#: Classes with more than this share of all rows are broadcast: fewer than 1/SUPPORT, by definition.
SUPPORT = 1e-3


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE_RUN), lambda w: w != "")


def few_words(text: Column) -> Column:
    return F.size(_words(text)) < 100


def few_distinct_words(text: Column) -> Column:
    words = _words(text)
    return 100 * F.size(F.array_distinct(words)) < 80 * F.size(words)


def many_capitals(text: Column) -> Column:
    return 100 * (F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))) > 10 * F.length(text)


def odd_signs(text: Column) -> Column:
    return text.rlike("[#$%&*|]")


#: A letter for each filter, and whether a text (null: empty) fails it.
FILTERS: dict[str, Callable[[Column], Column]] = {"A": few_words, "B": few_distinct_words, "C": many_capitals, "D": odd_signs}
COPIES = "E"


def _blocks(text: Column) -> list[Column]:
    starts = (0, *BLOCK_ENDS)
    return [F.xxhash64(F.substring(text, a + 1, b - a)) for a, b in zip(starts, (*BLOCK_ENDS, 1 << 30))]


def _class(text: Column, blocks: int) -> Column:
    """The class of a text after the length and so many blocks."""
    return F.xxhash64(F.length(text), *_blocks(text)[:blocks])


def refine(rows: DataFrame, hashes: list[str], n_rows: int) -> DataFrame:
    """(doc_id, class) of the rows that are not alone in their class after the length and all block hashes.

    rows: doc_id, n_chars and the hashes. A round groups what the one before left, by all it knows of a text. Rows of large
    classes stay where they are, the others are joined with their class's size. Classes are told by 64 bits, so different
    texts may share one; comparing them is left to the caller.
    """
    alive = rows.select("doc_id", F.xxhash64("n_chars").alias("class"), "n_chars", *hashes)
    for k in range(len(hashes) + 1):
        alive = alive.withColumn("class", F.xxhash64("n_chars", *hashes[:k]))
        several = shared_table(alive.groupBy("class").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), f"several{k}")
        large = F.col("n") > max(1, int(n_rows * SUPPORT))
        hot = F.broadcast(several.where(large).select("class"))
        kept = alive.join(hot, "class", "left_semi").unionByName(alive.join(hot, "class", "left_anti").join(several.where(~large), "class", "left_semi"))
        alive = shared_table(kept.select("doc_id", "class", "n_chars", *hashes), f"alive{k}")
    return alive.select("doc_id", "class")


def first_ids(docs: DataFrame, alive: DataFrame, n_blocks: int) -> tuple[DataFrame, DataFrame]:
    """The smallest id of each text that stands more than once: (class, first, n) of the classes with one text, and (class,
    text, first, n) of those with several, which share a class by chance.

    docs: doc_id, text. Only texts whose class may be in alive are shuffled, and of equal ones only one a task.
    """
    classes = shared_table(alive.select("class").distinct(), "classes")
    found = maybe_among(docs.select("doc_id", "text", _class(F.col("text"), n_blocks).alias("class")), "class", classes)
    found = found.groupBy("class", "text").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    texts = shared_table(found.join(classes, "class", "left_semi"), "texts")
    mixed = texts.groupBy("class").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("class")
    mixed = shared_table(mixed, "mixed")
    return texts.join(mixed, "class", "left_anti").select("class", "first", "n"), texts.join(mixed, "class", "left_semi").where("n > 1")


def _mark(rows: DataFrame, known: DataFrame, keys: list[str], n_rows: int) -> DataFrame:
    """rows with first, the smallest id of their text, from known(*keys, first, n); null where it is not known."""
    frequent = shared_table(known.where(F.col("n") > max(1, int(n_rows * SUPPORT))).select(*keys, "first"), "frequent")
    hot = rows.join(F.broadcast(frequent), keys)
    rest = rows.join(F.broadcast(frequent.select(keys)), keys, "left_anti").join(known.select(*keys, "first"), keys, "left")
    return hot.select(*rows.columns, "first").unionByName(rest.select(*rows.columns, "first"))


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", filters: dict[str, Callable[[Column], Column]] = FILTERS, copies: str = COPIES) -> DataFrame:
    """doc_id, part, fails of each row of docs: the letters of the filters that it fails, in alphabetical order.

    A null text is empty, a null part the empty string. Copies fail if a smaller id has the same text, whatever other
    filters do; null ids are not smaller than any and have none smaller than them, and rows of one id do not fail for each
    other. Very long texts are read whole. Only the named columns are read, so others may have any name. An empty table
    gives an empty one.
    """
    text, parts = F.col("text"), F.coalesce(F.col(part_col).cast("string"), F.lit(""))
    docs = bounded_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), parts.alias("part"))
    own = F.concat(*(F.when(fails(text), F.lit(letter)).otherwise(F.lit("")) for letter, fails in sorted(filters.items())))
    hashes = [f"h{k}" for k in range(len(BLOCK_ENDS) + 1)]
    rows = docs.select("doc_id", "part", own.alias("fails"), F.length("text").alias("n_chars"), *(h.alias(name) for h, name in zip(_blocks(text), hashes)))
    rows = shared_table(rows, "signatures")
    n_rows = rows.count()
    alike, mixed = first_ids(docs, refine(rows, hashes, n_rows), len(hashes))
    rows = rows.select("doc_id", "part", "fails", F.xxhash64("n_chars", *hashes).alias("class"))
    several = shared_table(mixed, "mixed_texts")
    if several.isEmpty():
        marked = _mark(rows, alike, ["class"], n_rows)
    else:  # texts that share a class by chance are looked up by themselves
        chance = several.select("class").distinct()
        plain = _mark(rows.join(chance, "class", "left_anti"), alike, ["class"], n_rows)
        again = docs.withColumns({"fails": own, "class": _class(text, len(hashes))}).join(chance, "class", "left_semi")
        marked = plain.unionByName(again.join(several.select("class", "text", "first"), ["class", "text"], "left").select(plain.columns))
    copy = F.when(F.col("doc_id") > F.col("first"), F.lit(copies)).otherwise(F.lit(""))
    return marked.select("doc_id", "part", F.array_join(F.array_sort(F.split(F.concat("fails", copy), "")), "").alias("fails"))


def mask_counts(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """part, fails, n, good, toxic: documents of each part that fail just these filters, and how many of them the labels call
    good (quality 1) and toxic (toxic 1). Repeated labels of an id count as one; nulls are not 1."""
    told = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    # rows without an id have no label, and would all meet in one task
    named = failed.where("doc_id IS NOT NULL").join(told, "doc_id", "left").select("part", "fails", "good", "toxic")
    rows = named.union(failed.where("doc_id IS NULL").select("part", "fails", F.lit(None).cast("boolean"), F.lit(None).cast("boolean")))
    one = F.count(F.lit(1))
    return rows.groupBy("part", "fails").agg(one.alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))


def interactions(masks: DataFrame, letters: str) -> DataFrame:
    """One row per part, order of the letters and step: what the filter of that step finds after those before it.

    kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley as in audit_filters(). The work follows the
    number of parts and orders, not of documents.
    """
    orders = ["".join(order) for order in itertools.permutations(letters)]
    rows = masks.select("*", F.explode(F.array(*map(F.lit, orders))).alias("filter_order"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step"))
    rows = rows.withColumns({"letter": F.expr("substring(filter_order, step, 1)"), "before": F.expr("substring(filter_order, 1, step - 1)")})
    now, earlier = F.contains("fails", "letter"), F.expr("translate(before, fails, '') <> before")
    total = lambda x, when: F.sum(F.when(when, F.col(x)).otherwise(F.lit(0).cast("long")))
    # of the orders, the letter comes first of the k that a document fails in one of k
    share = F.when(now, F.col("n") * F.expr(f"{math.factorial(len(letters))} div length(fails)")).otherwise(F.lit(0).cast("long"))
    return rows.groupBy("part", "filter_order", "step").agg(
        total("n", ~now & ~earlier).alias("kept"),
        total("n", now & ~earlier).alias("removed"),
        total("n", now & earlier).alias("redundant"),
        total("n", F.col("fails") == F.col("letter")).alias("unique_fails"),
        total("good", now & ~earlier).alias("good_lost"),
        total("toxic", now & ~earlier).alias("toxic_lost"),
        F.sum(share).alias("shapley"),
    )


def audit_filters(docs: DataFrame, labels: DataFrame, filters: dict[str, Callable[[Column], Column]] = FILTERS, copies: str = COPIES) -> DataFrame:
    """One row per part (lang; null: empty string), filter_order and step, zeros included.

    Of the part's documents: kept after this step, removed by its filter, redundant (failing it, but removed before),
    unique_fails (failing it alone of all filters), good_lost and toxic_lost (removed here, by their labels), shapley (what
    this filter removes, summed over all orders). Rows with null or repeated ids are documents of their own; for all else
    see failures() and mask_counts(). A table without documents has no parts and gives no rows.
    """
    masks = shared_table(mask_counts(failures(docs, filters=filters, copies=copies), labels), "masks")
    return interactions(masks, "".join(sorted([*filters, copies])))
