"""Spelling variants: words that differ by one letter, found by anagram hashing, and the frequent form that each belongs to.

A word's key is the sum of its letters' fifth powers, whatever their order. Words that differ by one added, removed or
replaced letter have keys that differ by that letter's value or by the difference of two. Instead of adding every such value
to every key, each key is lowered by the value of each of its letters: two keys differ by an exchange if lowered keys
agree, by an addition or removal if a lowered key is a whole one. Keys alone are joined first; a lowered key has one key for
each letter at most. Of the words whose keys so agree, the order of the letters is verified by what is left of a word around
the letter: words that agree in that, place and rest, differ by just this letter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, gives_back, shared_table

#: Words have at least so many code points and occurrences; a form has at least so many times its variant's occurrences.
LENGTH, OCCURRENCES, TIMES = 6, 5, 5
#: One in so many runs loses a code point, as the crc32 of its id and word says.
NOISE = 199
#: Different words, and characters of them, that a task counts before it hands them on.
COUNTED, COUNTED_CHARS = 200_000, 8 << 20
#: Longer words are told by 127-bit digests of what is left of them.
WHOLE = 64
PRIME, BASE = (1 << 127) - 1, 0x5DEECE66D1B54A32D192ED03A6F4B7C1 % ((1 << 127) - 1)
POWER = 5


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, occurrences: int = OCCURRENCES, noise: int = NOISE) -> DataFrame:
    """(word, n): lower-cased runs of A to Z and Latin-1 letters, with at least so many code points, and how often they stand.

    One in `noise` runs of a document loses a code point before it is counted. Null texts have no words; a null id counts as
    the empty string. Every row counts, repeated ones too. Tasks add up what they read before it is shuffled.
    """
    find = re.compile("[a-zÀ-ÿ]+").findall
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: Counter[str] = Counter()
        chars = 0

        def rows() -> Iterator[pa.RecordBatch]:
            words = list(counted)
            for low in range(0, len(words), 20_000):
                some = words[low : low + 20_000]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), pa.array([counted[w] for w in some], pa.int64())], schema=schema)
            counted.clear()

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                before = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                text = text.as_py().encode("utf-8").lower().decode("utf-8")  # bytes change A to Z alone
                for word, n in Counter(find(text)).items():
                    if len(word) < length:
                        continue
                    h = zlib.crc32(word.encode("utf-8"), before)
                    if h % noise == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < length:
                            continue
                    if word not in counted:
                        chars += len(word)
                    counted[word] += n
                if len(counted) >= COUNTED or chars >= COUNTED_CHARS:
                    yield from rows()
                    chars = 0
        yield from rows()

    texts = bounded_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counted = texts.mapInArrow(gives_back(run), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= occurrences)


def _value(letter):
    return F.pow(F.ascii(letter), F.lit(POWER)).cast("long")


def keyed(words: DataFrame) -> DataFrame:
    """words(word, n) with id, in the order of the words, letters and key, the sum of the values of all letters."""
    ordered = words.orderBy("word").withColumn("id", F.monotonically_increasing_id())
    letters = F.split("word", "")
    return ordered.select("id", "word", "n", F.array_distinct(letters).alias("letters"), F.aggregate(letters, F.lit(0).cast("long"), lambda s, x: s + _value(x)).alias("key"))


def _rests(word: str, letter: str) -> Iterator[tuple[int, bytes]]:
    """(place, what is left) for each place of the letter in the word."""
    if len(word) <= WHOLE:
        at = word.find(letter)
        while at >= 0:
            yield at, (word[:at] + word[at + 1 :]).encode("utf-8")
            at = word.find(letter, at + 1)
        return
    after, power = [0] * (len(word) + 1), 1  # of the letters from there on, and the base to their number
    for k in range(len(word) - 1, -1, -1):
        after[k] = (ord(word[k]) * power + after[k + 1]) % PRIME
        power = power * BASE % PRIME
    before, inverse = 0, pow(BASE, -1, PRIME)
    for k, c in enumerate(word):
        power = power * inverse % PRIME
        if c == letter:
            yield k, b"\0" + ((before * power + after[k + 1]) % PRIME).to_bytes(16, "big") + len(word).to_bytes(8, "big")
        before = (before * BASE + ord(c)) % PRIME


def _whole(word: str) -> bytes:
    """What _rests() gives for a word with one more letter, if this is what is left of it."""
    if len(word) < WHOLE:
        return word.encode("utf-8")
    total = 0
    for c in word:
        total = (total * BASE + ord(c)) % PRIME
    return b"\0" + total.to_bytes(16, "big") + (len(word) + 1).to_bytes(8, "big")


def near_places(words: DataFrame) -> DataFrame:
    """(lowered, rest, place, id, n): each word whose key another differs from by a letter, at each place of that letter.

    Rows for removal have place -1, one for each string that is left. Rows of whole words, to which a letter may be added, have
    place -2, and their own key as lowered key.
    """
    lowered = words.select("id", "word", "n", "key", F.explode("letters").alias("letter"))
    lowered = lowered.withColumn("lowered", F.col("key") - _value(F.col("letter")))
    keys = lowered.select("lowered", "letter").union(words.select("key", F.lit(""))).distinct()
    met = keys.groupBy("lowered").agg(F.count(F.lit(1)).alias("keys")).where("keys > 1").select("lowered")
    met = shared_table(met, "met")
    lowered = lowered.join(met, "lowered", "left_semi").select("lowered", "letter", "id", "n", "word")
    whole = words.select(F.col("key").alias("lowered"), F.lit("").alias("letter"), "id", "n", "word").join(met, "lowered", "left_semi")
    schema = pa.schema([("lowered", pa.int64()), ("rest", pa.binary()), ("place", pa.int32()), ("id", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[], [], [], [], []]
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                lowered, letter, word_id, n, word = row
                found = [(-2, _whole(word))] if not letter else []
                if letter:
                    for place, rest in _rests(word, letter):
                        found.append((place, rest))
                        if not place or word[place - 1] != letter:  # of equal letters in a row, each leaves the same
                            found.append((-1, rest))
                for place, rest in found:
                    for col, x in zip(cols, (lowered, rest, place, word_id, n)):
                        col.append(x)
                if len(cols[0]) >= 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)
                    cols = [[], [], [], [], []]
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)

    return bounded_batches(lowered.union(whole)).mapInArrow(gives_back(run), "lowered long, rest binary, place int, id long, n long")


def near_words(words: DataFrame) -> DataFrame:
    """(id, n_near, best): how many words are near a word, and of them the one of largest n, the first in order of ties.

    best is struct(n, order), order being the near word's id with a minus, so that greater means better. Words without
    near words are not here.
    """
    places = shared_table(near_places(words), "places")
    rank = F.struct("n", (-F.col("id")).alias("order"))
    # one word for each letter at most
    alike = places.where("place >= 0").groupBy("lowered", "place", "rest").agg(F.sort_array(F.collect_list(rank), asc=False).alias("all")).where(F.size("all") > 1)
    replaced = alike.select("all", F.explode("all").alias("self")).select(
        (-F.col("self.order")).alias("id"),
        (F.size("all") - 1).cast("long").alias("n_near"),
        F.when(F.col("self.order") == F.col("all")[0]["order"], F.col("all")[1]).otherwise(F.col("all")[0]).alias("best"),
    )
    longer = places.where("place = -1").select("lowered", "rest", F.col("id").alias("long_id"), F.col("n").alias("long_n"))
    whole = places.where("place = -2").select("lowered", "rest", "id", "n")
    added = longer.join(whole, ["lowered", "rest"])
    both = F.explode(F.array(F.struct(F.col("id").alias("id"), F.struct(F.col("long_n").alias("n"), (-F.col("long_id")).alias("order")).alias("best")), F.struct(F.col("long_id").alias("id"), rank.alias("best"))))
    added = added.select(both.alias("x")).select("x.id", F.lit(1).cast("long").alias("n_near"), "x.best")
    return replaced.union(added).groupBy("id").agg(F.sum("n_near").alias("n_near"), F.max("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(id, root) for forms(id, form): the last one that following forms leads to. Each round doubles the steps, and forms
    grow at least TIMES-fold, so there are few."""
    at = shared_table(forms.select("id", F.col("form").alias("root")), "roots")
    while True:
        on = at.select(F.col("id").alias("root"), F.col("root").alias("next"))
        moved = shared_table(at.join(on, "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        at = moved.select("id", "root")
        if moved.where("moved").isEmpty():
            return at


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, occurrences: int = OCCURRENCES, times: int = TIMES, noise: int = NOISE) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    form is the near word of largest n (of ties the first in code-point order), if that n is at least `times` that of the
    word, else null; root is where following forms ends, the word itself if it has none. Words of any length are compared,
    those of more than 64 code points by 127-bit digests. Null and empty texts have no words; repeated rows count each
    time; a table without words gives no rows. Only the two named columns are read, so others may have any name.
    """
    words = shared_table(keyed(shared_table(word_counts(docs, id_col, text_col, length, occurrences, noise), "words")), "keyed")
    near = shared_table(near_words(words), "near")
    near = words.select("id", "word", "n").join(near, "id", "left")
    enough = F.col("best.n") >= times * F.col("n")
    near = shared_table(near.select("id", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(enough, -F.col("best.order")).alias("form"), F.when(enough, F.col("best.n")).alias("form_n")), "forms")
    ends = roots(near.where("form IS NOT NULL").select("id", "form"))
    of = lambda name: words.select(F.col("id").alias(name), F.col("word").alias(f"{name}_word"))
    # most words have no form: only those that have one look names up
    have = near.where("form IS NOT NULL").join(ends, "id").join(of("form"), "form").join(of("root"), "root")
    have = have.select("word", F.col("form_word").alias("form"), F.col("root_word").alias("root"), "n", "n_near", "form_n")
    none = near.where("form IS NULL").select("word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near", "form_n")
    return have.union(none)
