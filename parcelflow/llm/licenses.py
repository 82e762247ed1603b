"""License scans: base phrases, and an exact set-similarity join of text blocks with license templates.

A block is a window of BLOCK words, every BLOCK / 2 words, so any passage of BLOCK / 2 words lies whole in one. A template
matches a block that contains at least THRESHOLD of its distinct words. Words of the templates are ordered by their
frequency in the whole corpus, rarest first. A match must share a word with the template's prefix, its rarest
n - needed + 1 words; the block must have enough template words (length filter); and the places of the first shared word
in both must leave enough words behind it (positional filter). Filters lose nothing, and intersections are then counted.
Templates that differ from others in the one word that decides the label have that word in DECIDING: it must stand in the
block too, so the rest of the words is not enough.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, gives_back, local_table, shared_table
from .textbytes import ALNUM, U64, buffers, key_of, slices, words

BLOCK = 80
THRESHOLD = 0.9

# Phrases that name a license by themselves.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# First sentences and short notices of public licenses.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
# Notices that are told from those above by their deciding words alone.
NOTICES = [
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc-sa", "licensed under cc by nc sa 4 0"),
    ("cc-by-nc-sa", "licensed under a creative commons attribution noncommercial sharealike 4 0 international license"),
    ("cc-by-nc-sa", "licensed under a creative commons attribution non commercial share alike 4 0 international license"),
]

# The phrases (phrase, words not before, words not after) of which a match of the template must hold one.
Deciding = dict[str, list[tuple[str, set[str], set[str]]]]
DECIDING: Deciding = {
    "licensed under cc by 4 0": [("cc by", set(), {"nc", "sa", "nd"})],
    "licensed under cc by nc 4 0": [("nc", set(), {"sa"})],
    "licensed under cc by sa 4 0": [("sa", {"nc"}, set())],
    "licensed under cc by nc sa 4 0": [("nc sa", set(), set())],
    "licensed under a creative commons attribution 4 0 international license": [("attribution", set(), {"noncommercial", "non", "sharealike", "share", "noderivatives", "noderivs", "no"})],
    "licensed under a creative commons attribution noncommercial 4 0 international license": [(x, set(), {"sharealike", "share"}) for x in ("noncommercial", "non commercial")],
    "licensed under a creative commons attribution sharealike 4 0 international license": [(x, {"noncommercial", "commercial"}, set()) for x in ("sharealike", "share alike")],
    "licensed under a creative commons attribution noncommercial sharealike 4 0 international license": [(f"{x} {y}", set(), set()) for x in ("noncommercial", "non commercial") for y in ("sharealike", "share alike")],
    "licensed under a creative commons attribution non commercial share alike 4 0 international license": [("non commercial share alike", set(), set())],
    "licensed under the gnu lesser general public license": [("lesser", set(), set())],
    "licensed under the gnu affero general public license": [("affero", set(), set())],
}


def _word_counts(rows: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """How often each word of a fixed list stands in all texts."""
    keys = np.array([key_of(w) for w in vocabulary], U64)
    order = np.argsort(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(0))
            n = np.zeros(len(keys), np.int64)
            for i, j in slices(offsets):
                w = words(data, offsets[i : j + 1], ALNUM)
                at = np.minimum(np.searchsorted(keys[order], w.key), len(keys) - 1)
                n += np.bincount(order[at[keys[order][at] == w.key]], minlength=len(keys))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(keys))), pa.array(n)], ["word", "n"])

    found = rows.select("text").mapInArrow(gives_back(run), "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()  # a row a word
    n = {r["word"]: r["n"] for r in found}
    return {w: n.get(i, 0) for i, w in enumerate(vocabulary)}


def _scan(rows: DataFrame, ranked: list[str], prefix: set[int], phrases: dict[str, str], block: int, deciding: list[tuple[str, set[str], set[str]]]) -> DataFrame:
    """One row per document: counts of the phrases, and the blocks with a word of any prefix as sorted word ranks. The
    deciding phrases that lie in a block have the ranks behind those of the words."""
    keys = np.array([key_of(w) for w in ranked], U64)
    order = np.argsort(keys)
    in_prefix = np.isin(np.arange(len(ranked)), list(prefix))
    parts = [(label, [key_of(w) for w in phrase.split()]) for phrase, label in phrases.items()]
    marks = [([key_of(w) for w in phrase.split()], *(np.array([key_of(w) for w in sorted(x)], U64) for x in around)) for phrase, *around in deciding]
    half = block // 2

    def stands(w, ks: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Where a phrase begins, and in which document."""
        hit = w.key[: max(0, len(w.key) - len(ks) + 1)] == U64(ks[0])
        for k, x in enumerate(ks[1:], 1):
            hit &= w.key[k : k + len(hit)] == U64(x)
        at = np.flatnonzero(hit)
        doc = np.searchsorted(w.first, at, "right") - 1
        whole = at + len(ks) <= w.first[doc + 1]
        return at[whole], doc[whole]

    def decide(w, ks: list[int], not_before: np.ndarray, not_after: np.ndarray) -> np.ndarray:
        at, doc = stands(w, ks)
        before = (at > w.first[doc]) & np.isin(w.key[np.maximum(at - 1, 0)], not_before)
        after = (at + len(ks) < w.first[doc + 1]) & np.isin(w.key[np.minimum(at + len(ks), len(w.key) - 1)], not_after)
        return at[~before & ~after]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            n_words, n_base, first, last, labels, blocks = [], [], [], [], [], []
            for i, j in slices(offsets):
                w = words(data, offsets[i : j + 1], ALNUM)
                places: dict[int, list[tuple[int, str]]] = {}
                for label, ks in parts:
                    for a, d in zip(*(x.tolist() for x in stands(w, ks))):
                        places.setdefault(d, []).append((a - int(w.first[d]), label))
                near = np.minimum(np.searchsorted(keys[order], w.key), len(keys) - 1)
                known = np.flatnonzero(keys[order][near] == w.key)
                rank = order[near[known]]
                doc = np.searchsorted(w.first, known, "right") - 1
                place = known - w.first[doc]
                found: dict[int, list[list[int]]] = {}
                wanted = {(d, b) for d, p in zip(doc[in_prefix[rank]].tolist(), (place[in_prefix[rank]] // half).tolist()) for b in (p - 1, p) if b >= 0}
                decided = [(len(ks), decide(w, ks, *around)) for ks, *around in marks] if wanted else []
                for d, b in sorted(wanted):
                    low, high = w.first[d] + b * half, min(w.first[d] + b * half + block, w.first[d + 1])
                    a, z = np.searchsorted(known, low), np.searchsorted(known, high)
                    more = [len(keys) + k for k, (size, at) in enumerate(decided) if len(at) and np.searchsorted(at, low) < np.searchsorted(at, high - size, "right")]
                    found.setdefault(d, []).append(np.unique(rank[a:z]).tolist() + more)
                for d in range(j - i):
                    here = places.get(d, [])
                    n_words.append(int(w.first[d + 1] - w.first[d]))
                    n_base.append(len(here))
                    first.append(min(here)[0] if here else None)
                    last.append(max(here)[0] if here else None)
                    labels.append(sorted({x for _, x in here}))
                    blocks.append([list(x) for x in dict.fromkeys(map(tuple, found.get(d, [])))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), *(pa.array(x, pa.int64()) for x in (n_words, n_base, first, last)), pa.array(labels, pa.list_(pa.string())), pa.array(blocks, pa.list_(pa.list_(pa.int32())))],
                ["doc_id", "row", "n_words", "n_base", "first_word", "last_word", "base", "blocks"])

    return rows.mapInArrow(gives_back(run), "doc_id long, row long, n_words long, n_base long, first_word long, last_word long, base array<string>, blocks array<array<int>>")


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD, block: int = BLOCK, phrases: dict[str, str] | None = None, deciding: Deciding | None = None) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Words are lower-cased (A-Z) runs of digits, ASCII letters and non-ASCII characters. The score is the highest share of
    a matching template found in one block, 1 where a phrase stands, else 0. Null and empty texts have no words, labels ''
    and score 0. Ids may be null or repeated; equal rows have equal results. Only doc_id and text are read.
    """
    templates = TEMPLATES + NOTICES if templates is None else templates
    deciding = DECIDING if deciding is None else deciding
    marks = [(t, x) for t in dict.fromkeys(t for _, t in templates) for x in deciding.get(t, [])]
    if any(len(t.split()) > block // 2 for _, t in templates):
        raise ValueError(f"a template has more than {block // 2} words")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("doc_id").cast("long"), text).alias("row"), text.alias("text"))
    vocabulary = sorted({w for _, t in templates for w in t.split()})
    n = _word_counts(rows, vocabulary)
    ranked = sorted(vocabulary, key=lambda w: (n[w], w))
    rank = {w: i for i, w in enumerate(ranked)}
    index, sets = [], []
    for k, (label, t) in enumerate(templates):
        own = sorted({rank[w] for w in t.split()})
        needed = math.ceil(threshold * len(own) - 1e-9)
        sets.append((k, label, own, needed, [len(ranked) + m for m, (of, _) in enumerate(marks) if of == t]))
        index += [(own[p], k, p) for p in range(len(own) - needed + 1)]

    scanned = shared_table(_scan(rows, ranked, {w for w, _, _ in index}, PHRASES if phrases is None else phrases, block, [x for _, x in marks]), "scanned")
    spark = docs.sparkSession
    ints = pa.list_(pa.int32())
    by_word = local_table(spark, index, pa.schema([("word", pa.int32()), ("template", pa.int32()), ("place_t", pa.int32())]))
    of_template = local_table(spark, sets, pa.schema([("template", pa.int32()), ("label", pa.string()), ("own", ints), ("needed", pa.int32()), ("deciding", ints)]))
    blocks = scanned.where(F.size("blocks") > 0).select("doc_id", "row", F.explode("blocks").alias("words"))
    probes = blocks.select("doc_id", "row", "words", F.posexplode("words").alias("place", "word"))
    pairs = probes.join(F.broadcast(by_word), "word").join(F.broadcast(of_template), "template")
    behind = F.least(F.size("own") - F.col("place_t"), F.size("words") - F.col("place"))
    pairs = pairs.where((F.size("words") >= F.col("needed")) & (F.least("place", "place_t") + behind >= F.col("needed")))
    share = F.size(F.array_intersect("words", "own"))
    decided = (F.size("deciding") == 0) | F.arrays_overlap("words", "deciding")
    matched = pairs.where((share >= F.col("needed")) & decided).groupBy("doc_id", "row").agg(F.collect_set("label").alias("more"), F.max(share / F.size("own")).alias("share"))
    matched = matched.toDF("id_of", "row_of", "more", "share")
    out = scanned.drop("blocks").join(matched, (F.col("row") == F.col("row_of")) & F.col("doc_id").eqNullSafe(F.col("id_of")), "left")
    return out.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>")))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).cast("double").alias("score"),
    )
