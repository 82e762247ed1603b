"""Best-fit packing planned on the histogram of piece lengths.

Only the histogram (one row a length, so at most `size` rows) reaches the driver. Best fit decreasing runs over its
counts: whole groups of equal sequences take whole groups of equal pieces. The plan is a table of runs; pieces take
their planned places by a join on the rank within their length. Ranks are counted in salted groups, so a length that
holds a third of all pieces is dealt over many tasks.
"""

from __future__ import annotations

import functools
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import gives_back, id_text, local_table, shared_table

SIZE = 1024
END_ID = 2
#: Pieces of one length that a single task ranks.
RANKED_TOGETHER = 1000


@functools.cache
def encoder(path: str):
    """The rank file's byte-level BPE: the vocabulary and merges of byte_bpe_50k.json, and the same ids, several times
    as fast; tests hold the two against each other."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def piece_bounds(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids; only the first can be shorter than size."""
    first = n % size or size
    return [(0, min(first, n))] + [(s, size) for s in range(first, n, size)]


def cut_pieces(docs: DataFrame, vocabulary: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode_ordinary
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array([*encode(text.as_py()), end_id], "<u4")
                for k, (start, length) in enumerate(piece_bounds(len(ids), size)):
                    for col, x in zip(rows, (doc, k, start, length, zlib.crc32(ids[start : start + length].tobytes()))):
                        col.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, schema.types)], schema=schema)

    return id_text(docs).mapInArrow(gives_back(cut), "doc_id long, piece int, start long, length long, ids_crc32 long")


def plan_best_fit(histogram: dict[int, int], size: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit decreasing over counts: (length, first rank, last rank + 1, first sequence, pieces a sequence, offset).

    Piece of rank r in a run goes to sequence first + (r - first rank) // pieces a sequence, after
    (r - first rank) % pieces a sequence others of its length. The runs depend on the histogram's shape, not on the
    number of pieces.
    """
    room: dict[int, list[tuple[int, int]]] = {}  # free ids in a sequence -> (first sequence, how many)
    spaces: list[int] = []
    runs, opened = [], 0

    def add(space: int, first: int, n: int) -> None:
        if space and n:
            if space not in room:
                room[space] = []
                heapq.heappush(spaces, space)
            room[space].append((first, n))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        fits = sorted(s for s in room if s >= length)
        while left:
            while fits and not room.get(fits[0]):
                room.pop(fits.pop(0), None)
            if fits:
                space = fits[0]
                first, n = room[space].pop()
            else:
                space, first, n = size, opened, -(-left // (size // length))
                opened += n
            each = space // length
            used = min(n, left // each)
            if used:
                runs.append((length, rank, rank + used * each, first, each, size - space))
                add(space - each * length, first, used)
                rank, left = rank + used * each, left - used * each
            if left and used < n:  # the last one takes fewer
                runs.append((length, rank, rank + left, first + used, left, size - space))
                add(space - left * length, first + used, 1)
                used, left = used + 1, 0
            add(space, first + used, n - used)
            fits = sorted(s for s in room if s >= length and room[s]) if not left else [s for s in fits if room.get(s)]
    return runs


def ranked(pieces: DataFrame, histogram: dict[int, int], together: int = RANKED_TOGETHER) -> DataFrame:
    """pieces with rank: 0, 1, ... within each length, counted in salted groups of about `together` rows."""
    spark = pieces.sparkSession
    salts = local_table(spark, [(k, -(-n // together)) for k, n in histogram.items()], pa.schema([("length", pa.int64()), ("salts", pa.int64())]))
    salted = pieces.join(F.broadcast(salts), "length").withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.col("salts")))
    before = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = before.withColumn("before", F.sum("n").over(W.partitionBy("length").orderBy("salt")) - F.col("n")).drop("n")
    local = F.row_number().over(W.partitionBy("length", "salt").orderBy("doc_id", "piece")) - 1
    return salted.withColumn("local", local).join(before, ["length", "salt"]).withColumn("rank", F.col("local") + F.col("before")).drop("salt", "salts", "local", "before")


def pack(docs: DataFrame, vocabulary: str | None = None, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are the end id alone. Rows with a null or repeated id are packed like others. Columns other
    than doc_id and text are not read. An empty table gives an empty result. Of equal pieces, ids and piece numbers
    decide the place; of wholly equal rows, either may take either place.
    """
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    spark = docs.sparkSession
    pieces = shared_table(cut_pieces(docs, vocabulary, size, end_id), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `size` rows
    runs = plan_best_fit(histogram, size)
    plan = local_table(spark, runs, pa.schema([(name, pa.int64()) for name in ("length", "low", "high", "first", "each", "place")]))
    at = F.col("rank") - F.col("low")
    out = ranked(pieces, histogram).join(F.broadcast(plan), "length").where((F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    return out.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first") + F.floor(at / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("place") + at % F.col("each") * F.col("length")).cast("long").alias("offset"),
    )
