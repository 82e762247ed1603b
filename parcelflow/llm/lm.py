"""Language-model scores by deleted interpolation of word n-grams.

P(w | u) mixes the maximum-likelihood bigram c(u w) / c(u), the unigram c(w) / N and an add-one unigram. The mixture
weights depend on how often the context u was seen (a bucket for each power of two) and are learned by expectation
maximisation on held-out counts: each training token is scored with itself deleted from all counts.

Counting covers every word and bigram of the corpus and keeps none of it in one place. Documents are read in chunks;
a chunk sends its distinct bigrams and words, sorted and packed, to buckets by hash range, and a bucket answers each
chunk with the totals in the order asked. So a bigram costs a few bytes a chunk, a frequent one no more than a rare one.
Bigrams are known by log2(tokens) + 16 bits of a hash: another one has the same with a probability of 1 in 65,536 at
any size of corpus. Words, which are few beside them, are known by their whole 64-bit keys.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, gives_back, id_text, shared_table
from .textbytes import NOT_SPACE, U64, buffers, mix, slices, words

#: Text of a chunk, and keys that a bucket of counts expects.
CHUNK_BYTES, BUCKET_KEYS = 6 << 20, 700_000
END = U64(0x5851F42D4C957F2D)
START = U64(0x14057B7EF767814F)
ROUNDS = 40
WORD, PAIR = 1, 2


def pack(values: np.ndarray) -> bytes:
    """Unsigned integers as compressed byte planes."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8).T.tobytes())


def unpack(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel().astype(U64)


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=U64(0)))


def unpack_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(unpack(raw), dtype=U64)


def chunk_table(docs: DataFrame, parts: int, held: int, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per chunk: ids, which are held out, tokens of each document, the sorted word keys, and the tokens as
    places in these keys."""
    rows = id_text(docs).withColumn("held", fold("doc_id", parts) == held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, made = TaskContext.get().partitionId(), 0
        ids, flags, sizes, keys, size = [], [], [], [], 0

        def out() -> pa.RecordBatch:
            vocabulary, tokens = np.unique(np.concatenate(keys), return_inverse=True)
            n = np.concatenate(sizes)
            learned = ~np.array([bool(h) for h in flags])
            return pa.RecordBatch.from_arrays(
                [pa.array([(task << 24) + made]), pa.array([len(tokens)]), pa.array([int(n[learned].sum())]), pa.array([int(learned.sum())]), pa.array([ids], pa.list_(pa.int64())), pa.array([flags], pa.list_(pa.bool_())),
                 pa.array([pack(n)], pa.binary()), pa.array([pack_sorted(vocabulary)], pa.binary()), pa.array([pack(tokens)], pa.binary())],
                ["chunk", "n_tokens", "n_train", "n_train_docs", "ids", "held", "sizes", "vocabulary", "tokens"])

        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for i, j in slices(offsets):
                w = words(data, offsets[i : j + 1], NOT_SPACE)
                keys.append(np.insert(w.key, w.first[1:], END))
                sizes.append(np.diff(w.first) + 1)
                ids += batch.column(0)[i:j].to_pylist()
                flags += batch.column(2)[i:j].to_pylist()
                size += int(offsets[j] - offsets[i])
                if size >= chunk_bytes:
                    yield out()
                    made += 1
                    ids, flags, sizes, keys, size = [], [], [], [], 0
        if ids:
            yield out()

    return rows.mapInArrow(gives_back(run), "chunk long, n_tokens long, n_train long, n_train_docs long, ids array<long>, held array<boolean>, sizes binary, vocabulary binary, tokens binary")


class Chunk:
    """A chunk's arrays: for each token its word, its context word (len(vocabulary) for the start), and its bigram."""

    def __init__(self, row: dict, bits: int):
        self.sizes = unpack(row["sizes"]).astype(np.int64)
        self.vocabulary = unpack_sorted(row["vocabulary"])
        self.word = unpack(row["tokens"]).astype(np.int32)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.context = np.empty_like(self.word)
        self.context[1:] = self.word[:-1]
        self.context[self.first] = len(self.vocabulary)
        self.learned = ~np.array([bool(h) for h in row["held"]])
        self.from_training = np.repeat(self.learned, self.sizes)
        key = np.append(self.vocabulary, START)
        shift = U64(64 - bits)
        self.words_mixed = mix(self.vocabulary)  # none falls together
        self.words_order = np.argsort(self.words_mixed, kind="stable")
        self.pairs, self.pair = np.unique(mix(key[self.context] * U64(0x9E3779B97F4A7C15) + key[self.word]) >> shift, return_inverse=True)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """How often training documents hold each word and each bigram."""
        one = self.from_training
        return np.bincount(self.word[one], minlength=len(self.vocabulary)), np.bincount(self.pair[one], minlength=len(self.pairs))


def requests(chunks: DataFrame, bits: int, buckets: int) -> DataFrame:
    """(kind, bucket, chunk, keys, counts): a chunk's sorted keys in one bucket, with its own counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk(row, bits)
                n_words, n_pairs = chunk.counts()
                for kind, size, keys, n in ((WORD, 64, chunk.words_mixed[chunk.words_order], n_words[chunk.words_order]), (PAIR, bits, chunk.pairs, n_pairs)):
                    bucket = ((keys >> U64(size - 20)) * U64(buckets)) >> U64(20)
                    cuts = np.searchsorted(bucket, np.arange(buckets + 1, dtype=U64))
                    for b in np.flatnonzero(np.diff(cuts)).tolist():
                        a, z = cuts[b], cuts[b + 1]
                        yield pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([b], pa.int32()), pa.array([row["chunk"]]), pa.array([pack_sorted(keys[a:z])], pa.binary()), pa.array([pack(n[a:z])], pa.binary())], ["kind", "bucket", "chunk", "keys", "counts"])

    return chunks.mapInArrow(gives_back(run), "kind int, bucket int, chunk long, keys binary, counts binary")


def answers(asked: DataFrame) -> DataFrame:
    """(chunk, kind, bucket, totals, distinct): totals over all chunks in the order asked; distinct, on one row of a
    bucket, is how many of its keys training documents hold."""

    def total(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        keys = [unpack_sorted(r["keys"]) for r in rows]
        unique, place = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.zeros(len(unique), np.int64)
        np.add.at(n, place, np.concatenate([unpack(r["counts"]) for r in rows]).astype(np.int64))
        ends = np.cumsum([len(k) for k in keys])
        made = [pack(n[place[e - len(k) : e]]) for k, e in zip(keys, ends)]
        distinct = [int((n > 0).sum())] + [0] * (len(rows) - 1)
        return pa.table({"chunk": table["chunk"], "kind": table["kind"], "bucket": table["bucket"], "totals": pa.array(made, pa.binary()), "distinct": pa.array(distinct, pa.int64())})

    return asked.groupBy("kind", "bucket").applyInArrow(total, "chunk long, kind int, bucket int, totals binary, distinct long")


def _with_answers(chunks: DataFrame, answered: DataFrame, bits: int, fn, schema: str) -> DataFrame:
    """fn(chunk row, Chunk, word counts, pair counts) -> record batch columns, for each chunk with its answers."""

    def both(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        row = next(r for r in rows if r["kind"] == 0)
        chunk = Chunk(row, bits)
        found = {}
        for kind in (WORD, PAIR):
            mine = sorted((r for r in rows if r["kind"] == kind), key=lambda r: r["bucket"])
            found[kind] = np.concatenate([unpack(r["totals"]) for r in mine]).astype(np.int64)
        n_words = np.empty(len(chunk.vocabulary), np.int64)
        n_words[chunk.words_order] = found[WORD]
        return pa.table(fn(row, chunk, n_words, found[PAIR]))

    left = chunks.select("chunk", F.lit(0).alias("kind"), F.lit(0).alias("bucket"), F.lit(None).cast("binary").alias("totals"), "ids", "held", "sizes", "vocabulary", "tokens")
    none = [F.lit(None).cast(t).alias(c) for c, t in left.dtypes[4:]]
    return left.union(answered.select("chunk", "kind", "bucket", "totals", *none)).groupBy("chunk").applyInArrow(both, schema)


def bucket_of(count: np.ndarray) -> np.ndarray:
    """0 for no occurrence, else one more than the power of two."""
    return np.where(count > 0, np.floor(np.log2(np.maximum(count, 1))) + 1, 0).astype(np.int64)


class Model:
    def __init__(self, tokens: int, documents: int, distinct: int):
        self.tokens, self.documents, self.distinct = tokens, documents, distinct
        self.weights = np.tile([0.0, 0.0, 1.0], (66, 1))  # bigram, unigram, add-one unigram; by context bucket

    def context_counts(self, chunk: Chunk, n_words: np.ndarray) -> np.ndarray:
        return np.append(n_words, self.documents)[chunk.context]

    def base(self, count: np.ndarray) -> np.ndarray:
        return (count + 1) / (self.tokens + self.distinct + 1)

    def estimates(self, pair: np.ndarray, context: np.ndarray, word: np.ndarray, deleted: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bigram, unigram and add-one estimates, with `deleted` occurrences of the token itself taken away."""
        context, word, tokens = context - deleted, word - deleted, self.tokens - deleted
        bigram = np.where(context > 0, (pair - deleted) / np.maximum(context, 1), 0.0)
        return bigram, word / max(tokens, 1), (word + 1) / (tokens + self.distinct + 1)

    def fit(self, histogram: list[tuple[int, int, int, int]]) -> None:
        """Expectation maximisation for each bucket. histogram: (bucket, quarter-octaves of the bigram estimate over the
        add-one one, the same of the unigram, tokens); NONE stands for zero."""
        by: dict[int, list] = {}
        for b, q2, q1, n in histogram:
            by.setdefault(b, []).append((q2, q1, n))
        for b, rows in by.items():
            q2, q1, n = np.array(rows, float).T
            r = np.stack([np.where(q2 == NONE, 0, 2 ** (q2 / 4)), np.where(q1 == NONE, 0, 2 ** (q1 / 4)), np.ones(len(n))])
            w = np.full(3, 1 / 3)
            for _ in range(ROUNDS):
                share = w[:, None] * r
                w = (share / share.sum(0) * n).sum(1) / n.sum()
            self.weights[b] = 0.999 * w + 0.001 * np.array([0, 0, 1]) if b else np.array([0, w[1], w[0] + w[2]])
        seen = sorted(by)
        for b in range(len(self.weights)):  # a bucket that training has not met takes the nearest one's
            if b not in by and [s for s in seen if s]:
                near = min((s for s in seen if s), key=lambda s: abs(s - b))
                self.weights[b] = self.weights[near]
                if b == 0:
                    self.weights[0] = [0, self.weights[near][1], 1 - self.weights[near][1]]


NONE = -10_000


def _quarter_octaves(x: np.ndarray, over: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        q = np.rint(4 * np.log2(x / over))
    return np.where(x > 0, q, NONE).astype(np.int64)


def score_documents(docs: DataFrame, parts: int = 7, held: int = 2, chunk_bytes: int = CHUNK_BYTES, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """One row per row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Words are lower-cased (A-Z) runs of non-white-space; each text ends with an end token, the only one of null and
    empty texts. A null id is in no fold: it is learned from, and its held_out is null. Repeated rows count and are
    scored each. Without any training document the add-one unigram remains. Only doc_id and text are read.
    """
    chunks = shared_table(chunk_table(docs, parts, held, chunk_bytes), "chunks")
    n, tokens, documents = (x or 0 for x in chunks.agg(F.sum("n_tokens"), F.sum("n_train"), F.sum("n_train_docs")).first())
    bits = min(64, max(32, math.ceil(math.log2(n + 2)) + 16))
    answered = shared_table(answers(requests(chunks, bits, max(1, -(-n // bucket_keys)))), "answers")
    distinct = answered.where(F.col("kind") == WORD).agg(F.sum("distinct")).first()[0] or 0
    model = Model(tokens, documents, distinct)

    def spread(row: dict, chunk: Chunk, n_words: np.ndarray, n_pairs: np.ndarray) -> dict:
        one = chunk.from_training
        context = model.context_counts(chunk, n_words)[one]
        bigram, unigram, base = model.estimates(n_pairs[chunk.pair[one]], context, n_words[chunk.word[one]], deleted=1)
        bins = np.stack([bucket_of(context - 1), _quarter_octaves(bigram, base), _quarter_octaves(unigram, base)], 1)
        packed = (bins[:, 0] << 40) + ((bins[:, 1] + 20_000) << 20) + bins[:, 2] + 20_000
        packed, n = np.unique(packed, return_counts=True)
        return {"bucket": packed >> 40, "q2": ((packed >> 20) & 0xFFFFF) - 20_000, "q1": (packed & 0xFFFFF) - 20_000, "n": n}

    seen = _with_answers(chunks, answered, bits, spread, "bucket long, q2 long, q1 long, n long").groupBy("bucket", "q2", "q1").agg(F.sum("n").alias("n"))
    model.fit([tuple(r) for r in seen.collect()])  # bounded by the numbers of buckets and quarter-octaves

    def score(row: dict, chunk: Chunk, n_words: np.ndarray, n_pairs: np.ndarray) -> dict:
        word, context = n_words[chunk.word], model.context_counts(chunk, n_words)
        w = model.weights[bucket_of(context)]
        bigram, unigram, base = model.estimates(n_pairs[chunk.pair], context, word)
        p = np.log10(w[:, 0] * bigram + w[:, 1] * unigram + w[:, 2] * base)
        sums = [np.add.reduceat(x, chunk.first) for x in (word > 0, np.log10(model.base(word)), p)]
        return {"doc_id": pa.array(row["ids"], pa.int64()), "held_out": pa.array(row["held"], pa.bool_()), "n_tokens": chunk.sizes, "n_known": sums[0].astype(np.int64), "train_tokens": np.full(len(chunk.sizes), model.tokens, np.int64), "base_score": sums[1], "score": sums[2]}

    return _with_answers(chunks, answered, bits, score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
