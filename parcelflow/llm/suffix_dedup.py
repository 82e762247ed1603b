"""Removal of every byte covered by a 400-byte string that also starts elsewhere, by suffix arrays of shards.

1. Each 400-byte window belongs to its minimiser: the leftmost of its smallest-hashed 32-byte grams. Equal windows have
   equal minimisers, and neighbouring windows mostly share one, so a text becomes about one anchor in 185 bytes, each with
   its context: the bytes of all windows that belong to it.
2. Minimisers met twice are found, and only their contexts go on; these are counted by minimiser and content. A context
   met twice is wholly repeated; one that is alone with its minimiser has no repeated window. Only minimisers with several
   contexts need their bytes.
3. Those bytes, one copy of each context, are dealt by minimiser to shards of bounded size. Each shard builds its suffix
   array by induced sorting and the permuted common prefixes; windows whose common prefix with a neighbour in the order
   reaches 400 bytes are repeated. All equal windows are in one shard, so this is exact.
4. A minimiser with more contexts than a shard may hold goes another exact way: its windows are counted by content hash
   in an ordinary aggregation, which deals them over all tasks.
5. Runs of repeated windows return to the documents by context, and are merged and cut out.

Contexts and windows are told apart by 128-bit hashes, as copies are by their digests elsewhere; the shards compare bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, free_names, gives_back, key_filter, maybe_in, row_hash, shared_table, with_plain_names
from .suffixes import common_prefixes, suffix_array
from .textbytes import BYTE_KEYS, U64, buffers, mix, slices

LENGTH = 400
GRAM = 32
#: Contexts of one minimiser that may stand in one shard, the bytes of a shard (its arrays and lists take some 100 times as much),
#: and shards that a task sorts one after another.
SHARD_CONTEXTS, SHARD_BYTES, SHARDS_A_TASK = 4000, 5 << 17, 24
#: Stands between contexts in a shard; no UTF-8 text holds it.
WALL = 255
_STEPS = [U64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]
_SLICE = 1 << 20


def _grams(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each run of `gram` bytes; gram is a power of two up to 32."""
    h, width = BYTE_KEYS[data], 1
    for k in _STEPS:
        if width == gram:
            break
        h = h[:-width] * k + h[width:]
        width *= 2
    return mix(h)


def _window_minima(h: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost smallest value (by 33 bits) in each run of `width` values."""
    n = len(h)
    v = (h >> U64(31) << U64(31)) | np.arange(n, dtype=U64)
    pad = -n % width
    v = np.concatenate([v, np.full(pad, np.iinfo(U64).max, U64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(v, axis=1).ravel()
    back = np.minimum.accumulate(v[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - width + 1
    return (np.minimum(back[:m], ahead[width - 1 : width - 1 + m]) & U64((1 << 31) - 1)).astype(np.int64)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Arrays of the anchors of some documents: (document, first window's start in it, windows, minimiser, its place in
    data). data[offsets[i]:offsets[i + 1]] are the documents."""
    found = []
    for i, j in slices(offsets, _SLICE):
        base, end = int(offsets[i]), int(offsets[j])
        if end - base < length:
            continue
        part = data[base:end]
        h = _grams(part, gram)
        place = _window_minima(h, length - gram + 1)
        start = np.arange(len(place))
        doc = np.searchsorted(offsets[i : j + 1] - base, start, "right") - 1
        whole = start + length <= offsets[i + 1 : j + 1][doc] - base
        new = np.concatenate([[True], (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])]) & whole
        first = np.flatnonzero(new)
        if len(first):
            # a run of windows ends before the next one or at its document's last window
            last = np.minimum(np.append(first[1:], len(place)), offsets[i + 1 : j + 1][doc[first]] - base - length + 1)
            found.append((doc[first] + i, base + first - offsets[i:j][doc[first]], last - first, h[place[first]].view(np.int64), base + place[first], base + first))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    return tuple(np.concatenate(x).astype(np.int64) for x in zip(*found))


def _context_keys(data: np.ndarray, at: np.ndarray, windows: np.ndarray, place: np.ndarray, length: int) -> np.ndarray:
    """64-bit digests of the contexts: their bytes and where the minimiser stands in them. With the minimiser's own
    64-bit hash beside it, a context is known by 128 bits."""
    raw = data.tobytes() if len(at) else b""
    out = np.empty(len(at), np.int64)
    for k, (a, n, p) in enumerate(zip(at.tolist(), windows.tolist(), (place - at).tolist())):
        out[k] = int.from_bytes(hashlib.blake2b(raw[a : a + n + length - 1], digest_size=8, key=p.to_bytes(4, "little")).digest(), "little", signed=True)
    return out


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, row: a hash of id and text that tells rows apart where ids are null or repeated, text)."""
    return bounded_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), row_hash(id_col, text_col).alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def _batches(batch: pa.RecordBatch, length: int, gram: int) -> Iterator[tuple]:
    """(documents of the batch, data, anchors) in slices."""
    data, offsets = buffers(batch.column("text"))
    for i, j in slices(offsets, 2 << 20):
        part = data[offsets[i] : offsets[j]]
        yield i, part, anchors(part, offsets[i : j + 1] - offsets[i], length, gram)


def anchor_table(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """(doc_id, row, start, windows, key, context)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, data, (doc, start, windows, key, place, at) in _batches(batch, length, gram):
                take = pa.array(doc + i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(take), batch.column("row").take(take), pa.array(start.astype(np.int32)), pa.array(windows.astype(np.int32)), pa.array(key), pa.array(_context_keys(data, at, windows, place, length))],
                    ["doc_id", "row", "start", "windows", "key", "context"])

    return rows.mapInArrow(gives_back(run), "doc_id long, row long, start int, windows int, key long, context long")


def context_bytes(rows: DataFrame, needed: DataFrame, length: int, gram: int) -> DataFrame:
    """(key, context, windows, bytes) of the contexts whose key is in needed(key), each once a task batch."""
    test = key_filter(needed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, (_, _, windows, key, place, at) in _batches(batch, length, gram):
                ok = np.arange(len(key)) if test is None else np.flatnonzero(test(key))
                windows, key, place, at = windows[ok], key[ok], place[ok], at[ok]
                context = _context_keys(data, at, windows, place, length)
                _, once = np.unique(context, return_index=True)
                raw = data.tobytes() if len(once) else b""
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[once]), pa.array(context[once]), pa.array(windows[once].astype(np.int32)), pa.array([raw[a : a + n + length - 1] for a, n in zip(at[once].tolist(), windows[once].tolist())], pa.binary())],
                    ["key", "context", "windows", "bytes"])

    return rows.select("text").mapInArrow(gives_back(run), "key long, context long, windows int, bytes binary")


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Firsts and lasts of the runs of true values."""
    edge = np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def shard_repeats(contents: DataFrame, shards: int, length: int) -> DataFrame:
    """(key, context, low, high): runs of repeated windows in each context, from one suffix array a shard."""

    def sort(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows)
        texts = table.column("bytes").to_pylist()
        text = np.frombuffer(bytes([WALL]) + bytes([WALL]).join(texts) + bytes([WALL]), np.uint8)
        at = np.cumsum([1, *(len(t) + 1 for t in texts[:-1])])
        del texts
        plcp, before = common_prefixes(text, suffix_array(text), WALL)
        repeated = plcp >= length
        repeated[before[repeated]] = True  # the neighbour on the other side
        first, last = _runs(repeated)
        owner = np.searchsorted(at, first, "right") - 1
        take = pa.array(owner)
        low, high = first - at[owner], last - at[owner]
        return pa.RecordBatch.from_arrays([table.column(c).take(take).combine_chunks() for c in ("key", "context")] + [pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))], ["key", "context", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            cuts = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if held and held[-1].column("shard")[0].as_py() != shard[a]:
                    yield sort(held)
                    held = []
                held.append(batch.slice(a, b - a))
        if held:
            yield sort(held)

    dealt = contents.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    dealt = dealt.repartition(max(1, -(-shards // SHARDS_A_TASK)), "shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(gives_back(run), "key long, context long, low int, high int")


def window_repeats(contents: DataFrame, length: int) -> DataFrame:
    """The same for minimisers with too many contexts for a shard: windows are grouped by content hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, context, n, text in zip(*(batch.column(k).to_pylist() for k in range(4))):
                digests = [hashlib.blake2b(text[i : i + length], digest_size=16).digest() for i in range(n)]
                yield pa.RecordBatch.from_arrays([pa.array([key] * n, pa.int64()), pa.array([context] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array(digests, pa.binary())], ["key", "context", "low", "digest"])

    windows = contents.mapInArrow(gives_back(run), "key long, context long, low int, digest binary")
    several = windows.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return windows.join(several, "digest", "left_semi").select("key", "context", "low", F.col("low").alias("high"))


def repeated_spans(rows: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_contexts: int = SHARD_CONTEXTS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, row, spans): each document's intervals of repeated windows as [first byte, last byte + 1), not merged.
    Documents without any are absent."""
    found = shared_table(anchor_table(rows, length, gram), "anchors")
    n_found = found.count()
    met = found.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("context").alias("low"), F.max("context").alias("high"))
    met = shared_table(met.where("n > 1").select("key", (F.col("low") < F.col("high")).alias("several")), "keys", n_found)
    counted = maybe_in(found, "key", met).where("maybe").join(met, "key").groupBy("key", "context")
    counted = counted.agg(F.count(F.lit(1)).alias("n"), F.max("windows").alias("windows"), F.max("several").alias("several"))
    counted = shared_table(counted, "contexts", n_found)

    several = counted.where("several")
    n_several, total = (x or 0 for x in several.agg(F.count(F.lit(1)), F.sum(F.col("windows").cast("long") + length)).first())
    contents = context_bytes(rows, met.where("several").select("key"), length, gram)
    contents = contents.join(several.select("key", "context"), ["key", "context"], "left_semi").dropDuplicates(["key", "context"])
    contents = shared_table(contents.select("key", "context", "windows", "bytes"), "contents", n_several, 10_000)
    crowded = several.groupBy("key").agg(F.count(F.lit(1)).alias("contexts")).where(F.col("contexts") > shard_contexts)
    crowded = shared_table(crowded.select("key"), "crowded", n_several // shard_contexts + 1)
    shards = max(1, -(-total // shard_bytes))
    if crowded.take(1):
        runs = shard_repeats(contents.join(crowded, "key", "left_anti"), shards, length).union(window_repeats(contents.join(crowded, "key", "left_semi"), length))
    else:
        runs = shard_repeats(contents, shards, length)
    whole = counted.where("n > 1").select("key", "context", F.lit(0).alias("low"), (F.col("windows") - 1).alias("high"))
    single = counted.where("n = 1").select("key", "context")
    runs = shared_table(runs.join(single, ["key", "context"], "left_semi").union(whole), "runs", n_found)

    near = maybe_in(found, "context", runs.select("context").distinct()).where("maybe").drop("maybe")
    spans = near.join(runs, ["key", "context"])
    span = F.struct((F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("high") + length).alias("high"))
    return spans.groupBy("doc_id", "row").agg(F.collect_set(span).alias("spans"))


def merge_spans(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Sorted, disjoint spans; those that touch are one run of removed bytes."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["low"], s["high"]) for s in spans or ()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, kept = 0, []
    for a, b in spans:
        kept.append(text[at:a])
        at = b
    return b"".join([*kept, text[at:]])


def _with_spans(docs: DataFrame, spans: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """docs' rows that may have spans, with them as a last column, and all others. Only the former are shuffled."""
    row, maybe, found, id_of, row_of = free_names(docs, "row", "maybe", "spans", "id_of", "row_of")
    cols = [F.col(f"`{c}`") for c in docs.columns]
    marked = maybe_in(docs.withColumn(row, row_hash(id_col, text_col)), row, spans.select("row"), maybe)
    right = spans.select(F.col("doc_id").alias(id_of), F.col("row").alias(row_of), F.col("spans").alias(found))
    on = (F.col(row) == F.col(row_of)) & F.col(id_col).cast("long").eqNullSafe(F.col(id_of))
    return marked.where(F.col(maybe)).join(right, on, "left").select(*cols, found), marked.where(~F.col(maybe)).select(*cols)


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, **bounds) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Texts are their UTF-8 bytes; null and empty ones have none, and texts under `length` bytes lose nothing. Strings are
    judged on the input, also against their own document. Rows with null or repeated ids are judged as documents of their
    own; wholly equal rows repeat each other. Very long texts are read whole. Only the two named columns are read. An empty
    table gives an empty result.
    """
    spans = shared_table(repeated_spans(_documents(docs, id_col, text_col), length, **bounds), "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, removed, number, digest = [], [], [], []
            for text, found in zip(batch.column(1), batch.column(2).to_pylist()):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                merged = merge_spans(found)
                kept = cut(raw, merged)
                n.append(len(raw))
                removed.append(len(raw) - len(kept))
                number.append(len(merged))
                digest.append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in (n, removed, number)), pa.array(digest, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    touched, whole = _with_spans(rows, spans, "doc_id", "text")
    text, none = F.coalesce("text", F.lit("")), F.lit(0).cast("long")
    whole = whole.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"), F.sha2(text, 256).alias("kept_sha256"))
    return touched.mapInArrow(gives_back(run), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string").union(whole)


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """docs with repeated bytes cut out of the text; same columns, which may have any name. Where a cut parts a character,
    what is left of it goes too. A text without repeats, null, empty and short ones too, stays as it is; a very long one
    is read whole. Rows of one id with different texts are judged apart; wholly equal rows repeat each other. An empty
    table gives an empty result."""
    return with_plain_names(docs, [id_col, text_col], lambda rows: _cut_repeats(rows, id_col, text_col, length))


def _cut_repeats(docs: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    spans = shared_table(repeated_spans(_documents(docs, id_col, text_col), length), "spans")
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, found in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                texts.append(cut(text.encode("utf-8"), merge_spans(found)).decode("utf-8", "ignore") if found else text)
            cols = list(batch.columns[:-1])
            cols[at] = pa.array(texts, cols[at].type)
            yield pa.RecordBatch.from_arrays(cols, batch.schema.names[:-1])

    touched, whole = _with_spans(docs, spans, id_col, text_col)
    return touched.mapInArrow(gives_back(run), docs.schema).union(whole)
