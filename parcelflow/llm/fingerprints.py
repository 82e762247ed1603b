"""Chroma fingerprints of audio columns, and alignment of recordings by offset histograms and bit errors.

A recording is cut into overlapping frames; each frame's spectrum is folded into twelve pitch classes. An integral image
over (frames, pitch classes) gives the sum of any rectangle in four look-ups. Sixteen filters compare two areas of a
stretch of frames and are quantised to two bits each, so every frame becomes one packed 32-bit integer. Recordings that
share runs of these integers are laid over each other at each difference of places: the most voted offset is tried first,
and the share of differing bits in the overlap there tells how well they agree.
"""

from __future__ import annotations

import hashlib
import io
import wave
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, gives_back, maybe_in, shared_table

RATE, FRAME, HOP = 8000, 512, 128
LOW_HZ, HIGH_HZ = 60.0, 3600.0
#: Consecutive integers that two recordings must share to be compared, and the most differing bits of a match.
RUN, MOST_ERROR = 2, 0.15
#: Integers and places of a run's holders that meet in one block, and pairs of places and integers compared at once.
BLOCK, PAIRS, SLICE = 1 << 16, 8192, 1 << 20
ALIGNED = pa.schema([("media_id", pa.int64()), ("other_id", pa.int64()), ("votes", pa.int64()), ("offset", pa.int32()), ("compared", pa.int64()), ("bit_error", pa.float64())])
_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def filters() -> list[tuple[str, int, int, int]]:
    """(shape, first pitch class, classes, frames): every shape in four sizes, wide ones for melody, short for onsets."""
    sizes = [(0, 12, 8), (0, 6, 6), (6, 6, 6), (3, 6, 4)]
    return [(shape, *size) for shape in ("rows", "columns", "corners", "middle") for size in sizes]


FILTERS = filters()
THRESHOLDS = (-0.12, 0.0, 0.12)


def samples_of(raw: bytes) -> np.ndarray:
    """Mono samples of a WAV file with 8 or 16 bits, or of bare unsigned 8-bit samples, in -1..1."""
    if raw[:4] == b"RIFF" and raw[8:12] == b"WAVE":
        try:
            with wave.open(io.BytesIO(raw)) as w:
                data, width, channels = w.readframes(w.getnframes()), w.getsampwidth(), w.getnchannels()
        except (wave.Error, EOFError):
            return np.zeros(0, np.float32)
        x = np.frombuffer(data, "<i2").astype(np.float32) / 32768 if width == 2 else (np.frombuffer(data, np.uint8).astype(np.float32) - 128) / 128
        return x[: len(x) // channels * channels].reshape(-1, channels).mean(1)
    return (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128


def _classes() -> np.ndarray:
    """(bins, 12): which pitch class a bin of the spectrum counts for."""
    hz = np.fft.rfftfreq(FRAME, 1 / RATE)
    fold = np.zeros((len(hz), 12), np.float32)
    for k, f in enumerate(hz):
        if LOW_HZ <= f <= HIGH_HZ:
            fold[k, int(round(12 * np.log2(f / 440.0))) % 12] = 1
    return fold


_FOLD, _WINDOW = _classes(), np.hanning(FRAME).astype(np.float32)


def chroma(x: np.ndarray) -> np.ndarray:
    """(frames, 12) normalised energies; a recording that is shorter than a frame, or ends within one, is padded."""
    if not len(x):
        return np.zeros((0, 12), np.float32)
    frames = max(1, -(-(len(x) - FRAME) // HOP) + 1)
    x = np.concatenate([x - x.mean(), np.zeros((frames - 1) * HOP + FRAME - len(x), np.float32)])
    out = []
    view = np.lib.stride_tricks.sliding_window_view(x, FRAME)[::HOP]
    for i in range(0, frames, 4096):
        spectrum = np.fft.rfft(view[i : i + 4096] * _WINDOW, axis=1)
        energy = (spectrum.real**2 + spectrum.imag**2).astype(np.float32) @ _FOLD
        out.append(energy / np.maximum(np.linalg.norm(energy, axis=1, keepdims=True), 1e-6))
    return np.concatenate(out)


def packed_items(image: np.ndarray) -> np.ndarray:
    """One 32-bit integer for each frame."""
    n = len(image)
    if not n:
        return np.zeros(0, np.uint32)
    longest = max(f[3] for f in FILTERS)
    total = np.zeros((n + longest + 1, 13))
    total[1 : n + 1, 1:] = image.cumsum(0, dtype=np.float64).cumsum(1)
    total[n + 1 :] = total[n]
    at = np.arange(n)

    def area(t0: int, t1: int, c0: int, c1: int) -> np.ndarray:
        return total[at + t1, c1] - total[at + t0, c1] - total[at + t1, c0] + total[at + t0, c0]

    items = np.zeros(n, np.uint32)
    for shape, c, classes, frames in FILTERS:
        half_c, half_t = c + classes // 2, frames // 2
        whole = area(0, frames, c, c + classes)
        if shape == "rows":
            one = area(0, frames, c, half_c)
        elif shape == "columns":
            one = area(0, half_t, c, c + classes)
        elif shape == "corners":
            one = area(0, half_t, c, half_c) + area(half_t, frames, half_c, c + classes)
        else:
            one = area(frames // 4, frames - frames // 4, c, c + classes)
        value = np.log1p(one) - np.log1p(np.maximum(whole - one, 0))
        level = np.searchsorted(THRESHOLDS, value)
        items = (items << np.uint32(2)) | (level ^ (level >> 1)).astype(np.uint32)  # Gray code: next levels differ in one bit
    return items


def bit_error(a: np.ndarray, b: np.ndarray, offset: int) -> tuple[float, int]:
    """(share of differing bits, integers compared) when b's place 0 stands at a's place `offset`."""
    start, end = max(0, offset), min(len(a), offset + len(b))
    if end <= start:
        return 1.0, 0
    x = (a[start:end] ^ b[start - offset : end - offset]).view(np.uint8)
    return float(_POPCOUNT[x].sum()) / (32 * (end - start)), end - start


def fingerprint_media(media: DataFrame, id_col: str = "media_id", content_col: str = "content") -> DataFrame:
    """(media_id, n_samples, n_items, items array<int>, fingerprint_sha256) for each row. Null and empty contents, and
    damaged WAV files, have no samples and no items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, items, digest = [], [], []
            for raw in batch.column(1):
                x = samples_of(raw.as_py() or b"")
                own = packed_items(chroma(x))
                n.append(len(x))
                items.append(own.view(np.int32))
                digest.append(hashlib.sha256(own.astype("<u4").tobytes()).hexdigest())
            ends = np.concatenate([[0], np.cumsum([len(x) for x in items])]).astype(np.int32)
            flat = np.concatenate(items) if items else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(np.diff(ends).astype(np.int64)), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32())), pa.array(digest, pa.string())], ["media_id", "n_samples", "n_items", "items", "fingerprint_sha256"])

    rows = bounded_batches(media).select(F.col(id_col).cast("long").alias("media_id"), F.col(content_col).cast("binary").alias("content"))
    return rows.mapInArrow(gives_back(run), "media_id long, n_samples long, n_items long, items array<int>, fingerprint_sha256 string")


def run_posts(recordings: DataFrame, run_length: int = RUN) -> DataFrame:
    """(key, media_id, n_items, places, befores) for each different run of each recording (media_id, items): all places
    of the run, and the integers that stand before it there (null at place 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("items")
            n = lists.value_lengths().to_numpy().astype(np.int64)
            flat = lists.flatten().to_numpy().view(np.uint32).astype(np.uint64)
            first = np.cumsum(n) - n
            many = np.maximum(n - run_length + 1, 0)
            of = np.repeat(np.arange(len(n)), many)
            place = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
            at = first[of] + place
            key = np.zeros(len(at), np.uint64)
            for k in range(run_length):
                key = (key ^ flat[at + k]) * np.uint64(0xD6E8FEB86659FD93)
                key = (key ^ (key >> np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F)
                key ^= key >> np.uint64(29)
            order = np.lexsort((place, key, of))
            of, key, place, at = of[order], key[order], place[order], at[order]
            new = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (key[1:] != key[:-1])])) if len(of) else np.zeros(0, np.int64)
            ends = pa.array(np.append(new, len(of)).astype(np.int32))
            before = pa.array(flat[np.maximum(at - 1, 0)].astype(np.uint32).view(np.int32) if len(at) else np.zeros(0, np.int32), pa.int32(), mask=place == 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[new].view(np.int64)), batch.column("media_id").take(pa.array(of[new])), pa.array(n[of[new]]), pa.ListArray.from_arrays(ends, pa.array(place.astype(np.int32))), pa.ListArray.from_arrays(ends, before)],
                ["key", "media_id", "n_items", "places", "befores"])

    return recordings.select("media_id", "items").mapInArrow(gives_back(run), "key long, media_id long, n_items long, places array<int>, befores array<int>")


def best_alignments(holders: DataFrame, run_length: int = RUN, most_error: float = MOST_ERROR, block: int = BLOCK) -> DataFrame:
    """(media_id, other_id, votes, offset, compared, bit_error): the best alignments of recordings with earlier ones that
    hold one of their runs; at most a row for each holder and two blocks.

    holders: (key, weight of all its holders, media_id, items, places, befores). A run of more weight than `block` is cut
    into blocks by a hash of the id, and each two blocks meet in a task of their own. There each two places of a run give
    an alignment, unless the integers before them agree too: then the run before gives the same one. Votes and bit errors
    are counted on the items, so an alignment needs no row before it has passed.
    """
    blocks = F.ceil(F.col("weight") / block).cast("int")
    own = F.pmod(F.xxhash64("media_id"), blocks).cast("int")
    met = F.transform(F.sequence(F.lit(0), blocks - 1), lambda o: F.struct(F.least(own, o).alias("i"), F.greatest(own, o).alias("j")))
    dealt = holders.withColumn("met", F.explode(met)).withColumn("own", own).select("key", "met.i", "met.j", "own", "media_id", "items", "places", "befores")
    dealt = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def compare(table: pa.Table) -> pa.RecordBatch:
        key, i, j, own, ids = (table.column(c).to_numpy() for c in ("key", "i", "j", "own", "media_id"))
        lists = table.column("items").combine_chunks()
        n_items = lists.value_lengths().to_numpy().astype(np.int64)
        first, flat = np.cumsum(n_items) - n_items, lists.flatten().to_numpy().view(np.uint32)
        places = table.column("places").combine_chunks()
        of = np.repeat(np.arange(len(ids)), places.value_lengths().to_numpy())
        place = places.flatten().to_numpy().astype(np.int64)
        before = pc.fill_null(table.column("befores").combine_chunks().flatten(), 0).to_numpy()
        new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]))
        group = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(ids))))[of]
        left = np.searchsorted(group, group, "right") - np.arange(len(of)) - 1
        best: dict[int, tuple] = {}
        least = np.zeros(len(ids), np.int64)  # votes that a later alignment of the row must reach

        def weigh(mine: np.ndarray, other: np.ndarray, offset: np.ndarray) -> None:
            start, end = np.maximum(0, offset), np.minimum(n_items[other], offset + n_items[mine])
            length = end - start
            ok = length - run_length + 1 >= least[mine]
            mine, other, offset, start, length = mine[ok], other[ok], offset[ok], start[ok], length[ok]
            cuts = np.searchsorted(np.cumsum(length), np.arange(0, int(length.sum()) + SLICE, SLICE), "right")
            for a, z in zip(cuts, cuts[1:] if len(cuts) else ()):
                if a == z:
                    continue
                size = length[a:z]
                begin = np.cumsum(size) - size
                step = np.arange(int(size.sum())) - np.repeat(begin, size)
                x = flat[np.repeat(first[other[a:z]] + start[a:z], size) + step] ^ flat[np.repeat(first[mine[a:z]] + start[a:z] - offset[a:z], size) + step]
                error = np.add.reduceat(np.bitwise_count(x).astype(np.int64), begin) / (32 * size)
                good = np.flatnonzero(error <= most_error)
                if not len(good):
                    continue
                same, whole = x == 0, np.ones(max(0, len(x) - run_length + 1), bool)
                for k in range(run_length):
                    whole &= same[k : k + len(whole)]
                total = np.concatenate([[0], np.cumsum(whole)])
                votes = total[begin[good] + size[good] - run_length + 1] - total[begin[good]]
                for g, v in zip(good.tolist(), votes.tolist()):
                    m = int(mine[a + g])
                    if v and v >= least[m]:
                        found = (v, -int(ids[other[a + g]]), -int(offset[a + g]), int(size[g]), float(error[g]))
                        k = int(ids[m])
                        if k not in best or best[k] < found:
                            best[k] = found
                        least[m] = best[k][0]

        lag, at = 1, np.flatnonzero(left > 0)
        while len(at):
            for k in range(0, len(at), PAIRS):
                a = at[k : k + PAIRS]
                b = a + lag
                r, q = of[a], of[b]
                ok = (ids[r] != ids[q]) & ((i[r] == j[r]) | (own[r] != own[q])) & ((before[a] != before[b]) | (place[a] == 0) | (place[b] == 0))
                a, b = a[ok], b[ok]
                if len(a):
                    later = ids[of[a]] > ids[of[b]]
                    a, b = np.where(later, a, b), np.where(later, b, a)
                    weigh(of[a], of[b], place[b] - place[a])
            lag += 1
            at = at[left[at] >= lag]
        rows = [(k, -o, v, -p, n, e) for k, (v, o, p, n, e) in best.items()]
        return pa.RecordBatch.from_pylist([dict(zip(ALIGNED.names, r)) for r in rows], ALIGNED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            k, i, j = (batch.column(c).to_numpy() for c in ("key", "i", "j"))
            last = np.flatnonzero((k != k[-1]) | (i != i[-1]) | (j != j[-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if held:
                h = held[-1]
                if any(h.column(c)[h.num_rows - 1].as_py() != batch.column(c)[0].as_py() for c in ("key", "i", "j")):
                    yield compare(pa.Table.from_batches(held))
                    held = []
            if cut:
                yield compare(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield compare(pa.Table.from_batches(held))

    return dealt.mapInArrow(gives_back(run), "media_id long, other_id long, votes long, offset int, compared long, bit_error double")


def align_recordings(prints: DataFrame, run_length: int = RUN, most_error: float = MOST_ERROR, block: int = BLOCK) -> DataFrame:
    """One row per row of prints, with match_id, offset, votes, compared, bit_error of its best alignment.

    Every two recordings are laid over each other at each offset at which they share a run of packed integers; the votes
    of an alignment are its shared runs. Of all alignments with earlier recordings (smaller ids) whose bit error is small
    enough, the most voted one is taken; ties go to the smaller id, then the smaller offset. Recordings without one, and
    those with a null id, have nulls. Repeated ids are taken as one recording, that of the smallest fingerprint.

    Recordings of one fingerprint are one class, and only its smallest id is compared. A copy shares all its runs with
    that one, and more votes than runs there are none, so it takes the class's alignment if that has all runs too (its
    id is smaller), else the smallest id of its class.
    """
    table = shared_table(prints, "prints")
    usable = table.where(F.col("media_id").isNotNull() & (F.col("n_items") >= run_length))
    chosen = table.where(F.col("media_id").isNotNull()).groupBy("media_id").agg(F.min(F.struct("fingerprint_sha256", "n_items")).alias("c"))
    chosen = chosen.select("media_id", "c.*").where(F.col("n_items") >= run_length)
    classes = shared_table(chosen.groupBy("fingerprint_sha256", "n_items").agg(F.min("media_id").alias("rep_id")), "classes")
    reps = usable.join(classes.select(F.col("rep_id").alias("media_id"), "fingerprint_sha256"), ["media_id", "fingerprint_sha256"], "left_semi")
    reps = shared_table(reps.dropDuplicates(["media_id"]).select("media_id", "items"), "items")

    posts = run_posts(reps, run_length)
    keys = posts.groupBy("key").agg(
        F.min("media_id").alias("low"), F.max("media_id").alias("high"), F.sum(F.col("n_items") + F.size("places")).alias("weight"),
        F.max(F.array_contains("places", 0)).alias("at_start"), F.min(F.array_min("befores")).alias("before_low"), F.max(F.array_max("befores")).alias("before_high"),
    )
    # where the integers before a run agree in all holders, the run before has the same alignments
    keys = shared_table(keys.where("low < high and (at_start or before_low < before_high)").select("key", "weight"), "keys")
    holders = maybe_in(posts, "key", keys).where("maybe").drop("maybe", "n_items").join(keys, "key").join(reps, "media_id")
    found = shared_table(best_alignments(holders, run_length, most_error, block), "alignments")
    top = found.groupBy("media_id").agg(F.max(F.struct("votes", (-F.col("other_id")).alias("o"), (-F.col("offset")).alias("p"), "compared", "bit_error")).alias("m"))

    resolved = shared_table(classes.join(top.withColumnRenamed("media_id", "rep_id"), "rep_id", "left"), "resolved")
    runs = F.col("n_items") - (run_length - 1)
    copy = F.struct(runs.alias("votes"), (-F.col("rep_id")).alias("o"), F.lit(0).alias("p"), F.col("n_items").alias("compared"), F.lit(0.0).alias("bit_error"))
    of_id = chosen.drop("n_items").join(resolved, "fingerprint_sha256")
    of_id = of_id.withColumn("m", F.when((F.col("media_id") == F.col("rep_id")) | F.coalesce(F.col("m.votes") == runs, F.lit(False)), F.col("m")).otherwise(copy)).where("m is not null")
    of_id = of_id.select(F.col("media_id").alias("of"), (-F.col("m.o")).alias("match_id"), (-F.col("m.p")).alias("offset"), "m.votes", "m.compared", "m.bit_error")
    return table.drop("items").join(of_id, F.col("media_id") == F.col("of"), "left").drop("of")
