import io
import wave
from collections import Counter

import numpy as np

from parcelflow.llm.fingerprints import FILTERS, MOST_ERROR, RUN, align_recordings, bit_error, chroma, fingerprint_media, packed_items, samples_of


def tune(seed, notes=40):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(notes):
        t = np.arange(700) / 8000
        out.append(sum(np.sin(2 * np.pi * 220 * 2 ** (rng.integers(0, 24) / 12) * t) for _ in range(2)) / 2)
    return (np.clip(np.concatenate(out) * 100 + 128, 0, 255)).astype(np.uint8).tobytes()


def as_wav(raw, width=1):
    f = io.BytesIO()
    with wave.open(f, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(width)
        w.setframerate(8000)
        x = np.frombuffer(raw, np.uint8)
        w.writeframes(raw if width == 1 else ((x.astype(np.int16) - 128) * 256).astype("<i2").tobytes())
    return f.getvalue()


def slow_items(image):
    """Rectangle sums one by one."""
    n, out = len(image), []
    for t in range(n):
        item = 0
        for shape, c, classes, frames in FILTERS:
            part = np.zeros((frames, classes))
            rows = image[t : t + frames, c : c + classes]
            part[: len(rows)] = rows
            h, w = frames // 2, classes // 2
            one = {"rows": part[:, :w], "columns": part[:h], "middle": part[frames // 4 : frames - frames // 4]}.get(shape)
            one = part[:h, :w].sum() + part[h:, w:].sum() if one is None else one.sum()
            value = np.log1p(one) - np.log1p(max(part.sum() - one, 0))
            level = sum(value > x for x in (-0.12, 0.0, 0.12))
            item = item << 2 | (level ^ level >> 1)
        out.append(item)
    return out


def test_integral_image_equals_plain_sums():
    image = chroma(samples_of(tune(1, 6)))
    a, b = packed_items(image), slow_items(image.astype(np.float64))
    assert sum(x != y for x, y in zip(a.tolist(), b)) <= len(b) // 50  # sums that fall on a threshold


def test_formats_agree():
    raw = tune(2)
    assert np.array_equal(packed_items(chroma(samples_of(raw))), packed_items(chroma(samples_of(as_wav(raw)))))
    assert bit_error(packed_items(chroma(samples_of(raw))), packed_items(chroma(samples_of(as_wav(raw, 2)))), 0)[0] < 0.01
    assert len(samples_of(as_wav(raw)[:30])) == 0 and len(samples_of(b"")) == 0


def test_bit_error():
    a = np.array([1, 2, 3, 4], np.uint32)
    assert bit_error(a, a, 0) == (0.0, 4) and bit_error(a, a[2:], 2) == (0.0, 2) and bit_error(a, a, 9) == (1.0, 0)
    assert bit_error(a, np.array([0], np.uint32), 0) == (1 / 32, 1)


def brute(prints):
    own = {}
    for k, v in sorted((p["media_id"], p["items"]) for p in prints if p["media_id"] is not None):
        own.setdefault(k, np.array(v, np.int32).view(np.uint32))
    first = {}
    for k in sorted(own):
        for i in range(len(own[k]) - RUN + 1):
            first.setdefault(tuple(own[k][i : i + RUN]), (k, i))
    out = {}
    for k in own:
        votes = Counter()
        for i in range(len(own[k]) - RUN + 1):
            o, p = first[tuple(own[k][i : i + RUN])]
            if o < k:
                votes[o, p - i] += 1
        best = {}
        for (o, off), n in votes.items():
            best[o] = max(best.get(o, (0, 0)), (n, -off))
        ok = []
        for o, (n, back) in best.items():
            error, compared = bit_error(own[o], own[k], -back)
            if error <= MOST_ERROR:
                ok.append((n, -o, back, compared, error))
        out[k] = max(ok, default=None)
    return out


def test_alignment_equals_brute_force_and_finds_excerpts(spark):
    rows = [(1, tune(1)), (2, tune(2)), (3, tune(1)), (4, tune(3) + tune(1)), (5, tune(2)[128 * 40 :]), (6, None), (7, b""), (None, tune(1)), (8, b"short"), (3, tune(1)), (9, as_wav(tune(2)))]
    prints = fingerprint_media(spark.createDataFrame(rows, "media_id long, content binary"))
    got = align_recordings(prints).collect()
    assert len(got) == len(rows)
    want = brute(prints.collect())
    for r in got:
        if r["media_id"] is not None and want[r["media_id"]]:
            n, o, back, compared, error = want[r["media_id"]]
            assert (r["votes"], r["match_id"], r["offset"], r["compared"]) == (n, -o, -back, compared) and abs(r["bit_error"] - error) < 1e-12
        else:
            assert r["match_id"] is None
    by = {r["media_id"]: r for r in got}
    assert by[3]["match_id"] == 1 and by[3]["offset"] == 0 and by[3]["bit_error"] == 0
    assert by[5]["match_id"] == 2 and by[5]["offset"] == 40
    assert by[9]["match_id"] == 2
    assert by[1]["match_id"] is None and by[6]["n_items"] == 0


def test_empty(spark):
    assert align_recordings(fingerprint_media(spark.createDataFrame([], "media_id long, content binary"))).count() == 0


def every_pair(prints):
    """Each recording against each earlier one at each offset."""
    own = {}
    for p in prints:
        own[p["media_id"]] = np.array(p["items"], np.int32).view(np.uint32)
    out = {}
    for k, x in own.items():
        ok = []
        for o, y in own.items():
            for offset in range(-len(x), len(y)) if o < k else ():
                votes = sum(0 <= i + offset and i + offset + RUN <= len(y) and np.array_equal(x[i : i + RUN], y[i + offset : i + offset + RUN]) for i in range(len(x) - RUN + 1))
                error, n = bit_error(y, x, offset)
                if votes and error <= MOST_ERROR:
                    ok.append((votes, -o, -offset, n, error))
        out[k] = max(ok, default=None)
    return out


def printed(spark, items):
    import hashlib

    rows = [(k, len(v) * 128, len(v), np.array(v, np.uint32).view(np.int32).tolist(), hashlib.sha256(np.array(v, "<u4").tobytes()).hexdigest()) for k, v in items.items()]
    return spark.createDataFrame(rows, "media_id long, n_samples long, n_items long, items array<int>, fingerprint_sha256 string")


def test_every_holder_of_a_run_is_compared(spark):
    rng = np.random.default_rng(5)
    s, x, y, z, u = (rng.integers(0, 1 << 32, n).tolist() for n in (20, 12, 12, 20, 20))
    hush = [7] * 9
    near = [v ^ 1 if i % 5 == 0 else v for i, v in enumerate(s)]
    # many votes where the bits differ, fewer where they agree
    apart = s[:8] + [v ^ 0xFFFFFFFF for v in s[:8]] + z
    items = {1: s[:12] + x, 2: y + s[8:], 3: hush + z, 4: hush + u, 5: hush + z[:10] + hush, 8: s, 9: s, 10: near, 11: near, 12: apart, 13: apart[8:16] + apart[:2] + u, 14: [7], 15: [7], 16: hush[:5], 17: hush[:5], 18: u + hush + s}
    prints = printed(spark, items)
    want = every_pair(prints.collect())
    for block in (1 << 16, 64):
        for r in align_recordings(prints, block=block).collect():
            got = None if r["match_id"] is None else (r["votes"], -r["match_id"], -r["offset"], r["compared"], r["bit_error"])
            assert got == want[r["media_id"]], (block, r, want[r["media_id"]])
            if r["media_id"] == 9:
                assert (r["match_id"], r["offset"], r["bit_error"]) == (8, 0, 0)
