import collections
import random
import re
import zlib

from parcelflow.llm.spelling import spelling_variants

from .cases import SCHEMA, documents


def edited(rng, word, letters):
    at = rng.randrange(len(word))
    return rng.choice([word[:at] + word[at + 1 :], word[:at] + rng.choice(letters) + word[at:], word[:at] + rng.choice(letters) + word[at + 1 :]])


def table():
    rng = random.Random(3)
    letters = "abcdéßÉÿ"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 9))) for _ in range(12)] + ["aaaaaa", "aaabaaa", "ab" * 33, "a" * 64, "a" * 65, "abcé" * 200]
    words = collections.Counter()
    for w in base:
        words[w] += rng.choice([5, 30, 300])
        for _ in range(8):
            v = edited(rng, w, letters)
            words[v] += rng.choice([1, 5, 6, 30])
            words[edited(rng, v, letters)] += rng.choice([5, 6])
    words["abc" * 1000] += 6
    words["abc" * 1000 + "d"] += 40
    runs = [w if rng.random() < 0.5 else w.upper() if w.isascii() else w for w, n in words.items() for _ in range(n)]
    rng.shuffle(runs)
    texts = [" ,1-"[rng.randrange(4)].join(runs[k : k + 25]) for k in range(0, len(runs), 25)]
    rows = [(k * 7 + 1, t, *[None] * 7) for k, t in enumerate(texts)]
    return documents(seed=9) + rows + rows[:3] + [(None, texts[5], *[None] * 7), (99, "word×÷ĀЖ" * 3, *[None] * 7)]


def expected(rows, noise=199):
    counts = collections.Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % noise == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}

    def near(a, b):
        a, b = sorted((a, b), key=len)
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    close = {w: [x for x in words if abs(len(x) - len(w)) < 2 and near(w, x)] for w in words}
    form = {w: min(close[w], key=lambda x: (-words[x], x), default=None) for w in words}
    form = {w: f if f and words[f] >= 5 * words[w] else None for w, f in form.items()}

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted(((w, f, root(w), words[w], len(close[w]), words.get(f)) for w, f in form.items()), key=str)


def test_variants_equal_comparing_all_pairs(spark):
    rows = table()
    want = expected(rows)
    assert sum(r[1] is not None for r in want) > 20 and any(r[2] != (r[1] or r[0]) for r in want) and any(len(r[0]) > 700 and r[4] for r in want)
    got = spelling_variants(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=str) == want


def test_every_tenth_run_damaged_and_counts_handed_on_early(spark, monkeypatch):
    rows = table()
    got = spelling_variants(spark.createDataFrame(rows, SCHEMA), noise=10).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows, 10)


def test_nothing_to_compare(spark):
    assert spelling_variants(spark.createDataFrame([], SCHEMA)).count() == 0
    odd = spark.createDataFrame([(1, "letters " * 6, 2, 3)], "`my id` long, `te.xt` string, word int, `a.b` int")
    assert [tuple(r) for r in spelling_variants(odd, "my id", "`te.xt`", noise=10**9).collect()] == [("letters", None, "letters", 6, 0, None)]
