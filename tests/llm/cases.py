"""Documents for the tests: nulls, empty and very long texts, ties, repeated rows, copies, passages, clashing columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, row string, component_id string, n int"


def prose(rng, n, words=400):
    return " ".join(rng.choice(WORDS) for _ in range(n))


_rng = random.Random(5)
WORDS = ["".join(_rng.choice(["an", "the", "or", "in", "é", "ß", "st", "tion"]) for _ in range(_rng.randint(1, 4))) for _ in range(600)]


def documents(seed=1, n=60):
    rng = random.Random(seed)
    texts = [None, "", "   \t\n", "one", "ONE", "one two three", "one  two\tthree", "!!! 123", "a b c d e", "a b c d e f"]
    passage = prose(rng, 130)
    for i in range(n):
        base = prose(rng, rng.randint(1, 250))
        kind = i % 6
        if kind == 1:
            base = base + " " + passage + " " + prose(rng, 20)
        if kind == 2 and len(texts) > 20:
            base = texts[-3]
        if kind == 3 and len(texts) > 20:
            w = (texts[-2] or "x").split()
            w[len(w) // 2 :: 40] = ["edit"] * len(w[len(w) // 2 :: 40])
            base = " ".join(w)
        if kind == 4:
            base = "ab cd " * rng.randint(1, 300)
        texts.append(base)
    texts.append("y" * 1000 + passage + "z" * 3000)
    texts.append("long " + prose(rng, 6000))
    rows = [(i + 1, t, ["en", "de", None][i % 3], f"s{i % 2}", len(t or ""), "x", "y", "z", 7) for i, t in enumerate(texts)]
    rows += [rows[15], rows[15], (None, texts[20], "en", None, None, None, None, None, None), (None, texts[20], None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    rng.shuffle(rows)
    return rows
