import random
import zlib

import numpy as np

from parcelflow.llm.langid import SEGMENT, Network, identify_languages, keep_identified, train_network

from .cases import SCHEMA, documents

SYLLABLES = {"aa": ["ka", "lo", "mi", "te"], "bb": ["xz", "qu", "wy", "ju"], "cc": ["né", "ßa", "öl", "ço"]}


def corpus(n=300):
    rng = random.Random(2)
    return [(i, " ".join("".join(rng.choice(SYLLABLES[k]) for _ in range(3)) for _ in range(rng.randint(3, 60))), k, None, None, None, None, None, None) for i in range(n) for k in [rng.choice(list(SYLLABLES))]]


def test_gradients_are_those_of_the_loss():
    net = Network(3, hidden=3, seed=1)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    rng = np.random.default_rng(0)
    text, label = rng.integers(0, 256, (4, 7)), rng.integers(0, 3, 4)
    loss, grad = net.gradients(text, label)
    for k, g in grad.items():
        places = [tuple(rng.integers(0, s) for s in g.shape) for _ in range(4)] + [tuple(x[0] for x in np.nonzero(g))]
        for at in places:
            old, e = net.weights[k][at], 1e-5
            net.weights[k][at] = old + e
            up = net.gradients(text, label)[0]
            net.weights[k][at] = old - e
            down = net.gradients(text, label)[0]
            net.weights[k][at] = old
            assert abs((up - down) / (2 * e) - g[at]) < 1e-6, k


def test_every_byte_counts_once():
    net = Network(4, seed=5)
    rng = np.random.default_rng(1)
    size = np.array([0, 5, 64, 65, 300])
    data = rng.integers(1, 255, size.sum()).astype(np.uint8)
    offsets = np.concatenate([[0], np.cumsum(size)])
    p = net.of_documents(data, offsets, segment=64, together=3)
    assert np.isnan(p[0]).all()
    for d in range(1, 5):
        text = data[offsets[d] : offsets[d + 1]]
        want = np.concatenate([net.probabilities(text[None, i : i + 64].astype(np.int64))[:, :, 0] for i in range(0, len(text), 64)]).mean(0)
        assert np.allclose(p[d], want, atol=1e-5)


def test_held_out_accuracy(spark):
    rows = corpus()
    got = {r["doc_id"]: r for r in identify_languages(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == len(rows)
    assert all(got[r[0]]["held_out"] == (zlib.crc32(str(r[0]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if got[r[0]]["held_out"]]
    assert sum(got[r[0]]["lang_pred"] == r[2] for r in held) >= 0.97 * len(held)


def test_cases(spark):
    rows = documents()
    got = identify_languages(spark.createDataFrame(rows, SCHEMA))
    assert got.count() == len(rows)
    letters = lambda t: any(c.isalpha() for c in t or "")
    assert got.where("lang_pred = 'und'").count() == sum(not letters(r[1]) for r in rows)
    kept = keep_identified(spark.createDataFrame(rows, SCHEMA))
    assert kept.count() == sum(letters(r[1]) for r in rows) and kept.columns[1] == "text"
    assert identify_languages(spark.createDataFrame([], SCHEMA)).count() == 0


def by_hand(net, text):
    """Mean probabilities of a text, one byte, unit and direction after another."""
    raw, w, n = text.encode(), net.weights, net.hidden
    total = np.zeros(net.classes)
    for i in range(0, len(raw), SEGMENT):
        part = raw[i : i + SEGMENT]
        states = np.zeros((len(part), 2 * n))
        for k, (d, places) in enumerate((("f", range(len(part))), ("b", range(len(part) - 1, -1, -1)))):
            h = np.zeros(n)
            for t in places:
                x, g = w[f"x{d}"][:, part[t]].astype(float), w[f"u{d}"].astype(float) @ h
                update, reset = 1 / (1 + np.exp(-x[:n] - g[:n])), 1 / (1 + np.exp(-x[n : 2 * n] - g[n : 2 * n]))
                h = update * h + (1 - update) * np.tanh(x[2 * n :] + reset * (g[2 * n :] + w[f"c{d}"][:, 0]))
                states[t, k * n : (k + 1) * n] = h
        for s in states:
            e = np.exp(w["o"] @ s + w["p"][:, 0])
            total += e / e.sum()
    return total / len(raw)


def test_equals_brute_force(spark):
    rows = corpus(80) + [(900, "né" * 700 + " ka lo", None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    langs, net = train_network(docs.select("doc_id", "text", "lang"))
    got = {r["doc_id"]: r for r in identify_languages(docs).collect()}
    for r in rows:
        p = by_hand(net, r[1])
        best = int(p[:-1].argmax())
        assert got[r[0]]["lang_pred"] == langs[best]
        assert abs(got[r[0]]["score"] - p[best] / p[:-1].sum()) < 1e-3 and abs(got[r[0]]["none_share"] - p[-1]) < 1e-3


def test_texts_of_no_language_go(spark):
    rng = random.Random(8)
    junk = ["".join(rng.choice("bcdfghjklmnpqrstvwxyz ") for _ in range(400)), "Это совсем другой язык и его никто не учил " * 5, "日本語の文章です" * 20]
    rows = corpus() + [(1000 + i, t, None, None, None, None, None, None, None) for i, t in enumerate(junk)]
    kept = {r["doc_id"] for r in keep_identified(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert kept == {r[0] for r in rows if r[0] < 1000}


def test_languages_are_not_capped(spark, monkeypatch):
    monkeypatch.setattr(Network, "train", lambda *_: 0.0)
    rows = [(i, f"text number {i} " * 3, f"l{i}", None, None, None, None, None, None) for i in range(1300)]
    langs, _ = train_network(spark.createDataFrame(rows, SCHEMA).select("doc_id", "text", "lang"), documents=1300)
    assert len(langs) > 1000
