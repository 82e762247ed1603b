import random
import zlib

import numpy as np

from parcelflow.llm.toxicity import EVENTS, GRAMMAR, Matcher, compose, fit_weights, score_toxicity

from .cases import SCHEMA, WORDS, documents


def run(machine, symbols):
    state, out = machine.start, []
    for s in symbols:
        state, o = machine.step(state, s)
        out.append(o)
    return out


def test_grammar_marks_scope_speech_and_target():
    assert run(GRAMMAR, "oIo") == ["o", "I", "o"]
    assert run(GRAMMAR, "NoI") == ["N", "o", "I-"]
    assert run(GRAMMAR, "NooooI")[-1] == "I"
    assert run(GRAMMAR, "RGoI")[-1] == "I'@"
    assert run(GRAMMAR, "ToG") == ["T", "o", ">T"]
    assert run(GRAMMAR, "GTI") == ["G", "T@", "I@"]
    assert {x for s in ("NRGI", "ITG", "RNTG") for x in run(GRAMMAR, s) if x[0] in "IT>"} <= set(EVENTS)


def test_composition_is_application_in_turn():
    from parcelflow.llm.toxicity import Machine, _negation, _reported

    rng = random.Random(1)
    a, b = Machine(0, _negation), Machine(False, _reported)
    for _ in range(200):
        symbols = [rng.choice("oITGNR") for _ in range(rng.randint(0, 12))]
        assert run(compose(a, b), symbols) == run(b, run(a, symbols))


def test_clauses_end_at_punctuation_and_documents():
    m = Matcher([], [b"grum"])
    raw = [b"You are an idiot.", b"not you, idiot", b"she said: you idiot", b"grumpel you", b"", b"idiots"]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    got = [dict(c) for c in m.documents(data, offsets)]
    assert got == [{"I@": 1}, {"I": 1}, {"I@": 1}, {"I": 1, ">I": 1}, {}, {"I": 1}]


def test_weights_separate():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 500).astype(float)
    x = np.stack([y + 0.1 * rng.standard_normal(500), rng.standard_normal(500)], 1)
    w = fit_weights(x, y)
    assert w[0] > 2 and abs(w[1]) < 1


def test_learned_words_stems_and_held_out(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(900):
        words = [rng.choice(WORDS) for _ in range(60)]
        toxic = rng.random() < 0.25
        for _ in range(3 * toxic):
            words[rng.randrange(60)] = rng.choice(["zorgh", "Stupid", "blarg" + rng.choice(WORDS)])
        rows.append((i, " ".join(words), *[None] * 7))
        labels.append((i, 1, int(toxic)))
    got = score_toxicity(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    truth = {k: t for k, _, t in labels}
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_cases(spark):
    rows = documents()
    docs = spark.createDataFrame(rows, SCHEMA)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(1, None, 1), (1, None, 0), (None, None, 1), (2, 1, None), (3, 0, 0)], "doc_id long, quality int, toxic int")
    for labels in (none, odd):
        got = score_toxicity(docs, labels)
        assert got.count() == len(rows) and got.where("score is null or score < 0 or score > 1").count() == 0
    assert score_toxicity(spark.createDataFrame([], SCHEMA), none).count() == 0
