import re

import pytest

import corpus_pipeline
from parcelflow.llm import exact_dedup, langid, minhash
from parcelflow.llm.packing import encoder

from . import test_minhash, test_suffix_dedup
from .cases import documents

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(seed=3):
    return [r[:5] for r in documents(seed) if r[0] is not None][: -2 if seed else None]


def brute(rows, kept_by_language):
    """The rows after all stages but the first and last, which have tests of their own."""
    rows = [r for r in rows if r[0] in kept_by_language]
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t)
    least = {}
    for r in sorted(rows):
        least.setdefault(norm(r[1]), r[0])
    rows = [r for r in rows if least[norm(r[1])] == r[0]]
    kept = {eval(x)[0] for x in test_minhash.brute(rows, corpus_pipeline.NEAR_PERCENT) if eval(x)[3]}
    rows = [r for r in rows if r[0] in kept]
    raw = [r[1].encode() for r in rows]
    seen, n = {}, corpus_pipeline.REPEAT_BYTES
    for t in raw:
        for i in range(len(t) - n + 1):
            seen[t[i : i + n]] = seen.get(t[i : i + n], 0) + 1
    out = {}
    for r, t in zip(rows, raw):
        gone = bytearray(len(t))
        for i in range(len(t) - n + 1):
            if seen[t[i : i + n]] > 1:
                gone[i : i + n] = b"\1" * n
        out[r[0]] = bytes(b for b, g in zip(t, gone) if not g).decode("utf-8", "ignore")
    return out


@pytest.mark.parametrize("seed", [3, 4])
def test_run_equals_brute_force(spark, tmp_path, seed):
    rows = list({r[0]: r for r in rows_of(seed)}.values())
    docs = spark.createDataFrame(rows, COLUMNS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    by_language = {r["doc_id"] for r in langid.keep_identified(docs).collect()}
    assert all(any(c.isalpha() for c in r[1] or "") for r in rows if r[0] in by_language)
    want = brute(rows, by_language)
    got = {}
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    import public_tokenizers

    encode = encoder(public_tokenizers.path("byte_bpe_50k.tiktoken")).encode_ordinary
    assert got == {k: len(encode(t)) + 1 for k, t in want.items()}


def test_stages_keep_columns_and_take_odd_tables(spark):
    odd = documents(5)
    names = [x.split()[0] for x in test_suffix_dedup.SCHEMA.split(", ")]
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, test_suffix_dedup.SCHEMA)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, "")
            assert docs.columns == names
        assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() >= len(rows) // 4


def test_a_passage_of_51_words_stands_once_at_most(spark):
    words = [f"{a}{b}" for a in ("and", "the", "for", "bus", "car") for b in ("", "s", "er", "ly", "en", "al", "ic", "us", "ed", "or", "ing")]
    passage = " ".join(words[:51])
    assert len(passage.encode()) < 400
    rows = [(1, "alpha beta " * 3 + "x" * 90 + " " + passage + " " + "tail one " * 5, "en", "a", 1), (2, "quite other words " * 9 + passage, "en", "a", 1), (3, "nothing in common here " * 2, "en", "a", 1)]
    docs = spark.createDataFrame(rows, COLUMNS)
    out = {r["doc_id"]: r["text"] for r in corpus_pipeline.repeated_strings(spark, docs, "").collect()}
    assert passage not in out[1] and passage not in out[2] and out[3] == rows[2][1]


CLASHING = "doc_id long, text string, lang string, __text string, __key string, __row string, __maybe string, __gone string, __lang string, __score string, __spans string, maybe string, Row string, `key` string, spans string, whole string, place string, text_sha256 string, keep_id string"


def test_rows_are_told_apart_by_id_and_text_whatever_their_columns(spark):
    """A text that no other row holds stays, even if its id comes again with a text that goes."""
    many = " ".join(f"word{i}" for i in range(60)) + " "
    texts = [(1, "alpha text one"), (1, "beta text"), (0, "beta text"), (None, "beta text"), (None, "gamma text"), (7, many + "a b c d"), (5, many), (7, "delta"), (7, None), (6, None), (8, "")]
    rows = [(i, t, "en", *"abcdefghijklmnop") for i, t in texts]
    docs = spark.createDataFrame(rows, CLASHING)
    for _, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, docs, "").columns == docs.columns
    exact = [(r["doc_id"], r["text"]) for r in corpus_pipeline.exact_copies(spark, docs, "").collect()]
    assert sorted(map(repr, exact)) == sorted(map(repr, [(1, "alpha text one"), (0, "beta text"), (None, "gamma text"), (7, many + "a b c d"), (5, many), (7, "delta"), (6, None)]))
    by_shuffle = exact_dedup.drop_exact_copies(docs, broadcast_groups=0).collect()
    assert sorted(map(repr, ((r["doc_id"], r["text"]) for r in by_shuffle))) == sorted(map(repr, exact))
    near = [(r["doc_id"], r["text"]) for r in minhash.drop_near_copies(docs, 80).collect()]
    gone = [(1, "beta text"), (7, many + "a b c d")]
    assert sorted(map(repr, near)) == sorted(repr(x) for x in texts if x not in gone)


def test_names_with_dots_blanks_and_quotes(spark):
    many = " ".join(f"word{i}" for i in range(60)) + " "
    rows = [(1, many + "a b c d", "en", 1, 2, 3, 4), (2, many, "en", 5, 6, 7, 8), (3, "other text", "en", 9, 10, 11, 12), (3, "other text", "en", 9, 10, 11, 13), (4, "123", "en", 0, 0, 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, `a.b` int, `c``d` int, `e f` int, `text.x` int")
    kept = []
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        kept.append(sorted((r[0], *r[3:]) for r in out.collect()))
    whole = sorted((r[0], *r[3:]) for r in rows)
    assert kept == [whole[:-1], whole, [whole[0], *whole[2:]], whole]
