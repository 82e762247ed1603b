import collections

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from parcelflow.llm.token_counts import LIMIT, longest_prefixes, prefix_counter, prefix_counts, token_counts, tokens_at

from .cases import SCHEMA, documents

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = "abcdethionrsABC'<|>!? \t\n09\u00e9\u00c9\u00df\u0130\u03a3\u03c3\u4e2d\U0001f600\u0301\u0308\u1100\u1161\u11a8\x1c\ufb01\u212b\u2003\u3000\x85q"
PARTS = st.lists(st.sampled_from([*ODD, "<|endoftext|>", "<|startoftext|>", "'re", "'ll", "the", "ing", "e\u0301"]), max_size=12).map("".join)


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def n_tokens(text):
    return len(library.kept.encode(text, add_special_tokens=False).ids)


library.kept = library()


@settings(max_examples=400, deadline=None)
@given(PARTS | st.text(max_size=20))
def test_every_prefix_counts_as_if_encoded_by_itself(text):
    assert prefix_counter(PATH).counts(text).tolist() == [n_tokens(text[: i + 1]) for i in range(len(text))]


def test_long_words_and_rows_forgotten(monkeypatch):
    from parcelflow.llm import token_counts as module

    monkeypatch.setattr(module, "ROWS", 50)
    own = module.PrefixCounter(PATH)
    texts = ["y" * 3000, "ing" * 700, "e\u0301" * 300, "\u1100\u1161" * 200, "thouingble " * 300, "!" * 500, "x\u0301\u0301" * 40]
    for text in texts * 2:
        got = own.counts(text).tolist()
        assert len(got) == len(text)
        for i in {0, 1, 2, len(text) // 2, len(text) // 2 + 1, len(text) - 2, len(text) - 1}:
            assert got[i] == n_tokens(text[: i + 1]), (text[:10], i)


@pytest.fixture(scope="module")
def rows():
    extra = [(7000, "<|endoftext|> x <|end", *[None] * 7), (7001, "A" * 40_000, *[None] * 7), (7002, "e\u0301 " * 5000, *[None] * 7), (7003, "word " * 500_000, *[None] * 7)]
    return documents() + extra


def test_counts_and_questions(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    table = prefix_counts(docs, block=1000).cache()
    want = [(r[0], len((r[1] or "").encode()), n := n_tokens(r[1] or ""), n > LIMIT) for r in rows]
    assert sorted(map(repr, map(tuple, token_counts(table).collect()))) == sorted(map(repr, want))

    texts = collections.defaultdict(set)
    for r in rows:
        texts[r[0]].add(r[1] or "")
    prefix = {t: [0, *prefix_counter(PATH).counts(t).tolist()] for s in texts.values() for t in s}
    for budget in (0, 1, 7, 300):
        got = collections.Counter((r["doc_id"], r["n_chars"], r["n_tokens"]) for r in longest_prefixes(table, budget).collect())
        fits = {t: max(i for i, n in enumerate(p) if n <= budget) for t, p in prefix.items()}
        want = collections.Counter((d, fits[t], prefix[t][fits[t]]) for d, s in texts.items() for t in s)
        assert got == want

    asked = [(d, n) for d, s in texts.items() for t in s for n in {0, 1, len(t) // 2, len(t), len(t) + 1, 1000, 1001}] + [(-5, 3)]
    got = collections.Counter(map(tuple, tokens_at(table, spark.createDataFrame(asked, "doc_id long, n_chars int"), block=1000).collect()))
    want = collections.Counter()
    for d, n in asked:
        held = [prefix[t] for t in texts[d] if n <= max(1, -(-len(t) // 1000)) * 1000] if d is not None and d in texts else []
        for p in held or [None]:
            want[d, n, None if p is None or n >= len(p) else p[n]] += 1
    assert got == want


def test_empty_table_and_odd_columns(spark):
    assert token_counts(prefix_counts(spark.createDataFrame([], SCHEMA))).count() == 0
    odd = spark.createDataFrame([(1, "one two", 3, 4, 5)], "`my id` long, `te.xt` string, row int, counts int, `a.b` int")
    got = token_counts(prefix_counts(odd, id_col="my id", text_col="`te.xt`")).collect()
    assert [tuple(r) for r in got] == [(1, 7, 2, False)]
