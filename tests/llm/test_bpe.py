import hashlib
import struct

import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from parcelflow.llm.bpe import Utf8Stream, codec, encode_documents
from parcelflow.llm.packing import encoder

from .cases import SCHEMA, documents

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text("abcdethionrs 's\n\t09é中😀", max_size=80))
def test_ids_are_tiktokens_and_round_trip(text):
    own, other = codec(PATH), encoder(PATH)
    assert isinstance(other, tiktoken.Encoding)
    ids = own.encode(text)
    assert ids == other.encode_ordinary(text)
    assert "".join(own.decode(iter(ids), 2)) == text


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=30), st.integers(1, 4))
def test_streaming_decode_equals_whole_decode(raw, size):
    stream = Utf8Stream()
    out = "".join(stream.feed(raw[i : i + size]) for i in range(0, len(raw), size)) + stream.feed(b"", final=True)
    assert out == raw.decode("utf-8", "replace")


def test_documents(spark):
    rows = documents()
    want = []
    for r in rows:
        ids = encoder(PATH).encode_ordinary(r[1] or "")
        want.append((r[0], len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()))
    got = encode_documents(spark.createDataFrame(rows, SCHEMA))
    assert sorted(repr(tuple(r)) for r in got.collect()) == sorted(map(repr, want))
    assert encode_documents(spark.createDataFrame(rows, SCHEMA), with_ids=True).where("size(ids) <> n_tokens").count() == 0
    assert encode_documents(spark.createDataFrame([], SCHEMA)).count() == 0
