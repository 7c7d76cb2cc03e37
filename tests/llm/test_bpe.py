import hashlib

import numpy as np
import public_tokenizers as P
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from linkloom.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.read_ranks(PATH)
KNOWN = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
pieces = st.lists(st.one_of(st.text(max_size=6), st.sampled_from([" ", "  ", "\n", "\t", " the", "'s", "123", "é", "\x1c", "　", "▁", "<|endoftext|>"])), max_size=12).map("".join)


@settings(max_examples=500, deadline=None)
@given(pieces)
def test_equals_the_library(text):
    own = bpe.codec(PATH, P.PATTERN)
    ids = own.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == KNOWN.encode_ordinary(text)
    assert own.decode(ids) == text.encode()


def test_long_runs():
    own = bpe.codec(PATH, P.PATTERN)
    for text in ("ab" * 30000, "a" * 60000, " " * 50000 + "x", "é" * 20000):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == KNOWN.encode_ordinary(text)


def test_cache_may_be_cleared(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    own = bpe.Codec(RANKS, P.PATTERN)
    for text in ("one two three four five six", "six five four", "one two three four five six") * 3:
        assert np.frombuffer(own.encode(text), "<u4").tolist() == KNOWN.encode_ordinary(text)


def test_columns(spark):
    rows = [(1, "one two", "x"), (1, "one two", "x"), (2, None, "x"), (3, "", None), (None, "é", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.digests(df, PATH, P.PATTERN).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id in (2, 3):
            assert r.n_tokens == 0 and r.ids_sha256 == r.decoded_sha256 == hashlib.sha256(b"").hexdigest()
        if r.doc_id == 1:
            ids = KNOWN.encode_ordinary("one two")
            assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(b"one two").hexdigest()
    assert bpe.digests(df.limit(0), PATH, P.PATTERN).count() == 0
