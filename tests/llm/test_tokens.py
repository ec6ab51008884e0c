from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lotline.llm.tokens import PATTERN, Encoder, StreamDecoder, Utf8Stream, count_tokens, decode_ids, encode_documents, vocabulary

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def enc():
    return Encoder(vocabulary())


@pytest.fixture(scope="module")
def ref(enc):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=enc.fst.ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_any_text(enc, ref, text):
    ids = list(enc.encode(text))
    assert ids == ref.encode_ordinary(text)
    d = StreamDecoder(enc.fst.bytes_of)
    assert "".join(map(d.push, ids)) + d.end() == text


@pytest.mark.parametrize("text", ["", " ", "\n\n  x", "a" * 3000, "=-" * 2000, "<|endoftext|>", "don't 'S 'll", "x\x1cy\x1f \x85z", "房东说大门已经坏了", "ab" * 50 + "\U0001f600" * 9, "thethethe" * 300])
def test_hard_texts(enc, ref, text):
    assert list(enc.encode(text)) == ref.encode_ordinary(text)


def test_transducer_alone(enc, ref):
    rng = random.Random(2)
    for _ in range(300):
        piece = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(1, 40)))
        assert list(enc.fst.encode_piece(piece.encode())) == ref.encode_ordinary(piece)


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=24), st.integers(1, 5))
def test_utf8_machine(data, step):
    u = Utf8Stream()
    assert "".join(u.feed(data[k : k + step]) for k in range(0, len(data), step)) + u.end() == data.decode("utf-8", "replace")


def test_documents(spark, ref):
    rows = [(1, "No heat. Привет 👋", "a"), (2, None, "b"), (3, "", "c"), (4, "x y " * 20000, "d"), (1, "No heat. Привет 👋", "a")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")  # a column that clashes
    got = encode_documents(df, "doc_id", "text", vocabulary())
    assert sorted((r.doc_id, list(r.ids)) for r in got.collect()) == sorted((k, ref.encode_ordinary(t or "")) for k, t, _ in rows)
    back = {r.doc_id: r.text for r in decode_ids(got, "doc_id", "ids", vocabulary()).collect()}
    assert back == {k: t or "" for k, t, _ in rows}
    n = {r.doc_id: r.n_tokens for r in count_tokens(df.select("doc_id", "text"), "text", vocabulary()).collect()}
    assert n == {k: len(ref.encode_ordinary(t or "")) for k, t, _ in rows}
    assert encode_documents(df.limit(0), "doc_id", "text", vocabulary()).count() == 0


def test_long_pieces_keep_few_states(monkeypatch):
    """A piece without end fills no table without end, and its ids stay those of the definition."""
    import random

    from lotline.llm import tokens as T

    fst = T.encoder(T.vocabulary()).fst
    rng = random.Random(1)
    piece = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(4000)).encode()
    want = fst.merge(piece)
    monkeypatch.setattr(T, "MAX_ARCS", 50)
    small = T.BpeTransducer(fst.ranks)
    assert list(small.encode_piece(piece)) == want
    assert len(small._arcs) <= 52 and len(small._states) <= 60
