import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sluiceway.llm import bpe, queries

CODEC = bpe.Codec(queries.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    own = Tokenizer.from_file(queries.VOCABULARY)
    own.no_truncation()
    own.no_padding()
    return own


LIBRARY = Tokenizer.from_file(queries.VOCABULARY)


def same(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    n, ids, decoded = CODEC.digest(text)
    assert ids == " ".join(map(str, want)) and n == len(want)
    assert decoded == LIBRARY.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["", " ", "it's DON'T we'LL", "ΣΑΣ İstanbul ﬁ é", "a\x1cb\x85c​d", "x<|endoftext|>y <|startoftext|>", "aaaaaaaa ababab ......", "日本語😀", "1234", "th" * 300])
def test_equals_library(text):
    same(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcdeéistnoruh '.,!?-AZ09ß\n "), max_size=40))
def test_equals_library_on_any_text(text):
    same(text)


def test_caches_change_nothing():
    small = bpe.Codec(queries.VOCABULARY, words=2, cached_chunks=2)
    text = "the quick brown fox, the quick; brown. fox " * 5
    assert small.encode(text) == CODEC.encode(text)


def test_query_equals_library(spark, sf, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.QUERIES["op6_bpe"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_odd_rows(odd, odd_rows, empty):
    rows = bpe.encode(odd, queries.VOCABULARY).collect()
    assert len(rows) == len(odd_rows) and all(r.n_tokens == 0 and r.ids == "" for r in rows if r.doc_id in (3, 4, 6))
    decoded = bpe.decode(bpe.encode(odd, queries.VOCABULARY), queries.VOCABULARY)
    by_id = {r.doc_id: r.decoded for r in decoded.collect()}
    assert by_id[3] == "" and by_id[7] == "one</w> two</w>"
    assert bpe.round_trip(empty, queries.VOCABULARY).count() == 0
