import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sluiceway.llm import queries, token_store

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
SPACES = [" ", "  ", "\n", "\t", " \n", " ", "　", "᠎", "\x1c", "\x85", " "]


def plain(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0]


def expected(docs):
    out, start = [], 0
    for key, text in docs:
        ids = plain(text)
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1]))


def test_query_equals_the_library_on_whole_texts(spark, sf):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    got = queries.QUERIES["op11_token_store"](spark, sf)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert order(map(tuple, got.collect())) == expected(docs)


@pytest.fixture(scope="module")
def encoder():
    return token_store.ChunkEncoder(PATH, 0)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([*SPACES, "a", "Été", "don't", "1234", "<|endoftext|>", "<|endof", "text|>", "'s", "😀", "..."]), st.text(max_size=4)), max_size=14).map("".join))
def test_chunks_equal_whole_texts(encoder, text):
    assert np.frombuffer(encoder([text])[0], "<u2").tolist() == plain(text)


def test_chunks_equal_whole_texts_for_every_code_point(encoder):
    points = [c for c in range(1, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    text = "".join(f"a{chr(c)} {chr(c)}b {chr(c)} " for c in points)
    assert np.frombuffer(encoder([text])[0], "<u2").tolist() == plain(text)


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000])
def test_hash_is_minimal_and_perfect(n):
    digests = np.random.default_rng(n).integers(0, 256, 16 * n, dtype=np.uint8)
    numbers = token_store.PerfectHash(token_store.build_levels(digests))(digests) if n else np.zeros(0)
    assert sorted(numbers) == list(range(n))
    places = np.arange(n, dtype=np.int64) * 7
    part = token_store.IndexPart(token_store.pack_index(digests, places, places + 1))
    first, last = part(digests)
    assert (first == places).all() and (last == places + 1).all()
    other = np.random.default_rng(n + 1).integers(0, 256, 16 * 500, dtype=np.uint8)
    assert (part(other)[0] == -1).all()


def test_many_shards_repeated_null_and_unknown_keys(spark, tmp_path):
    """One key holds a third of all rows and spreads over many shards; a null key; an empty and a null text; a long one."""
    rows = [(k % 40 if k % 3 else 77, f"text {k} " + "word " * (k % 50)) for k in range(1500)]
    rows += [(None, "no key"), (None, None), (100, ""), (101, None), (102, "long " * 60_000), (-5, "first")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).sortWithinPartitions("doc_id", "text")
    folder = f"file://{tmp_path}/store"
    token_store.write_store(df, folder, PATH, range_bytes=20_000, shard_ids=300, shard_docs=40, index_keys=16)
    got = order((r.doc_id, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in token_store.read_documents(df.select("doc_id"), folder).collect())
    assert len(got) == len(rows)
    at = 0
    for _, start, ids in got:
        assert start == at
        at += len(ids)
    by_key = lambda pairs: sorted(pairs, key=lambda p: (p[0] is not None, p[0], p[1]))
    assert by_key((k, ids) for k, _, ids in got) == by_key((k, plain(t)) for k, t in rows)
    assert [g[0] for g in got] == sorted((k for k, _ in rows), key=lambda k: (k is not None, k))
    store = token_store.TokenStore(folder)
    assert store.about["documents"] == len(rows) and store.about["keys"] == len({k for k, _ in rows})
    for key in {k for k, _ in rows}:
        assert [ids.tolist() for ids in store.get(key)] == [ids for k, _, ids in got if k == key]
    assert list(store.get(999)) == [] and list(store.get("x")) == []
    some = spark.createDataFrame([(77,), (77,), (5,), (12345,)], "doc_id long")
    assert token_store.read_documents(some, folder).count() == sum(k in (77, 5) for k, _ in rows)
    with pytest.raises(Exception):  # a store is not written over
        token_store.write_store(df, folder, PATH)


def test_text_keys_and_odd_rows(odd, odd_rows, empty, tmp_path):
    got = token_store.token_digests(odd, f"file://{tmp_path}/a", PATH)
    sizes = sorted((r[0] is not None, r[0], len(plain(r[1]))) for r in odd_rows)
    assert sorted((r.doc_id is not None, r.doc_id, r.n_tokens) for r in got.collect()) == sizes
    assert token_store.token_digests(empty, f"file://{tmp_path}/b", PATH).collect() == []
    named = odd.selectExpr("concat('k-', coalesce(doc_id, 0)) as part", "text as begin", "lang as ids", "score as shard")
    assert token_store.token_digests(named, f"file://{tmp_path}/c", PATH, key="part", text="begin").count() == len(odd_rows)
