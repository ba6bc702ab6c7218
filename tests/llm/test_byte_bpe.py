from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimforge.llm import byte_bpe


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.mark.parametrize("block_chars", [1 << 25, 50])
def test_ids_and_bytes_of_odd_texts(spark, odd, ranks, block_chars):
    whole = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = byte_bpe.decode(byte_bpe.encode(odd, ranks, public_tokenizers.PATTERN, block_chars), ranks).collect()
    expected = [(r.doc_id, r.text or "") for r in odd.collect()]
    ids = lambda text: np.array(whole.encode_ordinary(text), "<u4").tobytes()
    assert sorted(((r.doc_id or 0), bytes(r.ids)) for r in found) == sorted((i or 0, ids(t)) for i, t in expected)
    assert sorted(bytes(r.decoded) for r in found) == sorted(t.encode() for _, t in expected)
    assert all(r.n_tokens == len(r.ids) // 4 for r in found)


def test_many_blocks_in_a_partition(spark, documents, ranks):
    """More blocks than block numbers once had room for: no text gets another's words."""
    docs = documents([(i, f"text {i} of {i * 7919 % 6007} é{i}") for i in range(6000)]).repartition(2)
    blocks = byte_bpe.split_words(docs.select("doc_id", "text"), public_tokenizers.PATTERN, 1)
    assert blocks.where("kind = 0").agg(F.count_distinct("block")).first()[0] == 6000
    found = byte_bpe.decode(byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN, 1), ranks).collect()
    assert {r.doc_id: bytes(r.decoded).decode() for r in found} == {r.doc_id: r.text for r in docs.collect()}


def test_too_many_blocks_are_an_error(spark, documents, monkeypatch):
    monkeypatch.setattr(byte_bpe, "PART_BLOCK_BITS", 2)
    docs = documents([(i, "a b") for i in range(6)]).repartition(1).select("doc_id", "text")
    with pytest.raises(Exception, match="too many blocks"):
        byte_bpe.split_words(docs, public_tokenizers.PATTERN, 1).collect()


def test_query_equals_the_library(spark, ranks):
    whole = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    expected = set()
    for r in docs:
        ids = whole.encode_ordinary(r.text or "")
        digests = [hashlib.sha256(x).hexdigest() for x in (np.array(ids, "<u4").tobytes(), (r.text or "").encode())]
        expected.add((r.doc_id, len(ids), *digests))
    found = byte_bpe.op5_byte_bpe(spark, "/root/testdata/sf0.001").collect()
    assert {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found} == expected and len(found) == len(docs)


def test_empty_table_and_only_empty_texts(spark, none, documents, ranks):
    assert byte_bpe.encode(none, ranks, public_tokenizers.PATTERN).collect() == []
    found = byte_bpe.encode(documents([(1, None), (2, "")]), ranks, public_tokenizers.PATTERN).collect()
    assert sorted((r.doc_id, bytes(r.ids)) for r in found) == [(1, b""), (2, b"")]


@given(st.lists(st.integers(0, 2**32 - 1)))
def test_byte_planes_round_trip(values):
    assert byte_bpe.unpack(byte_bpe.pack(np.array(values, np.uint32))).tolist() == values


@given(st.lists(st.lists(st.integers(0, 255), max_size=4), min_size=1), st.data())
def test_gather(slices, data):
    codes = data.draw(st.lists(st.integers(0, len(slices) - 1)))
    values = np.array([x for s in slices for x in s], np.uint8)
    found = byte_bpe.gather(np.array(codes, np.int64), byte_bpe.offsets(map(len, slices)), values)
    assert found.tolist() == [x for c in codes for x in slices[c]]
