"""Packing: every id once, ids as the tokenizer gives them, sequences within the capacity."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from adtally.llm import packing
from adtally.llm.queries import op7_packing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def check(spark, tokenizer, documents, rows, capacity=packing.CAPACITY):
    texts = {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
    ends, by_doc = {}, {}
    for r in rows:
        ends.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append(r)
    for places in ends.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert by_doc.keys() == texts.keys()
    for doc_id, parts in by_doc.items():
        ids, at = ids_of(tokenizer, texts[doc_id]), 0
        for r in sorted(parts, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.asarray(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    return sum(r.length for r in rows) / (capacity * len(ends))


def test_query(spark, tokenizer):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    assert check(spark, tokenizer, documents, op7_packing(spark, SF).collect()) > 0.94


def test_odd_texts(spark, tokenizer):
    texts = [None, "", " ", "\n\n", "a", "Don't  'S it'LL\tgo\x1con \x85x", "é É İx ŉ", "x" * 5000, "<|startoftext|> b<|endoftext|>", "12 ½ Ⅷ", "the " * 9000]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 as length", "'z' as offset")
    rows = packing.packed_documents(documents).collect()
    check(spark, tokenizer, documents, rows)


def test_ids_and_repeated_rows(spark, tokenizer):
    documents = spark.createDataFrame([(7, "the same text")] * 30 + [(None, "no id")], "doc_id long, text string")
    placed = packing.packed_documents(documents, capacity=16, ids=True)
    sequences = packing.token_sequences(placed).collect()
    got = [i for s in sequences for i in np.frombuffer(s.ids, "<u4").tolist()]
    want = ids_of(tokenizer, "the same text") * 30 + ids_of(tokenizer, "no id")
    assert sorted(got) == sorted(want) and all(s.length * 4 == len(s.ids) <= 64 for s in sequences)


def test_empty_table(spark):
    assert packing.packed_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), min_size=1, max_size=60))
def test_windows_hold(lengths):
    lengths = np.array(lengths)
    window_of = packing.packed_block(lengths, 100)
    assert (window_of >= 0).all() and np.bincount(window_of, lengths).max() <= 100


def test_known_partition():
    """8, 7, 6, 5, 4 into two windows: differencing gives 16 and 14."""
    lengths = np.array([8, 7, 6, 5, 4])
    assert sorted(np.bincount(packing.differenced(lengths, 2), lengths)) == [14, 16]
